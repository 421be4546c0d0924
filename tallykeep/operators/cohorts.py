"""Cohort retention: matrix, decay curve, dense grid, best cohorts.

A customer's cohort is the month of their first purchase in the full invoice data,
whatever the filter; activity comes from the scope.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, elapsed_months, month_index, month_start, within
from tallykeep.functions.display import format_kpi, month_label
from tallykeep.functions.measures import ratio
from tallykeep.operators.scope import Scope

def _customer_months(scope: Scope, date_range: DateRange | None) -> DataFrame:
    """One row per customer and month with any purchase in the full data.

    cohort (month index), month_offset, active (a purchase of the scope in the range),
    and first/last date of the scope's purchases in that month.

    The scope is stacked on the full data and both are reduced to customer months in
    one shuffle, instead of joining them; the window sees a customer's months only.
    Purchases without a customer id belong to no cohort and are nobody's activity; only
    their dates count, for the months the scope spans.
    """
    everything = scope.model.invoices().select("CustomerId", "dt")
    if scope.flt is None:
        stacked = everything.withColumn("scope_dt", F.col("dt"))
    else:
        chosen = scope.invoices().select("CustomerId", "dt", F.col("dt").alias("scope_dt"))
        stacked = everything.withColumn("scope_dt", F.lit(None).cast("date")).unionByName(chosen)
    in_range = F.lit(True) if date_range is None else within(F.col("scope_dt"), date_range)
    someone = F.col("CustomerId").isNotNull()
    active = someone & F.col("scope_dt").isNotNull() & in_range
    per_month = stacked.groupBy("CustomerId", month_index(F.col("dt")).alias("month")).agg(
        F.max(F.coalesce(active, F.lit(False))).alias("active"),
        F.min("scope_dt").alias("scope_from"),
        F.max("scope_dt").alias("scope_to"),
    )
    cohort = F.min("month").over(Window.partitionBy("CustomerId"))
    return per_month.withColumn("cohort", F.when(someone, cohort)).withColumn(
        "month_offset", F.col("month") - F.col("cohort")
    )


def _limited(report: DataFrame, max_offset: int | None) -> DataFrame:
    """One row: the rows of a report up to the limit, by default the months the scope spans.

    A report has at most one row per (cohort, offset), whatever the data size, so it
    travels as one array and the limit needs no second pass over the data.
    """
    packed = report.agg(
        F.min("scope_from").alias("scope_from"),
        F.max("scope_to").alias("scope_to"),
        F.collect_list(F.struct(*report.columns)).alias("rows"),
    )
    if max_offset is None:
        limit = elapsed_months(F.col("scope_from"), F.col("scope_to"))
    else:
        limit = F.lit(max_offset)
    return packed.select(
        F.filter("rows", lambda row: row["month_offset"] <= limit).alias("rows")
    )


def cohort_retention(
    scope: Scope, date_range: DateRange | None, max_offset: int | None = None
) -> DataFrame:
    """cohort_month, month_offset, num_active_customers, cohort_size, retention_pct.

    Sizes count every customer of the cohort: each has exactly one row at offset 0,
    which is within any limit.
    """
    report = _customer_months(scope, date_range).groupBy("cohort", "month_offset").agg(
        F.count("CustomerId").alias("customers"),
        F.count_if("active").alias("num_active_customers"),
        F.min("scope_from").alias("scope_from"),
        F.max("scope_to").alias("scope_to"),
    )
    size = F.max(F.when(F.col("month_offset") == 0, F.col("customers")))
    return (
        _limited(report, max_offset)
        .select(F.inline("rows"))
        .withColumn("cohort_size", size.over(Window.partitionBy("cohort")))
        .filter("month_offset > 0 AND num_active_customers > 0")
        .select(
            month_start(F.col("cohort")).alias("cohort_month"),
            "month_offset",
            "num_active_customers",
            "cohort_size",
            ratio(F.col("num_active_customers"), F.col("cohort_size")).alias("retention_pct"),
        )
    )


def retention_decay(
    scope: Scope, date_range: DateRange | None, max_offset: int | None = None
) -> DataFrame:
    """month_offset, num_retained, num_customers, retention_rate.

    The base is everyone active in the range at an offset within the limit, including
    offset 0. Each customer is counted once for it, at their lowest active offset.
    """
    lowest = F.min(F.when(F.col("active"), F.col("month_offset"))).over(
        Window.partitionBy("CustomerId")
    )
    report = (
        _customer_months(scope, date_range)
        .withColumn("lowest", F.col("active") & (F.col("month_offset") == lowest))
        .groupBy("month_offset")
        .agg(
            F.count_if("active").alias("num_retained"),
            F.count_if("lowest").alias("entering"),
            F.min("scope_from").alias("scope_from"),
            F.max("scope_to").alias("scope_to"),
        )
    )
    base = F.aggregate("rows", F.lit(0).cast("bigint"), lambda total, row: total + row["entering"])
    return (
        _limited(report, max_offset)
        .select(base.alias("num_customers"), F.explode("rows").alias("row"))
        .select("row.*", "num_customers")
        .filter("month_offset > 0 AND num_retained > 0")
        .select(
            "month_offset",
            "num_retained",
            "num_customers",
            ratio(F.col("num_retained"), F.col("num_customers")).alias("retention_rate"),
        )
    )


def cohort_grid(cohorts: DataFrame) -> DataFrame:
    """Every cohort month and every offset between the observed ends; gaps are NULL.

    The cohort frame is a report (months x months), the grid no larger than that.
    """
    ends = cohorts.agg(
        F.min("cohort_month").alias("from_month"),
        F.max("cohort_month").alias("to_month"),
        F.min("month_offset").alias("from_offset"),
        F.max("month_offset").alias("to_offset"),
    ).filter(F.col("from_month").isNotNull())
    grid = ends.select(
        F.explode(F.expr("sequence(from_month, to_month, interval 1 month)")).alias("cohort_month"),
        "from_offset",
        "to_offset",
    ).select("cohort_month", F.explode(F.sequence("from_offset", "to_offset")).alias("month_offset"))
    return grid.join(cohorts, ["cohort_month", "month_offset"], "left")


def best_cohorts(cohorts: DataFrame, offsets: Sequence[int] = (3, 6, 9), *by: str) -> DataFrame:
    """One row, or one per value of ``by``: per offset the month and percentage of the best cohort, as text.

    Equal percentages go to the earlier cohort; an offset without a cohort is NULL.
    """
    ranked = F.struct((-F.col("retention_pct")).alias("order"), "cohort_month", "retention_pct")
    usable = F.col("retention_pct").isNotNull()
    found = cohorts.groupBy(*by).agg(
        *[
            F.min(F.when((F.col("month_offset") == k) & usable, ranked)).alias(f"best_{k}")
            for k in offsets
        ]
    )
    shown = [F.col(name) for name in by]
    for k in offsets:
        best = F.col(f"best_{k}")
        text = format_kpi(best.getField("retention_pct"), "percent")
        shown.append(month_label(best.getField("cohort_month")).alias(f"top_cohort_month_{k}"))
        shown.append(F.when(best.isNotNull(), text).alias(f"top_cohort_retention_{k}"))
    return found.select(*shown)
