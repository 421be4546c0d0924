"""Customer retention in a date window: bounds, derived measures, summary."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, bounds, months_between_calendar, within
from tallykeep.functions.display import format_kpi
from tallykeep.functions.measures import ratio
from tallykeep.operators.cohorts import best_cohorts
from tallykeep.operators.scope import Scope


def scope_dates(scope: Scope) -> tuple[Column, Column]:
    """First and last purchase date of the scope, as scalar subqueries."""
    invoices = scope.invoices()
    return (
        invoices.agg(F.min("dt").alias("start")).scalar(),
        invoices.agg(F.max("dt").alias("end")).scalar(),
    )


def window_ends(scope: Scope, date_range: DateRange | None) -> tuple[Column, Column]:
    if date_range is None:
        return scope_dates(scope)
    start, end = bounds(date_range)
    return F.lit(start), F.lit(end)


def customer_bounds(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """One row per customer with a purchase in the window; without an id there is no customer.

    first_date, second_date, last_date and total_purchases span all purchases of the
    scope; first_in_window, second_in_window, last_in_window and num_in_window those
    in the window; last_before_window and first_after_window enclose it.

    Purchases are counted per customer and day before any row moves to its customer,
    so a customer with very many invoices is no more than the days of the history.
    The day after a single-purchase day then holds the second purchase.
    """
    start, end = window_ends(scope, date_range)
    known = scope.invoices().filter(F.col("CustomerId").isNotNull())
    days = known.groupBy("CustomerId", "dt").agg(F.count(F.lit(1)).alias("n"))
    history = Window.partitionBy("CustomerId").orderBy("dt")
    days = days.withColumn(
        "second", F.when(F.col("n") > 1, F.col("dt")).otherwise(F.lead("dt").over(history))
    )
    dt, second = F.col("dt"), F.col("second")
    inside = dt.between(start, end)
    day_inside = F.when(inside, dt)
    return (
        days.groupBy("CustomerId")
        .agg(
            F.min("dt").alias("first_date"),
            F.min_by("second", "dt").alias("second_date"),
            F.max("dt").alias("last_date"),
            F.sum("n").alias("total_purchases"),
            F.min(day_inside).alias("first_in_window"),
            F.min_by(F.when(second <= end, second), day_inside).alias("second_in_window"),
            F.max(day_inside).alias("last_in_window"),
            F.sum(F.when(inside, F.col("n"))).alias("num_in_window"),
            F.max(F.when(dt < start, dt)).alias("last_before_window"),
            F.min(F.when(dt > end, dt)).alias("first_after_window"),
        )
        .filter("num_in_window > 0")
    )


def _days(later: str, earlier: str) -> Column:
    return F.datediff(later, earlier)


def customer_behaviour(customers: DataFrame, start: Column, end: Column) -> DataFrame:
    """Add the 14 derived measures to :func:`customer_bounds`.

    Lifespans are calendar months, gaps are days. ``repeat_conv`` holds for new
    customers who bought again in the window, and also for those who never came back
    after it.
    """
    n, total = F.col("num_in_window"), F.col("total_purchases")
    before, after = F.col("last_before_window"), F.col("first_after_window")
    first_in, last_in = F.col("first_in_window"), F.col("last_in_window")
    new = before.isNull()
    leaves = after.isNull()
    repeats = total > 1

    months_in_window = (
        F.when(~new & ~leaves, months_between_calendar(start, end))
        .when(new & ~leaves, months_between_calendar(first_in, end))
        .when(~new & leaves, months_between_calendar(start, last_in))
        .when(n > 1, months_between_calendar(first_in, last_in))
    )
    average_inside = ratio(_days("last_in_window", "first_in_window"), n - 1)
    average_bounded = (
        F.when(new & leaves, average_inside)
        .when(~new & ~leaves, ratio(_days("first_after_window", "last_before_window"), n + 1))
        .when(new, ratio(_days("first_after_window", "first_in_window"), n))
        .otherwise(ratio(_days("last_in_window", "last_before_window"), n))
    )
    return customers.withColumns(
        {
            "cust_new": new,
            "repeat_any": repeats,
            "repeat_ret": ~new,
            "repeat_conv": new & ((n > 1) | leaves),
            "repeat_window": n > 1,
            "lifespan_mo_total": F.when(
                repeats, months_between_calendar(F.col("first_date"), F.col("last_date"))
            ),
            "lifespan_mo_window": months_in_window,
            "gap_life": F.when(repeats, _days("second_date", "first_date")),
            "gap_window": _days("second_in_window", "first_in_window"),
            "gap_winback": _days("first_in_window", "last_before_window"),
            "gap_retention": _days("first_after_window", "last_in_window"),
            "avg_gap_life": ratio(_days("last_date", "first_date"), total - 1),
            "avg_gap_window": average_inside,
            "avg_gap_bound": average_bounded,
        }
    )


def behaviour_of(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """Bounds and derived measures per customer."""
    start, end = window_ends(scope, date_range)
    return customer_behaviour(customer_bounds(scope, date_range), start, end)


def behaviour_summary(behaviour: DataFrame) -> DataFrame:
    """The 20 retention KPIs in one row; no row without customers in the window.

    Medians are exact. Gaps are whole days, so each holds one counter per distinct
    number of days, not one value per customer.
    """
    totals = behaviour.agg(
        F.count(F.lit(1)).alias("num_cust"),
        F.count_if("cust_new").alias("num_new"),
        F.count_if("repeat_any").alias("ret_n_any"),
        F.count_if("repeat_ret").alias("ret_n_return"),
        F.count_if("repeat_conv").alias("ret_n_conv"),
        F.count_if("repeat_window").alias("ret_n_window"),
        F.avg("lifespan_mo_total").alias("avg_life_mo_tot"),
        F.avg("lifespan_mo_window").alias("avg_life_mo_win"),
        F.median("gap_life").alias("med_gap_life"),
        F.median("gap_window").alias("med_gap_window"),
        F.median("gap_winback").alias("med_gap_winback"),
        F.median("gap_retention").alias("med_gap_ret"),
        F.avg("avg_gap_life").alias("avg_gap_life"),
        F.avg("avg_gap_window").alias("avg_gap_window"),
        F.avg("avg_gap_bound").alias("avg_gap_bound"),
    )
    everyone, new = F.col("num_cust"), F.col("num_new")
    return totals.filter("num_cust > 0").select(
        "num_cust",
        "num_new",
        ratio(new, everyone).alias("pct_new"),
        "ret_n_any",
        ratio(F.col("ret_n_any"), everyone).alias("ret_rate_any"),
        "ret_n_return",
        ratio(F.col("ret_n_return"), everyone - new).alias("ret_rate_return"),
        "ret_n_conv",
        ratio(F.col("ret_n_conv"), new).alias("ret_rate_conv"),
        "ret_n_window",
        ratio(F.col("ret_n_window"), everyone).alias("ret_rate_window"),
        *totals.columns[6:],
    )


# The first pattern found in a KPI name decides its display kind.
SUMMARY_KINDS = ((r"pct|rate", "percent"), (r"life|avg|gap|med", "float"))


def summary_kind(name: str) -> str:
    return next((kind for pattern, kind in SUMMARY_KINDS if re.search(pattern, name)), "number")


def format_summary(summary: DataFrame) -> DataFrame:
    """The summary with every KPI as display text."""
    return summary.select(
        *[format_kpi(F.col(name), summary_kind(name)).alias(name) for name in summary.columns]
    )


def retention_kpis(
    scope: Scope,
    date_range: DateRange | None,
    cohorts: DataFrame,
    offsets: Sequence[int] = (3, 6, 9),
) -> DataFrame:
    """The retention card: 20 KPIs and the best cohorts, all as text, in one row.

    Without a range the window spans the scope. No row without customers in it.
    """
    summary = format_summary(behaviour_summary(behaviour_of(scope, date_range)))
    best = best_cohorts(cohorts, offsets)
    return beside(summary, best).filter(F.col("num_cust").isNotNull())


def beside(*blocks: DataFrame) -> DataFrame:
    """Blocks of at most one row each, put next to each other in one row."""
    stacked = blocks[0]
    for block in blocks[1:]:
        stacked = stacked.unionByName(block, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
