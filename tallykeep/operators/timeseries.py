"""Monthly trend and its overview card."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, elapsed_months_of, within
from tallykeep.functions.display import format_kpi
from tallykeep.functions.measures import money, ratio, total_cents
from tallykeep.operators.scope import Scope


def monthly_summary(scope: Scope, date_range: DateRange) -> DataFrame:
    """month, num_purchases, num_customers, tracks_sold, revenue, first_time_customers.

    First-time customers bought in the month of their first purchase in the whole
    scope, which may lie before the range; where the store knows that date, only the
    range's months are read. Purchases without a customer id are not part
    of the report. Customers are reduced to one row per
    month first; the window looks for the first of those rows.
    """
    sold = F.col("num_lines").isNotNull() & within(F.col("dt"), date_range)
    firsts = scope.first_dates()
    rows = scope.invoices(totals=True) if firsts is None else scope.limited(date_range).invoices(totals=True)
    per_month = (
        rows.filter(F.col("CustomerId").isNotNull())
        .groupBy("CustomerId", F.trunc("dt", "MM").alias("month"))
        .agg(
            F.count_if(sold).alias("purchases"),
            F.sum(F.when(sold, F.col("qty"))).alias("qty"),
            F.sum(F.when(sold, F.col("cents"))).alias("cents"),
        )
    )
    if firsts is None:
        first_month = F.min("month").over(Window.partitionBy("CustomerId"))
    else:
        per_month, first_month = per_month.join(firsts, "CustomerId"), F.trunc("first_dt", "MM")
    return (
        per_month.withColumn("first_time", F.col("month") == first_month)
        .filter("purchases > 0")
        .groupBy("month")
        .agg(
            F.sum("purchases").alias("num_purchases"),
            F.count("CustomerId").alias("num_customers"),
            F.sum("qty").alias("tracks_sold"),
            money(total_cents(F.col("cents"))).alias("revenue"),
            F.count_if("first_time").alias("first_time_customers"),
        )
        .withColumn("month", F.date_format("month", "yyyy-MM"))
    )


def overview(core: DataFrame, date_range: DateRange) -> DataFrame:
    """The seven display values of the trend card, from :func:`core.core_kpis`.

    Revenue per month divides by the whole months in the range plus one.
    """
    months = elapsed_months_of(date_range) + 1
    revenue = F.col("total_revenue")
    return core.select(
        format_kpi(revenue, "dollar").alias("total_rev"),
        format_kpi(ratio(revenue, F.lit(months)), "dollar").alias("avg_rev"),
        format_kpi(F.col("total_orders"), "number").alias("total_purchases"),
        format_kpi(F.col("total_tracks"), "number").alias("total_tracks"),
        format_kpi(F.col("avg_rev_per_order"), "dollar").alias("avg_per_purchase"),
        format_kpi(F.col("total_customers"), "number").alias("total_customers"),
        format_kpi(F.col("pct_new_customers"), "percent").alias("first_time_pct"),
    )
