"""KPIs by country, per year and over all years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.countries import with_iso3
from tallykeep.functions.dates import DateRange, bounds
from tallykeep.functions.measures import money, ratio, total_cents
from tallykeep.operators.filters import in_days
from tallykeep.operators.scope import Scope

ALL_YEARS = "All"
MODES = ("yearly", "aggregate", "both")


def _months_of_year(year: Column, date_range: DateRange) -> Column:
    """Months of the range in a calendar year.

    In the first year they run to December even if the range ends earlier.
    """
    start, end = bounds(date_range)
    return (
        F.when(year == str(start.year), 13 - start.month)
        .when(year == str(end.year), end.month)
        .when(year != ALL_YEARS, 12)
    )


def geo_metrics(scope: Scope, date_range: DateRange, mode: str = "yearly") -> DataFrame:
    """year, num_months, country and the KPIs; year is 'All' for the aggregate.

    First-time customers bought there on their first day in the range. Purchases without
    a customer id are not part of the report. A customer
    is reduced to one row per country and year; the row of their first year there
    is marked, so the totals over all years are plain sums of the yearly ones.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    sold = in_days(scope.limited(date_range).invoices(country=True, totals=True), date_range)
    per_customer = (
        sold.filter(F.col("num_lines").isNotNull() & F.col("CustomerId").isNotNull())
        .groupBy("CustomerId", "country", F.year("dt").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
            F.min("dt").alias("first_here"),
        )
    )
    everywhere = Window.partitionBy("CustomerId")
    here = Window.partitionBy("CustomerId", "country")
    yearly = (
        per_customer.withColumn("first_year", F.col("year") == F.min("year").over(here))
        .withColumn("first_time", F.col("first_here") == F.min("first_here").over(everywhere))
        .groupBy("country", "year")
        .agg(
            F.count("CustomerId").alias("customers"),
            F.count_if("first_year").alias("arrivals"),
            F.sum("purchases").alias("purchases"),
            F.sum("qty").alias("qty"),
            total_cents(F.col("cents")).alias("cents"),
            F.count_if("first_time").alias("first_time"),
        )
    )
    labels = {
        "yearly": [F.col("year").cast("string")],
        "aggregate": [F.lit(ALL_YEARS)],
        "both": [F.col("year").cast("string"), F.lit(ALL_YEARS)],
    }[mode]
    customers = F.when(F.col("year") == ALL_YEARS, F.col("arrivals")).otherwise(F.col("customers"))
    return (
        yearly.withColumn("year", F.explode(F.array(*labels)))
        .groupBy("year", "country")
        .agg(
            F.sum(customers).alias("num_customers"),
            F.sum("purchases").alias("num_purchases"),
            F.sum("qty").alias("tracks_sold"),
            money(F.sum("cents")).alias("revenue"),
            F.sum("first_time").alias("first_time_customers"),
        )
        .select(
            "year",
            _months_of_year(F.col("year"), date_range).alias("num_months"),
            "country",
            "num_customers",
            "num_purchases",
            "tracks_sold",
            "revenue",
            "first_time_customers",
        )
    )


def map_frames(scope: Scope, date_range: DateRange, dimension: DataFrame) -> DataFrame:
    """Both modes with alpha-3 code and revenue per customer; unknown countries drop out."""
    return (
        with_iso3(geo_metrics(scope, date_range, "both"), "country", dimension, "iso_alpha")
        .filter(F.col("iso_alpha").isNotNull())
        .withColumn("revenue_per_customer", ratio(F.col("revenue"), F.col("num_customers")))
    )
