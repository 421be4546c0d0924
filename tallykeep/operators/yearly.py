"""Yearly KPIs by genre or artist, and the frame behind the stacked bar chart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange
from tallykeep.functions.measures import money, ratio, total_cents
from tallykeep.operators.catalog import catalog
from tallykeep.operators.filters import in_days
from tallykeep.operators.groups import group_column
from tallykeep.operators.scope import Scope


def _customer_side(scope: Scope, name: str, date_range: DateRange) -> DataFrame:
    """Per year and group: customers, purchases, countries, tracks, revenue.

    Lines shrink to invoices, then to one row per (year, group, customer, country).
    The window sees those rows only, in that order: the first row of a year and group
    stands for the customer when customers are counted, which leaves the country as
    the single distinct count. Purchases without a customer id stand for no customer.
    """
    scope = scope.limited(date_range)
    invoices = in_days(scope.invoices_for_lines(country=True), date_range)
    lines = scope.model.lines_of(invoices).withColumn("group_val", F.col(name))
    per_invoice = (
        lines.filter(F.col("group_val").isNotNull())
        .groupBy("InvoiceId", "country", "group_val")
        .agg(
            F.min("CustomerId").alias("CustomerId"),
            F.min(F.year("dt")).alias("year"),
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
        )
    )
    per_customer = per_invoice.groupBy("CustomerId", "year", "group_val", "country").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum("qty").alias("qty"),
        F.sum("cents").alias("cents"),
    )
    # the rows without an id have no order among them, so they need not meet in one task
    apart = F.when(F.col("CustomerId").isNull(), F.struct("year", "group_val"))
    ordered = Window.partitionBy("CustomerId", apart).orderBy("year", "group_val", "country")
    previous = F.lag(F.struct("year", "group_val")).over(ordered)
    return (
        per_customer.withColumns(
            {"previous": previous, "first_time": F.col("year") == F.first("year").over(ordered)}
        )
        .withColumn(
            "stands",
            F.col("CustomerId").isNotNull()
            & F.coalesce(F.col("previous") != F.struct("year", "group_val"), F.lit(True)),
        )
        .groupBy("year", "group_val")
        .agg(
            F.count_if("stands").alias("num_customers"),
            F.sum("purchases").alias("num_purchases"),
            F.count_distinct("country").alias("num_countries"),
            F.sum("qty").alias("tracks_sold"),
            money(total_cents(F.col("cents"))).alias("revenue"),
            F.count_if(F.col("stands") & F.col("first_time")).alias("first_time_customers"),
        )
    )


def _track_side(scope: Scope, name: str, date_range: DateRange) -> DataFrame:
    """Per year and group: distinct tracks sold, and those sold for the first time.

    Lines shrink to one row per (track, year) before they meet the dimension, where
    those of unknown tracks drop out.
    """
    scope = scope.limited(date_range)
    invoices = in_days(scope.invoices_for_lines(), date_range).select(
        "InvoiceId", F.year("dt").alias("year")
    )
    sold = (
        scope.model.lines.select("InvoiceId", "TrackId")
        .join(invoices, "InvoiceId")
        .select("TrackId", "year")
        .distinct()
    )
    first_year = F.min("year").over(Window.partitionBy("TrackId"))
    tracks = scope.model.tracks.filter(F.col(name).isNotNull())
    return (
        sold.withColumn("first_sale", F.col("year") == first_year)
        .join(tracks.select("TrackId", F.col(name).alias("group_val")), "TrackId")
        .groupBy("year", "group_val")
        .agg(
            F.count(F.lit(1)).alias("unique_tracks_sold"),
            F.count_if("first_sale").alias("first_tracks_sold"),
        )
    )


def yearly_summary(scope: Scope, group: str, date_range: DateRange) -> DataFrame:
    """One row per year and genre (or artist), named after the group.

    first_time_customers and first_tracks_sold compare the year with the first year
    of the customer or track in the range, over all groups.
    """
    name = group_column(group)
    sizes = catalog(scope.model, group).select(
        F.col(name).alias("group_val"), F.col("num_tracks").alias("catalog_size")
    )
    return (
        _customer_side(scope, name, date_range)
        .join(_track_side(scope, name, date_range), ["year", "group_val"])
        .join(sizes, "group_val", "left")
        .select(
            F.col("year").cast("string").alias("year"),
            F.col("group_val").alias(name),
            "num_customers",
            "num_purchases",
            "num_countries",
            "tracks_sold",
            "revenue",
            "first_time_customers",
            "unique_tracks_sold",
            "first_tracks_sold",
            "catalog_size",
        )
    )


def top_group_bars(yearly: DataFrame, group: str, metric: str = "revenue", max_n: int = 15) -> DataFrame:
    """The yearly rows of the ``max_n`` groups with the highest total metric.

    Adds total_metric, revenue_per_catalog_track and pct_catalog_sold. Equal totals
    rank by the first year a group appears in, then by name. A group's rows (one per
    year) travel together, so ranking needs no second pass over the input.
    """
    name = group_column(group)
    if dict(yearly.dtypes)[metric] == "double":
        # money: summed in whole cents, so the total does not depend on the order of rows
        total = F.sum(F.col(metric).cast("decimal(28,2)")).cast("double")
    else:
        total = F.sum(metric)
    by_group = (
        yearly.groupBy(name)
        .agg(
            F.coalesce(total, F.lit(0)).alias("total_metric"),
            F.min("year").alias("first_year"),
            F.collect_list(F.struct(*yearly.columns)).alias("rows"),
        )
        .orderBy(F.desc("total_metric"), "first_year", name)
        .limit(max_n)
    )
    return (
        by_group.select("total_metric", F.explode("rows").alias("row"))
        .select("row.*", "total_metric")
        .withColumn("revenue_per_catalog_track", ratio(F.col("revenue"), F.col("catalog_size")))
        .withColumn("pct_catalog_sold", ratio(F.col("unique_tracks_sold"), F.col("catalog_size")))
    )
