"""Catalog sizes and the share of the catalog sold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange
from tallykeep.functions.measures import ratio
from tallykeep.model import SalesModel
from tallykeep.operators.filters import in_months
from tallykeep.operators.groups import ARTIST, GENRE, group_column
from tallykeep.operators.scope import Scope

CATALOG_VIEWS = {GENRE: "genre_catalog", ARTIST: "artist_catalog"}


def catalog(model: SalesModel, group: str) -> DataFrame:
    """genre (or artist), num_tracks; groups sharing a name are one."""
    name = group_column(group)
    return (
        model.tracks.filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("num_tracks"))
    )


def create_catalogs(model: SalesModel) -> None:
    """Publish both catalogs as temporary views, replacing earlier ones."""
    for group, view in CATALOG_VIEWS.items():
        catalog(model, group).createOrReplaceTempView(view)


def catalogs_exist(spark: SparkSession) -> bool:
    return all(spark.catalog.tableExists(view) for view in CATALOG_VIEWS.values())


def _sold_tracks(scope: Scope, date_range: DateRange | None) -> DataFrame:
    """TrackId of every known track sold, each once; unknown ones may be among them."""
    scope = scope.limited(date_range)
    invoices = in_months(scope.invoices_for_lines().select("InvoiceId", "dt"), date_range)
    lines = scope.model.lines.select("InvoiceId", "TrackId")
    return lines.join(invoices, "InvoiceId").select("TrackId").distinct()


def catalog_sales(scope: Scope, group: str, date_range: DateRange | None = None) -> DataFrame:
    """group_val, unique_tracks_sold, catalog_size, pct_catalog_sold for groups with sales.

    Lines are reduced to distinct tracks before they meet the dimension, and one
    pass over the dimension counts the tracks sold and the catalog together.
    """
    name = group_column(group)
    sold = _sold_tracks(scope, date_range).withColumn("sold", F.lit(True))
    return (
        scope.model.tracks.filter(F.col(name).isNotNull())
        .join(sold, "TrackId", "left")
        .groupBy(F.col(name).alias("group_val"))
        .agg(F.count("sold").alias("unique_tracks_sold"), F.count(F.lit(1)).alias("catalog_size"))
        .filter("unique_tracks_sold > 0")
        .withColumn("pct_catalog_sold", ratio(F.col("unique_tracks_sold"), F.col("catalog_size")))
    )


def enrich_with_catalog(df: DataFrame, sales: DataFrame) -> DataFrame:
    """Attach the columns of :func:`catalog_sales` to a frame with group_val."""
    return df.join(sales, "group_val", "left")
