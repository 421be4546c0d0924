"""Filter choices and the dataset overview table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.functions.display import format_kpi, month_label
from tallykeep.model import SalesModel
from tallykeep.operators.behaviour import beside
from tallykeep.operators.core import core_kpis
from tallykeep.operators.scope import all_invoices


def date_limits(model: SalesModel) -> DataFrame:
    """min_date, max_date over all invoices."""
    return model.invoices().agg(F.min("dt").alias("min_date"), F.max("dt").alias("max_date"))


def filter_choices(model: SalesModel) -> DataFrame:
    """kind (genre, artist, country), value: every name a filter can offer.

    Genres and artists come from the dimension, sold or not; countries from invoices.
    """
    lists = {"genre": model.genres, "artist": model.artists, "country": model.countries}
    frames = [
        frame.select(F.lit(kind).alias("kind"), F.col(kind).alias("value"))
        for kind, frame in lists.items()
    ]
    stacked = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return stacked.filter(F.col("value").isNotNull())


def filter_meta(model: SalesModel) -> DataFrame:
    """:func:`filter_choices` with the date limits as rows min_date and max_date."""
    limits = date_limits(model).select(
        F.explode(
            F.array(
                F.struct(F.lit("min_date").alias("kind"), F.col("min_date").cast("string").alias("value")),
                F.struct(F.lit("max_date").alias("kind"), F.col("max_date").cast("string").alias("value")),
            )
        ).alias("row")
    )
    return limits.select("row.*").unionByName(filter_choices(model))


def dataset_overview(model: SalesModel) -> DataFrame:
    """position, metric, value: eight facts about all data, as text.

    A single row says so when nothing was sold.
    """
    choices = filter_choices(model).agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in ("genre", "artist", "country")]
    )
    facts = beside(date_limits(model), core_kpis(all_invoices(model)), choices)
    span = F.concat_ws(" – ", month_label(F.col("min_date")), month_label(F.col("max_date")))
    entries = [
        ("Date Range", span),
        ("Number of Purchases", format_kpi(F.col("total_orders"), "number")),
        ("Number of Customers", format_kpi(F.col("total_customers"), "number")),
        ("Tracks Sold", format_kpi(F.col("total_tracks"), "number")),
        ("Revenue (USD$)", format_kpi(F.col("total_revenue"), "dollar")),
        ("Number of Genres", format_kpi(F.col("n_genre"), "number")),
        ("Number of Artists", format_kpi(F.col("n_artist"), "number")),
        ("Number of Countries", format_kpi(F.col("n_country"), "number")),
    ]

    def row(position: int, metric: str, value):
        return F.struct(F.lit(position).alias("position"), F.lit(metric).alias("metric"), value.alias("value"))

    filled = F.array(*[row(i, name, value) for i, (name, value) in enumerate(entries, start=1)])
    missing = F.array(row(1, "Summary", F.lit("No data available")))
    rows = F.when(F.col("total_revenue").isNull(), missing).otherwise(filled)
    return facts.select(F.explode(rows).alias("row")).select("row.*")
