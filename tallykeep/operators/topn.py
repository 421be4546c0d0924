"""Top-N tables per metric, derived ratios and display columns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.countries import country_dimension, with_flag
from tallykeep.functions.display import format_kpi
from tallykeep.functions.measures import cents, money, ratio, total_cents
from tallykeep.operators.groups import COUNTRY


@dataclass(frozen=True)
class Metric:
    name: str
    label: str


METRICS = (
    Metric("revenue", "Revenue (USD$)"),
    Metric("num_customers", "Number of Customers"),
    Metric("first_time_customers", "First-Time Customers"),
    Metric("num_purchases", "Number of Purchases"),
    Metric("tracks_sold", "Tracks Sold"),
)


def metric_definitions(extra: Iterable[Metric] = ()) -> tuple[Metric, ...]:
    """The selectable metrics, optionally followed by others."""
    return METRICS + tuple(extra)


def top_groups(df: DataFrame, metric: str, n: int = 5) -> DataFrame:
    """The ``n`` rows with the highest metric; ties go to the lower group_val."""
    return (
        df.filter(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), F.asc("group_val"))
        .limit(n)
    )


def top_groups_by_metric(
    df: DataFrame, metrics: Sequence[Metric] = METRICS, n: int = 5
) -> DataFrame:
    """:func:`top_groups` for every metric in one long frame.

    Adds metric, rank and value (double) to the columns of ``df``. Each task keeps
    only its own best ``n`` rows per metric before the shuffle.
    """
    choices = F.array(
        *[
            F.struct(F.lit(m.name).alias("metric"), F.col(m.name).cast("double").alias("value"))
            for m in metrics
        ]
    )
    ranked = Window.partitionBy("metric").orderBy(F.desc("value"), F.asc("group_val"))
    return (
        df.withColumn("choice", F.explode(choices))
        .select(*df.columns, "choice.metric", "choice.value")
        .filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= n)
    )


# The first pattern found in a column name decides its display kind.
DISPLAY_KINDS = (
    (r"percent|pct", "percent"),
    (r"share", "percent"),
    (r"revenue", "dollar"),
    (r"avg_tracks_", "float"),
    (r"tracks|purchases|customers|orders|catalog", "number"),
)


def display_kind(column: str) -> str:
    return next((kind for pattern, kind in DISPLAY_KINDS if re.search(pattern, column)), "float")


def with_ratios(df: DataFrame, total_revenue: Column | float | None = None) -> DataFrame:
    """Add averages per customer and purchase, and the share of revenue.

    The share is taken of ``total_revenue`` (a number or a scalar subquery). Without
    one it is taken of the rows given, within each metric if there are several.
    """
    if total_revenue is None and "metric" in df.columns:
        whole = F.sum("revenue").over(Window.partitionBy("metric"))
    elif total_revenue is None:
        # summed in every task first; a window over all rows would gather them in one
        whole = df.agg(money(total_cents(cents(F.col("revenue")))).alias("whole")).scalar()
    else:
        whole = total_revenue if isinstance(total_revenue, Column) else F.lit(total_revenue)
    return df.withColumns(
        {
            "avg_revenue_per_cust": ratio(F.col("revenue"), F.col("num_customers")),
            "avg_revenue_per_purchase": ratio(F.col("revenue"), F.col("num_purchases")),
            "avg_tracks_per_purchase": ratio(F.col("tracks_sold"), F.col("num_purchases")),
            "revenue_share": ratio(F.col("revenue"), whole),
        }
    )


def format_top_groups(
    df: DataFrame,
    group: str,
    total_revenue: Column | float | None = None,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Add ratios and one ``<column>_fmt`` text per numeric column.

    For countries, ``group_label`` adds flag and name; group_val stays as it is.
    Meant for top-N rows, not for a whole group table.
    """
    plain = {"group_val", "metric", "rank", "value"}
    wide = with_ratios(df, total_revenue)
    texts = {
        f"{name}_fmt": format_kpi(F.col(name), display_kind(name))
        for name in wide.columns
        if name not in plain
    }
    wide = wide.withColumns(texts)
    if group == COUNTRY:
        known = dimension if dimension is not None else country_dimension(df.sparkSession)
        wide = with_flag(wide, "group_val", known, "group_label", label=True)
    return wide
