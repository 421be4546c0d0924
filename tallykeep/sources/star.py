"""Model over the star-schema tables: orders, lineitem, part, customer, nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.measures import cents_of, whole
from tallykeep.model import SalesModel
from tallykeep.session import stored_bytes, tune

# The columns in use. Stating them spares a job per table that would read file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def star_model(
    spark: SparkSession,
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
) -> SalesModel:
    """An order is an invoice, a part a track (genre: type, artist: brand).

    The billing country is the nation of the ordering customer, NULL when the
    customer is unknown. A part counts as a track when it has a type and a brand.
    Fractional quantities and fractions of a cent are refused when they are read.
    """
    headers = orders.select(
        F.col("o_orderkey").alias("InvoiceId"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_orderdate").cast("date").alias("dt"),
    )
    homes = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("CustomerId"), F.col("n_name").alias("country")
    )
    lines = lineitem.select(
        F.col("l_orderkey").alias("InvoiceId"),
        F.col("l_partkey").alias("TrackId"),
        whole(F.col("l_quantity"), "l_quantity").alias("qty"),
        cents_of(F.col("l_extendedprice"), "l_extendedprice").alias("cents"),
    )
    tracks = part.filter(F.col("p_type").isNotNull() & F.col("p_brand").isNotNull()).select(
        F.col("p_partkey").alias("TrackId"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("artist"),
    )
    return SalesModel(
        spark=spark,
        headers=headers,
        billed=headers.join(homes, "CustomerId", "left"),
        lines=lines,
        tracks=tracks,
        genres=tracks.select("genre").distinct(),
        artists=tracks.select("artist").distinct(),
        # Customers first lose their repeats, so a busy one is a single row in the join.
        countries=headers.select("CustomerId").distinct().join(homes, "CustomerId").select("country").distinct(),
        paired_dimensions=True,
    )


def read_star(spark: SparkSession, folder: str) -> SalesModel:
    """:func:`star_model` over ``<folder>/<table>.parquet``, session tuned to their size."""
    paths = {name: f"{folder.rstrip('/')}/{name}.parquet" for name in SCHEMAS}
    tune(spark, sum(stored_bytes(spark, path) for path in paths.values()))
    tables = {
        name: spark.read.schema(schema).parquet(paths[name]) for name, schema in SCHEMAS.items()
    }
    return star_model(spark, **tables)
