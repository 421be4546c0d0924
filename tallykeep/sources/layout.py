"""Optional stored layout for large data: facts bucketed by invoice.

Every operator joins lines to invoices. Stored this way, with genre and artist
already attached to the lines, neither that join nor the per-invoice aggregation
shuffles the lines any more, and the track join is paid once, on writing. A roll-up with
one row per invoice spares results without genre or artist the lines altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallykeep.model import SalesModel, rolled_up

DIMENSIONS = ("tracks", "genres", "artists", "countries")
PARTS = ("invoices", "lines", "rollup", *DIMENSIONS)


def _save(df: DataFrame, table: str, buckets: int | None) -> None:
    writer = df.write.format("parquet").mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, "InvoiceId").sortBy("InvoiceId")
    writer.saveAsTable(table)


def write_layout(model: SalesModel, prefix: str, buckets: int) -> None:
    """Store the model as the tables ``<prefix>_invoices``, ``<prefix>_lines`` ...

    Facts are first distributed by invoice, so that each bucket is one file.
    """
    invoices = model.invoices(country=True)
    lines = model.described_lines()
    _save(invoices.repartition(buckets, "InvoiceId"), f"{prefix}_invoices", buckets)
    _save(lines.repartition(buckets, "InvoiceId"), f"{prefix}_lines", buckets)
    # from the stored lines: the buckets are in place already, nothing is shuffled
    rollup = rolled_up(model.spark.table(f"{prefix}_lines"))
    _save(rollup.repartition(buckets, "InvoiceId"), f"{prefix}_rollup", buckets)
    for name in DIMENSIONS:
        _save(getattr(model, name), f"{prefix}_{name}", None)


def read_layout(spark: SparkSession, prefix: str, paired_dimensions: bool = False) -> SalesModel:
    tables = {name: spark.table(f"{prefix}_{name}") for name in PARTS}
    described = tables["lines"].select("InvoiceId", "TrackId", "qty", "cents", "genre", "artist")
    billed = tables["invoices"].select("InvoiceId", "CustomerId", "dt", "country")
    return SalesModel(
        spark=spark,
        headers=billed.drop("country"),
        billed=billed,
        lines=described.drop("genre", "artist"),
        tracks=tables["tracks"],
        genres=tables["genres"],
        artists=tables["artists"],
        countries=tables["countries"],
        paired_dimensions=paired_dimensions,
        described=described,
        rollup=tables["rollup"].select("InvoiceId", "num_lines", "qty", "cents", "usable"),
    )


def drop_layout(spark: SparkSession, prefix: str) -> None:
    for name in PARTS:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")
