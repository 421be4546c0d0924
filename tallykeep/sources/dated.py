"""Stored layout for dated reports: facts partitioned by month, lines sorted for skipping.

``<folder>/invoices`` holds an invoice per row with its country and what its lines add up
to, ``<folder>/lines`` the lines with genre and artist, both in a partition per month.
A report of some months names them, so neither fact is read beyond (``PartitionFilters``).

Lines are dealt to files by ranges of (month, genre, artist) and sorted so inside; row
groups then hold few genres and artists, and their statistics and Parquet bloom filters let
a filter on either skip the others. The range ends in a hash of the line, so a genre,
artist or invoice with very many lines spreads over several files.

``<folder>/customers`` holds each customer's first dates, which first-time figures need from
before the report's months.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, month_index, whole_months
from tallykeep.model import SalesModel, rolled_up
from tallykeep.session import MEGABYTE, stored_bytes

# Stored bytes of a file of lines, about, and of a row group, the unit of skipping. A task sorts
# the lines of a file, as rows ten times their stored size and more.
FILE_BYTES = 32 * MEGABYTE
GROUP_BYTES = 16 * MEGABYTE
# Distinct genres or artists of a row group its bloom filter is made for.
BLOOM_VALUES = 10_000

SCHEMAS = {
    "invoices": "InvoiceId bigint, CustomerId bigint, dt date, country string, num_lines bigint, qty bigint, "
    "cents bigint, usable boolean, month int",
    "lines": "InvoiceId bigint, TrackId bigint, qty bigint, cents bigint, genre string, artist string, month int",
    "customers": "CustomerId bigint, first_any date, first_usable date",
    "tracks": "TrackId bigint, genre string, artist string",
    "genres": "genre string",
    "artists": "artist string",
    "countries": "country string",
}
DIMENSIONS = ("tracks", "genres", "artists", "countries")


def line_ranges(stored: int, least: int = 1) -> int:
    """Ranges of lines for so many stored bytes of them, so that none grows with the data."""
    return max(least, math.ceil(stored / FILE_BYTES))


def write_dated(
    model: SalesModel, folder: str, line_files: int | None = None, group_bytes: int = GROUP_BYTES
) -> None:
    """Store a model below ``folder``, replacing what is there.

    ``line_files`` is the number of ranges of lines, by default as many as their stored size asks for;
    it is the only figure here that should grow with the data (see :func:`line_ranges`).
    """
    spark = model.spark
    folder = folder.rstrip("/")
    month = month_index(F.col("dt")).cast("int").alias("month")
    billed = model.invoices(country=True).select("InvoiceId", "CustomerId", "dt", "country", month)
    lines = model.described_lines().join(billed.select("InvoiceId", "month"), "InvoiceId")
    lines = _in(lines, "lines")
    if line_files is None:
        lines.write.mode("overwrite").parquet(f"{folder}/unsorted")
        lines = _read(spark, folder, "unsorted", SCHEMAS["lines"])
        line_files = line_ranges(stored_bytes(spark, f"{folder}/unsorted"))
    order = ["month", "genre", "artist"]
    spread = F.xxhash64("InvoiceId", "TrackId")
    ranged = lines.repartitionByRange(line_files, *order, spread).sortWithinPartitions(*order)
    writer = ranged.write.mode("overwrite").partitionBy("month").option("parquet.block.size", group_bytes)
    for name in ("genre", "artist"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", BLOOM_VALUES)
    writer.parquet(f"{folder}/lines")

    totals = rolled_up(_read(spark, folder, "lines"))
    summed = _in(billed.join(totals, "InvoiceId", "left"), "invoices")
    # a month is in few tasks, a large one is split by its measured size
    summed.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{folder}/invoices")
    first_usable = F.min(F.when(F.col("usable"), F.col("dt"))).alias("first_usable")
    known = _read(spark, folder, "invoices").filter(F.col("CustomerId").isNotNull())
    known.groupBy("CustomerId").agg(F.min("dt").alias("first_any"), first_usable).write.mode("overwrite").parquet(
        f"{folder}/customers"
    )
    for name in DIMENSIONS:
        _in(getattr(model, name), name).write.mode("overwrite").parquet(f"{folder}/{name}")


def _in(frame: DataFrame, table: str) -> DataFrame:
    """The stored columns of a table, in their order and types."""
    return frame.select(*[F.col(name).cast(kind) for name, kind in (part.split() for part in SCHEMAS[table].split(", "))])


def _read(spark: SparkSession, folder: str, table: str, schema: str | None = None) -> DataFrame:
    return spark.read.schema(schema or SCHEMAS[table]).parquet(f"{folder}/{table}")


def read_dated(spark: SparkSession, folder: str, paired_dimensions: bool = False) -> SalesModel:
    """The model stored below ``folder``; ``limit`` narrows its facts to the months of a range."""
    folder = folder.rstrip("/")
    tables = {name: _read(spark, folder, name) for name in SCHEMAS}

    def model(months: Column | None) -> SalesModel:
        summed, described = tables["invoices"], tables["lines"]
        if months is not None:
            summed, described = summed.filter(months), described.filter(months)
        summed, described = summed.drop("month"), described.drop("month")
        billed = summed.select("InvoiceId", "CustomerId", "dt", "country")
        return SalesModel(
            spark=spark,
            headers=billed.drop("country"),
            billed=billed,
            lines=described.drop("genre", "artist"),
            **{name: tables[name] for name in DIMENSIONS},
            paired_dimensions=paired_dimensions,
            described=described,
            summed=summed,
            firsts=tables["customers"],
        )

    def limit(date_range: DateRange) -> SalesModel:
        start, end = whole_months(date_range)
        first, last = (day.year * 12 + day.month - 1 for day in (start, end))
        return model(F.col("month").between(first, last))

    return replace(model(None), limit=limit)
