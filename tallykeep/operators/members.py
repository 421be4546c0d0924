"""Who and what was sold per month and group, as bitmaps that merge.

One pass over the lines leaves, per month and genre (or artist), bitmaps of the invoices,
customers and tracks, the countries by name, and the sums of the lines. Distinct counts of
any run of months are then bit counts of united bitmaps: no line is read again, nothing is
counted by listing it, and no window is used. Summaries merge, so new lines are summarised
on their own and added.

A bitmap is a word of 64 neighbouring ids, so a row is as small for ids that are few or far
apart as for dense ones, and a task holds numbers, not blocks of bytes. Ids may be zero or
negative. Undated invoices and lines without a group are in no month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, bounds, month_index, whole_months
from tallykeep.functions.measures import money, total_cents
from tallykeep.operators.catalog import catalog
from tallykeep.operators.groups import group_column
from tallykeep.operators.scope import Scope

INVOICE, CUSTOMER, TRACK, BILLED = "invoice", "customer", "track", "country"

SCHEMA = "group_val string, kind string, word bigint, name string, bits bigint, qty bigint, cents bigint, month int"

_KEYS = ("month", "group_val", "kind", "word", "name")

# Ids of a word are those with the same upper bits.
_WORD_BITS = 6


def _entry(kind: str, number: Column | None = None, name: Column | None = None, sums: bool = False) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        (F.lit(None) if number is None else number).cast("bigint").alias("id"),
        (F.lit(None) if name is None else name).cast("string").alias("name"),
        (F.col("qty") if sums else F.lit(0)).cast("bigint").alias("qty"),
        (F.col("cents") if sums else F.lit(0)).cast("bigint").alias("cents"),
    )


def _bit(number: Column) -> Column:
    """The word with the bit of an id only."""
    place = number.bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def summarise(scope: Scope, group: str) -> DataFrame:
    """One row per month, group, kind and word of ids, or name of a country.

    The sums of the lines stand at the words of their invoices. Repeated ids fold in
    each task before the only shuffle, so a hot customer or track is one row per task.
    """
    invoices = scope.invoices_for_lines(country=True).filter(F.col("dt").isNotNull())
    lines = scope.model.lines_of(invoices).withColumn("group_val", F.col(group_column(group)))
    entries = F.array(
        _entry(INVOICE, F.col("InvoiceId"), sums=True),
        _entry(CUSTOMER, F.col("CustomerId")),
        _entry(TRACK, F.col("TrackId")),
        _entry(BILLED, name=F.col("country")),
    )
    marked = (
        lines.filter(F.col("group_val").isNotNull())
        .select(month_index(F.col("dt")).cast("int").alias("month"), "group_val", F.inline(entries))
        .filter(F.col("id").isNotNull() | F.col("name").isNotNull())
        .withColumns({"word": F.shiftright("id", _WORD_BITS), "bits": _bit(F.col("id"))})
    )
    return _united(marked, *_KEYS)


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The summary of both sets of lines; no line may be in both, an invoice may."""
    return _united(one.unionByName(other), *_KEYS)


def _united(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.bit_or("bits").alias("bits"), F.sum("qty").alias("qty"), F.sum("cents").alias("cents")
    )


def write_members(members: DataFrame, folder: str) -> None:
    """Store a summary by month, replacing what is there; a large month is split, so no task holds more of it."""
    members.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(folder)


def read_members(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def in_whole_months(members: DataFrame, date_range: DateRange | None) -> DataFrame:
    """The rows of a range; one that cuts a month has no answer here and is refused."""
    if date_range is None:
        return members
    if bounds(date_range) != whole_months(date_range):
        raise ValueError("a summary by month answers whole months only")
    first, last = (day.year * 12 + day.month - 1 for day in bounds(date_range))
    return members.filter(F.col("month").between(first, last))


def _seen_before(parts: DataFrame) -> DataFrame:
    """(year, group_val, kind, n): how many customers or tracks were sold to, or sold, in an earlier year.

    A word lists its years once, a row each; what they held before meets the groups again by year and word.
    """
    of_year = parts.filter(F.col("kind").isin(CUSTOMER, TRACK))
    ever = of_year.groupBy("year", "kind", "word").agg(F.bit_or("bits").alias("bits"))
    listed = ever.groupBy("kind", "word").agg(F.collect_list(F.struct("year", "bits")).alias("years"))

    def before(year: Column) -> Column:
        earlier = F.filter("years", lambda other: other["year"] < year["year"])
        held = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda bits, other: bits.bitwiseOR(other["bits"]))
        return F.struct(year["year"].alias("year"), held.alias("before"))

    known = listed.select("kind", "word", F.inline(F.transform("years", before)))
    return of_year.join(known, ["year", "kind", "word"]).select(
        "year",
        "group_val",
        F.concat("kind", F.lit(" seen")).alias("kind"),
        F.bit_count(F.col("bits").bitwiseAND(F.col("before"))).cast("bigint").alias("n"),
    )


def yearly_summary(members: DataFrame, sizes: DataFrame, group: str, date_range: DateRange | None = None) -> DataFrame:
    """The rows of :func:`tallykeep.operators.yearly.yearly_summary` for a range of whole months.

    ``sizes`` is the catalog (name of the group, num_tracks).
    """
    name = group_column(group)
    chosen = in_whole_months(members, date_range).withColumn("year", F.floor(F.col("month") / 12).cast("int"))
    parts = _united(chosen, "year", "group_val", "kind", "word", "name")
    n = F.when(F.col("kind") == BILLED, F.lit(1).cast("bigint")).otherwise(F.bit_count("bits"))
    counted = parts.select("year", "group_val", "kind", n.alias("n"), "qty", "cents")
    counted = counted.unionByName(_seen_before(parts), allowMissingColumns=True)

    def number(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0).cast("bigint"))

    per_group = counted.groupBy("year", "group_val").agg(
        number(CUSTOMER).alias("num_customers"),
        number(INVOICE).alias("num_purchases"),
        number(BILLED).alias("num_countries"),
        F.sum("qty").alias("tracks_sold"),
        money(total_cents(F.col("cents"))).alias("revenue"),
        (number(CUSTOMER) - number(f"{CUSTOMER} seen")).alias("first_time_customers"),
        number(TRACK).alias("unique_tracks_sold"),
        (number(TRACK) - number(f"{TRACK} seen")).alias("first_tracks_sold"),
    )
    known = sizes.select(F.col(name).alias("group_val"), F.col("num_tracks").alias("catalog_size"))
    return per_group.join(known, "group_val", "left").select(
        F.col("year").cast("string").alias("year"),
        F.col("group_val").alias(name),
        *per_group.columns[2:],
        "catalog_size",
    )


def sizes_of(scope: Scope, group: str) -> DataFrame:
    """The catalog that :func:`yearly_summary` compares with."""
    return catalog(scope.model, group)
