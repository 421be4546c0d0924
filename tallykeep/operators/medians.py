"""Exact medians of values that are many, without holding a group's values in one task.

``median`` keeps a counter per distinct value of a group in one buffer, which is right for
whole days and wrong for amounts. Here the distinct values and their counts are a table.
Cut points, taken from a sketch of the distinct values, part each group into ranges; the
counts of the ranges say in which the middle lies, and only that range is kept. Sketches
choose the cuts only, the counts decide, so the result is exact. When the largest group
left is small, its running counts give the middle.

Nulls and NaN are no values; a group without values has no row. Keys may be null.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.session import remove_folder, shared_folder

# Ranges a group is parted into in a round, and the accuracy of the sketch that parts it.
RANGES = 64
ACCURACY = 2_000
# Distinct values of a group that one task may sort.
SORTABLE = 100_000


def _key_names(keys: list[str]) -> list[str]:
    return [f"key_{place}" for place in range(len(keys))]


def _same(left: str, right: str, names: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names], F.lit(True))


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """key_0.., value (double), n: the distinct values of each group, repeats folded before the shuffle."""
    number = F.col(value).cast("double")
    columns = [F.col(key).alias(name) for key, name in zip(keys, _key_names(keys))]
    known = rows.select(*columns, number.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy(*_key_names(keys), "value").agg(F.count(F.lit(1)).alias("n"))


def _middles(counts: DataFrame, names: list[str]) -> DataFrame:
    """Per group: its values, and the (1-based) ranks whose values the median is the mean of."""
    total = F.sum("n")
    return counts.groupBy(*names).agg(
        F.floor((total + 1) / 2).cast("bigint").alias("low_rank"),
        F.floor(total / 2 + 1).cast("bigint").alias("high_rank"),
        total.alias("total"),
    )


def _narrowed(counts: DataFrame, middles: DataFrame, names: list[str], ranges: int) -> tuple[DataFrame, DataFrame]:
    """The values of the ranges that hold the middle ranks, and these ranks counted from there."""
    shares = [place / ranges for place in range(1, ranges)]
    cuts = counts.groupBy(*names).agg(F.percentile_approx("value", shares, ACCURACY).alias("cuts"))
    placed = counts.alias("a").join(cuts.alias("b"), _same("a", "b", names)).select(
        *[F.col(f"a.{name}").alias(name) for name in names], "a.value", "a.n",
        F.size(F.filter("b.cuts", lambda cut: cut < F.col("a.value"))).alias("range"),
    )
    per_range = placed.groupBy(*names, "range").agg(F.sum("n").alias("held"))
    # at most `ranges` rows of a group meet here
    upto = F.sum("held").over(Window.partitionBy(*names).orderBy("range"))
    reached = per_range.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("held"))
    wanted = (
        reached.alias("a")
        .join(middles.alias("b"), _same("a", "b", names))
        .filter("b.low_rank <= a.upto AND b.high_rank > a.below")
        .groupBy(*[F.col(f"b.{name}").alias(name) for name in names])
        .agg(
            F.min("a.range").alias("first"),
            F.max("a.range").alias("last"),
            F.min("a.below").alias("skipped"),
            F.min("b.low_rank").alias("low_rank"),
            F.min("b.high_rank").alias("high_rank"),
        )
    )
    kept = (
        placed.alias("a")
        .join(wanted.alias("b"), _same("a", "b", names))
        .filter("a.range BETWEEN b.first AND b.last")
        .select(*[F.col(f"a.{name}").alias(name) for name in names], "a.value", "a.n")
    )
    left = wanted.select(*names, *[(F.col(rank) - F.col("skipped")).alias(rank) for rank in ("low_rank", "high_rank")])
    return kept, left


def exact_median(rows: DataFrame, keys: list[str], value: str, sortable: int = SORTABLE, ranges: int = RANGES) -> DataFrame:
    """The keys, ``n`` (values) and ``median``, equal to Spark's ``median`` of each group.

    A round reads the values left, keeps at most a few of ``ranges`` parts of each large
    group, and writes them to the shared folder, so a lost executor costs no earlier round.
    The driver sees one number per round, the size of the largest group left. The result is
    read from the last round's files, which stay; those of earlier rounds are removed.
    """
    if not 4 <= ranges <= sortable:
        raise ValueError(f"needs 4 <= ranges <= sortable, so that every round gets smaller, not {ranges} and {sortable}")
    spark, names = rows.sparkSession, _key_names(keys)
    folder = shared_folder(spark)

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    left = stored(value_counts(rows, keys, value), "counts-0")
    middles = stored(_middles(left, names), "middles-0")
    totals, number = middles.filter("total > 0"), 0
    while (left.groupBy(*names).count().agg(F.max("count")).first()[0] or 0) > sortable:
        narrowed, ranks = _narrowed(left, middles, names, ranges)
        number += 1
        left, middles = stored(narrowed, f"counts-{number}"), stored(ranks, f"middles-{number}")
        remove_folder(spark, f"{folder}/counts-{number - 1}")
        if number > 1:  # the first holds the totals
            remove_folder(spark, f"{folder}/middles-{number - 1}")
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy("value"))
    places = left.withColumn("upto", upto)
    joined = places.alias("a").join(middles.alias("b"), _same("a", "b", names))
    at = [F.min(F.when(F.col("a.upto") >= F.col(f"b.{rank}"), F.col("a.value"))) for rank in ("low_rank", "high_rank")]
    found = joined.groupBy(*[F.col(f"b.{name}").alias(name) for name in names]).agg((at[0] * 0.5 + at[1] * 0.5).alias("median"))
    return totals.alias("a").join(found.alias("b"), _same("a", "b", names)).select(
        *[F.col(f"a.{name}").alias(key) for name, key in zip(names, keys)], F.col("a.total").alias("n"), "b.median"
    )
