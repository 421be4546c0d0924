"""Importance resampling towards a target distribution, drawn by a distributed radix sort.

Features of a text (runs of consecutive words) fall into a fixed number of buckets. What
the corpus and the target hold per bucket gives every bucket a gain, an array of fixed
size; a document's weight is the sum of its features' gains. Gumbel noise from a
hash of its id makes the highest scores a draw without replacement.

The draw is a least-significant-digit radix sort of the composite key (score descending,
id ascending), spread over blocks of rows. A pass counts the digits of each block; prefix
sums over digits, then blocks, say where each (block, digit) begins; a row's destination is that
beginning plus its place among the rows of its block and digit. Passes are stable, rows go
by destination into the blocks of the next pass, and after the last pass the destination
is the rank. Only digits in which keys differ take a pass. A digit that all rows share
still falls into one group per block, so no group exceeds a block.

Defined cases: a null or empty text has no features and weight 0; a row without an id
counts among the corpus' features but has no score and is never drawn; rows that share an
id (and so the noise) are judged each on its own, in the order they are read where even the scores
agree; empty tables give gains from the smoothing alone and an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches, durable

# Bits of a digit; a pass has a counter per digit value and block.
DIGIT_BITS = 11
# Rows of a block. A group of equal digits in a block is sorted in one task.
BLOCK_ROWS = 1 << 16
# Features whose bucket a task remembers; the memory is emptied when full.
REMEMBERED = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWEST = -(1 << 63)


class Draw(NamedTuple):
    """What to draw: features, buckets, the noise's seed, eligible documents and their share."""

    longest_run: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


DEFAULT = Draw()


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: digits, letters a-z (A-Z lowered) and all beyond ASCII.

    Every byte of a character beyond ASCII is above 0x7F, so bytes and characters agree.
    """
    return _WORD.findall(text.lower())


class Buckets:
    """Buckets of texts' features; common features are remembered."""

    def __init__(self, draw: Draw):
        self.draw = draw
        self.known: dict[bytes, int] = {}

    def of(self, found: list[bytes]) -> np.ndarray:
        features = list(found)
        for length in range(2, self.draw.longest_run + 1):
            features += [b" ".join(found[i : i + length]) for i in range(len(found) - length + 1)]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, buckets = self.known, self.draw.buckets
        for feature in set(features).difference(known):
            known[feature] = zlib.crc32(feature) % buckets
        return np.fromiter(map(known.__getitem__, features), dtype=np.int64, count=len(features))


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def _count(draw: Draw):
    """Features per bucket of a task's texts, a row per bucket that occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(draw), np.zeros(draw.buckets, dtype=np.int64)
        for batch in batches:
            for text in _texts(batch.column(0)):
                total += np.bincount(buckets.of(words(text)), minlength=draw.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, draw: Draw = DEFAULT) -> np.ndarray:
    """Features per bucket over all rows of ``texts`` (text); a fixed number of counters."""
    bounded_batches(texts.sparkSession)
    counted = texts.select(F.col("text").cast("string")).mapInArrow(_count(draw), "bucket long, n long")
    total = np.zeros(draw.buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the smoothed log ratio of target to corpus, in thousandths, rounded down."""
    buckets, held, wanted = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (held + buckets) / ((s + 1.0) * (wanted + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def _weigh(draw: Draw, gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(draw)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [])
            for text in _texts(batch.column(1)):
                found = words(text)
                held = buckets.of(found)
                for column, value in zip(columns, (len(found), len(held), int(gain[held].sum()))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(one, pa.int64()) for one in columns]],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weigh


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def scored(docs: DataFrame, target: DataFrame, draw: Draw = DEFAULT) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row of ``docs`` (doc_id, text)."""
    gain = gains(bucket_counts(docs, draw), bucket_counts(target, draw))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = given.mapInArrow(_weigh(draw, gain), "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed))


def radix_ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their ``place``, from 0, in ascending order of long columns, the first leading.

    ``rows`` must be materialised, so that each pass sees the same rows in the same blocks.
    """
    ends = rows.agg(*[one(key).alias(f"{name}_{i}") for i, key in enumerate(keys) for name, one in (("a", F.min), ("z", F.max))])
    ends = ends.first()
    place = F.monotonically_increasing_id()
    rows = rows.withColumn("place", place).withColumn("block", F.spark_partition_id().cast("long"))
    passes = 0
    for i in range(len(keys) - 1, -1, -1):
        least, most = ends[f"a_{i}"], ends[f"z_{i}"]
        differing = 0 if least is None else ((least ^ most) & (2 * (1 << 63) - 1)).bit_length()
        for shift in range(0, differing, DIGIT_BITS):
            rows = durable(_pass(rows, keys[i], shift))
            passes += 1
    if not passes:  # no two keys differ: the order of reading stands, settled by one pass over an equal digit
        rows = durable(_pass(rows, keys[-1], 64 - DIGIT_BITS))
    return rows.drop("block")


def _pass(rows: DataFrame, key: str, shift: int) -> DataFrame:
    """One stable counting sort by a digit of ``key``; sets ``place`` and the next ``block``."""
    unsigned = F.col(key).bitwiseXOR(F.lit(_LOWEST))
    digit = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
    dealt = rows.withColumn("digit", digit)
    counts = dealt.groupBy("block", "digit").agg(F.count("*").alias("n"))
    earlier_blocks = Window.partitionBy("digit").orderBy("block")
    smaller_digits = Window.orderBy("digit")  # at most 2 ** DIGIT_BITS rows
    within = counts.select("block", "digit", (F.sum("n").over(earlier_blocks) - F.col("n")).alias("within"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    before = totals.select("digit", (F.sum("n").over(smaller_digits) - F.col("n")).alias("before"))
    begins = within.join(before, "digit").select("block", "digit", (F.col("within") + F.col("before")).alias("begin"))
    turn = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
    sent = dealt.withColumn("turn", turn).join(begins, ["block", "digit"])
    destination = F.col("begin") + F.col("turn")
    return sent.withColumn("place", destination).withColumn("block", F.floor(destination / BLOCK_ROWS)).select(*rows.columns)


def drawn(docs: DataFrame, target: DataFrame, draw: Draw = DEFAULT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row; the rank is null where not drawn."""
    judged = durable(scored(docs, target, draw))
    eligible = (F.col("n_words") >= draw.least_words) & F.col("doc_id").isNotNull()
    most = judged.filter(eligible).count() * draw.percent // 100
    keyed = judged.filter(eligible).withColumn("falling", F.bitwise_not("score"))
    rank = F.col("place") + 1
    ranked = radix_ranked(keyed, ["falling", "doc_id"]).withColumn("rank", F.when(rank <= most, rank))
    others = judged.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(others.select(*names))


def resample(docs: DataFrame, target: DataFrame, draw: Draw = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose ids were drawn, with their columns unchanged."""
    chosen = drawn(docs, target, draw).filter(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi").select(*docs.columns)
