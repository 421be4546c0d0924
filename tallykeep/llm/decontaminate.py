"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item leaks into a document if at least 80 percent of the item's distinct 5-word
shingles occur there. Items are few and short, documents many and long, so similarity is
low even where containment is full; the sketch is therefore one of containment. Of an
item with q shingles the q - ceil(0.8 q) + 1 smallest are its sketch, in an order by how
many items hold a shingle and then by hash: a document that contains enough of the item holds at least one
of them, and a lead-in that many items share is in few sketches. Items are partitioned by size; a partition
has a bitmap of its sketches and the least number of shingles a document needs, and a
document probes only the partitions it is large enough for. Items of equal shingles are one.

A hit names a document and an item; only these pairs are verified by exact containment,
counted over all shingles of the item. No text is shuffled, and a passage that many
documents and many items share makes no pairs by itself.

Bitmaps have ``BITS_PER_SHINGLE`` bits per shingle of the benchmark, up to 2 ** ``MOST_BITMAP_BITS``; fuller ones only let more
documents through to the verification.

Defined cases: null and empty texts have no shingles, leak nothing and hold nothing; an
item of fewer than five words is one shingle, its whole word sequence, looked for as
such; items with the same text each match; rows sharing an item_id are each looked for on
their own, and the one that shares most is reported; rows sharing a doc_id are each compared and
reported once per item; rows without an id are reported with a null id, and cleaned like others;
extra columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches, durable, free_name, with_digest
from tallykeep.llm.words import digest, ngrams, slices, word_hashes

SHINGLE_WORDS = 5
CONTAINED_PERCENT = 80
# Size of the bitmaps of the benchmark's shingles, and their limit: 16 MB.
BITS_PER_SHINGLE = 32
MOST_BITMAP_BITS = 27
# Bytes of a piece of a bitmap as Spark builds it.
PIECE_BYTES = 4096

_ITEM = "item_id long, item_row long, shingles string, width int, size int, hash long"
_HELD = "doc_id long, row long, low long, high long, width int, hash long"


def _sets_by_width(texts: pa.Array, widths: tuple[int, ...]) -> Iterator[tuple[int, int, dict[int, np.ndarray]]]:
    """Row, words and, for each width, the sorted distinct shingles of each text."""
    for first, last, data, offsets in slices(texts):
        hashes, bounds = word_hashes(data, offsets, lower=True)
        grams = {width: ngrams(hashes, width) for width in widths}
        for row in range(first, last):
            begin, end = bounds[row - first], bounds[row - first + 1]
            found = {w: np.unique(grams[w][begin : max(begin, end - w + 1)]) for w in widths}
            yield row, int(end - begin), found


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        columns: list[list] = [[], [], [], [], [], []]
        for row, count, sets in _sets_by_width(batch.column(2), tuple(range(1, SHINGLE_WORDS + 1))):
            if not count:
                continue
            width = min(count, SHINGLE_WORDS)
            found = sets[width]
            size = len(found)
            name = hashlib.blake2b(bytes([width]) + found.tobytes(), digest_size=16).hexdigest()
            for column, value in zip(columns, (numbers[row], rows[row], name, width, size)):
                column += [value] * size
            columns[5] += found.view(np.int64).tolist()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=["item_id", "item_row", "shingles", "width", "size", "hash"],
        )


def _sketches(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shingles, width, size, hash) of distinct items, and the part of it that is in sketches."""
    sets = items.select("shingles", "width", "size", "hash").distinct()
    held = sets.groupBy("width", "hash").agg(F.count("*").alias("items"))
    rank = F.row_number().over(Window.partitionBy("shingles").orderBy("items", "hash"))
    needed = F.col("size") - F.ceil(F.col("size") * CONTAINED_PERCENT / 100) + 1
    ranked = sets.join(held, ["width", "hash"]).withColumn("rank", rank)
    return sets, ranked.filter(F.col("rank") <= needed).select("shingles", "width", "size", "hash")


class Bitmap:
    """Which of 2 ** bits slots hold one of some hashes."""

    def __init__(self, bits: int):
        self.bits = bits
        self.slots = np.zeros((1 << bits) // 8, dtype=np.uint8)

    def slot(self, hashes: Column) -> Column:
        return hashes.bitwiseAND(F.lit((1 << self.bits) - 1))

    def filled(self, hashes: DataFrame) -> Bitmap:
        """With the slots of column ``hash``, gathered in pieces."""
        number = self.slot(F.col("hash")) + 1  # Spark numbers bits and pieces from 1
        pieces = hashes.groupBy(F.bitmap_bucket_number(number).alias("piece")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
        )
        for piece, held in pieces.collect():  # at most 2 ** bits / 32768 rows
            begin = (piece - 1) * PIECE_BYTES
            self.slots[begin : begin + PIECE_BYTES] = np.frombuffer(held, dtype=np.uint8)
        return self

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes & np.uint64((1 << self.bits) - 1)
        return (self.slots[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bits_for(hashes: int) -> int:
    """Bits of a bitmap of so many hashes; no less than a piece."""
    return min(max((BITS_PER_SHINGLE * hashes - 1).bit_length(), 15), MOST_BITMAP_BITS)


def _probe(partitions: list[tuple[int, int, Bitmap]], whole: dict[int, Bitmap]):
    """Shingles of documents with a sketch hit, as far as the benchmark may hold them.

    ``partitions`` holds (width, least shingles of a document, its items' sketches).
    """

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            columns: list[list] = [[], [], [], [], [], []]
            for at, _, sets in _sets_by_width(batch.column(2), tuple(whole)):
                for width, found in sets.items():
                    probed = (sketch for w, least, sketch in partitions if w == width and least <= len(found))
                    if any(sketch[found].any() for sketch in probed):
                        held = found[whole[width][found]].view(np.int64).tolist()
                        low, high = digest(batch.column(2)[at].as_py())
                        for column, value in zip(columns, (ids[at], rows[at], low, high, width)):
                            column += [value] * len(held)
                        columns[5] += held
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["doc_id", "row", "low", "high", "width", "hash"],
            )

    return probe


def _leaking(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, low, high, shingles, size, n_shared) of leaks by distinct items, and the items' shingles."""
    bounded_batches(docs.sparkSession)
    items = durable(
        benchmark.select(
            F.col("item_id").cast("long").alias("item_id"),
            F.monotonically_increasing_id().alias("item_row"),
            F.col("text").cast("string").alias("text"),
        ).mapInArrow(_items, _ITEM)
    )
    sets, sketches = _sketches(items)
    sketches = durable(sketches)
    # sizes between powers of two form a partition; so there are few rows, whatever the benchmark
    power = F.floor(F.log2("size")).cast("int").alias("power")
    summary = sketches.groupBy("width", power).agg(F.min("size"), F.count("*")).collect()
    partitions = [
        (width, -(-CONTAINED_PERCENT * size // 100), Bitmap(_bits_for(n)).filled(sketches.filter((F.col("width") == width) & (power == exponent))))
        for width, exponent, size, n in summary
    ]
    whole = {
        width: Bitmap(_bits_for(n)).filled(sets.filter(F.col("width") == width))
        for width, n in sets.groupBy("width").count().collect()
    }
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    held = durable(texts.mapInArrow(_probe(partitions, whole), _HELD))
    pairs = held.join(sketches, ["width", "hash"]).select("row", "shingles").distinct()
    shared = pairs.join(sets, "shingles").join(held, ["row", "width", "hash"])
    counted = shared.groupBy("doc_id", "row", "low", "high", "shingles", "size").agg(F.count("*").alias("n_shared"))
    return counted.filter(100 * F.col("n_shared") >= CONTAINED_PERCENT * F.col("size")), items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared): every document that holds an item."""
    shared, items = _leaking(docs, benchmark)
    named = shared.join(items.select("item_id", "shingles").distinct(), "shingles")
    # of several texts of an item, or rows of a document, the figures of those that share most
    most = F.max(F.struct("n_shared", F.col("size").cast("long").alias("size"))).alias("most")
    found = named.groupBy("doc_id", "item_id").agg(most)
    return found.select("doc_id", "item_id", F.col("most.size").alias("n_item_shingles"), F.col("most.n_shared").alias("n_shared"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with their columns unchanged; an id may be null or repeated."""
    shared, _ = _leaking(docs, benchmark)
    low, high = free_name(docs, "low"), free_name(docs, "high")
    leaking = shared.select(F.col("doc_id").alias("id"), F.col("low").alias("a"), F.col("high").alias("b")).distinct()
    marked = with_digest(docs, low, high)
    same = marked["doc_id"].cast("long").eqNullSafe(leaking["id"]) & (marked[low] == leaking["a"]) & (marked[high] == leaking["b"])
    return marked.join(leaking, same, "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])
