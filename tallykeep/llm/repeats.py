"""Substring dedup: passages that an earlier document holds are removed.

Anchors are the blocks of 7 words at places 0, 7, 14 ... of every document. Any passage
of 13 words covers one whole anchor of each document that holds it, so probing the
anchors with every rolling block of 7 words finds every document pair that shares a
passage. Hits are extended to the passages of 13 words around them, on both sides, and
these are compared by 64-bit hashes of all their words; adjoining ones form the maximal repeat.

Both comparisons are a shuffle by hash. Many blocks travel in one row (the hashes of a
batch that fall into a partition), and a block counts once per document, so a block that
a third of all documents share adds one number per document to its partition and is
reduced to a smallest and a largest document there, never to pairs.

Defined cases: a null or empty text has no words and an empty rest; documents of one id
are no earlier than each other; a null id is earlier than nothing and later than
nothing, such rows keep all words; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches, partitions
from tallykeep.llm.packing import PACKED, by_document, packed, returned, unpacked
from tallykeep.llm.words import text_ngrams

PASSAGE_WORDS = 13
# The longest block of which every passage holds a whole anchor.
BLOCK_WORDS = (PASSAGE_WORDS + 1) // 2

_FOUND = "doc_id long, hashes binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _block_keys(blocks: np.ndarray) -> np.ndarray:
    """Block hashes with the lowest bit free for the mark of an anchor."""
    return blocks & ~np.uint64(1)


def _emit_blocks(parts: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            numbers = batch.column(0).to_pylist()
            for row, _, blocks in text_ngrams(batch.column(1), BLOCK_WORDS, lower=False):
                if len(blocks) >= PASSAGE_WORDS - BLOCK_WORDS + 1:
                    keys = _block_keys(blocks)
                    keys[::BLOCK_WORDS] |= np.uint64(1)
                    ids.append(numbers[row])
                    found.append(np.unique(keys))
            yield packed(parts, ids, found, np.uint32)

    return emit


def _probe(parts: int):
    """Blocks that meet an anchor of an earlier document, and the anchors so met."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ranks, hashes in unpacked(batches, np.uint32):
            if len(hashes):
                yield returned(parts, ids, *_met(ranks, hashes))

    return probe


def _met(ranks: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # block, document, mark: one integer, so that one sort brings equal blocks together
    rows = (hashes >> np.uint32(1)).astype(np.uint64) << np.uint64(33)
    rows |= (ranks << np.uint64(1)) | (hashes & np.uint32(1)).astype(np.uint64)
    rows.sort()
    block, rank, anchor = rows >> np.uint64(33), (rows & np.uint64(2**33 - 1)) >> np.uint64(1), rows & np.uint64(1)
    del rows
    new = np.r_[True, block[1:] != block[:-1]]
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    least = np.minimum.reduceat(np.where(anchor == 1, rank, np.uint64(2**32)), heads)[group]
    most = np.maximum.reduceat(rank, heads)[group]
    hit = (rank > least) | ((anchor == 1) & (rank < most))
    return rank[hit], block[hit].astype(np.uint32)


def _emit_passages(parts: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of the passages around the blocks that were hit, in either role."""
        for batch in batches:
            ids, found = [], []
            numbers, hits = batch.column(0).to_pylist(), batch.column(2)
            passages = text_ngrams(batch.column(1), PASSAGE_WORDS, lower=False)
            blocks = text_ngrams(batch.column(1), BLOCK_WORDS, lower=False)
            for (row, _, whole), (_, _, block) in zip(passages, blocks):
                keys = np.frombuffer(hits[row].as_py(), np.uint32)
                met = np.isin((block.astype(np.uint32) >> np.uint32(1)), keys)
                # a passage at s covers the blocks s ... s + 6
                sums = np.r_[0, np.cumsum(met)]
                near = sums[PASSAGE_WORDS - BLOCK_WORDS + 1 :] - sums[: len(whole)]
                ids.append(numbers[row])
                found.append(np.unique(whole[near > 0]))
            yield packed(parts, ids, found, np.uint64)

    return emit


def _verify(parts: int):
    """Passages that an earlier document holds too."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ranks, hashes in unpacked(batches, np.uint64):
            if not len(hashes):
                continue
            order = np.argsort(hashes, kind="stable")
            hashes, ranks = hashes[order], ranks[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            least = np.minimum.reduceat(ranks, np.flatnonzero(new))[np.cumsum(new) - 1]
            later = ranks > least
            yield returned(parts, ids, ranks[later], hashes[later])

    return verify


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, as a digest; see kept_text for the text itself."""
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [])
        for words, kept in _kept_words(batch):
            columns[0].append(len(words))
            columns[1].append(len(words) - len(kept))
            columns[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _kept_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [b" ".join(kept).decode() for _, kept in _kept_words(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _kept_words(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """All words and the kept words of every row (doc_id, text, found)."""
    texts, found = batch.column(1), batch.column(2)
    for row, _, passages in text_ngrams(texts, PASSAGE_WORDS, lower=False):
        words = (texts[row].as_py() or "").encode().split()
        repeated = found[row].as_py()
        if repeated:
            starts = np.isin(passages, np.frombuffer(repeated, np.uint64))
            change = np.zeros(len(words) + 1, dtype=np.int64)
            change[: len(starts)] += starts
            change[PASSAGE_WORDS : PASSAGE_WORDS + len(starts)] -= starts
            yield words, list(compress(words, np.cumsum(change[:-1]) == 0))
        else:
            yield words, words


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes): each document's passages that an earlier one holds."""
    parts = partitions(docs.sparkSession)
    texts = _dealt(docs)

    def exchanged(rows: DataFrame, reduce, width: type) -> DataFrame:
        """Deal hashes to partitions, reduce them there, and gather the rest by document."""
        reduced = rows.repartition(parts, "part").mapInArrow(reduce(parts), PACKED)
        return reduced.repartition(parts, "part").mapInArrow(by_document(width), _FOUND)

    hits = exchanged(texts.mapInArrow(_emit_blocks(parts), PACKED), _probe, np.uint32)
    around = texts.join(hits, "doc_id").mapInArrow(_emit_passages(parts), PACKED)
    return exchanged(around, _verify, np.uint64)


def _named(docs: DataFrame) -> DataFrame:
    """Id and text, cast only if need be: a plain column keeps plans equal to each other."""
    wanted = {"doc_id": "bigint", "text": "string"}
    kinds = dict(docs.dtypes)
    return docs.select(*[F.col(c) if kinds[c] == k else F.col(c).cast(k).alias(c) for c, k in wanted.items()])


def _dealt(docs: DataFrame) -> DataFrame:
    """Texts by id. Every use has the same plan, so the texts are shuffled once."""
    bounded_batches(docs.sparkSession)
    return _named(docs).filter(F.col("doc_id").isNotNull()).repartition(partitions(docs.sparkSession), "doc_id")


def _with_found(docs: DataFrame) -> DataFrame:
    known = _dealt(docs).join(repeated_passages(docs), "doc_id", "left")
    unknown = _named(docs).filter(F.col("doc_id").isNull())
    return known.unionByName(unknown.withColumn("hashes", F.lit(None).cast("binary")))


def removed_digest(docs: DataFrame) -> DataFrame:
    """Per document: words, words removed, and the SHA-256 of the kept words."""
    return _with_found(docs).mapInArrow(_remove, _RESULT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the kept words, joined by one space."""
    return _with_found(docs).mapInArrow(_kept_text, "doc_id long, text string")
