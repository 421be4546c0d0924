"""Ranked lexical search by branch and bound over FP-trees of documents.

A document's terms are restricted to those of the items and ordered by how many documents hold
them, most frequent first; documents whose ordered terms begin alike share a path of the tree. For
every subtree the tree knows the largest term frequency of each term and the smallest m, a
document's length factor. A score rises with frequencies and falls with m, so these bound all
scores of the subtree. Per item the tree is searched depth-first, best child first, and a
subtree that cannot beat the worst of the hits held so far is left out; ends of few
documents are scored exactly.

A task grows one tree after another over its documents, each as large as ``CELLS`` allows, and keeps its
best hits per item from tree to tree. Corpus statistics are taken over all documents
before. Items are taken in blocks of bounded size, so what travels to the tasks is
bounded too: each block takes one pass for statistics and one for the search.

Defined cases: a null or empty text has no terms and is found by no item; an item without
terms finds nothing; each row of the items is an item of its own, also with a repeated
or null id; a document without an id counts in the statistics and is not found; of equal
scores the smaller id is first, and rows that share an id are found each; other columns are ignored;
empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches, durable

# Hits per item.
HITS = 10
# A block of items: so many at most, and so many bytes of text unless one item has more.
BLOCK_ITEMS = 2000
BLOCK_BYTES = 1 << 20
# Documents times terms of one tree.
CELLS = 1 << 22
# A subtree of so many documents is scored instead of divided.
END_DOCUMENTS = 32
# First steps of the merge of tasks' hits, so that no group grows with the number of tasks alone.
SHARES = 64

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_DOCUMENTS, _TERMS = -1, -2


class Ranking(NamedTuple):
    """The weighting's fixed numbers: percent of length normalisation, and eighths of a term's scale."""

    by_length: int = 75
    eighths: int = 8


RANKING = Ranking()


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of digits, letters and all beyond ASCII; A-Z lowered."""
    return _TERM.findall(text.lower())


class Block(NamedTuple):
    """Items to search together: their ids and term counts, and the number of each term."""

    ids: list
    counts: list[Counter]
    numbers: dict[bytes, int]


class Statistics(NamedTuple):
    """Documents with a term, terms of them all, and per term of a block the documents holding it."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        """Weights in thousandths, rounded down; 0 for terms that no document holds."""
        top = float(2 * self.documents + 2)
        return np.array([math.floor(1000 * math.log(top / (2 * n + 1))) if n else 0 for n in self.holding.tolist()], dtype=np.int64)


def blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of bounded size, a partition of them at a time."""
    ids, counts, numbers, size = [], [], {}, 0
    for item_id, text in items.select(F.col("item_id"), F.col("text").cast("string")).toLocalIterator():
        found = Counter(terms((text or "").encode()))
        if ids and (len(ids) == BLOCK_ITEMS or size + len(text or "") > BLOCK_BYTES):
            yield Block(ids, counts, numbers)
            ids, counts, numbers, size = [], [], {}, 0
        for term in found:
            numbers.setdefault(term, len(numbers))
        ids.append(item_id)
        counts.append(found)
        size += len(text or "")
    if ids:
        yield Block(ids, counts, numbers)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def _count(numbers: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, length = np.zeros(len(numbers), dtype=np.int64), 0, 0
        for batch in batches:
            for text in _texts(batch.column(0)):
                found = terms(text)
                documents += bool(found)
                length += len(found)
                held = [numbers[term] for term in set(found) if term in numbers]
                holding[held] += 1
        used = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_DOCUMENTS, _TERMS, *used.tolist()], pa.int64()), pa.array([documents, length, *holding[used].tolist()], pa.int64())],
            names=["term", "n"],
        )

    return count


def statistics(docs: DataFrame, block: Block) -> Statistics:
    """Counts over all documents for the terms of a block; as many rows as it has terms."""
    counted = docs.select("text").mapInArrow(_count(block.numbers), "term long, n long")
    known = dict(counted.groupBy("term").agg(F.sum("n")).collect())
    holding = np.array([known.get(i, 0) for i in range(len(block.numbers))], dtype=np.int64)
    return Statistics(known.get(_DOCUMENTS, 0), known.get(_TERMS, 0), holding)


class PathTree:
    """An FP-tree over some documents: their term vectors in order of their paths, and its nodes.

    A node is a run of neighbouring documents that share the beginning of their paths.
    ``children`` of a node are none where its documents are to be scored.
    """

    def __init__(self, ids: list[int], factors: list[int], paths: list[np.ndarray], frequencies: list[np.ndarray], width: int):
        written = [path.astype(">u4").tobytes() for path in paths]
        order = sorted(range(len(ids)), key=written.__getitem__)
        self.ids = np.array(ids, dtype=np.int64)[order]
        self.factors = np.array(factors, dtype=np.int64)[order]
        self.vectors = np.zeros((len(ids), width), dtype=np.int32)
        rows = np.repeat(np.arange(len(order)), [len(paths[i]) for i in order])
        self.vectors[rows, np.concatenate([paths[i] for i in order])] = np.concatenate([frequencies[i] for i in order])
        shared = np.array([_shared(paths[a], paths[b]) for a, b in zip(order, order[1:])], dtype=np.int64)
        self.begins, self.ends, self.children = [0], [len(order)], []
        node = 0
        while node < len(self.begins):
            begin, end = self.begins[node], self.ends[node]
            runs = self._divided(shared, begin, end) if end - begin > END_DOCUMENTS else []
            self.children.append(np.arange(len(self.begins), len(self.begins) + len(runs)))
            self.begins += [run[0] for run in runs]
            self.ends += [run[1] for run in runs]
            node += 1
        self._summarise()

    @staticmethod
    def _divided(shared: np.ndarray, begin: int, end: int) -> list[tuple[int, int]]:
        """Runs below a node: where paths part first; small neighbours stay together."""
        inner = shared[begin : end - 1]
        cuts = (begin + 1 + np.flatnonzero(inner == inner.min())).tolist()
        runs, start, last = [], begin, begin
        for cut in [*cuts, end]:
            if cut - start > END_DOCUMENTS and last > start:
                runs.append((start, last))
                start = last
            last = cut
        return [*runs, (start, end)]

    def _summarise(self) -> None:
        """Largest frequencies, smallest factor and smallest id below every node, from the ends upwards."""
        size = len(self.begins)
        self.largest = np.empty((size, self.vectors.shape[1]), dtype=np.int32)
        self.least = np.empty(size, dtype=np.int64)
        self.first = np.empty(size, dtype=np.int64)
        for node in range(size - 1, -1, -1):
            below = self.children[node]
            here = slice(self.begins[node], self.ends[node])
            self.largest[node] = (self.largest[below] if len(below) else self.vectors[here]).max(axis=0)
            self.least[node] = self.factors[here].min()
            self.first[node] = self.ids[here].min()


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    """How many terms two paths begin with in common."""
    length = min(len(one), len(other))
    apart = one[:length] != other[:length]
    return int(apart.argmax()) if apart.any() else length


def scores(frequencies: np.ndarray, factors: np.ndarray, weights: np.ndarray, eighths: int) -> np.ndarray:
    """Sums of weighted terms, a row per document, in 64-bit integers."""
    tf = frequencies.astype(np.int64)
    return (weights * ((1_000_000_000 * tf) // (1000 * tf + eighths * factors[:, None]))).sum(axis=1)


class Hits:
    """The best documents of one item so far."""

    def __init__(self, most: int):
        self.most = most
        self.scores = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)

    def beaten_by(self, score: int, doc_id: int) -> bool:
        if score <= 0:
            return False
        if len(self.ids) < self.most:
            return True
        return (-score, doc_id) < (-int(self.scores[-1]), int(self.ids[-1]))

    def add(self, found: np.ndarray, ids: np.ndarray) -> None:
        good = found > 0 if len(self.ids) < self.most else found >= max(1, int(self.scores[-1]))
        if good.any():
            all_scores, all_ids = np.r_[self.scores, found[good]], np.r_[self.ids, ids[good]]
            best = np.lexsort((all_ids, -all_scores))[: self.most]
            self.scores, self.ids = all_scores[best], all_ids[best]


def branch_and_bound(tree: PathTree, wanted: np.ndarray, weights: np.ndarray, hits: Hits, eighths: int) -> int:
    """Add the tree's best documents for an item's terms; returns how many were scored."""
    looked = 0
    root = scores(tree.largest[:1, wanted], tree.least[:1], weights, eighths)
    open_nodes = [(int(root[0]), 0)]
    while open_nodes:
        bound, node = open_nodes.pop()
        if not hits.beaten_by(bound, int(tree.first[node])):
            continue
        below = tree.children[node]
        if len(below):
            bounds = scores(tree.largest[below][:, wanted], tree.least[below], weights, eighths)
            best_last = np.lexsort((-tree.first[below], bounds))
            open_nodes += zip(bounds[best_last].tolist(), below[best_last].tolist())
        else:
            here = slice(tree.begins[node], tree.ends[node])
            looked += here.stop - here.start
            hits.add(scores(tree.vectors[here][:, wanted], tree.factors[here], weights, eighths), tree.ids[here])
    return looked


def _search(block: Block, known: Statistics, most: int, ranking: Ranking):
    weights = known.weights()
    # terms that weigh nothing add nothing to a score
    order = np.array(sorted(np.flatnonzero(weights > 0), key=lambda i: (-known.holding[i], i)), dtype=np.int64)
    place = np.full(len(weights), -1, dtype=np.int64)
    place[order] = np.arange(len(order))
    places = {term: int(place[i]) for term, i in block.numbers.items() if place[i] >= 0}
    asked = []
    for counts in block.counts:
        held = sorted((places[term], n) for term, n in counts.items() if term in places)
        wanted = np.array([one for one, _ in held], dtype=np.int64)
        asked.append((wanted, weights[order[wanted]] * np.array([n for _, n in held], dtype=np.int64) if held else wanted))
    held_at_once = max(2 * END_DOCUMENTS, CELLS // max(1, len(order)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = [Hits(most) for _ in asked]
        ids, factors, paths, frequencies = [], [], [], []

        def grow() -> None:
            if ids:
                tree = PathTree(ids, factors, paths, frequencies, len(order))
                for (wanted, own), best in zip(asked, hits):
                    if len(wanted):
                        branch_and_bound(tree, wanted, own, best, ranking.eighths)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                found = terms(text)
                held = [places[term] for term in found if term in places]
                if doc_id is None or not held:
                    continue
                path, counts = np.unique(np.array(held, dtype=np.int64), return_counts=True)
                ids.append(doc_id)
                factors.append(100 - ranking.by_length + ranking.by_length * len(found) * known.documents // known.terms)
                paths.append(path)
                frequencies.append(counts)
                if len(ids) >= held_at_once:
                    grow()
                    ids, factors, paths, frequencies = [], [], [], []
        grow()
        columns = [np.repeat(np.arange(len(hits)), [len(one.ids) for one in hits])]
        columns += [np.concatenate([getattr(one, name) for one in hits]) for name in ("ids", "scores")]
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in columns], names=["item", "doc_id", "score"])

    return search


def _merged(found: DataFrame, most: int) -> DataFrame:
    """The best hits per item over all tasks, first by shares of the documents."""
    best = F.desc("score"), F.asc("doc_id")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    for keys in (["item", "share"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        found = (found.withColumn("share", share) if "share" in keys else found).withColumn("rank", rank).filter(F.col("rank") <= most)
    return found.select("item", F.col("rank").cast("int"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, most: int = HITS, ranking: Ranking = RANKING) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    results: list[DataFrame] = []
    for block in blocks(items):
        known = statistics(docs, block)
        found = docs.mapInArrow(_search(block, known, most, ranking), "item long, doc_id long, score long")
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
        results.append(_merged(found, most).join(ids, "item").select("item_id", "rank", "doc_id", "score"))
        if len(results) > 1:  # several blocks: keep the plan small
            results = [durable(results[0].unionByName(results[1]))]
    return results[0] if results else _nothing(spark, kind)


def _nothing(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
