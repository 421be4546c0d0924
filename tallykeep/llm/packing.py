"""Hashes of many documents dealt to partitions, a row per batch and partition.

A shuffle row per hash would cost several times the hash itself. Here one row carries
all hashes of a batch that belong to a partition: the ids of their documents, how many
each has, and the hashes, of which only ``width`` bits need to be kept as the partition
number stands for others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallykeep.llm.words import mix

PACKED = "part int, ids binary, counts binary, hashes binary"


def packed(parts: int, ids: list[int], found: list[np.ndarray], width: type) -> pa.RecordBatch:
    """Hashes of each document, dealt by hash.

    A hash belongs to the partition of its upper half; only ``width`` of it is kept.
    """
    hashes = np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
    rows = np.repeat(np.arange(len(ids)), [len(one) for one in found])
    to = ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return _rows(to[order], rows[order], np.array(ids, dtype=np.int64), hashes[order].astype(width))


def returned(parts: int, ids: np.ndarray, ranks: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Hashes of documents, given by rank among ``ids``, dealt by document."""
    ranks = ranks.astype(np.int64)
    to = (mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)[ranks]
    order = np.lexsort((ranks, to))
    return _rows(to[order], ranks[order], ids, hashes[order])


def _rows(to: np.ndarray, rows: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """A row per partition, from hashes ordered by partition and document."""
    edges = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True]) if len(to) else np.zeros(1, dtype=np.int64)
    columns: tuple[list, ...] = ([], [], [], [])
    for begin, end in zip(edges[:-1], edges[1:]):
        docs, each = np.unique(rows[begin:end], return_counts=True)
        columns[0].append(int(to[begin]))
        columns[1].append(ids[docs].tobytes())
        columns[2].append(each.astype(np.int32).tobytes())
        columns[3].append(hashes[begin:end].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *[pa.array(one, pa.binary()) for one in columns[1:]]],
        names=["part", "ids", "counts", "hashes"],
    )


def unpacked(batches: Iterator[pa.RecordBatch], width: type) -> Iterator[tuple]:
    """For each partition number in a task: ids, and per hash its id's rank and the hash."""
    gathered: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            gathered.setdefault(row["part"], []).append((row["ids"], row["counts"], row["hashes"]))
    while gathered:
        _, rows = gathered.popitem()
        ids, ranks = np.unique(np.concatenate([np.frombuffer(r[0], np.int64) for r in rows]), return_inverse=True)
        counts = np.concatenate([np.frombuffer(r[1], np.int32) for r in rows])
        hashes = np.concatenate([np.frombuffer(r[2], width) for r in rows])
        rows.clear()
        yield ids, np.repeat(ranks.astype(np.uint64), counts), hashes


def by_document(width: type):
    """Turn rows dealt by document into (doc_id, hashes), a row per document."""

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ranks, hashes in unpacked(batches, width):
            yield _by_document(ids, ranks, hashes)

    return regroup


def _by_document(ids: np.ndarray, ranks: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(ranks, kind="stable")
    ranks, hashes = ranks[order], hashes[order]
    edges = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1], True]) if len(ranks) else np.zeros(1, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[ranks[edges[:-1]].astype(np.int64)], pa.int64()),
            pa.array([hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        ],
        names=["doc_id", "hashes"],
    )
