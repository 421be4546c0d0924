"""N-gram Jaccard join: count-vector R-trees over documents' word shingles.

Two documents link when their sets of word shingles overlap by a given share of their
union, such as 85 percent of that of 4-word shingles. A set's shingles are hashed into groups; the numbers per group are a point.
Two sets share at most the sum, over groups, of the smaller number, so a tree whose
nodes keep the largest number per group bounds the overlap of a probe with everything
below a node. Pairs the bound admits are verified on the sets themselves.

No tree can hold the corpus, and a probe must not visit every tree. So points are dealt
to trees by shared shingles: two linked sets share one of their rarest ceil(15 %) + 1
shingles, in any common order. Shingles are ordered by how many the corpus has in their
counting slot, so passages that many documents share come last. Each such shared shingle
is the root of a small tree, and its probes give candidate links.

What the candidates connect is gathered, each set once, and joined again by a tree; sets that
their shingles' hashes link are compared once more by their words. A set already connected to
the probe needs no further look. A gathering too large for one cell is joined in rounds: first
every cell holds a share of its sets and the same few pivots, which connects nearly all of
a group of near copies; only sets still apart from the largest component then meet
all cells. Each set travels once per round, and every cell and tree names a component
by its smallest member, so equal findings are one link.

Exact copies, texts of the same words in order, are one set throughout: they meet only in the
final lookup by a 128-bit digest of their words.

Defined cases: a null or empty text, or one without words, has no shingles and links
with nothing; fewer than four words are one shingle; rows without an id have no
component and link nothing; rows that share an id are versions of one document, which
links by any of them; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches, durable, free_name, partitions, shared_root, with_digest
from tallykeep.llm.graph import components
from tallykeep.llm.packing import PACKED, packed, unpacked
from tallykeep.llm.words import digest, mix, shingle_sets
from tallykeep.session import remove_folder

# Shingles of a set per group of its point, about; more groups bound more tightly.
SHINGLES_PER_GROUP = 8
# Counters of the corpus' shingles. Their number is fixed; they only order shingles.
SLOT_BITS = 16
# Shingles of the sets in one cell, about; a larger gathering is joined in rounds.
CELL_SHINGLES = 1 << 18
# Sets of a large gathering that all its cells hold in the first rounds, about.
PIVOTS = 16
# Rounds with pivots, each with cells of its own, before sets still apart meet all cells.
ROUNDS = 2

_DESCRIBED = "doc_id long, n long, low long, high long, point binary, slots binary"


class Linking(NamedTuple):
    """Words of a shingle, and the least share of the union, in percent, that linked sets share."""

    words: int
    percent: int

    def least_overlap(self, sizes):
        """The least intersection of linked sets, from the sum of their sizes."""
        return -(-self.percent * sizes // (100 + self.percent))

    def least_size(self, size):
        """The least size of a set linked to one of this size."""
        return -(-self.percent * size // 100)

    def prefix_length(self, size: int) -> int:
        """So many of a set's first shingles meet those of every linked set."""
        return size - self.least_size(size) + 1

    def holds(self, shared: int, sizes: int) -> bool:
        return 100 * shared >= self.percent * (sizes - shared)


JOIN = Linking(words=4, percent=85)
NEAR_DUPLICATE = Linking(words=5, percent=80)


def group_bits(size: int) -> int:
    return max(3, (max(size - 1, 0) // SHINGLES_PER_GROUP).bit_length())


def point_of(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The number of shingles in each of 2 ** bits groups."""
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def word_shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """A text's shingles as words."""
    found = (text or "").encode().lower().split()
    size = min(size, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


class Roots:
    """Components of numbered sets; the smaller of two is relabelled when they join."""

    def __init__(self, labels: np.ndarray):
        self.of = labels.copy()
        self.members: dict[int, list[int]] = {}
        for i, label in enumerate(labels.tolist()):
            self.members.setdefault(label, []).append(i)

    def unite(self, i: int, j: int) -> bool:
        a, b = int(self.of[i]), int(self.of[j])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.of[moved] = a
        self.members[a] += moved
        return True

    def edges(self, names: list[int]) -> tuple[list[int], list[int]]:
        """Every member of a component but its smallest, and that smallest, by name."""
        ends: tuple[list, list] = ([], [])
        for members in self.members.values():
            if len(members) > 1:
                held = {names[i] for i in members}
                least = min(held)
                held.discard(least)
                ends[0].extend(held)
                ends[1].extend([least] * len(held))
        return ends


def _edges_batch(ends: tuple[list[int], list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in ends], names=["a", "b"])


def coarser(point: np.ndarray, bits: int) -> np.ndarray:
    """The same point with 2 ** bits groups."""
    return point if len(point) == 1 << bits else point.reshape(1 << bits, -1).sum(axis=1)


class CountTree:
    """An R-tree over points of group counts, packed bottom-up in order of size."""

    FAN = 16

    def __init__(self, sizes: np.ndarray, points: np.ndarray, link: Linking):
        self.link = link
        # neighbours in size, then along the most varied group, share a leaf
        varied = int(np.argmax(points.var(axis=0)))
        self.order = np.lexsort((points[:, varied], np.log2(sizes + 1).round(1)))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            upper, least, most = self.levels[-1]
            heads = np.arange(0, len(upper), self.FAN)
            self.levels.append(
                (np.maximum.reduceat(upper, heads), np.minimum.reduceat(least, heads), np.maximum.reduceat(most, heads))
            )

    def probe(self, size: int, point: np.ndarray) -> np.ndarray:
        """Indexes of the points that may be linked to a set of this size and point."""
        link = self.link
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least, most = self.levels[depth]
            fits = (most[at] >= link.least_size(size)) & (link.least_size(least[at]) <= size)
            at = at[fits]
            bound = np.minimum(upper[at], point).sum(axis=1)
            at = at[bound >= link.least_overlap(size + np.maximum(least[at], link.least_size(size)))]
            if depth and len(at):
                below = (at[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                at = below[below < len(self.levels[depth - 1][0])]
            elif not len(at):
                return at
        exact = link.least_overlap(size + self.levels[0][1][at])
        at = at[np.minimum(self.levels[0][0][at], point).sum(axis=1) >= exact]
        return self.order[at]


def join_trees(
    sizes: np.ndarray,
    points: list[np.ndarray],
    roots: Roots,
    link: Linking,
    verify: Callable[[int, int], bool],
    sides: np.ndarray | None = None,
) -> None:
    """Connect sets by trees; ``roots`` numbers the components so far and is updated.

    There is a tree per number of groups; a set probes the tree of its own number and, as
    linked sets differ little in size, the one of half as many. With ``sides``, sets of
    one side do not meet.
    """
    bits = np.array([int(len(point)).bit_length() - 1 for point in points])
    for level in np.unique(bits):
        held = np.flatnonzero(bits == level)
        tree = CountTree(sizes[held], np.stack([points[i] for i in held]), link)
        for i in np.flatnonzero((bits == level) | (bits == level + 1)):
            if len(roots.members) == 1:
                return
            found = held[tree.probe(int(sizes[i]), coarser(points[i], int(level)))]
            if sides is not None:
                found = found[sides[found] != sides[i]]
            for j in found[roots.of[found] != roots.of[i]]:
                if roots.of[i] != roots.of[j] and verify(int(i), int(j)):
                    roots.unite(int(i), int(j))


def _describe(link: Linking):
    """Size, fingerprint and point of every set, and one row of shingles per counting slot."""
    names = ["doc_id", "n", "low", "high", "point", "slots"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def record(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            columns: list[list] = [ids, [], [], [], [], [None] * len(ids)]
            for row, shingles in shingle_sets(batch.column(1), link.words):
                low, high = digest(batch.column(1)[row].as_py())
                columns[1].append(len(shingles))
                columns[2].append(low)
                columns[3].append(high)
                columns[4].append(point_of(shingles, group_bits(len(shingles))).astype(np.uint32).tobytes())
                slots += np.bincount((shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(slots))
            yield record(columns)
        yield record([[None], [None], [None], [None], [None], [slots.tobytes()]])

    return describe


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for batch in batches:
        for slots in batch.column(0):
            total += np.frombuffer(slots.as_py(), dtype=np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total)), pa.int64()), pa.array(total, pa.int64())], names=["slot", "n"]
    )


def _emit_prefixes(parts: int, slots: np.ndarray, link: Linking):
    """The rarest shingles of every set, enough to meet every linked set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints: dict[int, np.ndarray] = {}
            for row, shingles in shingle_sets(batch.column(0), link.words):
                if len(shingles):
                    rarity = slots[(shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                    order = np.lexsort((shingles, rarity))[: link.prefix_length(len(shingles))]
                    prints[digest(batch.column(0)[row].as_py())[0]] = shingles[order]
            yield packed(parts, list(prints), list(prints.values()), np.uint32)

    return emit


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each partition: the sets that share a shingle, and the distinct groups of them."""
    for part, ids, ranks, hashes in _with_part(batches):
        rows = np.unique((hashes.astype(np.uint64) << np.uint64(32)) | ranks)
        key, rank = rows >> np.uint64(32), (rows & np.uint64(2**32 - 1)).astype(np.int64)
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, dtype=bool)
        heads = np.flatnonzero(new)
        lengths = np.diff(np.r_[heads, len(key)])
        # groups of the same members are one; a group's members are in order
        shared = np.repeat(lengths > 1, lengths)
        rank, lengths = rank[shared], lengths[lengths > 1]
        if not len(lengths):
            continue
        heads = np.r_[0, np.cumsum(lengths)[:-1]]
        marks = np.add.reduceat(mix(rank.astype(np.uint64) + np.uint64(1)), heads)
        _, firsts = np.unique(marks, return_index=True)
        members = np.concatenate([rank[heads[i] : heads[i] + lengths[i]] for i in firsts])
        used, members = np.unique(members, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([ids[used].tobytes()], pa.binary()),
                pa.array([members.astype(np.int32).tobytes()], pa.binary()),
                pa.array([lengths[firsts].astype(np.int32).tobytes()], pa.binary()),
            ],
            names=["part", "prints", "members", "lengths"],
        )


def _with_part(batches: Iterator[pa.RecordBatch]):
    """Like ``unpacked``, with the partition's number."""
    by_part: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        for i, part in enumerate(batch.column(0).to_pylist()):
            by_part.setdefault(part, []).append(batch.slice(i, 1))
    while by_part:
        part, rows = by_part.popitem()
        for ids, ranks, hashes in unpacked(iter(rows), np.uint32):
            yield part, ids, ranks, hashes


_POINT_NAMES = ["bucket", "part", "prints", "sizes", "bits", "counts"]
_POINTS = "bucket int, part int, prints binary, sizes binary, bits binary, counts binary"


def _bucket_of(prints: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(prints.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _points_row(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=_POINT_NAMES)




def _ask(buckets: int):
    """For each partition, the sets whose points it needs, dealt by set."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                prints = np.frombuffer(row["prints"], np.int64)
                to = _bucket_of(prints, buckets)
                rows = [(int(k), row["part"], prints[to == k].tobytes(), None, None, None) for k in np.unique(to)]
                yield _points_row(rows)

    return ask


def _offer(buckets: int):
    """Sets' sizes and points, dealt by set; many travel in one row."""

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            prints = np.array([row["low"] for row in rows], dtype=np.int64)
            to = _bucket_of(prints, buckets)
            sets = [(row["low"], row["n"], np.frombuffer(row["point"], np.uint32)) for row in rows]
            shares = {int(k): [sets[i] for i in np.flatnonzero(to == k)] for k in np.unique(to)}
            yield _points_row([(k, None, *_bundle(share)) for k, share in shares.items()])

    return offer


def _bundle(sets: list[tuple[int, int, np.ndarray]]) -> tuple[bytes, bytes, bytes, bytes]:
    """Prints, sizes, group bits and group counts of sets; counts are small and pack well."""
    counts = np.concatenate([point for *_, point in sets])
    bits = [len(point).bit_length() - 1 for *_, point in sets]
    return (
        np.array([one for one, *_ in sets], dtype=np.int64).tobytes(),
        np.array([size for _, size, _ in sets], dtype=np.int64).tobytes(),
        np.array(bits, dtype=np.uint8).tobytes(),
        zlib.compress(counts.astype(np.uint32).tobytes(), 1),
    )


def _unbundled(row: dict) -> Iterator[tuple[int, int, np.ndarray]]:
    counts, done = np.frombuffer(zlib.decompress(row["counts"]), np.uint32), 0
    columns = np.frombuffer(row["prints"], np.int64).tolist(), np.frombuffer(row["sizes"], np.int64).tolist()
    for one, size, bits in zip(*columns, np.frombuffer(row["bits"], np.uint8).tolist()):
        yield one, size, counts[done : done + (1 << bits)]
        done += 1 << bits


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The points asked for, per partition; a task holds the points of its share of all sets."""
    asked, points = [], {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["counts"] is None:
                asked.append((row["part"], np.frombuffer(row["prints"], np.int64)))
            else:
                points.update({one: (one, size, point) for one, size, point in _unbundled(row)})
    for part, prints in asked:
        yield _points_row([(None, part, *_bundle([points[one] for one in prints.tolist()]))])


def _candidates(link: Linking):
    """Candidate links among the groups of a partition, as far as they connect sets.

    Rows hold either a partition's groups or some of its sets.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, tuple] = {}
        sets: dict[int, dict[int, tuple[int, np.ndarray]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["members"] is not None:
                    groups[row["part"]] = row["prints"], row["members"], row["lengths"]
                else:
                    known = sets.setdefault(row["part"], {})
                    known.update({one: (size, point.astype(np.int32)) for one, size, point in _unbundled(row)})
        for part, (prints, members, lengths) in groups.items():
            prints = np.frombuffer(prints, np.int64).tolist()
            roots = _join_groups(link, prints, sets.pop(part), np.frombuffer(members, np.int32), np.frombuffer(lengths, np.int32))
            yield _edges_batch(roots.edges(prints))

    return candidates


def _join_groups(link: Linking, prints: list[int], known: dict, members: np.ndarray, lengths: np.ndarray) -> Roots:
    """Connect sets in groups that share a shingle; pairs first, they need no tree."""
    sizes = np.array([known[one][0] for one in prints], dtype=np.int64)
    points = [known[one][1] for one in prints]
    roots = Roots(np.arange(len(prints)))
    heads = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    _join_pairs(link, sizes, points, roots, [(members[h], members[h + 1]) for h in heads[lengths == 2]])
    for h, length in zip(heads[lengths > 2], lengths[lengths > 2]):
        group = members[h : h + length]
        if (roots.of[group] != roots.of[group[0]]).any():
            within = Roots(roots.of[group])
            join_trees(sizes[group], [points[i] for i in group], within, link, lambda i, j: True)
            for together in within.members.values():
                for i in together[1:]:
                    roots.unite(int(group[together[0]]), int(group[i]))
    return roots


def _join_pairs(link: Linking, sizes: np.ndarray, points: list[np.ndarray], roots: Roots, pairs: list) -> None:
    """Pairs that the bound admits: trees of two points, without the tree."""
    for i, j in pairs:
        i, j = int(i), int(j)
        small, large = min(sizes[i], sizes[j]), max(sizes[i], sizes[j])
        if roots.of[i] != roots.of[j] and small >= link.least_size(large):
            bits = min(len(points[i]), len(points[j])).bit_length() - 1
            bound = np.minimum(coarser(points[i], bits), coarser(points[j], bits)).sum()
            if bound >= link.least_overlap(small + large):
                roots.unite(i, j)


def _verified(link: Linking):
    """Links among the sets of each cell; rows come ordered by cell.

    A row names its set; a text that is not the set's (another version of the id) is passed over.
    """

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            cell = [row for row in cell if digest(row[3])[0] == row[0]]
            if len(cell) < 2:
                continue
            names = [row[0] for row in cell]
            sides = np.array([row[1] for row in cell])
            texts = [row[3] for row in cell]
            sets = [one for _, one in shingle_sets(pa.array(texts, pa.string()), link.words)]
            sizes = np.array([len(one) for one in sets], dtype=np.int64)
            points = [point_of(one, group_bits(len(one))) for one in sets]
            in_words: dict[int, set] = {}

            def worded(i: int) -> set:
                if i not in in_words:
                    in_words[i] = word_shingles(texts[i], link.words)
                return in_words[i]

            def linked(i: int, j: int) -> bool:
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if not link.holds(shared, len(sets[i]) + len(sets[j])):
                    return False
                one, other = worded(i), worded(j)
                return link.holds(len(one & other), len(one) + len(other))

            roots = Roots(np.unique([row[2] for row in cell], return_inverse=True)[1])
            join_trees(sizes, points, roots, link, linked, sides if sides.min() != sides.max() else None)
            yield _edges_batch(roots.edges(names))

    return verified


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (low, side, component, text) of one cell at a time."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            cell = row["cluster"], row["first"], row["second"]
            if cell != current and rows:
                yield rows
                rows = []
            current = cell
            rows.append((row["low"], row["side"], row["component"], row["text"]))
    if rows:
        yield rows


def _share_of(salt: int):
    """The share of its gathering a set falls into in a round."""
    return F.pmod(F.xxhash64("low", F.lit(salt)), F.col("shares")).cast("int")


def _with_pivots(placed: DataFrame, salt: int) -> DataFrame:
    """Cells of a round: each set in the cell of its share, a few pivots in every cell."""
    pivot = (F.col("shares") > 1) & (F.pmod(F.xxhash64("low", F.lit(-1 - salt)), F.col("members")) < PIVOTS)
    everywhere = F.sequence(F.lit(0), F.col("shares").cast("int") - 1)
    dealt = placed.withColumn("first", F.explode(F.when(pivot, everywhere).otherwise(F.array(_share_of(salt)))))
    return dealt.withColumn("second", F.lit(0)).withColumn("side", F.lit(0))


def _with_all(placed: DataFrame) -> DataFrame:
    """Cells of the last round: shares of the sets apart from the largest component meet all shares."""
    apart = F.col("component") != F.col("largest")
    away = placed.filter(apart).withColumn("first", _share_of(0))
    asked = away.groupBy("cluster").agg(F.collect_set("first").alias("asked"))  # at most the gathering's shares
    others = F.sequence(F.lit(0), F.col("shares").cast("int") - 1)
    here = away.withColumn("second", F.explode(others)).withColumn("side", F.lit(0))
    there = placed.join(asked, "cluster").withColumn("second", _share_of(0)).withColumn("first", F.explode("asked"))
    return here.unionByName(there.drop("asked").withColumn("side", F.lit(1)))


def _sets(docs: DataFrame, link: Linking) -> tuple[DataFrame, DataFrame]:
    """Every document's set (doc_id, n, low, high, point), and the corpus' slots."""
    described = durable(docs.mapInArrow(_describe(link), _DESCRIBED))
    slots = described.filter(F.col("slots").isNotNull()).select("slots").mapInArrow(_slot_rows, "slot long, n long")
    return described.filter(F.col("slots").isNull()).drop("slots"), slots.groupBy("slot").agg(F.sum("n").alias("n"))


def _candidate_links(docs: DataFrame, nodes: DataFrame, slots: DataFrame, link: Linking) -> DataFrame:
    """(a, b): fingerprints of sets that may be linked, enough to connect all that are."""
    spark = docs.sparkSession
    parts = partitions(spark)
    counted = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for row in slots.collect():  # a fixed number of rows
        counted[row["slot"]] = row["n"]
    texts = docs.filter(F.col("doc_id").isNotNull()).select("text")
    prefixes = texts.mapInArrow(_emit_prefixes(parts, counted, link), PACKED).repartition(parts, "part")
    shared = durable(prefixes.mapInArrow(_share, "part int, prints binary, members binary, lengths binary"))
    # points go where they are asked for in packed rows: one per pair of partitions, not per set
    asked = shared.select("part", "prints").mapInArrow(_ask(parts), _POINTS)
    offered = nodes.select("low", "n", "point").mapInArrow(_offer(parts), _POINTS)
    points = asked.unionByName(offered).repartition(parts, "bucket").mapInArrow(_answer, _POINTS)
    rows = points.drop("bucket").unionByName(shared, allowMissingColumns=True).repartition(parts, "part")
    return rows.mapInArrow(_candidates(link), "a long, b long")


def _joined_cells(texts: DataFrame, cells: DataFrame, link: Linking) -> DataFrame:
    """(a, b): verified links between the sets of each cell (cluster, first, second, side, low, component, doc_id).

    ``cells`` either bear their ``text`` or find it in ``texts`` (low, doc_id, text).
    """
    key = ["cluster", "first", "second"]
    borne = cells if "text" in cells.columns else texts.join(cells, ["low", "doc_id"])
    wanted = borne.select(*key, "side", "low", "component", "text")
    ordered = wanted.repartition(partitions(cells.sparkSession), *key).sortWithinPartitions(*key)
    return ordered.mapInArrow(_verified(link), "a long, b long").distinct()


def _links(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, link: Linking) -> DataFrame:
    """(a, b): verified links between sets that connect all linked ones.

    Gathered sets find their texts once; where later rounds need them again, they read those of
    large gatherings from the shared folder, and no other text moves.
    """
    spark = docs.sparkSession
    gatherings = components(candidates).select(F.col("node").alias("low"), F.col("component").alias("cluster"))
    shares = F.ceil(F.sum("n") / CELL_SHINGLES).cast("long")
    held = nodes.select("low", "n", "doc_id").join(gatherings, "low")
    sizes = held.groupBy("cluster").agg(F.count("*").alias("members"), shares.alias("shares"))
    placed = durable(held.join(durable(sizes), "cluster").withColumn("component", F.col("low")))
    large = placed.filter(F.col("shares") > 1)
    texts = docs.join(placed, "doc_id")
    if large.isEmpty():
        return durable(_joined_cells(texts, _with_pivots(texts, 0), link))
    folder = f"{shared_root(spark).rstrip('/')}/tallykeep-gathered-{uuid.uuid4().hex}"
    texts.write.parquet(folder)
    texts = spark.read.parquet(folder)
    links = durable(_joined_cells(texts, _with_pivots(texts, 0), link))
    again = texts.filter(F.col("shares") > 1).select("low", "doc_id", "text")
    for salt in range(1, ROUNDS + 1):
        apart = durable(_still_apart(large, links))
        if apart.isEmpty():
            break
        cells = _with_pivots(apart, salt) if salt < ROUNDS else _with_all(apart)
        links = durable(links.unionByName(_joined_cells(again, cells, link)))
    remove_folder(spark, folder)
    return links


def _still_apart(large: DataFrame, links: DataFrame) -> DataFrame:
    """The sets of gatherings that hold several components, and the largest component of each."""
    known = components(links).select(F.col("node").alias("low"), F.col("component").alias("found"))
    labelled = large.join(known, "low", "left").withColumn("component", F.coalesce("found", "low")).drop("found")
    counted = labelled.groupBy("cluster", "component").agg(F.count("*").alias("size"))
    several = counted.groupBy("cluster").agg(F.max_by("component", "size").alias("largest"), F.count("*").alias("parts"))
    return labelled.join(several.filter(F.col("parts") > 1).drop("parts"), "cluster")


def _versions(sets: DataFrame) -> DataFrame:
    """(a, b): the sets that rows of one id bear, each with the id's smallest."""
    own = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    several = own.groupBy("doc_id").agg(F.min("low").alias("b"), F.max("low").alias("most")).filter("b != most")
    return own.join(several.select("doc_id", "b"), "doc_id").select(F.col("low").alias("a"), "b").distinct()


def _known_sets(docs: DataFrame, link: Linking, versions_join: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, low, high) of every row, and (n, low, high, doc_id, root) of every set.

    A set's ``doc_id`` is the smallest that bears it, its ``root`` a name of its component.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets, slots = _sets(docs, link)
    # of copies the smallest id stands for all; any of them has the set's point
    nodes = durable(
        sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("n", "low", "high")
        .agg(F.min("doc_id").alias("doc_id"), F.first("point").alias("point"))
    )
    links = _links(docs, nodes, _candidate_links(docs, nodes, slots, link), link)
    linked = components(links.unionByName(_versions(sets)) if versions_join else links)
    known = nodes.join(linked, nodes["low"] == linked["node"], "left")
    root = F.coalesce("component", "low").alias("root")
    return sets.select("doc_id", "n", "low", "high"), durable(known.select("n", "low", "high", "doc_id", root))


def link_components(docs: DataFrame, link: Linking = JOIN) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    sets, known = _known_sets(docs, link, versions_join=True)
    least = known.groupBy("root").agg(F.min("doc_id").alias("component"))
    named = durable(known.drop("doc_id").join(least, "root").drop("root"))
    found = sets.join(named, ["n", "low", "high"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def first_of_each(docs: DataFrame, link: Linking = NEAR_DUPLICATE) -> DataFrame:
    """One row of each group of linked texts, with its columns unchanged: that of the smallest id.

    Rows that share an id and their words are one; rows that share an id alone are judged
    each by its text. Rows without an id all stay.
    """
    sets, known = _known_sets(docs, link, versions_join=False)
    first = known.groupBy("root").agg(F.min(F.struct("doc_id", "n", "low", "high")).alias("first")).select("first.*")
    bearing = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "low", "high").distinct()
    dropped = bearing.join(first.select("doc_id", "low", "high"), ["doc_id", "low", "high"], "left_anti")
    low, high, place = free_name(docs, "low"), free_name(docs, "high"), free_name(docs, "place")
    marked = with_digest(docs, low, high)
    dropped = dropped.withColumnsRenamed({"low": low, "high": high})
    kept = marked.join(dropped, ["doc_id", low, high], "left_anti")
    others = [F.col(f"`{name}`") for name in docs.columns if name != "doc_id"]
    order = Window.partitionBy("doc_id", low, high).orderBy(*others)
    numbered = kept.withColumn(place, F.row_number().over(order))
    return numbered.filter(F.col("doc_id").isNull() | (F.col(place) == 1)).select(*[F.col(f"`{name}`") for name in docs.columns])
