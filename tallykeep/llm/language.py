"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams of one to three letters, most frequent
first. A document's own list is compared to each profile: every n-gram costs the
difference of its two places, one the profile lacks costs the length of the profile, and the
language with the least total wins. N-grams are taken inside words, whose ends
count as a letter of their own; letters are those of Unicode, in lower case, and all else
separates words. An n-gram is its code points in one integer, so different n-grams never meet.

Counts for profiles are taken over all rows learnt from. Profiles go to the tasks in
blocks of ``LANGUAGES_AT_ONCE`` languages, a bounded size whatever the table holds.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text where
nothing could be learnt; equal n-gram counts are ordered by code point, equal distances go to
the language first in order; a row without an id is not learnt from; repeated rows count
and are answered as often as they occur; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches

# Places of a language's profile, and of a document's own list.
PROFILE_GRAMS = 500
DOCUMENT_GRAMS = 300
LANGUAGES_AT_ONCE = 1000
UNKNOWN = "und"
# N-grams a task holds before it hands its counts on.
COUNTED_GRAMS = 1 << 20

_EDGE = 1  # the end of a word; code point 1 is no letter
_SHIFT = np.uint64(21)


@cache
def _folding() -> np.ndarray:
    """For every code point its lower-case letter, or the word edge."""
    folded = np.full(0x110000, _EDGE, dtype=np.uint64)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            folded[code] = ord(lower) if len(lower) == 1 else code
    return folded


def grams_of(text: str | None) -> np.ndarray:
    """All n-grams of a text, with repeats; none if it has no letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32)
    letters = np.empty(len(codes) + 2, dtype=np.uint64)
    letters[0] = letters[-1] = _EDGE
    letters[1:-1] = _folding()[codes]
    inside = letters != _EDGE
    letters = letters[np.r_[True, inside[1:] | inside[:-1]]]
    inside = letters != _EDGE
    two = (letters[:-1] << _SHIFT) | letters[1:]
    three = (two[:-1] << _SHIFT) | letters[2:]
    return np.concatenate([letters[inside], two[inside[:-1] | inside[1:]], three[inside[1:-1]]])


def most_frequent(grams: np.ndarray, most: int) -> np.ndarray:
    """Distinct n-grams by falling count, then by code points, the first ``most`` of them."""
    distinct, counts = np.unique(grams, return_counts=True)
    return distinct[np.argsort(-counts, kind="stable")[:most]]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row's id keeps it out of what profiles learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, summed as far as memory allows."""
    waiting: dict[str, list] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams = grams_of(text)
            waiting.setdefault(lang, []).append((grams, np.ones(len(grams), dtype=np.int64)))
            size += len(grams)
            if size > COUNTED_GRAMS:
                waiting = {lang: [_summed(parts)] for lang, parts in waiting.items()}
                size = sum(len(parts[0][0]) for parts in waiting.values())
                if size > COUNTED_GRAMS // 2:
                    yield from _rows(waiting)
                    waiting, size = {}, 0
    yield from _rows({lang: [_summed(parts)] for lang, parts in waiting.items()})


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([part[0] for part in parts])
    counts = np.concatenate([part[1] for part in parts])
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    heads = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, dtype=np.int64)
    return grams[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _rows(counted: dict[str, list]) -> Iterator[pa.RecordBatch]:
    for lang, ((grams, counts),) in counted.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
            names=["lang", "gram", "n"],
        )


def profiles(labelled: DataFrame, length: int = PROFILE_GRAMS) -> DataFrame:
    """(lang, gram, place) from rows (lang, text): every language's most frequent n-grams, place from 0."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(_count, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return totals.withColumn("place", place).filter(F.col("place") <= length).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """Places of n-grams in some languages' profiles, as a table of n-grams by languages."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int):
        self.length = length
        self.names = sorted({lang for lang, _, _ in rows})
        self.grams = np.array(sorted({gram for _, gram, _ in rows}), dtype=np.uint64)
        # a last row of n-grams that no profile holds
        self.places = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int32)
        number = {name: i for i, name in enumerate(self.names)}
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.grams, np.uint64(gram)), number[lang]] = place

    def distances(self, own: np.ndarray) -> np.ndarray:
        """The out-of-place distance of a document's list to each language."""
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        places = self.places[at]
        apart = np.abs(places - np.arange(len(own))[:, None])
        return np.where(places < 0, self.length, np.minimum(apart, self.length)).sum(axis=0)


_FOUND = "doc_id long, held_out boolean, text string, lang string, distance long, worst long"


def _nearest(known: Profiles):
    """Keep for every row the language of least distance, of those met before and these."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, distances = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            worst = [None] * len(langs)
            for i, text in enumerate(batch.column(2).to_pylist()):
                own = most_frequent(grams_of(text), DOCUMENT_GRAMS)
                if not len(own):
                    continue
                worst[i] = len(own) * known.length
                found = known.distances(own)
                best = int(found.argmin())
                if distances[i] is None or (int(found[best]), known.names[best]) < (distances[i], langs[i]):
                    langs[i], distances[i] = known.names[best], int(found[best])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(langs, pa.string()), pa.array(distances, pa.int64()), pa.array(worst, pa.int64())],
                names=["doc_id", "held_out", "text", "lang", "distance", "worst"],
            )

    return nearest


def identify(docs: DataFrame, learnt: DataFrame, length: int = PROFILE_GRAMS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text), by profiles ``learnt``.

    The score is 1 for a document listed exactly like the profile, 0 for one that shares nothing with it.
    """
    bounded_batches(docs.sparkSession)
    key = F.col("doc_id").cast("long")
    found = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col("text").cast("string").alias("text"))
    for name, kind in (("lang", "string"), ("distance", "long"), ("worst", "long")):
        found = found.withColumn(name, F.lit(None).cast(kind))
    names = [row.lang for row in learnt.select("lang").distinct().orderBy("lang").toLocalIterator()]
    for first in range(0, len(names), LANGUAGES_AT_ONCE):
        block = learnt.filter(F.col("lang").isin(names[first : first + LANGUAGES_AT_ONCE]))
        known = Profiles([tuple(row) for row in block.select("lang", "gram", "place").collect()], length)
        found = found.mapInArrow(_nearest(known), _FOUND)
    score = F.coalesce(1 - F.col("distance") / F.col("worst"), F.lit(0.0))
    return found.select("doc_id", "held_out", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def learnt_and_identified(docs: DataFrame) -> DataFrame:
    """Profiles from the labelled rows that are not held out, applied to every row of ``docs`` (doc_id, text, lang)."""
    rows = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id").cast("long"))).select("lang", "text")
    learnt = profiles(rows)
    kept = learnt.persist()
    try:
        return identify(docs, kept)
    finally:
        kept.unpersist()
