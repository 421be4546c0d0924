"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tallykeep.llm import resample
from tallykeep.llm.common import durable
from tallykeep.llm.resample import Draw

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, draw):
    found = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(found[i : i + n]) for n in range(1, draw.longest_run + 1) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(run.encode()) % draw.buckets for run in runs]


def plain(docs, target, draw):
    """Rows (doc_id, n_features, weight, score, rank) by sorting everything."""
    corpus, wanted = np.zeros(draw.buckets, int), np.zeros(draw.buckets, int)
    for _, text in docs:
        np.add.at(corpus, features(text, draw)[1], 1)
    for text in target:
        np.add.at(wanted, features(text, draw)[1], 1)
    s, t = int(corpus.sum()), int(wanted.sum())
    gain = [
        math.floor(1000 * math.log((b + 1) * (s + draw.buckets) / ((a + 1) * (t + draw.buckets)))) for a, b in zip(corpus, wanted)
    ]
    rows = []
    for i, text in docs:
        n_words, held = features(text, draw)
        weight = sum(gain[b] for b in held)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{draw.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(held), weight, score, None, n_words])
    eligible = sorted((r for r in rows if r[5] >= draw.least_words and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for rank, row in enumerate(eligible[: draw.percent * len(eligible) // 100], start=1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def run(spark, docs, target, draw=resample.DEFAULT):
    table = spark.createDataFrame([(i, x, 1) for i, x in docs], "doc_id long, text string, score int").repartition(5)
    wanted = spark.createDataFrame([(x, 2) for x in target], "text string, rank int")
    return sorted((tuple(r) for r in resample.drawn(table, wanted, draw).collect()), key=repr)


@pytest.mark.parametrize("draw", [Draw(percent=40), Draw(longest_run=3, buckets=97, least_words=5, percent=100)])
def test_against_plain_python(spark, draw):
    rng = random.Random(5)
    pool = ["Alpha", "beta", "ÉTÉ", "été", "x9", "don't", "naïve-ly", "<b>", "日本"]
    docs = [(rng.randrange(-(2**62), 2**62), " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for _ in range(80)]
    docs += [(None, "alpha " * 30), (7, None), (8, ""), (9, "# $ %"), (11, "beta " * 30_000), (-(2**63), "été " * 25), (2**63 - 1, "é " * 25)]
    target = ["beta beta été", None, "日本 x9"]
    assert run(spark, docs, target, draw) == plain(docs, target, draw)


def test_empty_tables_and_equal_texts(spark):
    assert run(spark, [], ["a"]) == []
    docs = [(i, "same words " * 12) for i in range(30)]
    assert run(spark, docs, []) == plain(docs, [], resample.DEFAULT)
    assert run(spark, [(3, "few words")], []) == plain([(3, "few words")], [], resample.DEFAULT)


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_radix_passes_sort_stably(spark, monkeypatch, block):
    """Blocks smaller than the digits' groups, keys of 64 bits, equal keys in the order of reading."""
    monkeypatch.setattr(resample, "BLOCK_ROWS", block)
    rng = random.Random(block)
    rows = [(rng.choice([-5, 0, 3, 2**40]), rng.choice([1, 2, -(2**63), 2**63 - 1]), i) for i in range(90)]
    frame = durable(spark.createDataFrame(rows, "a long, b long, at long").coalesce(3))
    placed = {r.place: (r.a, r.b, r.at) for r in resample.radix_ranked(frame, ["a", "b"]).collect()}
    read = {r.at: n for n, r in enumerate(frame.collect())}
    assert [placed[i] for i in range(90)] == sorted(rows, key=lambda r: (r[0], r[1], read[r[2]]))


def test_equal_keys_take_one_pass(spark):
    frame = durable(spark.createDataFrame([(5, i) for i in range(10)], "a long, at long").coalesce(1))
    assert [r.at for r in resample.radix_ranked(frame, ["a"]).orderBy("place").collect()] == list(range(10))


def test_drawn_rows_keep_their_columns(spark):
    docs = [(i, f"common words {'target ' * (20 if i % 2 else 0)}{'other ' * 20}") for i in range(40)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    kept = resample.resample(table, spark.createDataFrame([("target " * 9000,)], "text string"), Draw(percent=10))
    assert kept.columns == table.columns and kept.count() == 4 and all(r.doc_id % 2 for r in kept.collect())
