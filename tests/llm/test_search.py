"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallykeep.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [one.translate(LOWER) for one in TERM.findall(text or "")]


def plain(docs, items, most=10):
    held = [(i, Counter(terms(text)), len(terms(text))) for i, text in docs]
    held = [one for one in held if one[2]]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    w = {term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for term, n in df.items()}
    rows = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, counts, n in held:
            m = 25 + 75 * n * n_docs // length
            score = sum(k * w[t] * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t, k in asked.items() if t in counts)
            if score > 0 and i is not None:
                found.append((-score, i))
        rows += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:most], start=1)]
    return sorted(rows, key=repr)


def run(spark, docs, items):
    table = spark.createDataFrame([(i, x, 5) for i, x in docs], "doc_id long, text string, score int").repartition(4)
    asked = spark.createDataFrame([(i, x, 6) for i, x in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in search.search(table, asked).collect()), key=repr)


def corpus(seed, size):
    rng = random.Random(seed)
    pool = [f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(4000)] + ["ÉCOLE", "école", "x-ray", "it's"]
    docs = [(i * 7 - 30, " ".join(rng.choices(pool, k=rng.randint(1, 60)))) for i in range(size)]
    copy = docs[3][1]
    docs += [(5000 + i, copy) for i in range(60)] + [(None, copy), (9001, None), (9002, ""), (9003, "?!"), (9004, "w1 " * 20_000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.randint(1, 25)))) for i in range(20)]
    return docs, items + [(50, copy), (50, copy.upper()), (51, None), (52, ""), (53, "nobodyhasthis"), (None, "w1 w1 w2")]


@pytest.mark.parametrize("end, cells, block", [(32, 1 << 22, 2000), (2, 4000, 7), (1, 1, 2000)])
def test_against_every_document(spark, monkeypatch, end, cells, block):
    """Also with small trees, trees divided to single documents, and several blocks of items."""
    monkeypatch.setattr(search, "END_DOCUMENTS", end)
    monkeypatch.setattr(search, "CELLS", cells)
    monkeypatch.setattr(search, "BLOCK_ITEMS", block)
    docs, items = corpus(end, 200)
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(1, 5)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def grown(seed, size, width):
    rng = np.random.default_rng(seed)
    paths = [np.sort(rng.choice(width, size=rng.integers(1, width // 2), replace=False, p=np.arange(width, 0, -1) / np.arange(1, width + 1).sum())) for _ in range(size)]
    frequencies = [rng.integers(1, 4, len(path)) for path in paths]
    factors = rng.integers(40, 200, size).tolist()
    return search.PathTree(list(range(size)), factors, paths, frequencies, width)


@pytest.mark.parametrize("seed", range(4))
def test_nodes_bound_what_is_below_them(seed):
    tree = grown(seed, 300, 40)
    rng = np.random.default_rng(seed)
    wanted, weights = np.sort(rng.choice(40, 6, replace=False)), rng.integers(1, 5000, 6)
    own = search.scores(tree.vectors[:, wanted], tree.factors, weights, 8)
    bounds = search.scores(tree.largest[:, wanted], tree.least, weights, 8)
    for node, below in enumerate(tree.children):
        begin, end = tree.begins[node], tree.ends[node]
        assert own[begin:end].max() <= bounds[node]
        if len(below):
            assert [tree.begins[i] for i in below] == [begin, *[tree.ends[i] for i in below[:-1]]] and tree.ends[below[-1]] == end
    hits = search.Hits(10)
    looked = search.branch_and_bound(tree, wanted, weights, hits, 8)
    best = np.lexsort((tree.ids, -own))[:10]
    assert list(hits.scores) == list(own[best]) and list(hits.ids) == list(tree.ids[best]) and looked <= 300


def test_subtrees_that_cannot_win_are_left_out():
    """Documents of two kinds on two branches; an item of one kind scores none of the other's."""
    paths = [np.array([0, 2]) if i < 500 else np.array([1, 3]) for i in range(1000)]
    tree = search.PathTree(list(range(1000)), [100] * 1000, paths, [np.array([1, 1 + i % 3]) for i in range(1000)], 4)
    hits = search.Hits(10)
    assert search.branch_and_bound(tree, np.array([2]), np.array([1000]), hits, 8) < 300
    assert list(hits.ids) == [i for i in range(500) if i % 3 == 2][:10]
