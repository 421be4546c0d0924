import random

import numpy as np
import pytest

from llm import plain
from tallykeep.llm import graph, ngram_join
from tallykeep.llm.ngram_join import JOIN, NEAR_DUPLICATE, CountTree, Linking


def found(spark, docs, link=JOIN):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {row.doc_id: (row.n_shingles, row.component_id) for row in ngram_join.link_components(frame, link).collect()}


def changed(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def corpus(seed, texts, copies, length):
    """Texts that share passages, each with copies that differ more and more."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(20)]
    docs = []
    for _ in range(texts):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(*length))]
        if rng.random() < 0.5:
            base[3:3] = passage
        docs += [" ".join(changed(rng, base, c if c < 4 else c * 2)) for c in range(copies)]
    rng.shuffle(docs)
    return [(i * 3, text) for i, text in enumerate(docs)]


@pytest.mark.parametrize("link", [JOIN, NEAR_DUPLICATE])
def test_against_every_pair(spark, link):
    docs = corpus(1, 25, 6, (1, 160))
    assert found(spark, docs, link) == plain.components(docs, link.words, link.percent)


@pytest.mark.parametrize("rounds", [1, 2])
def test_a_large_gathering_is_joined_in_rounds(spark, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", 600)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    docs = corpus(2, 2, 30, (120, 160))
    assert found(spark, docs) == plain.components(docs, 4, 85)


def test_texts_and_links_grow_with_a_group_not_its_square(spark, monkeypatch):
    """Near copies of one text: text rows sent to cells, candidate links and verified links."""
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", 64 * 127)
    seen = []
    joined, linked = ngram_join._joined_cells, ngram_join._links

    def counting_cells(docs, cells, link):
        result = joined(docs, cells, link)
        seen.extend([cells.count(), result.count()])
        return result

    def counting_links(docs, nodes, candidates, link):
        seen.append(candidates.distinct().count())
        return linked(docs, nodes, candidates, link)

    monkeypatch.setattr(ngram_join, "_joined_cells", counting_cells)
    monkeypatch.setattr(ngram_join, "_links", counting_links)
    for copies in (400, 800, 1600):
        rng = random.Random(copies)
        base = [f"b{i}" for i in range(130)]
        docs = [(i, " ".join(changed(rng, base, 1))) for i in range(copies)]
        seen.clear()
        assert {component for _, component in found(spark, docs).values()} == {0}
        assert max(seen) <= 2 * copies


def test_texts_of_the_corpus_are_read_for_one_round_only(spark, monkeypatch, tmp_path):
    """Later rounds read the texts of large gatherings, which are few, and leave no file behind."""
    import os

    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", 600)
    monkeypatch.setattr(ngram_join, "PIVOTS", 0)
    joined, asked = ngram_join._joined_cells, []

    def looking(texts, cells, link):
        if "text" not in cells.columns:
            asked.append(texts.count())
        else:
            asked.append(0)
        return joined(texts, cells, link)

    monkeypatch.setattr(ngram_join, "_joined_cells", looking)
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    docs = corpus(2, 2, 30, (120, 160))
    few = len(docs)
    docs += [(10_000 + i, " ".join(f"o{i}_{k}" for k in range(30))) for i in range(300)]
    assert found(spark, docs) == plain.components(docs, 4, 85)
    assert len(asked) > 1 and asked[0] == 0 and max(asked) <= few
    assert not [name for name in os.listdir(root) if "gathered" in name]


def test_words_that_hash_alike_are_not_equal(spark):
    """Words of opposite repeating patterns, which collide under powers modulo 2 ** 64."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    docs = [(1, one), (2, other), (3, " ".join([one] * 20)), (4, " ".join([other] * 20))]
    assert found(spark, docs) == {1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4)}


def test_verified_links_compare_words(monkeypatch):
    """Cells do not trust hashes: with shingles that all hash alike nothing else links."""
    import pyarrow as pa

    texts = ["a b c d", "e f g h", "A  b c d", "a b c d x"]
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda rows, size: ((i, np.ones(1, np.uint64)) for i in range(len(rows))))
    low = [ngram_join.digest(text)[0] for text in texts]
    rows = [dict(cluster=1, first=0, second=0, low=low[i], side=0, component=low[i], text=texts[i]) for i in (0, 1, 3)]
    batches = ngram_join._verified(JOIN)(iter([pa.RecordBatch.from_pylist(rows)]))
    assert [batch.num_rows for batch in batches] == [0]
    assert low[0] == low[2]


def test_defined_cases(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two three"), (7, "One TWO\x0bthree"),
        (8, "one two three four"), (9, long), (10, long + " y"), (11, "É a b c"), (12, "é a b c"), (13, "a b c"),
    ]
    result = found(spark, docs)
    assert result == plain.components(docs, 4, 85)
    assert [result[i][1] for i in (1, 2, 3, 5, 7, 10, 12)] == [1, 2, 3, 4, 6, 9, 12]


def test_ids_that_are_missing_or_repeated(spark):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (2, "a b c d e"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    result = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.link_components(frame).collect())
    assert result == [(0, 0, None), (0, 2, None), (2, 2, 2), (5, 2, 2), (5, 2, 2)]


def test_versions_of_an_id_are_one_document(spark):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(30)) for name in "abcd")
    rows = [(3, b), (5, a), (5, b), (7, a), (8, c), (8, d), (9, d + " x"), (6, c), (10, "nothing like the others here"), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    result = sorted((r.doc_id, r.component_id) for r in ngram_join.link_components(frame).collect() if r.n_shingles)
    assert result == [(3, 3), (5, 3), (5, 3), (6, 6), (7, 3), (8, 6), (8, 6), (9, 6), (10, 10)]
    assert sorted(tuple(r) for r in ngram_join.first_of_each(frame).collect()) == [(3, b), (5, a), (6, c), (8, ""), (8, d), (10, rows[8][1])]


def test_texts_without_an_id_link_nothing(spark):
    text = [f"x{i}" for i in range(60)]
    rows = [(None, " ".join(text)), (None, " ".join(text + ["y"])), (4, " ".join(text + ["z"])), (9, " ".join(text + ["w"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in ngram_join.link_components(frame).collect() if r.doc_id) == [(4, 4), (9, 4)]


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(3, text, "a"), (1, text + " y", "b"), (1, text + " y", "b"), (7, "other words entirely here now", "c"), (None, text, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, place string")
    kept = ngram_join.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.place) for r in kept.collect()) == [(0, "d"), (1, "b"), (7, "c")]


def test_empty_table(spark):
    assert found(spark, []) == {}


@pytest.mark.parametrize("seed", range(5))
def test_a_tree_finds_all_that_may_be_linked(seed):
    rng = np.random.default_rng(seed)
    link = Linking(4, 85)
    base = rng.integers(0, 6, size=(6, 16))
    points = np.abs(np.repeat(base, 40, axis=0) + rng.integers(-1, 2, size=(240, 16)) * (rng.random((240, 16)) < 0.2))
    sizes = points.sum(axis=1)
    tree = CountTree(sizes, points, link)
    for i in range(0, 240, 7):
        bound = np.minimum(points, points[i]).sum(axis=1)
        expected = np.flatnonzero(bound >= link.least_overlap(sizes + sizes[i]))
        assert sorted(tree.probe(int(sizes[i]), points[i])) == list(expected)


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(4)
    for link in (JOIN, NEAR_DUPLICATE):
        for _ in range(3000):
            a = set(rng.sample(range(1000), rng.randint(1, 60)))
            b = set(rng.sample(sorted(a), rng.randint(max(1, len(a) - 8), len(a)))) | set(rng.sample(range(1000), rng.randint(0, 6)))
            if link.holds(len(a & b), len(a) + len(b)):
                assert set(sorted(a)[: link.prefix_length(len(a))]) & set(sorted(b)[: link.prefix_length(len(b))])
                assert len(a & b) >= link.least_overlap(len(a) + len(b)) and len(b) >= link.least_size(len(a))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (300, 299)]
    frame = spark.createDataFrame(edges, "a long, b long")
    result = {row.node: row.component for row in graph.components(frame).collect()}
    assert {node for node in result if result[node] == 0} == set(range(41))
    assert {node for node in result if result[node] == 100} == set(range(100, 150))
    assert (result[299], result[300]) == (299, 299)
