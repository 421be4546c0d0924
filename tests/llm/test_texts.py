"""Quality rules, substring dedup, benchmark decontamination."""

import random

import pytest

from llm import plain
from tallykeep.llm import decontaminate, quality, repeats

EDGES = [
    (1, None), (2, ""), (3, " \t\x0b "), (4, "one"), (5, "a b c a b c"), (6, "x " * 30_000), (6, "x " * 30_000),
    (7, "line one\nline one\n\n \nline two\nline one"), (8, "# * $ %%é\U0001f600 <b>|"), (9, "a a a a"), (10, "a b"),
]


def frame(spark, rows, extra=True):
    """Documents with columns that bear the names used inside the operators."""
    names = "quality string, quality_words string, kept string, n_words string, place string, row string, size string"
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in [one.split()[0] for one in names.split(", ")] if extra else []:
        table = table.selectExpr("*", f"'mine' AS {name}")
    return table


def random_docs(seed, count=60):
    rng = random.Random(seed)
    passages = [[f"p{k}_{i}" for i in range(rng.randint(5, 40))] for k in range(6)]
    docs = []
    for i in range(count):
        own = []
        for _ in range(rng.randint(0, 6)):
            own += rng.choice(passages)[rng.randint(0, 4) :] if rng.random() < 0.6 else [f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 30))]
        docs.append((i * 2 + 1, rng.choice([" ", "\n", "  "]).join(own)))
    return docs + [(200, docs[3][1]), (0, docs[5][1])]


def test_quality_measures(spark):
    rows = EDGES + [(i + 1000, text) for i, text in random_docs(1)]
    judged, name = quality.with_quality(frame(spark, rows))
    found = {r.doc_id: r[name] for r in judged.collect()}
    for doc_id, text in rows:
        one, (n, chars, symbols, lines, again) = found[doc_id], plain.quality(text)
        assert (one.n_words, one.word_chars, one.n_symbols, one.n_dup_lines, one.n_repeat_words) == (n, chars, symbols, lines, again)
        assert one.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (one.base_failed and one.kept)


def test_quality_keeps_columns_and_clean_text(spark):
    clean = " ".join(f"the word{i} of" for i in range(40))
    table = frame(spark, [(1, clean), (2, clean + " # $ %" * 40), (3, None), (4, "short")])
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    assert [(r.doc_id, r.quality, r.kept) for r in kept.collect()] == [(1, "mine", "mine")]


def test_quality_rules_are_a_table(spark):
    clean = " ".join(f"the word{i} of" for i in range(40))
    strict = (quality.Rule("mean_word_chars", 30.0, None),)
    assert quality.keep_good(frame(spark, [(1, clean)]), rules=strict).count() == 0
    assert quality.keep_good(frame(spark, [(1, clean)]), rules=()).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup(spark, seed):
    docs = random_docs(seed)
    found = repeats.removed_digest(frame(spark, docs).repartition(4)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == plain.kept_words(docs)


def test_substring_dedup_defined_cases(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [*EDGES, (None, passage), (None, passage), (30, passage), (30, passage), (31, "z " + passage + " z"), (32, " ".join(passage.split()[:13]))]
    found = {}
    for r in repeats.removed_digest(frame(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert found[None] == [(20, 0)] * 2 and found[30] == [(20, 0)] * 2
    assert (found[31], found[32]) == ([(22, 20)], [(13, 13)])
    assert (found[1], found[6]) == ([(0, 0)], [(30_000, 0)] * 2)
    texts = {r.doc_id: r.text for r in repeats.without_repeats(frame(spark, rows[-4:])).collect()}
    assert (texts[31], texts[32]) == ("z z", "")


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"Q{rng.randrange(200)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 12, 60])))) for i in range(30)]
    items += [(90, None), (91, ""), (92, items[0][1]), (93, "same same same same same same same")]
    docs = []
    for i in range(80):
        own = [f"q{rng.randrange(200)}" for _ in range(rng.randint(0, 400))]
        leak = items[rng.randrange(30)][1].lower().split()
        if rng.random() < 0.5:
            leak[rng.randrange(len(leak))] = "other"
        own[len(own) // 2 : len(own) // 2] = leak if rng.random() < 0.7 else []
        docs.append((i, " ".join(own)))
    docs += [*EDGES, (200, "x " * 300 + "same " * 9), (201, items[8][1] + " " + "y " * 20_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS size", "2 AS hash")
    found = decontaminate.leaks(frame(spark, docs).repartition(3), benchmark).collect()
    assert {tuple(r) for r in found} == plain.leaks(docs, items)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found}) > 10


def test_decontamination_drops_whole_documents(spark):
    table = frame(spark, [(1, "zero one two three four five six"), (2, "nothing here"), (None, "nothing here")])
    benchmark = spark.createDataFrame([(1, "One two three four five")], "item_id long, text string")
    kept = decontaminate.clean(table, benchmark)
    assert kept.columns == table.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]


def test_repeated_items_count_each_row_on_its_own(spark):
    words = [f"w{i}" for i in range(14)]  # 10 shingles
    other = [f"v{i}" for i in range(14)]
    items = [(1, " ".join(words))] * 2 + [(2, " ".join(words)), (2, " ".join(other))]
    items += [(3, " ".join(words + ["x"])), (3, " ".join(words[:9]))]
    docs = [(1, " ".join(words[:8])), (2, " ".join(words)), (3, " ".join(words[:8] + ["-"] + other[:8]))]
    table, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in decontaminate.leaks(table, benchmark).collect())
    assert found == [(1, 3, 5, 4), (2, 1, 10, 10), (2, 2, 10, 10), (2, 3, 11, 10), (3, 3, 5, 4)]
    assert [r.doc_id for r in decontaminate.clean(table, spark.createDataFrame(items[:4], "item_id long, text string")).collect()] == [1, 3]


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert quality.keep_good(none).count() == 0
    assert repeats.removed_digest(none).count() == 0
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(frame(spark, EDGES), items).count() == 0
    assert decontaminate.leaks(none, spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


def test_a_shared_lead_in_makes_no_pairs(spark, monkeypatch):
    """A passage all documents and all items share: joined rows stay near the number of documents."""
    lead = " ".join(f"l{i}" for i in range(9))
    docs = [(i, f"{lead} d{i} e{i} f{i} g{i} h{i} j{i} k{i}") for i in range(300)]
    items = [(i, f"{lead} x{i} y{i} z{i} u{i} v{i} w{i} s{i}") for i in range(300)]
    docs.append((300, "before " + items[7][1] + " after"))
    seen = []
    original = decontaminate._leaking

    def counting(docs, benchmark):
        shared, named = original(docs, benchmark)
        seen.append(shared.count())
        return shared, named

    monkeypatch.setattr(decontaminate, "_leaking", counting)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [tuple(r) for r in decontaminate.leaks(frame(spark, docs), benchmark).collect()]
    assert found == [(300, 7, 12, 12)] and seen == [1]
    widened, sketches = decontaminate._sketches(spark.createDataFrame(
        [row for batch in _item_batches(items) for row in batch.to_pylist()], decontaminate._ITEM))
    common = sketches.groupBy("hash").count().filter("count > 1")
    assert common.count() == 0 and widened.count() == 300 * 12


def _item_batches(items):
    import pyarrow as pa

    rows = [{"item_id": i, "item_row": i, "text": text} for i, text in items]
    return decontaminate._items(iter([pa.RecordBatch.from_pylist(rows)]))


def test_rows_without_an_id_are_cleaned_by_their_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(None, f"so {item} there", "a"), (None, "nothing of it", "b"), (4, f"so {item} there", "c"), (4, "a clean version", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, low string")
    kept = decontaminate.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.low for r in kept.collect()) == ["b", "d"]
