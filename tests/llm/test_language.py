"""Language identification: n-grams and distances against plain Python, accuracy on held-out rows."""

import random
import unicodedata
import zlib
from collections import Counter, defaultdict

from tallykeep.llm import language, queries

FOLDER = "/root/testdata/sf0.01"


def grams(text):
    """N-grams of one to three letters inside padded words."""
    letters = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
    words = "".join(low if c.isalpha() else " " for c, low in zip(text or "", letters)).split()
    found = []
    for word in words:
        padded = f"\x01{word}\x01"
        found += list(word) + [padded[i : i + 2] for i in range(len(padded) - 1)] + [padded[i : i + 3] for i in range(len(word))]
    return found


def key(gram):
    number = 0
    for letter in gram:
        number = number << 21 | ord(letter)
    return number


def ranked(counts, most):
    return [gram for gram, _ in sorted(counts.items(), key=lambda one: (-one[1], key(one[0])))[:most]]


def plain(docs):
    counts = defaultdict(Counter)
    for i, text, lang in docs:
        if i is not None and lang is not None and text is not None and zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(grams(text))
    places = {lang: {g: n for n, g in enumerate(ranked(one, language.PROFILE_GRAMS))} for lang, one in sorted(counts.items()) if one}
    rows = []
    for i, text, _ in docs:
        own = ranked(Counter(grams(text)), language.DOCUMENT_GRAMS)
        out = zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0
        if not own or not places:
            rows.append((i, out, "und", 0.0))
            continue
        miss = language.PROFILE_GRAMS
        far = {lang: sum(min(abs(n - known[g]), miss) if g in known else miss for n, g in enumerate(own)) for lang, known in places.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        rows.append((i, out, best, round(1 - far[best] / (len(own) * miss), 9)))
    return sorted(rows, key=repr)


def run(spark, docs):
    table = spark.createDataFrame([(i, x, lang, 1) for i, x, lang in docs], "doc_id long, text string, lang string, score int")
    found = language.learnt_and_identified(table.repartition(4)).collect()
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in found), key=repr)


def test_against_plain_python(spark):
    rng = random.Random(2)
    letters = {"aa": "abcdeé", "bb": "cdefgß", "cc": "日本語学校"}
    docs = []
    for i in range(120):
        lang = rng.choice(sorted(letters))
        words = ["".join(rng.choices(letters[lang], k=rng.randint(1, 6))) for _ in range(rng.randint(0, 40))]
        docs.append((i, rng.choice([" ", ", 7 ", "\n"]).join(words), lang if rng.random() < 0.9 else None))
    docs += [(None, "abc abd", "zz"), (500, None, "aa"), (501, "", "bb"), (502, "12 34 !?", "cc"), (503, "İstanbul ǅ ŉ ﬀ", None)]
    docs += [(504, "abc " * 40_000, "aa"), (505, "ABC", "dd"), (505, "ABC", "dd")]
    assert run(spark, docs) == plain(docs)


def test_languages_in_blocks_of_any_size(spark, monkeypatch):
    docs = [(i, text * 3, lang) for i, (text, lang) in enumerate([("aab abb ", "x"), ("ccd cdd ", "y"), ("eef eff ", "z"), ("aab abb ", "w")] * 9)]
    whole = run(spark, docs)
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 1)
    assert run(spark, docs) == whole == plain(docs)


def test_counts_do_not_depend_on_how_often_a_task_hands_them_on(spark, monkeypatch):
    docs = [(i, f"word{chr(97 + i % 7)} other{chr(97 + i % 5)}", "ab"[i % 2]) for i in range(60)]
    monkeypatch.setattr(language, "COUNTED_GRAMS", 40)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"lang": lang, "text": text} for _, text, lang in docs])
    total = Counter()
    rows = [row for part in language._count(iter([batch])) for row in part.to_pylist()]
    for row in rows:
        total[row["lang"], row["gram"]] += row["n"]
    expected = Counter((lang, key(gram)) for _, text, lang in docs for gram in grams(text))
    assert total == expected and len(rows) > len(total)


def test_nothing_to_learn_from(spark):
    assert run(spark, []) == []
    assert {row[2:] for row in run(spark, [(1, "text", None), (2, None, None)])} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = [r for r in queries.queries()["op13_language_id"](spark, FOLDER).collect()]
    assert len(found) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    judged = [r for r in found if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in judged) >= 0.97 * len(judged) > 100


def test_letters_are_those_of_unicode():
    assert set(grams("Straße Ω日")) >= {"ß", "ω", "日"} and unicodedata.category("日") == "Lo"
    assert sorted(language.grams_of("Ab c").tolist()) == sorted(key(gram) for gram in grams("Ab c"))
