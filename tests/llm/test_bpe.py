import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm import plain
from tallykeep.llm import bpe, queries

PATH = queries.vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    own, count, decoded = codec.encode(text)
    return (np.frombuffer(own, "<u4").tolist(), count, decoded) == (ids, len(ids), library.decode(ids, skip_special_tokens=False))


ODD = [
    "a", "B", "Σ", "ς", "é", "é", "́", " ", "\xa0", "\x1c", "\x85", " ", "'s", "'", "n", "1", "٣", "😀",
    "<|endoftext|>", "<|startoftext|>", "<|", "|>", "ß", "İ", "中", "\n", "!!", "ﬁ", "\0", "'re", "᠎", "²", "½", "µ",
    "ª", "Ä", "÷", "_", "x" * 70,
]


def test_any_text_encodes_as_the_library_does(codec, library):
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14)))
        assert same(codec, library, text), repr(text)


def test_every_latin_character(codec, library):
    rng = random.Random(6)
    assert codec.latin_rules
    for code in range(256):
        assert all(same(codec, library, text) for text in (chr(code), f"a{chr(code)}b", f"1{chr(code)} {chr(code)}"))
    for _ in range(4000):
        text = "".join(chr(rng.choice([rng.randrange(256), rng.choice(b"abcdEF'stmvl 12.")])) for _ in range(16))
        assert same(codec, library, text), repr(text)


def test_very_long_texts(codec, library):
    assert same(codec, library, "ab" * 20_000)
    assert same(codec, library, "word, " * 20_000)


def test_fragments_end_where_no_token_reaches_across(codec):
    word = "zqabcqzüx"
    parts = codec.fragments(word)
    assert "".join(parts) == word
    assert all(a[-1] + b[0] not in codec.joined for a, b in zip(parts, parts[1:]))


def test_a_full_memory_keeps_frequent_words(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(PATH)
    for text in ("a b c d e f g", "a a b", "h i j a", "one two three four five one"):
        assert same(codec, library, text)
    assert len(codec.words.new) <= 3 and len(codec.words.old) <= 3


def test_queries_over_frames(spark, library):
    rows = [(1, None), (2, ""), (3, "Hello, World"), (3, "Hello, World"), (4, " \n"), (None, "x <|endoftext|> y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'n' AS n_tokens")
    found = [tuple(r) for r in bpe.digest(frame, PATH).collect()]
    for (doc_id, text), row in zip(rows, found):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row[:2] == (doc_id, len(ids)) and row[3] == plain.sha(library.decode(ids, skip_special_tokens=False))
    back = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert back[2].text == "hello</w> ,</w> world</w>" and back[0].text == ""
    assert bpe.digest(frame.limit(0), PATH).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().text == ""
