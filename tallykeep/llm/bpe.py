"""BPE encoding and decoding with forced boundaries.

A vocabulary says which byte pairs can ever stand side by side inside a token. Where
two neighbouring bytes are no such pair, no merge can reach across, so a text may be cut
there and its fragments encoded on their own; the ids of the text are theirs, one after
the other. No token of these vocabularies joins letters, digits, signs or white space, so
the first cuts are between those, and the words between are shared by all texts; inside
a word the remaining cuts keep every fragment short. What words became is remembered in
a table of bounded size that keeps the frequent ones.

The tokenizers library supplies the merges of one fragment, and for texts beyond Latin-1
normalisation and pre-tokenisation, whose rules are written out here for Latin-1 alone.

Defined cases: a null text counts as empty and has no tokens; special tokens written out
in a text are found as the library finds them; extra columns are ignored; repeated rows
are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tallykeep.llm.common import bounded_batches

# Entries of a worker's table of words. A full table becomes the older one, in which
# words met again are found and moved back; the older one before it is forgotten.
REMEMBERED = 150_000
# Longer words are rarely met again and are not remembered.
LONGEST_REMEMBERED = 64

# White space as Unicode defines it, which is what the vocabularies' patterns mean by \s.
_CHUNK = regex.compile(r"[^\p{White_Space}]+")

# The rules of the vocabularies this codec knows, as stored in their files.
_RULES = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
# The same pattern for texts of Latin-1 characters in lower case.
_LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\t-\\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+"
)


class Memory:
    """A table of bounded size that keeps what is asked for often."""

    def __init__(self, make):
        self.make, self.new, self.old = make, {}, {}

    def find(self, key: str):
        entry = self.old.get(key) or self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self.new) >= REMEMBERED:
                self.new, self.old = {}, self.new
            self.new[key] = entry
        return entry

    def all(self, keys: list[str]) -> list:
        get, find = self.new.get, self.find
        found = []
        for key in keys:
            entry = get(key)
            if entry is None:
                entry = find(key)
                get = self.new.get
            found.append(entry)
        return found


class Codec:
    """Encoder and decoder of one BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        if model["type"] != "BPE" or stored["decoder"] is not None or stored["post_processor"] is not None:
            raise ValueError(f"not a vocabulary this codec knows: {path}")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in stored["added_tokens"]):
            raise ValueError(f"special tokens of {path} depend on the text around them")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"] or ""
        plain = {"vocab": model["vocab"], "merges": merges, "cache_capacity": 0}
        self.inner = BPE(**plain)
        self.final = BPE(**plain, end_of_word_suffix=self.suffix) if self.suffix else self.inner
        self.special = {token["content"]: token["id"] for token in stored["added_tokens"]}
        self.special_pattern = regex.compile("|".join(regex.escape(t) for t in self.special) or r"(?!)")
        self.tokens = {number: token for token, number in model["vocab"].items()}
        self.tokens |= {number: token for token, number in self.special.items()}
        bare = [token.removesuffix(self.suffix) if self.suffix else token for token in model["vocab"]]
        # every two neighbouring bytes (as the vocabulary writes them) of any token
        self.joined = {token[i : i + 2] for token in bare for i in range(len(token) - 1)}
        first = (stored["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        kinds = [one["type"] for one in (stored["normalizer"] or {}).get("normalizers", [])]
        # texts of Latin-1 alone take the rules written out here, if these are the file's
        self.latin_rules = kinds == _RULES["normalizer"] and first.get("pattern", {}).get("Regex") == _RULES["pattern"]
        self.byte_map = dict(enumerate(_byte_characters()))
        self.words, self.chunks = Memory(self._word), Memory(self._chunk)

    def fragments(self, word: str) -> list[str]:
        """A pre-tokenised word, cut wherever two neighbours occur in no token."""
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def _word_ids(self, word: str) -> list[int]:
        """Ids of a pre-tokenised word: those of its fragments, of which the last ends it."""
        *inner, last = self.fragments(word)
        ids = [token.id for fragment in inner for token in self.inner.tokenize(fragment)]
        return ids + [token.id for token in self.final.tokenize(last)]

    def _encode_words(self, text: str) -> list[int]:
        words = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [number for word, _ in words for number in self._word_ids(word)]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a piece of text without white space."""
        ids, done = [], 0
        for found in self.special_pattern.finditer(chunk):
            ids += self._encode_words(chunk[done : found.start()])
            ids.append(self.special[found.group()])
            done = found.end()
        return ids + self._encode_words(chunk[done:])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, as the library does for a vocabulary without decoder."""
        return " ".join([self.tokens[number] for number in ids])

    def _entry(self, ids: list[int]) -> tuple[bytes, str]:
        return np.array(ids, dtype="<u4").tobytes(), self.decode(ids)

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        return self._entry(self.encode_chunk(chunk))

    def _word(self, word: str) -> tuple[bytes, str]:
        """A word as the Latin pattern finds it."""
        return self._entry(self._word_ids(word.encode().decode("latin-1").translate(self.byte_map)))

    def encode(self, text: str) -> tuple[bytes, int, str]:
        """Ids as little-endian unsigned 32-bit integers, their number, and the decoded text."""
        if self.latin_rules and "<|" not in text and _is_latin(text):
            found = self.words.all(_LATIN.findall(text.lower()))
        else:
            found = self.chunks.all(_CHUNK.findall(text))
        ids = b"".join([one[0] for one in found])
        return ids, len(ids) // 4, " ".join([one[1] for one in found if one[0]])


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _byte_characters() -> list[str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path)


def _encoded_digest(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [])
            for text in batch.column(1):
                ids, _, decoded = encode(text.as_py() or "")
                columns[0].append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
                columns[1].append(hashlib.sha256(ids).hexdigest())
                columns[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.list_(pa.int32())), *[pa.array(c, pa.string()) for c in columns[1:]]],
                names=["doc_id", "ids", "ids_sha256", "decoded_sha256"],
            )

    return digest


def _digest(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [])
            for text in batch.column(1):
                ids, count, decoded = encode(text.as_py() or "")
                columns[0].append(count)
                columns[1].append(hashlib.sha256(ids).hexdigest())
                columns[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def _ids(path: str):
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            rows = [np.frombuffer(encode(text.as_py() or "")[0], dtype="<u4").astype(np.int32) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return ids


def _texts(path: str):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in batches:
            rows = [decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return texts


def _id_and(docs: DataFrame, column: str, kind: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{column}`").cast(kind).alias(column))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each text."""
    return _id_and(docs, text, "string").mapInArrow(_ids(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): what the ids decode to; null ids count as none."""
    return _id_and(encoded, "ids", "array<int>").mapInArrow(_texts(path), "doc_id long, text string")


def digest(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Per document: number of tokens, SHA-256 of the ids and of the decoded text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _id_and(docs, text, "string").mapInArrow(_digest(path), schema)


def encoded_digest(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Per document: the token ids, their SHA-256 and that of the decoded text."""
    schema = "doc_id long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return _id_and(docs, text, "string").mapInArrow(_encoded_digest(path), schema)
