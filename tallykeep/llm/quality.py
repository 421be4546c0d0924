"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a ratio computed by Spark functions from a text alone. A rule names a
measure and the smallest and largest value allowed; a document is kept if it passes
the base rules and every row of the table.

Defined cases: a null text counts as empty; an empty text has zero words and fails the
base rules; repeated rows are judged alike, each on its own; extra columns stay as they
are, and the names used inside give way to them; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.common import SPACE_CLASS, free_name, plain_text, split_words


class Rule(NamedTuple):
    """A measure and the values it may take; None leaves a side open."""

    measure: str
    least: float | None
    most: float | None


RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.2),
    Rule("stop_word_ratio", 0.02, None),
    Rule("duplicate_line_ratio", None, 0.5),
    Rule("words_per_line", 1.5, None),
)

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by this are at from he they his her not or have had "
    "de la le les des et un une en du que qui est pour dans par sur pas avec au ce il elle ne se "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus "
    "el los las y del se por con no su para al lo como más o pero sus"
).split()

# As they stand in a text; a set of literals is one hash lookup a word.
STOP_FORMS = sorted({form + mark for word in STOP_WORDS for form in (word, word.capitalize(), word.upper()) for mark in ("", ".", ",")})

LEAST_WORDS = 50
# The largest share, in percent, of words inside three-word windows seen before or again.
MOST_REPEATED_PERCENT = 50

SYMBOLS = "#*$%&|<>"


def _removed(text: Column, characters: str) -> Column:
    """How many of the text's characters are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _window_keys(words: Column) -> Column:
    """A key for every window of three words."""
    return F.when(
        F.size(words) >= 4,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )


def _ordered_if_repeated(keys: Column) -> Column:
    """Keys sorted with their positions, so equal ones are neighbours; null if all differ.

    The cost is that of a sort, however often a window repeats.
    """
    return F.when(
        F.size(F.array_distinct(keys)) < F.size(keys),
        F.sort_array(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at")))),
    )


def _covered(ordered: Column) -> Column:
    """Words inside windows that the text holds at least twice."""
    repeated = F.filter(
        ordered,
        lambda one, i: F.coalesce(F.get(ordered, i - 1)["key"] == one["key"], F.lit(False))
        | F.coalesce(F.get(ordered, i + 1)["key"] == one["key"], F.lit(False)),
    )
    at = F.flatten(F.transform(repeated, lambda one: F.array(one["at"], one["at"] + 1, one["at"] + 2)))
    return F.coalesce(F.size(F.array_distinct(at)), F.lit(0))


def with_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """Append one struct column of measures and verdicts; returns the frame and its name.

    The struct holds the base measures (``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``), every ratio a rule may name, ``base_failed``
    and ``kept``.
    """
    source = free_name(docs, "quality_text")
    words = free_name(docs, "quality_words")
    keys = free_name(docs, "quality_keys")
    ordered = free_name(docs, "quality_ordered")
    lines = free_name(docs, "quality_lines")
    counts = free_name(docs, "quality_counts")
    result = free_name(docs, "quality")
    staged = (
        docs.withColumn(source, plain_text(F.col(f"`{text}`")))
        .withColumn(words, split_words(F.col(source)))
        .withColumn(keys, _window_keys(F.col(words)))
        # each a column of its own: inside a lambda an expression would be computed per element
        .withColumn(ordered, _ordered_if_repeated(F.col(keys)))
        .withColumn(lines, F.filter(F.split(F.col(source), "\n"), lambda line: line.rlike(f"[^{SPACE_CLASS}]")))
        .withColumn(
            counts,
            F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.translate(source, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                _removed(F.col(source), SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _covered(F.col(ordered)).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                F.size(F.filter(words, lambda word: word.isin(STOP_FORMS))).cast("long")
                .alias("n_stop_words"),
            ),
        )
    )

    def count(name: str) -> Column:
        return F.col(counts)[name]

    def ratio(top: Column, below: Column) -> Column:
        return F.when(below > 0, top / below)

    measures = {
        "mean_word_chars": ratio(count("word_chars"), count("n_words")),
        "symbols_per_word": ratio(count("n_symbols"), count("n_words")),
        "stop_word_ratio": ratio(count("n_stop_words"), count("n_words")),
        "duplicate_line_ratio": ratio(count("n_dup_lines"), count("n_lines")),
        "words_per_line": ratio(count("n_words"), count("n_lines")),
    }
    base_failed = (count("n_words") < LEAST_WORDS) | (
        100 * count("n_repeat_words") > MOST_REPEATED_PERCENT * count("n_words")
    )
    passes = ~base_failed
    for rule in rules:
        value = measures[rule.measure]
        if rule.least is not None:
            passes &= F.coalesce(value >= rule.least, F.lit(False))
        if rule.most is not None:
            passes &= F.coalesce(value <= rule.most, F.lit(False))
    judged = staged.withColumn(
        result,
        F.struct(
            F.col(f"{counts}.*"),
            *[value.alias(name) for name, value in measures.items()],
            base_failed.alias("base_failed"),
            passes.alias("kept"),
        ),
    )
    return judged.drop(source, words, keys, ordered, lines, counts), result


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    judged, quality = with_quality(docs, text, rules)
    kept = free_name(judged, "kept")
    # a generated column, as a filter on a computed one would be pushed below its
    # computation and compute everything again inside the condition
    once = judged.select(*judged.columns, F.explode(F.array(F.col(quality)["kept"])).alias(kept))
    return once.filter(F.col(kept)).select(*docs.columns)
