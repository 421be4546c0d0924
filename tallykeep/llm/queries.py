"""One query per operator, applied with production parameters to a whole table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.llm import (
    bpe, chat, decontaminate, language, ngram_join, pages, pii, quality, repeats, resample, search, urls, warc,
)
from tallykeep.llm.common import only, table

# The vocabulary the BPE query uses; its place is looked up where the package is installed.
VOCABULARY = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_components(table(spark, folder, "documents"))


@_query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, result = quality.with_quality(only(table(spark, folder, "documents"), "doc_id", "text"))
    return judged.select("doc_id", F.col(f"{result}.*"))


@_query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removed_digest(table(spark, folder, "documents"))


@_query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_digest(table(spark, folder, "documents"))


@_query
def op5_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    pages = only(table(spark, folder, "pages"), "page_id", "url", "html")
    resolved = warc.resolve(warc.parse(warc.captures_of(pages)))
    lines = F.transform("fields", lambda one: F.concat(one["name"], F.lit(": "), one["value"]))
    return resolved.select(
        F.substring_index("record_id", ":", 1).cast("long").alias("page_id"),
        "url_key",
        "at",
        "outcome",
        F.substring_index("source_id", ":", 1).cast("long").alias("source_page_id"),
        "source_at",
        F.array_join(lines, "\n").alias("header"),
    )


@_query
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@_query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@_query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"), vocabulary())


@_query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long")
    pages = only(table(spark, folder, "pages"), "page_id", "url")
    return urls.judge(pages, labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")))


@_query
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = only(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    added = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.digest(chat.windows(given.unionByName(added)))


@_query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.drawn(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.learnt_and_identified(table(spark, folder, "documents"))
