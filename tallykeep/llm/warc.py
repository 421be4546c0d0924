"""WARC records: reading, and resolution of not-modified revisits.

A revisit says that a server answered 304 Not Modified, so the payload is that of an
earlier capture. It resolves to the latest earlier full response of the same canonical
URL, provided the validators agree: the entity tag where the revisit has one (weakly
compared), else the time of last modification. The resolved record carries the earlier
response's header fields, replaced by those a 304 may update.

The as-of join works on (canonical URL, time bucket): inside a bucket a window finds the
latest earlier response, and buckets hand their last response on in a second, small
window of one row per URL and bucket. So a URL with a third of all captures is spread
over its buckets. Payloads take no part; only record ids, times, validators and header
fields are shuffled.

Defined cases: a null or malformed record has null fields and is neither a response nor
a revisit; a response is full if its status is 200; captures of the same instant are not
earlier than each other; of responses at one time the largest record id counts, so
repeated records do no harm; a record without a URL answers none and is answered by none; a revisit without an earlier response is ``unresolved``, one
whose validators differ ``mismatch``, one without validators ``unverified`` (it resolves);
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallykeep.llm.common import durable

CRLF = "\r\n"
VERSION = "WARC/1.0"
# What the version lines of WARC 1.0 and 1.1 start with.
VERSION_START = "WARC/1."
# Seconds of a time bucket of one URL.
BUCKET_SECONDS = 86_400

# Header fields that describe the stored body or one connection; a 304 does not update them.
NOT_UPDATED = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authorization set-cookie te trailer transfer-encoding upgrade"
).split()

_TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)(?:=[^&]*)?"


def _content_end(value: Column) -> Column:
    """Bytes behind the start of a version line up to the end of the record's block, by its
    Content-Length; null without one, or where the head does not end in ``value``."""
    gap = CRLF + CRLF
    head = F.substring_index(value, gap, 1)
    stated = F.regexp_extract(head, r"(?i)\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r|$)", 1)
    return F.when(value.contains(gap) & (stated != ""), F.octet_length(head) + len(gap) + F.try_to_number(stated, F.lit("9" * 18)).cast("long"))


def _belonging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, start) of pieces inside the record that starts with another piece.

    Rows (file, piece, bytes, starts, content_end) come in file order; one record is remembered.
    """
    file, at, end, start = None, 0, 0, None
    for batch in batches:
        inside: tuple[list, list] = ([], [])
        for name, piece, size, starts, content_end in zip(*(column.to_pylist() for column in batch.columns)):
            if name != file:
                file, at, end, start = name, 0, 0, None
            if starts and at >= end:
                start, end = piece, at + len(VERSION_START) + (content_end or 0)
            elif start is not None:
                inside[0].append(piece)
                inside[1].append(start)
            at += size + len(VERSION_START)
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in inside], names=["piece", "start"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(raw): the records of WARC files, plain or compressed, read and split by Spark's text source.

    A record starts at a version line that a WARC field follows and that lies behind the block of
    the record before it, whose bytes Content-Length counts; so a payload may quote whole records.
    What follows the block is cut off. A record without Content-Length reaches to the next start.
    Pieces that start no record belong to the one before them; sizes of pieces are dealt by
    file, texts only where a record has several pieces.
    """
    starts = F.col("value").rlike(r"(?i)^[01]\r\n(WARC-|Content-(Length|Type):)")
    pieces = spark.read.option("lineSep", VERSION_START).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"),
        starts.alias("starts"),
        "value",
    )
    sizes = pieces.select("file", "block", "piece", F.octet_length("value").alias("bytes"), "starts", _content_end(F.col("value")).alias("content_end"))
    in_order = sizes.repartition("file").sortWithinPartitions("file", "block", "piece").drop("block")
    inside = durable(in_order.mapInArrow(_belonging, "piece long, start long"))
    cut = inside.select(F.col("start").alias("piece")).distinct()
    first = pieces.filter("starts").join(inside, "piece", "left_anti")
    whole = first.join(cut, "piece", "left_anti").select("value")
    parts = first.join(cut, "piece", "left_semi").withColumn("start", F.col("piece")).unionByName(pieces.join(inside, "piece"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    joined = parts.groupBy("start").agg(F.array_join(F.transform(ordered, lambda one: one["value"]), VERSION_START).alias("value"))
    end = _content_end(F.col("value"))
    block_only = F.when(end.isNotNull(), F.substring(F.col("value").cast("binary"), F.lit(1), end.cast("int")).cast("string"))
    records = whole.unionByName(joined.select("value"))
    return records.select(F.concat(F.lit(VERSION_START), F.coalesce(block_only, "value")).alias("raw"))


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash, and
    the query without tracking parameters, in order; scheme and fragment are left out."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"#[\s\S]*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?([\s\S]*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda one: (one != "") & ~one.rlike(f"^{_TRACKING}$")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _fields(block: Column) -> Column:
    """Header lines as (name in lower case, value), in order."""
    lines = F.filter(F.split(block, "\r?\n"), lambda line: line.contains(":"))
    return F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.trim(F.regexp_replace(line, r"^[^:]*:", "")).alias("value"),
        ),
    )


def field(fields: Column, name: str) -> Column:
    """The first value of a header field, else null."""
    return F.get(F.filter(fields, lambda one: one["name"] == name), F.lit(0))["value"]


def parse(records: DataFrame) -> DataFrame:
    """(record_id, kind, url, at, instant, status, fields, payload) from raw records.

    ``at`` is in whole seconds, ``instant`` in nanoseconds; ``fields`` are those of the HTTP message.
    """
    gap = CRLF + CRLF
    after_head = F.expr(f"substring(raw, length(substring_index(raw, '{gap}', 1)) + 5)")
    split = records.select(F.substring_index("raw", gap, 1).alias("head"), after_head.alias("message"))
    split = split.withColumn("head", _fields(F.col("head")))
    http = F.substring_index("message", gap, 1)
    date = field(F.col("head"), "warc-date")
    fraction = r"(:[0-9]{2})\.([0-9]{1,9})(?=[^0-9])"
    at = F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(date, fraction, "$1"), F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    nanos = F.rpad(F.regexp_extract(date, fraction, 2), 9, "0").cast("decimal(9,0)")
    instant = at.cast("decimal(18,0)") * F.lit(1_000_000_000).cast("decimal(10,0)") + nanos
    return split.select(
        field(F.col("head"), "warc-record-id").alias("record_id"),
        field(F.col("head"), "warc-type").alias("kind"),
        field(F.col("head"), "warc-target-uri").alias("url"),
        at.alias("at"),
        instant.cast("decimal(38,0)").alias("instant"),
        F.expr(r"try_cast(regexp_extract(message, '^HTTP/[0-9.]+ ([0-9]{3})', 1) AS int)").alias("status"),
        _fields(F.regexp_replace(http, r"^[^\r\n]*\r?\n", "")).alias("fields"),
        F.expr(f"substring(message, length(substring_index(message, '{gap}', 1)) + 5)").alias("payload"),
    )


def _tag(value: Column) -> Column:
    return F.regexp_replace(value, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url_key, at, outcome, source_id, source_at, fields) for every revisit.

    ``records`` are as :func:`parse` gives them. ``source_id`` names the response whose
    payload the revisit stands for; ``fields`` are the merged header fields.
    """
    is_response = (F.col("kind") == "response") & (F.col("status") == 200)
    is_revisit = (F.col("kind") == "revisit") & (F.col("status") == 304)
    captures = records.filter(F.coalesce(is_response | is_revisit, F.lit(False)) & F.col("at").isNotNull()).select(
        "record_id",
        F.coalesce(canonical_url(F.col("url")), F.lit("")).alias("url_key"),
        "at",
        "instant",
        F.floor(F.col("at") / BUCKET_SECONDS).cast("long").alias("bucket"),
        is_response.alias("full"),
        "fields",
    )
    response = F.when(F.col("full") & (F.col("url_key") != ""), F.struct("instant", "record_id", "at", "fields"))
    earlier_here = Window.partitionBy("url_key", "bucket").orderBy("instant").rangeBetween(Window.unboundedPreceding, -1)
    here = captures.withColumn("source", F.max(response).over(earlier_here)).filter(~F.col("full"))
    last = captures.groupBy("url_key", "bucket").agg(F.max(response).alias("last"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.withColumn("handed", F.last("last", ignorenulls=True).over(before)).drop("last")
    joined = here.join(handed, ["url_key", "bucket"]).withColumn("source", F.coalesce("source", "handed"))
    own_tag, own_time = field(F.col("fields"), "etag"), field(F.col("fields"), "last-modified")
    source_tag, source_time = field(F.col("source.fields"), "etag"), field(F.col("source.fields"), "last-modified")
    agrees = F.when(own_tag.isNotNull(), _tag(own_tag) == _tag(source_tag)).otherwise(own_time == source_time)
    outcome = (
        F.when(F.col("source").isNull(), "unresolved")
        .when(own_tag.isNull() & own_time.isNull(), "unverified")
        .when(F.coalesce(agrees, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    judged = joined.withColumn("outcome", outcome)
    found = F.col("outcome").isin("resolved", "unverified")
    updates = F.filter("fields", lambda one: ~one["name"].isin(NOT_UPDATED))
    names = F.transform(updates, lambda one: one["name"])
    kept = F.filter("source.fields", lambda one: ~F.array_contains(names, one["name"]))
    return judged.select(
        "record_id",
        "url_key",
        "at",
        "outcome",
        F.when(found, F.col("source.record_id")).alias("source_id"),
        F.when(found, F.col("source.at")).alias("source_at"),
        F.when(found, F.array_sort(F.concat(kept, updates))).alias("fields"),
    )


def captures_of(pages: DataFrame, every: int = 60, again_after: int = 60_030) -> DataFrame:
    """(raw): a crawl of the given pages as WARC records.

    Page n is captured ``every`` * n seconds after the epoch, and asked for again
    ``again_after`` seconds later with what was then known of it; the server answers 304
    and repeats the entity tag. Where another page of the same canonical URL was captured
    in between, the revisit meets that one.
    """
    at = F.col("page_id") * every
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))

    def stamp(seconds: Column) -> Column:
        """A UTC time, whatever the session's time zone."""
        day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int")).cast("string")
        parts = [F.floor(F.pmod(seconds, F.lit(86_400)) / step) % most for step, most in ((3600, 24), (60, 60), (1, 60))]
        return F.concat(day, F.lit("T"), F.concat_ws(":", *[F.lpad(part.cast("string"), 2, "0") for part in parts]), F.lit("Z"))

    def record(kind: str, suffix: str, seconds: Column, status: str, extra: Column, body: Column) -> Column:
        return F.concat(
            F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: "), F.col("page_id").cast("string"), F.lit(suffix),
            F.lit(f"{CRLF}WARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit(f"{CRLF}WARC-Date: "), stamp(seconds),
            F.lit(f"{CRLF}{CRLF}HTTP/1.1 {status}{CRLF}ETag: "), tag, F.lit(f"{CRLF}Date: "), stamp(seconds), extra,
            F.lit(f"{CRLF}{CRLF}"), body,
        )

    page = F.coalesce("html", F.lit(""))
    length = F.concat(F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(page).cast("string"))
    full = record("response", ":full", at, "200 OK", length, page)
    revisit = record("revisit", ":again", at + again_after, "304 Not Modified", F.lit(f"{CRLF}Cache-Control: max-age=60"), F.lit(""))
    return pages.select(F.explode(F.array(full, revisit)).alias("raw"))
