"""WARC files whose records state the length of their blocks."""

import gzip

import pytest

from tallykeep.llm import warc


def record(name: str, body: bytes, length: int | None = None) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: http://a/{name}\r\n"
    head += f"WARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: {len(body) if length is None else length}\r\n\r\n"
    return head.encode() + body


def message(payload: str) -> bytes:
    return b"HTTP/1.1 200 OK\r\nETag: x\r\n\r\n" + payload.encode()


def payloads(spark, folder) -> dict:
    return {r.record_id: r.payload for r in warc.parse(warc.read_warc(spark, str(folder))).collect()}


PAYLOADS = {
    "quotes": "see: \r\n\r\n" + record("fake", message("false")).decode() + "\r\n\r\nand WARC/1.0 so on",
    "nested": "x" + record("inner", message("WARC/1.1\r\nWARC-Type: y")).decode() + record("other", b"", 10**12).decode(),
    "empty": "",
    "wide": "äöü€𐍈 WARC/1.0\r\nWARC-Type: é",
    "blank": "ends with lines\r\n\r\n\r\n",
    "plain": "text",
}


@pytest.mark.parametrize("split", [64, 1 << 20])
@pytest.mark.parametrize("compressed", [False, True])
def test_blocks_are_as_long_as_stated(spark, tmp_path, split, compressed):
    records = [record(name, message(text)) + b"\r\n\r\n" for name, text in PAYLOADS.items()]
    if compressed:  # a member per record, as crawlers write them
        (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(one) for one in records))
    else:
        (tmp_path / "a.warc").write_bytes(b"".join(records))
        (tmp_path / "b.warc").write_bytes(record("alone", message("in its file")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = payloads(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == PAYLOADS | ({} if compressed else {"alone": "in its file"})


def test_records_without_a_usable_length_reach_to_the_next(spark, tmp_path):
    one = record("one", message("first")).replace(b"Content-Length: ", b"Content-Length: about ")
    (tmp_path / "a.warc").write_bytes(one + b"\r\n\r\n" + record("two", message("second")) + b"\r\n\r\n")
    assert payloads(spark, tmp_path) == {"one": "first\r\n\r\n", "two": "second"}


def test_a_length_beyond_the_file_keeps_what_there_is(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record("one", message("cut sho"), 10**6))
    assert payloads(spark, tmp_path) == {"one": "cut sho"}


def test_files_without_a_record_give_none(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"")
    (tmp_path / "b.warc").write_bytes(b"no record here, though WARC/1.0 is named\r\n")
    assert payloads(spark, tmp_path) == {}
