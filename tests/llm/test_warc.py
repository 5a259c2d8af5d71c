"""Archives read back against what was written, with magic inside payloads."""

import hashlib

import pytest

from rungworks.llm import warc

RECORD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: {}\r\n\r\n{}"
HTMLS = [
    "plain", None, "", "\r\n", "\r\n\r\n", "x\r\n\r\nWARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1\r\n",
    "a\r\n\r\n" + RECORD.format(3, "abc") + "\r\n\r\n" + RECORD.format(2, "de"),
    "a\r\n\r\n" + RECORD.format(9, "abcde"),
    "a\r\n\r\n" + RECORD.format(99999999999999, "abcde") + "\r\n\r\n" + RECORD.format("x", ""),
    "a\r\n\r\n" + RECORD.format(1, "b"),
    "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n",
    "é漢字\U0001f600", "z" * 300_000,
] * 2


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, f"http://h/{i}\r\nX: {i}", h) for i, h in enumerate(HTMLS)], "page_id long, url string, html string")


def _payloads(records):
    return {r.id: bytes(r.payload) for r in records if r.type == "response"}


@pytest.mark.parametrize("split", ["128m", "9000b"])
def test_payloads_come_back_whole(spark, pages, tmp_path, split):
    path = str(tmp_path / "a")
    warc.write_archives(pages.coalesce(1), path, least=10**9)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(HTMLS)
    assert _payloads(got) == {i: (h or "").encode() for i, h in enumerate(HTMLS)}
    assert all(r.url == f"http://h/{r.id}%0D%0AX: {r.id}" for r in got)


def test_repeated_payloads_become_revisits(spark, pages, tmp_path):
    got = warc.resolve(warc.archive_and_read(pages)).collect()
    last = {h or "": i for i, h in enumerate(HTMLS)}
    assert len(got) == len(HTMLS)
    for row in got:
        html = HTMLS[row.page_id] or ""
        assert row.payload_bytes == len(html.encode())
        assert row.refers_to == (None if last[html] == row.page_id else last[html])
        assert row.record_type == ("response" if row.refers_to is None else "revisit")


def test_base32_of_sha1(spark):
    import base64

    for text in ("", "abc", "é" * 50):
        got = spark.createDataFrame([(text,)], "t string").select(warc.base32_sha1(warc.F.col("t").cast("binary")).alias("d")).first().d
        assert got == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_a_file_that_is_no_archive_has_no_records(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"junk\r\n\r\nWARC/1.1\r\nContent-Length: 1\r\n\r\na\r\n\r\n")
    assert warc.read_archives(spark, str(tmp_path)).collect() == []
