from __future__ import annotations

import hashlib
import random
from datetime import datetime

import pytest
from helpers import SF_TINY, table
from pyspark.sql import functions as F

from ledgerlens.llm import warc
from ledgerlens.session import shared_folder

FIELDS = "page_id bigint, url string, html string, digest string, part int"
BIG = "<p>" + "warc " * 50 + "</p>"
ROWS = [
    (5, "http://www.b.org/x", BIG, "a", 1),
    (2, "https://a.b.org:80/x#top", BIG, "a", 1),
    (9, None, BIG, None, None),
    (1, "http://b.org/", "short", "a", 1),
    (3, "http://b.org/", "short", "a", 1),
    (4, "http://b.org/", None, "a", 1),
    (6, "http://b.org/", "", "a", 1),
    (7, "ftp://c.net/q?a=1", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "a", 1),
    (8, "http://é.fr/\r\nevil: 1", "é" * 100, "a", 1),
    (None, "http://b.org/", BIG, "a", 1),
    (None, "http://b.org/", "only without key" * 20, "a", 1),
    (2, "https://a.b.org:80/x#top", BIG, "a", 1),
]


def _round_trip(spark, frame, **options):
    path = shared_folder(spark, "test-archives")
    warc.write_archives(frame, path, **options)
    return path, warc.merge_index(warc.read_archives(spark, path))


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 700])
def test_awkward_pages(spark, archive_bytes):
    frame = spark.createDataFrame(ROWS, FIELDS).repartition(3)
    path, merged = _round_trip(spark, frame, archive_bytes=archive_bytes)
    rows = merged.collect()
    assert len(rows) == len(ROWS)
    by_id = {row["page_id"]: row for row in rows}
    for page, _, html, *_ in ROWS:
        raw = (html or "").encode()
        if page is not None:
            assert by_id[page]["payload_digest"] == hashlib.sha256(raw).hexdigest()
            assert by_id[page]["payload_bytes"] == len(raw)
    assert [by_id[i]["record_type"] for i in (1, 2, 3, 4, 5, 6, 9)] == [
        "response", "response", "response", "response", "revisit", "response", "revisit",
    ]
    assert by_id[5]["refers_to"] == by_id[9]["refers_to"] == 2
    keyless = sorted((row["payload_bytes"], row["record_type"]) for row in rows if row["page_id"] is None)
    assert keyless == [(len(BIG), "revisit"), (320, "response")]
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "part-*"
    ).load(path)
    assert (archives.count() > 6) == (archive_bytes == 700)


def test_index_is_in_global_order_and_complete(spark):
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet").repartition(4)
    _, merged = _round_trip(spark, pages, captured=F.to_timestamp(F.lit("2024-05-06 07:08:09")))
    rows = merged.collect()
    keys = [(row["url_key"], row["captured"], row["page_id"]) for row in rows]
    assert keys == sorted(keys)
    assert {row["captured"] for row in rows} == {"2024-05-06T07:08:09Z"}
    assert sorted(row["page_id"] for row in rows) == sorted(r[0] for r in table(SF_TINY, "pages"))


def test_records_stand_where_the_index_says(spark):
    pages = spark.createDataFrame(ROWS, FIELDS)
    path, merged = _round_trip(spark, pages)
    files = {
        row["path"]: bytes(row["content"])
        for row in spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*").load(path).collect()
    }
    for row in merged.collect():
        head = files[row["archive"]][row["offset"] :].split(b"\r\n\r\n")[0].decode()
        assert head.startswith("WARC/1.1\r\n") and f"WARC-Type: {row['record_type']}" in head
        date = head.split("WARC-Date: ")[1].split("\r\n")[0]
        assert datetime.strptime(date, "%Y-%m-%dT%H:%M:%SZ") and date == row["captured"]


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))
    assert list(warc.parse_archive(b"")) == []


def test_empty_table(spark):
    frame = spark.createDataFrame([], FIELDS)
    path = shared_folder(spark, "test-archives")
    warc.write_archives(frame, path)
    assert warc.merge_index(warc.read_archives(spark, path)).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(count):
    draw = random.Random(count)
    runs = [sorted(draw.randrange(50) for _ in range(draw.randrange(20))) for _ in range(count)]
    merged = [value for value in warc.LoserTree([iter([(v,) for v in run]) for run in runs])]
    assert merged == sorted((v,) for run in runs for v in run)


def test_keys_like_hashes_are_dated(spark, tmp_path):
    docs = spark.createDataFrame(
        [(2**62, "http://a.b/", "x" * 200), (2**62 + 5, "http://a.b/", "x" * 200), (-7, "http://a.b/", "y")],
        "page_id bigint, url string, html string",
    )
    warc.write_archives(docs, str(tmp_path / "archives"))
    rows = {row["page_id"]: row for row in warc.merge_index(warc.read_archives(spark, str(tmp_path / "archives"))).collect()}
    assert rows.keys() == {2**62, 2**62 + 5, -7}
    assert rows[2**62 + 5]["refers_to"] == 2**62 and rows[-7]["record_type"] == "response"
