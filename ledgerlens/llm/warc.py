"""Web archives: WARC files of captures, and one capture index in global order.

Archives are written by Spark's text writer as uncompressed WARC/1.1, one record after the other,
so a lost task leaves no half file. The captures of an archive lie in order of URL key, time and
page: every archive is a sorted run. The index is merged from these runs: ranges of the key
go to tasks, and a task merges its part of all runs with a loser tree.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.staging import Stage, as_bytes, as_text, ship_package

#: Archives are closed at this many bytes (a longer record has an archive of its own).
ARCHIVE_BYTES = 16 << 20

#: Payloads shorter than this are stored again rather than referred to.
REVISIT_FROM = 100

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> Column:
    """Sort key of a URL: host labels from the right, then port, path and query; no fragment."""
    plain = F.regexp_replace(F.lower(as_text(url)), r"#.*$|^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(plain, r"^[^/?:]*", 0), r"^www[0-9]*\.", "")
    rest = F.regexp_replace(plain, r"^[^/?:]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


class LoserTree:
    """Merges sorted runs: every step replays one path of matches, losers stay in the nodes."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.size = max(1, len(runs))
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * self.size
        for leaf in range(len(runs)):
            self._replay(leaf)

    def _beats(self, one: int, other: int) -> bool:
        left, right = self.heads[one], self.heads[other]
        if left is None or right is None:
            return right is None and (left is not None or one < other)
        return (left, one) < (right, other)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.size) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # while the tree is built: wait for the opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        if not self.runs:
            return
        while (head := self.heads[self.losers[0]]) is not None:
            yield head
            winner = self.losers[0]
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


#: Pages without a time of capture are dated by their key within this many seconds.
DATED_KEYS = 1_000_000_000


def _record(row: dict) -> bytes:
    """One WARC record, without the last line end."""
    moment = (_EPOCH + timedelta(microseconds=row["micros"])).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = row["refers_to"] is not None
    page = "" if row["page_id"] is None else str(row["page_id"])
    identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{page}|{row['digest']}|{row['url']}|{moment}")
    block = b"" if revisit else row["payload"]
    uri = re.sub(r"[\r\n]", " ", row["url"])
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{identity}>",
        f"WARC-Date: {moment}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"Payload-Length: {row['size']}",
        f"Page-ID: {page}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"Refers-To-Page-ID: {row['refers_to']}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n"


def write_archives(
    pages: DataFrame,
    path: str,
    captured: Column | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write a record per row. Equal payloads of ``REVISIT_FROM`` bytes or more are stored once.

    The row with the smallest key is the response, others revisit it and carry no payload. Null
    payloads and URLs are empty; a null key is written as empty and never chosen as the response
    of a keyed row; repeated rows with one key are all responses. ``captured`` is the time of
    capture; without it pages are dated by their key modulo DATED_KEYS. An empty table gives no archives.
    """
    ship_package(pages.sparkSession)
    if captured is None:
        # Keys like hashes would be dated beyond all calendars.
        second = F.pmod(F.coalesce(F.col(key).cast("long"), F.lit(0)), F.lit(DATED_KEYS))
        captured = F.timestamp_seconds(F.lit(1704067200) + second)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        as_text(url).alias("url"),
        url_key(url).alias("url_key"),
        F.coalesce(F.unix_micros(captured), F.lit(0)).alias("micros"),
        as_bytes(payload).alias("payload"),
        F.octet_length(as_bytes(payload)).cast("long").alias("size"),
        F.sha2(as_bytes(payload), 256).alias("digest"),
    )
    # Only digests travel here, merged on the map side; unique payloads are not listed.
    firsts = Stage(
        rows.where(F.col("size") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first is not null")
        .select("digest", "first"),
        "first-captures",
    )
    same = F.col("first").isNull() | F.col("first").eqNullSafe(F.col("page_id"))
    marked = (
        rows.join(firsts.frame, "digest", "left")
        .withColumn("refers_to", F.when(~same & (F.col("size") >= REVISIT_FROM), F.col("first")))
        .withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
        .drop("first")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = 0, 0
        for batch in batches:
            parts, values = [], []
            for row in batch.to_pylist():
                value = _record(row)
                if filled and filled + len(value) > archive_bytes:
                    part, filled = part + 1, 0
                filled += len(value) + 2
                parts.append(part)
                values.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    batch.column("url_key"),
                    batch.column("micros"),
                    batch.column("page_id"),
                    pa.array(values, pa.binary()),
                ],
                names=["part", "url_key", "micros", "page_id", "value"],
            )

    (
        marked.mapInArrow(
            records, "part int, url_key string, micros bigint, page_id bigint, value binary"
        )
        .sortWithinPartitions("part", "url_key", "micros", "page_id")
        .select("part", F.col("value").cast("string").alias("value"))
        .write.partitionBy("part")
        .option("lineSep", "\r\n")
        .text(path)
    )
    firsts.drop()


def parse_archive(content: bytes) -> Iterator[tuple[dict, bytes, int]]:
    """Headers, block and offset of every record, found by their stated lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if first != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines)
        begin = end + 4
        stop = begin + int(head["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        yield head, content[begin:stop], at
        at = stop + 4


_CAPTURE = (
    "url_key string, captured string, page_id bigint, url string, record_type string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, archive string, "
    "offset bigint, record int"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; a response whose payload does not have its digest is an error."""
    ship_package(spark)
    names = [field.split()[0] for field in _CAPTURE.split(", ")][1:]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content")):
                found = []
                for number, (head, block, at) in enumerate(parse_archive(content.as_py())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(head["Payload-Length"])
                    kind = head["WARC-Type"]
                    if kind == "response":
                        if hashlib.sha256(block).hexdigest() != digest or len(block) != size:
                            raise ValueError(f"{archive} at {at}: payload and digest differ")
                    page, refers = head["Page-ID"], head.get("Refers-To-Page-ID")
                    found.append(
                        (
                            head["WARC-Date"], int(page) if page else None,
                            head["WARC-Target-URI"], kind, size, digest,
                            int(refers) if refers else None, archive.as_py(), at, number,
                        )
                    )
                kinds = [
                    pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                    pa.int64(), pa.string(), pa.int64(), pa.int32(),
                ]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names
                    )

    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "content")
    )
    read_back = files.mapInArrow(read, _CAPTURE.split(", ", 1)[1])
    return read_back.select(url_key("url").alias("url_key"), "*")


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures in global order of URL key, time and page: range after range, merged.

    Each archive is a run in this order. A task gets a range of the key with the parts of all
    runs that fall into it, run by run, and merges them. A URL with very many captures is
    divided by time. ``captures`` is stored first, as ranges are drawn from a sample of it.
    """
    stored = Stage(captures, "captures").frame

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        archive = rows.column("archive").to_pylist()
        keys = list(
            zip(
                rows.column("url_key").to_pylist(),
                rows.column("captured").to_pylist(),
                [-1 if page is None else page for page in rows.column("page_id").to_pylist()],
                range(rows.num_rows),
            )
        )
        edges = [0] + [i for i in range(1, len(keys)) if archive[i] != archive[i - 1]] + [len(keys)]
        runs = [iter(keys[a:b]) for a, b in zip(edges, edges[1:])]
        order = [key[3] for key in LoserTree(runs)]
        yield from rows.take(pa.array(order)).combine_chunks().to_batches()

    return (
        stored.repartitionByRange("url_key", "captured", "page_id")
        .sortWithinPartitions("archive", "record")
        .mapInArrow(merge, _CAPTURE)
    )
