"""Write and read timings of file formats and codecs on one table."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlens.sources.files import avro_available, probe_output

FORMATS = ["parquet", "orc", "json", "csv"]
CODECS = ["none", "snappy", "gzip", "bzip2"]

# What a format calls a codec, and pairs that do not exist.
CODEC_NAMES = {("avro", "gzip"): "deflate", ("orc", "gzip"): "zlib", ("avro", "none"): "uncompressed"}
UNSUPPORTED = {("parquet", "bzip2"), ("orc", "bzip2")}

COLUMNS = (
    "format string, codec string, effective_codec string, write_seconds double, "
    "size_bytes bigint, read_seconds double, status string"
)


def _measure(frame: DataFrame, kind: str, codec: str, path: str) -> tuple:
    """Timings of one pair; a failure becomes a status, the sweep goes on."""
    spark = frame.sparkSession
    effective = CODEC_NAMES.get((kind, codec), codec)
    if (kind, codec) in UNSUPPORTED:
        return (kind, codec, None, None, None, None, "codec_unsupported")
    started = time.perf_counter()
    try:
        frame.write.mode("overwrite").format(kind).option("compression", effective).save(path)
    except Exception:
        return (kind, codec, effective, None, None, None, "write_failed")
    write_seconds = time.perf_counter() - started
    size = int(probe_output(spark, path)["bytes"])
    started = time.perf_counter()
    try:
        # Every column is read: an aggregate over a bare count could skip the data pages.
        spark.read.format(kind).schema(frame.schema).load(path).write.format("noop").mode(
            "overwrite"
        ).save()
    except Exception:
        return (kind, codec, effective, write_seconds, size, None, "read_failed")
    return (kind, codec, effective, write_seconds, size, time.perf_counter() - started, "ok")


def compare_formats(
    frame: DataFrame,
    folder: str,
    formats: Sequence[str] | None = None,
    codecs: Sequence[str] = tuple(CODECS),
) -> DataFrame:
    """One row per format and codec; Avro joins in where its module is present."""
    spark = frame.sparkSession
    if formats is None:
        formats = FORMATS + (["avro"] if avro_available(spark) else [])
    results = [
        _measure(frame, kind, codec, f"{folder}/{kind}_{codec}")
        for kind in formats
        for codec in codecs
    ]
    return spark.createDataFrame(results, COLUMNS)
