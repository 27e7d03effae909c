"""Typed readers and plain writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema

# Fixed value: the timestamp text of the public transfer files.
RAW_TIMESTAMP = "yyyy/MM/dd HH:mm"


def _csv(
    spark: SparkSession, path: str | list[str], kind: T.StructType, timestamp_format: str
) -> DataFrame:
    """Header CSV by position: the header row is skipped, its names are not used."""
    return (
        spark.read.schema(kind)
        .option("header", True)
        .option("enforceSchema", True)
        .option("nullValue", "")
        .option("timestampFormat", timestamp_format)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_accounts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The accounts dimension."""
    return _csv(spark, path, schema.ACCOUNTS, RAW_TIMESTAMP)


def read_transfers(
    spark: SparkSession, path: str | list[str], timestamp_format: str = RAW_TIMESTAMP
) -> DataFrame:
    """The raw ledger, 11 columns."""
    return _csv(spark, path, schema.TRANSFER, timestamp_format)


def read_pattern_rows(
    spark: SparkSession, path: str | list[str], timestamp_format: str = RAW_TIMESTAMP
) -> DataFrame:
    """S3: labelled transfers, 13 columns."""
    return _csv(spark, path, schema.PATTERN_ROW, timestamp_format)


def read_fines(spark: SparkSession, path: str) -> DataFrame:
    """The static table of enforcement fines."""
    return _csv(spark, path, schema.FINES, RAW_TIMESTAMP)


def fines_by_size(fines: DataFrame) -> DataFrame:
    """b8: fines from the smallest to the largest."""
    return fines.orderBy("fine_usd_billion", "institution", "year")


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored rows written by ``write_csv``, with their declared schema."""
    return _csv(spark, path, schema.SCORED, RAW_TIMESTAMP)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S12."""
    return spark.read.parquet(path)


def avro_available(spark: SparkSession) -> bool:
    """Avro is a separate Spark module; not every installation has it."""
    try:
        spark.read.format("avro").schema("probe int").load([])
    except Exception as error:
        return "avro" not in str(error).lower()
    return True


def read_avro(spark: SparkSession, path: str, avro_schema: str | None = None) -> DataFrame:
    """Avro files, with an external schema given as JSON text."""
    reader = spark.read.format("avro")
    if avro_schema:
        reader = reader.option("avroSchema", avro_schema)
    return reader.load(path)


def write_parquet(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Snappy Parquet, replacing what is there."""
    writer = frame.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(frame: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV with quoting. ``single_file`` is for small result tables only:
    it sends all rows through one task."""
    target = frame.coalesce(1) if single_file else frame
    target.write.mode("overwrite").option("header", True).csv(path)


def write_training_json(frame: DataFrame, path: str, single_file: bool = False) -> None:
    """Gzip JSON lines of ``features`` and ``label``; the vector becomes a struct."""
    target = frame.select("features", "label")
    target = target.coalesce(1) if single_file else target
    target.write.mode("overwrite").option("compression", "gzip").json(path)


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length of every data file under ``path`` (the content is not read)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def probe_output(spark: SparkSession, path: str) -> dict[str, object]:
    """Number of files, bytes and absolute location of a written folder."""
    row = (
        written_files(spark, path)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.min("path").alias("sample"),
        )
        .first()
    )
    location = None
    if row["sample"]:
        tail = path.rstrip("/").split("://")[-1].lstrip("./")
        head, found, _ = row["sample"].partition(tail)
        location = head + found
    return {"files": row["files"], "bytes": row["bytes"], "location": location}


def file_relation(frame: DataFrame) -> DataFrame:
    """Path, bytes, rows and write time of every file behind ``frame``, as a relation.

    Sizes come from the scan's own metadata column, so nothing is listed on the driver, and the
    row counts show files that were written but hold nothing. Empty files do not appear.
    """
    return frame.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("written"),
    ).agg(F.count(F.lit(1)).alias("rows"))
