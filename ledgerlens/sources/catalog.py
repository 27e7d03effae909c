"""Databases, result tables, external tables, schema descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop and create a database."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}{place}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def save_result(frame: DataFrame, name: str, database: str | None = None) -> str:
    """Store a result as table ``<name>_results``; running it again replaces it."""
    table = f"{database}.{name}_results" if database else f"{name}_results"
    frame.write.mode("overwrite").format("parquet").saveAsTable(table)
    return table


def register_parquet(spark: SparkSession, table: str, location: str) -> None:
    """External table over Parquet files; ``location`` must be absolute."""
    _require_absolute(location)
    drop_table(spark, table)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")


def register_csv(spark: SparkSession, table: str, location: str, kind: T.StructType) -> None:
    """External table over header CSV files with a declared schema."""
    _require_absolute(location)
    drop_table(spark, table)
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in kind.fields
    )
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING csv OPTIONS (header 'true') "
        f"LOCATION '{location}'"
    )


def _require_absolute(location: str) -> None:
    if not (location.startswith("/") or "://" in location or location.startswith("file:")):
        raise ValueError(f"external tables need an absolute location, got {location!r}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table with fresh file metadata."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def describe_schema(spark: SparkSession, table: str) -> DataFrame:
    """column_name, data_type of a table, read from the catalog; partition columns marked."""
    rows = [
        (
            column.name,
            column.dataType.upper() + (" (partition)" if column.isPartition else ""),
        )
        for column in spark.catalog.listColumns(table)
    ]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def filled_columns(spark: SparkSession, table: str) -> DataFrame:
    """D2 with contents: column_name, data_type, and how many rows of the table hold a value.

    One scan counts all columns; the result is turned to one row per column.
    """
    described = describe_schema(spark, table)
    rows = spark.table(table)
    counts = rows.agg(*[F.count(F.col(name)).alias(name) for name in rows.columns])
    cells = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("filled")) for name in rows.columns]
    )
    return described.join(counts.select(F.inline(cells)), "column_name")
