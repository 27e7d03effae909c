"""Shared folders for intermediate tables, and the package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_folder

_PACKAGE = Path(__file__).resolve().parent.parent


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlens_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="ledgerlens-package-")) / "ledgerlens_package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(_PACKAGE.rglob("*.py")):
            packed.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    context._ledgerlens_shipped = True


class Stage:
    """A table written to the shared folder of the cluster: survives lost executors."""

    def __init__(self, frame: DataFrame, name: str):
        spark = frame.sparkSession
        self.path = shared_folder(spark, name)
        frame.write.option("compression", "snappy").parquet(self.path)
        self.frame = spark.read.schema(frame.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the table; only after everything that reads it has been computed."""
        remove(self.frame.sparkSession, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system through Spark's own file access."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def as_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def as_text(column: str) -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Column that identifies rows inside an operator; not a likely name of a given column.
ROW = "__ledgerlens_row"


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose identity (``row_number``) is not in column ROW of ``dropped``."""
    return docs.withColumn(ROW, row_number()).join(dropped, ROW, "left_anti").drop(ROW)


def row_number() -> Column:
    """An identity for every row of a table, the same whenever the same files are read."""
    return F.monotonically_increasing_id()
