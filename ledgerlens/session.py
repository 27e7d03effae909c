"""Session settings the jobs rely on, and the shared folder for lineage cuts."""

from __future__ import annotations

import atexit
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_RUNTIME_SETTINGS = {
    # HOUR / DAYOFWEEK / dates are defined in one zone for every executor.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalescing, skew-join splitting, join strategy by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Re-loading a day replaces that day's partition only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Whether the shuffle files of a query are deleted at its end (from Spark 4.1).
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pin_session(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def build_session(app_name: str, time_zone: str = "UTC", **settings: str) -> SparkSession:
    """Create (or fetch) a session; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return pin_session(builder.getOrCreate(), time_zone)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints, shared by driver and executors.

    The cluster names it in ``spark.checkpoint.dir``. Where it does not, a folder below
    ``spark.sql.warehouse.dir`` is used; on a cluster that must not be a folder of one machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not current or named.rstrip("/") not in current:
            context.setCheckpointDir(named)
    elif not current:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        is_local = context.master.startswith("local") and not context.master.startswith("local-cluster")
        if not is_local and (warehouse.startswith(("file:", "/")) or "://" not in warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(f"{warehouse}/_staging")
    return context.getCheckpointDir()


def materialise(frame: DataFrame) -> DataFrame:
    """Compute a summary once into the shared checkpoint folder and cut its lineage.

    Used where a small result feeds several branches, so that the ledger is scanned once, or
    where values depend on the physical partitioning and must not be computed a second time.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


#: Folders given out and not yet deleted, oldest first.
_GIVEN: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder; see ``discard_staged``."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    return path


def remove_folder(path: str) -> None:
    """Delete a folder through Spark's own access to its file system."""
    jvm = SparkContext._jvm
    if jvm is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


def discard_staged(since: int = 0) -> None:
    """Delete staged folders given out after the first ``since``: their readers are done.

    Batch stages call it when their results are written. Frames that queries return read staged
    folders lazily, so for these it runs when the application ends.
    """
    while len(_GIVEN) > since:
        remove_folder(_GIVEN.pop())


def staged_count() -> int:
    """How many staged folders exist; pass it to ``discard_staged`` later."""
    return len(_GIVEN)


@atexit.register
def _discard_at_exit() -> None:
    try:
        discard_staged()
    except Exception:  # the JVM may be gone already
        _GIVEN.clear()


def store(frame: DataFrame) -> DataFrame:
    """The same for results of ledger size: a compressed Parquet table in the shared folder.

    Later passes read only the columns they need, and the planner knows the size. The shuffle files
    behind the table go as soon as it is written, not when the driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, "stored")
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        frame.write.option("compression", "snappy").parquet(path)
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(frame.schema).parquet(path)
