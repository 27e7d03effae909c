from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir, materialise, store


def test_folder_named_by_the_session_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in ensure_checkpoint_dir(spark)
    kept = store(spark.range(10).withColumn("x", F.col("id") * 2))
    assert all(named in path for path in kept.inputFiles())
    assert kept.agg(F.sum("x")).first()[0] == 90
    assert materialise(spark.range(5)).count() == 5
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_storing_leaves_no_shuffle_files(spark):
    """They stayed until the driver happened to collect its garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllFiles().mkString("\n").split("\n")
        return {name for name in names if "/shuffle_" in name}

    before = shuffled()
    stored = store(spark.range(1000).repartition(7, "id"))
    assert not shuffled() - before
    assert stored.agg({"id": "sum"}).first()[0] == 499_500
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
