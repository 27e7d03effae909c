"""A corpus pipeline: toxic texts go, exact copies go, near copies go, personal data is masked, and
what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dedup, packing, pii, simhash, toxicity
from ledgerlens.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the rejecting score, by a model of the labels in ``sf_dir``."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints that differ in three bits at most
    (BK-trees, as ``op7_simhash``), or by a similarity of 0.8 of their five-word shingles."""
    return simhash.keep_one(docs, radius=3, words=5, similarity=0.8)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    # A given column of the name that the operator adds is put aside meanwhile.
    aside = {name: f"__given_{name}" for name in docs.columns if name == "pii_spans"}
    masked = pii.redact(docs.withColumnsRenamed(aside))
    masked = masked.drop("pii_spans").withColumnsRenamed({new: old for old, new in aside.items()})
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids or a smaller power of two."""
    pieces = packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Most stages cannot be stated in SQL; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
