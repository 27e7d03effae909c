"""Token files: id arrays in ascending document order with Elias-Fano document boundaries.

A token file is a Parquet table of blocks. A block holds the ids of consecutive documents as
one array of 2- or 4-byte integers, and the ends of the documents in it as an Elias-Fano list:
about two bits and the logarithm of the mean length per document instead of 64. Shards are
ranges of document ids, so the order of (shard, block) is the order of the documents, and a
document starts at the sum of all ids before its block plus its offset in the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.elias_fano import EliasFano
from ledgerlens.llm.staging import as_bytes, ship_package
from ledgerlens.llm.words import encoder, slices

#: A block is closed at this many ids; a longer document has a block of its own.
BLOCK_IDS = 1_000_000

_BLOCKS = (
    "shard int, block int, docs array<bigint>, n_ids bigint, id_bytes int, ids binary, "
    "ends_size int, ends_low_bits int, ends_low binary, ends_high binary, ends_samples binary"
)


class _Block:
    """Documents gathered for one block."""

    def __init__(self, id_bytes: int):
        self.id_bytes = id_bytes
        self.docs: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.ids.append(ids)
        self.size += len(ids)

    def row(self, shard: int, number: int) -> pa.RecordBatch:
        ends = EliasFano.encode(np.cumsum([len(ids) for ids in self.ids]))
        raw = np.concatenate(self.ids).astype(f"<u{self.id_bytes}").tobytes()
        values = [
            shard, number, self.docs, self.size, self.id_bytes, raw,
            ends.size, ends.low_bits, ends.low, ends.high, ends.samples,
        ]
        kinds = [
            pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(),
            pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
        ]
        names = [field.split()[0] for field in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(values, kinds)], names=names
        )


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every whole text, append ``end_id``, and write blocks in ascending key order.

    A null text is empty and has the end id only. Null keys come first; rows with one key are
    ordered by a hash of their texts and all written. Other columns are not read. An empty
    table gives files without blocks. A shard is one task's range of keys, and at most a block
    and a few texts are in memory.
    """
    ship_package(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer_path)
        id_bytes = 2 if max(library.library.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        shard, number = TaskContext.get().partitionId(), 0
        block, end = _Block(id_bytes), np.asarray([end_id], dtype=np.uint32)
        for whole in batches:
            for batch in slices(whole, column="_text"):
                for doc, raw in zip(
                    batch.column("_key").to_pylist(), library.encode(batch.column("_text"))
                ):
                    ids = np.concatenate([np.frombuffer(raw, "<u4"), end])
                    if block.docs and block.size + len(ids) > block_ids:
                        yield block.row(shard, number)
                        block, number = _Block(id_bytes), number + 1
                    block.add(doc, ids)
        if block.docs:
            yield block.row(shard, number)

    in_order = (
        docs.select(F.col(key).cast("long").alias("_key"), as_bytes(text).alias("_text"))
        .repartitionByRange(F.col("_key").asc_nulls_first())
        .sortWithinPartitions(F.col("_key").asc_nulls_first(), F.xxhash64("_text"))
    )
    in_order.mapInArrow(pack, _BLOCKS).write.option("compression", "zstd").parquet(path)


def _block_starts(blocks: DataFrame) -> DataFrame:
    """shard, block, base: ids before each block, summed per shard first."""
    sizes = blocks.select("shard", "block", "n_ids")
    # One row per shard: the only window that is not divided has as many rows as there are files.
    shards = (
        sizes.groupBy("shard")
        .agg(F.sum("n_ids").alias("total"))
        .select(
            "shard",
            (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"),
        )
    )
    in_shard = Window.partitionBy("shard").orderBy("block")
    return sizes.withColumn("within", F.sum("n_ids").over(in_shard) - F.col("n_ids")).join(
        shards, "shard"
    ).select("shard", "block", (F.col("before") + F.col("within")).alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (little-endian unsigned 32-bit) of every document in the files."""
    ship_package(spark)
    blocks = spark.read.schema(_BLOCKS).parquet(path)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = EliasFano(
                    row["ends_size"], row["ends_low_bits"], row["ends_low"],
                    row["ends_high"], row["ends_samples"],
                ).decode()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
                raw = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["docs"], pa.int64()),
                        pa.array(starts + row["base"], pa.int64()),
                        pa.array(raw, pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return blocks.join(_block_starts(blocks), ["shard", "block"]).mapInArrow(
        unpack, "doc_id bigint, start bigint, ids binary"
    )
