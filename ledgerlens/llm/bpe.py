"""Byte-level BPE ids from a rank file with the tiktoken library, and bytes back from ids."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.held import held
from ledgerlens.llm.staging import as_bytes, ship_package
from ledgerlens.llm.words import slices

#: Longer texts are handed to the library in parts of about this many characters.
LONG_TEXT = 50_000

#: Text bytes encoded, and rows decoded, before results are handed on.
BATCH_BYTES, DECODED_ROWS = 2 << 20, 500

def _load(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in lines if line.strip())
        }
    name = hashlib.sha256(ranks_path.encode()).hexdigest()[:16]
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def codec(ranks_path: str, pattern: str):
    """The tiktoken encoding of this Python worker."""
    return held(("bpe", ranks_path, pattern), lambda: _load(ranks_path, pattern))


def safe_parts(text: str, size: int = LONG_TEXT) -> list[str]:
    """Parts of a text whose ids are the ids of the text.

    Cuts fall before a space that follows a visible ASCII character: no match of the split
    pattern goes across such a place, and what it looks ahead to lies in the same part. A text
    without such a place stays whole.
    """
    parts, start = [], 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut != -1 and not "!" <= text[cut - 1] <= "~":
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        parts.append(text[start:cut])
        start = cut
    parts.append(text[start:])
    return parts




def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key and ``ids`` (array of int) of every row; a null or empty text has no ids.

    Row by row and without a shuffle: repeated rows and null keys are simply kept, other columns
    are not read, an empty table gives an empty result. ``ranks_path`` names the rank file on
    every executor.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = codec(ranks_path, pattern)
        for whole in batches:
            for batch in slices(whole, BATCH_BYTES, "_text"):
                ids, ends = [], [0]
                for raw in batch.column("_text"):
                    size = 0
                    for part in safe_parts(raw.as_py().decode("utf-8", "replace")):
                        found = library.encode_ordinary(part)
                        ids.append(np.asarray(found, dtype=np.int32))
                        size += len(found)
                    ends.append(ends[-1] + size)
                flat = pa.array(np.concatenate(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    plain = docs.select(F.col(key), as_bytes(text).alias("_text"))
    kind = plain.schema[key].dataType.simpleString()
    return plain.mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes the ids stand for; null ids give no bytes."""
    ship_package(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = codec(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                some = batch.slice(start, DECODED_ROWS)
                # One list of Python integers at a time.
                raw = [library.decode_bytes(ids.as_py() or []) for ids in some.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(raw, pa.binary())],
                    names=[*some.schema.names, "decoded"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{fields}, decoded binary")
