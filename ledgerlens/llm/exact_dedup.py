"""Exact duplicates by content-defined chunk recipes. DataFrame functions only.

A text is cut where its own content says so, every chunk is replaced by an identifier, and two
texts are equal when their ordered identifier lists are. Chunks travel once, for the check of
their identifiers: a 64-bit hash identifies a chunk only if no other chunk has it. Chunks whose
hash is shared by different chunks stay in the recipe as full texts, so lists never agree by
accident. After that only recipes move, a few numbers per document however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import ROW, Stage, as_text, row_number, without

#: A chunk ends after a vowel and a non-letter, between 512 and 4096 characters from its start.
CHUNK = r"(?s).{512,4096}?(?<=[aeiou][^\p{L}])|(?s).{1,4096}"

#: Runs of white space that are not already a single space.
_LOOSE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(as_text(text), _LOOSE_SPACE, " ")


def chunks(text: Column) -> Column:
    """The chunks of a text in order; an empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _identifier(chunk: Column, hash_bits: int) -> Column:
    full = F.xxhash64(chunk)
    return full if hash_bits >= 64 else full.bitwiseAND(F.lit((1 << hash_bits) - 1))


def _ambiguous_hashes(texts: DataFrame, hash_bits: int) -> DataFrame:
    """Hashes that stand for more than one chunk; copies are merged before they travel."""
    found = texts.select(F.explode(chunks(F.col("_norm"))).alias("chunk")).select(
        _identifier(F.col("chunk"), hash_bits).alias("h"), "chunk"
    )
    return found.distinct().groupBy("h").count().where("count > 1").select("h")


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hash_bits: int = 64
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, _row.

    Of equal normalised texts the row with the smallest key is kept; null keys come last, and of
    repeated rows with one key a single row is kept. Null texts equal the empty text. ``_row``
    identifies the row as ``staging.row_number`` does on the same table. An empty table gives an
    empty result; other columns are not read. ``hash_bits`` below 64 is for tests of the check.
    """
    texts = docs.select(
        F.col(key).alias("_key"), row_number().alias("_row"), normalised(text).alias("_norm")
    )
    recipes = Stage(
        texts.select(
            "_key",
            "_row",
            F.sha2(F.col("_norm"), 256).alias("text_sha256"),
            F.transform(
                chunks(F.col("_norm")), lambda chunk: _identifier(chunk, hash_bits)
            ).alias("recipe"),
        ),
        "recipes",
    ).frame
    ambiguous = Stage(_ambiguous_hashes(texts, hash_bits), "ambiguous-hashes").frame
    if ambiguous.isEmpty():
        recipes = recipes.withColumn("exact", F.lit(None).cast("array<struct<pos:int,chunk:string>>"))
    else:
        spelled = (
            texts.select("_row", F.posexplode(chunks(F.col("_norm"))).alias("pos", "chunk"))
            .withColumn("h", _identifier(F.col("chunk"), hash_bits))
            .join(ambiguous, "h", "left_semi")
            .groupBy("_row")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "chunk"))).alias("exact"))
        )
        recipes = recipes.join(spelled, "_row", "left")
    # Merged on the map side, so a group of copies reaches its class as one row per task.
    classes = (
        recipes.groupBy("recipe", "exact")
        .agg(
            F.min(F.struct(F.col("_key").isNull().alias("last"), "_key", "_row")).alias("first"),
            F.count(F.lit(1)).alias("group_size"),
        )
        .where("group_size > 1")
    )
    # Single documents find no class here. A large class is split over tasks by the runtime
    # skew join, its side of this join being one row.
    own, of = recipes.alias("own"), classes.alias("of")
    joined = own.join(
        of,
        (F.col("own.recipe") == F.col("of.recipe"))
        & F.col("own.exact").eqNullSafe(F.col("of.exact")),
        "left",
    )
    single = F.col("of.group_size").isNull()
    return joined.select(
        F.col("own._key").alias(key),
        F.when(single, F.col("own._key")).otherwise(F.col("of.first._key")).alias("keep_id"),
        F.coalesce("of.group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("of.first._row") == F.col("own._row"))).alias("kept"),
        "own.text_sha256",
        "own._row",
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = exact_duplicates(docs, key, text)
    dropped = Stage(found.where(~F.col("kept")).select(F.col("_row").alias(ROW)), "dropped-copies").frame
    return without(docs, dropped)
