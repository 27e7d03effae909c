"""The named queries of this subpackage: thin digests over the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    embeddings,
    exact_dedup,
    licenses,
    packing,
    periodic,
    phrases,
    pii,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    warc,
)
from ledgerlens.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.repeated_strings(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels").where(~_held_out()))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        F.coalesce(_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT_AT).cast("int").alias("predicted"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    merged = warc.merge_index(warc.read_archives(spark, path))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=1,
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("_row")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    counts = [
        F.size(F.filter(spans, pii.of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.base_kinds()
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(spans, pii.base_kinds()), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write_token_files(
        _table(spark, sf_dir, "documents"),
        path,
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2,
    )
    return token_files.read_token_files(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode_texts(_table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode_ids(encoded, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def _labels(found: Column) -> Column:
    names = F.array_distinct(F.transform(found, lambda one: one["label"]))
    return F.array_join(F.sort_array(names), ",")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda one: one["is_phrase"])
    starts = F.transform(base, lambda one: one["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda one: one["share"])), F.lit(0.0)).alias("score"),
    )


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The documents of op13: every tenth by its checksum repeats a stretch of words to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select(
        "doc_id", "text", checksum.alias("_h"), F.floor(checksum / 10).cast("long").alias("_g")
    )
    words = F.regexp_extract_all("text", F.lit(periodic.WORD), F.lit(0))
    size = F.size(words).cast("long")
    first = F.col("_g") % size
    period = 1 + F.floor((size - first) / (3 + F.col("_g") % 8))
    head = F.slice(words, F.lit(1), first.cast("int"))
    unit = F.slice(words, (first + 1).cast("int"), period.cast("int"))
    tail = F.flatten(F.array_repeat(unit, F.ceil((size - first) / period).cast("int")))
    repeated = F.array_join(F.slice(F.concat(head, tail), F.lit(1), size.cast("int")), " ")
    text = F.when((F.col("_h") % 10 == 0) & (size > 0), repeated).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_repeats(_table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda run: F.struct(run["length"], -run["start"], -run["period"]))
    )
    lines = F.transform(
        "runs",
        lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")),
    )
    found = found.withColumn("_longest", longest)
    start, length, period = -F.col("_longest.col2"), F.col("_longest.length"), -F.col("_longest.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def all_queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_warc": op3_warc,
        "op4_packing": op4_packing,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_personal_data": op6_personal_data,
        "op7_simhash": op7_simhash,
        "op8_token_files": op8_token_files,
        "op9_embeddings": op9_embeddings,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_collocations": op11_collocations,
        "op12_license_scan": op12_license_scan,
        "op13_periodic_runs": op13_periodic_runs,
    }


def answers() -> dict[str, str]:
    return {
        "op3_warc": """
            WITH p AS (
                SELECT page_id, coalesce(html, '') AS html, url FROM pages),
            t AS (
                SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
                       CASE WHEN strlen(html) >= 100
                            THEN min(page_id) OVER (PARTITION BY sha256(html)) END AS first,
                       regexp_replace(regexp_replace(lower(coalesce(url, '')), '#.*$', ''),
                           '^[a-z][a-z0-9+.-]*://', '') AS plain
                FROM p)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN first <> page_id THEN first END AS refers_to,
                   concat(array_to_string(list_reverse(string_split(regexp_replace(
                       regexp_extract(plain, '^[^/?:]*'), '^www[0-9]*[.]', ''), '.')), ','), ')',
                       regexp_replace(plain, '^[^/?:]*', '')) AS url_key,
                   strftime(make_timestamp(1704067200000000 + (page_id % 1000000000) * 1000000),
                       '%Y-%m-%dT%H:%M:%SZ') AS captured
            FROM t""",
        "op5_exact_dedup": r"""
            WITH t AS (
                SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
                    '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                FROM documents)
            SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = min(doc_id) OVER same AS kept, text_sha256
            FROM t WINDOW same AS (PARTITION BY text_sha256)""",
        "op9_embeddings": """
            WITH RECURSIVE v AS (
                SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
            pairs AS (
                SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b USING (label)
                WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
            reach AS (
                SELECT vec_id AS a, vec_id AS b FROM embeddings
                UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
            component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
            linked AS (SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a)
            SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
                   vec_id = component_id AS kept
            FROM component LEFT JOIN linked USING (vec_id)""",
        "op11_collocations": r"""
            WITH t AS (
                SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS text
                FROM documents),
            pieces AS (
                SELECT lang, regexp_extract_all(
                    unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
                FROM t),
            grams AS (
                SELECT lang, m, unnest(list_transform(generate_series(1, len(w) - m + 1),
                    lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
                FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
            f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
            n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
            c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
            cuts AS (
                SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:m], ' ') AS q
                FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM c)),
            scored AS (
                SELECT cuts.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
                FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p
                JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
            best AS (
                SELECT * FROM scored
                QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
            inside AS (
                SELECT lang, a AS longer, array_to_string(w[s:s + size - 1], ' ') AS phrase
                FROM (SELECT *, unnest(generate_series(1, m - size + 1)) AS s
                      FROM (SELECT *, unnest(generate_series(2, m - 1)) AS size FROM c WHERE m > 2))),
            kept AS (
                SELECT * FROM best WHERE NOT EXISTS (
                    SELECT 1 FROM inside WHERE inside.lang = best.lang AND inside.phrase = best.phrase
                    AND 100::HUGEINT * longer >= 80::HUGEINT * a))
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
                   phrase, a, l, r, n, score
            FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    }
