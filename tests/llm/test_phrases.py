"""Collocations against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import SF_SMALL, awkward, empty

from ledgerlens.llm import phrases, queries
from oracle.compare import check, connect

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    """Occurrences of all phrases of one to four words by (lang, words)."""
    found = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    found[lang or "und", tuple(words[at : at + size])] += 1
    return found


def plain_collocations(rows, support, top):
    f = plain_counts(rows)
    n = Counter()
    for (lang, words), count in f.items():
        n[lang] += count * (len(words) == 1)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    dropped = set()
    for (lang, words), longer in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = (lang, words[at : at + size])
                if 100 * longer >= 80 * f[inner]:
                    dropped.add(inner)
    rows = []
    for (lang, words), a in candidates.items():
        if (lang, words) in dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]  # noqa: E741
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)  # noqa: E741
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    rows.sort()
    answer, rank = [], Counter()
    for lang, score, a, phrase, l, r in rows:  # noqa: E741
        rank[lang] += 1
        if rank[lang] <= top:
            answer.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return answer


def _texts(seed, count):
    draw = random.Random(seed)
    words = [f"w{at}" for at in range(12)] + ["Über", "ÀB", "a\x1fb", "x y", "日本"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "\x0b", " \t "]
    rows = []
    for _ in range(count):
        text = "".join(
            draw.choice(words[: draw.choice([3, 17])]) + draw.choice(ends) for _ in range(draw.randint(0, 60))
        )
        rows.append((text, draw.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_equals_plain_search(spark, shards):
    rows = [*_texts(1, 300), (None, "en"), ("", None), ("only one language", "xx")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(9)
    found = phrases.collocations(docs, top=50, support=8, shards=shards).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows, 8, 50)


def test_no_frequent_phrase_is_lost_between_shards(spark):
    """Exactly ``support`` occurrences, spread so that every shard holds a few of them."""
    rows = [(f"alpha beta gamma delta only{at}x", "en") for at in range(12)]
    rows += [(f"word{at} other{at}", "en") for at in range(50)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(12)
    frequent, _ = phrases.frequent_phrases(docs, support=12, shards=12)
    found = {row["phrase"]: row["f"] for row in frequent.collect()}
    assert found["alpha beta gamma delta"] == 12 and len(found) == 4 + 3 + 2 + 1


def test_a_full_filter_changes_nothing(spark):
    rows = _texts(2, 200)
    docs = spark.createDataFrame(rows, "text string, lang string")
    full, _ = phrases.frequent_phrases(docs, support=6, filter_bits=7)
    plain = {(lang, " ".join(words), f) for (lang, words), f in plain_counts(rows).items() if f >= 6}
    assert {(row["lang"], row["phrase"], row["f"]) for row in full.collect()} == plain


def test_many_ranges_change_nothing(spark):
    rows = _texts(4, 300)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found, words = phrases.frequent_phrases(docs, support=6, range_bytes=100)
    counts = plain_counts(rows)
    plain = {(lang, " ".join(words), f) for (lang, words), f in counts.items() if f >= 6}
    assert {(row["lang"], row["phrase"], row["f"]) for row in found.collect()} == plain
    for row in words.collect():
        assert row["n"] == sum(f for (lang, one), f in counts.items() if lang == row["lang"] and len(one) == 1)


def test_long_texts_are_cut_between_pieces():
    text = b"one two. three " * 900_000
    parts = list(phrases._parts(text))
    assert len(parts) > 2 and b"".join(parts) == text
    assert all(part.endswith(b".") for part in parts[:-1])
    assert list(phrases._parts(b"x" * (9 << 20))) == [b"x" * (9 << 20)]


def test_texts_without_words(spark):
    docs = spark.createDataFrame([(" . ", "en"), ("", "de"), (None, None)], "text string, lang string")
    assert phrases.collocations(docs).collect() == []


def test_awkward_rows(spark):
    assert phrases.collocations(empty(spark).withColumn("lang", phrases.F.lit("en"))).collect() == []
    docs = awkward(spark)
    rows = [(row["text"], row["label"]) for row in docs.collect()]
    clash = docs.withColumnRenamed("label", "lang")
    for name in ("phrase", "hash", "n", "score", "_text", "_lang", "size", "shard"):
        clash = clash.withColumn(name, phrases.F.lit("x"))
    found = phrases.collocations(clash, support=2, top=10).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows, 2, 10)


def test_scores_beyond_64_bits(spark):
    many = 10**15
    rows = [("en", 1, "a", 3 * many), ("en", 1, "b", 2 * many), ("en", 2, "a b", many)]
    frequent = spark.createDataFrame(rows, "lang string, size int, phrase string, f bigint")
    (row,) = phrases.scored_phrases(frequent).collect()
    assert row["score"] == 2000000 * many // (5 * many)


def test_query_equals_sql(spark):
    name = "op11_collocations"
    with connect(SF_SMALL) as connection:
        equal, note, rows = check(
            spark, SF_SMALL, queries.all_queries()[name], queries.answers()[name], connection
        )
    assert equal, note


def test_parts_of_phrases_are_not_broadcast(spark, tmp_path):
    """Each stands 16 times, which Spark does not see in the size of the file."""
    rows = [("en", 1, "a", 90), ("en", 1, "b", 80), ("en", 1, "c", 70), ("en", 2, "a b", 60), ("en", 2, "b c", 50), ("en", 3, "a b c", 40)]
    spark.createDataFrame(rows, "lang string, size int, phrase string, f bigint").write.parquet(str(tmp_path / "f"))
    scored = phrases.scored_phrases(spark.read.parquet(str(tmp_path / "f")))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [lang") == 2
    found = sorted(tuple(row) for row in scored.collect())
    assert found == [("en", "a b", 60, 90, 80, 705882), ("en", "a b c", 40, 90, 50, 571428)]
