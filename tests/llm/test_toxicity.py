from __future__ import annotations

import numpy as np
from helpers import awkward, empty

from ledgerlens.llm import queries, string_kernel, toxicity


def _slow(s, t, size=string_kernel.SUBSEQUENCE, decay=string_kernel.DECAY):
    """The kernel by its definition: all pairs of equal subsequences and what they span."""
    from itertools import combinations

    def weights(word):
        found = {}
        for at in combinations(range(len(word)), size):
            key = "".join(word[i] for i in at)
            found[key] = found.get(key, 0) + decay ** (at[-1] - at[0] + 1)
        return found

    a, b = weights(s), weights(t)
    cross = sum(a[k] * b.get(k, 0) for k in a)
    own = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return cross / own if own else 0.0


def test_kernel_by_definition():
    strings = ["idiot", "i.d.iot", "idiiot", "édition", "ab", "", "aaaaa", "moronic", "日本語x"]
    marks = ["idiot", "moron", "aaa", "日本語"]
    got = string_kernel.kernel(strings, marks)
    want = [[_slow(s, t) for t in marks] for s in strings]
    assert np.allclose(got, want, atol=1e-4)
    assert got[1][0] > got[3][0]


def test_words_cover_long_and_spaced_strings():
    text = "He is an I D I O T! " + "x" * 10 + "moron" + "y" * 60
    found = toxicity.words(text)
    assert "idiot" in found
    assert any("moron" in word for word in found)
    assert toxicity.words("") == set()


def _corpus(count, seed):
    rng = np.random.default_rng(seed)
    parts = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "vi"]
    insults = ["grobnik", "zwuffel", "pheckst"]
    rows, labels = [], []
    for key in range(count):
        words = ["".join(rng.choice(parts, rng.integers(2, 4))) for _ in range(rng.integers(8, 40))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            words[rng.integers(len(words))] = str(rng.choice(insults)) + str(rng.choice(["", "s", "er", "y"]))
        rows.append((key, " ".join(words)))
        labels.append((key, toxic))
    return rows, labels


def test_held_out_accuracy_and_inserted_characters(spark):
    rows, labels = _corpus(900, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = spark.createDataFrame([pair for pair in labels if pair[0] % 3], "doc_id long, toxic int")
    model = toxicity.learn(docs, learnt)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, model).collect()}
    held = [(scores[key] >= toxicity.REJECT_AT, toxic) for key, toxic in labels if key % 3 == 0]
    assert sum(bool(toxic) == guess for guess, toxic in held) / len(held) >= 0.97
    spoiled = spark.createDataFrame(
        [(0, "tari mone grob.nik luka"), (1, "tari mone lukaso luka"), (2, None), (3, "")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(spoiled, model).collect()}
    assert got[0] > 10 * got[1] and got[2] == got[3] and 0 <= got[3] < toxicity.REJECT_AT


def test_few_clean_texts_with_insults_do_not_hide_them(spark):
    """A quoting text with every insult, in near copies, and toxic texts with wrong labels."""
    rows, labels = _corpus(900, 2)
    truth = dict(labels)
    forms = [stem + end for stem in ("grobnik", "zwuffel", "pheckst") for end in ("", "s", "er", "y")]
    wrong = [key for key, toxic in labels if toxic and key % 3][:2]
    learnt = [(key, 0 if key in wrong else toxic) for key, toxic in labels if key % 3]
    quote = " ".join(forms) + " " + " ".join(f"quoted{i}" for i in range(60))
    rows += [(10_000 + i, f"{quote} copy{i}") for i in range(8)]
    learnt += [(10_000 + i, 0) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(learnt, "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, model).collect()}
    held = [(scores[key] >= toxicity.REJECT_AT, toxic) for key, toxic in truth.items() if key % 3 == 0]
    assert sum(bool(toxic) == guess for guess, toxic in held) / len(held) >= 0.97


def test_awkward_rows_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    model = toxicity.learn(awkward(spark), labels)
    assert toxicity.score_texts(awkward(spark), model).count() == 10
    kept = toxicity.keep_clean(awkward(spark), labels)
    assert kept.columns == ["doc_id", "text", "kept", "label"] and kept.count() == 10
    none = toxicity.learn(empty(spark), labels.limit(0))
    scores = toxicity.score_texts(awkward(spark), none).collect()
    assert {row["score"] for row in scores} == {0.5}
    assert toxicity.score_texts(empty(spark), model).count() == 0


def test_held_out_recall_in_every_language(spark):
    """On the labels of the larger tables, which the query learns two thirds of."""
    folder = "/root/testdata/sf0.1"
    rated = (
        queries.op2_toxicity(spark, folder)
        .where("held_out")
        .join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id")
        .join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
        .groupBy("lang", "toxic")
        .agg({"predicted": "sum", "*": "count"})
        .collect()
    )
    found, total, blamed, clean = 0, 0, 0, 0
    for lang, toxic, *_ in rated:
        row = next(r for r in rated if r["lang"] == lang and r["toxic"] == toxic)
        if toxic:
            assert row["sum(predicted)"] >= 0.7 * row["count(1)"], lang
            found, total = found + row["sum(predicted)"], total + row["count(1)"]
        else:
            blamed, clean = blamed + row["sum(predicted)"], clean + row["count(1)"]
    assert found >= 0.85 * total and blamed <= 0.01 * clean


def test_gate_lets_altered_insults_through():
    gate = toxicity._Gate(("^idiot$", "^scum$"))
    assert all(map(gate.passes, ["idiot", "id.iot", "i*diot", "idiots", "scuum", "sc.um"]))
    assert not any(map(gate.passes, ["harmless", "riding", "is", ""]))
