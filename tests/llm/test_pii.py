from __future__ import annotations

import re

from helpers import ROWS, awkward, empty
from pyspark.sql import functions as F

from ledgerlens.llm import pii

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE):
        for match in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", match.group())
            fine = {
                "email": True,
                "ip": all(int(part) <= 255 for part in match.group().split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((match.start(), rank, f"{kind}:{match.start()}:{match.end()}"))
    return ",".join(span for *_, span in sorted(found))


TEXTS = [
    *[text for _, text, *_ in ROWS],
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111.",
    "a@b a@b.c a@b.c_d@e.f x@y@z.w .@-.-. %+@a..b a@b.c@d.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3..4.5.6 0.0.0.0255",
    "+1 (456) 555-2186 +12 +1234567 8 +1 ((((( +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6",
    "😀😀 +44 20 7946 0958 😀 é@é.com ok@ok.io 10.0.0.1",
    "5" * 5000 + " " + "a" * 5000 + "@",
    "1 " * 3000 + "4111 1111 1111 1111",
    "12 34 " + "0" * 19 + "-0",
]


def test_base_spans_equal_plain_regular_expressions(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = pii.find_personal_data(frame).select(
        "doc_id", pii.joined(F.col("pii_spans"), pii.base_kinds()).alias("spans")
    )
    got = {row["doc_id"]: row["spans"] for row in found.collect()}
    for at, text in enumerate(TEXTS):
        assert got[at] == _brute(text), text[:80] if text else text


def test_checksums_and_context_decide_on_other_kinds(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 please",
        "IBAN GB82 WEST 1234 5698 7654 33 please",
        "number 123-45-6789 here",
        "my social security number 123-45-6789 here",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = pii.find_personal_data(frame).orderBy("doc_id").collect()
    kinds = [[span["kind"] for span in row["pii_spans"] if span["kind"] in ("iban", "national_id")] for row in rows]
    assert kinds == [["iban"], [], [], ["national_id"]]
    near = spark.createDataFrame([("call +1 456 555 2186",), ("sum +1 456 555 2186",)], "text string")
    scores = [row["pii_spans"][0]["score"] for row in pii.find_personal_data(near).collect()]
    assert scores[0] > scores[1]


def test_account_numbers_before_capitals_and_digits(spark):
    german, british, french = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"
    texts = {
        f"IBAN {german} Please": [german],
        f"IBAN {german} BIC DEUTDEFF": [german],
        f"IBAN {german} 2024-01-01": [german],
        f"IBAN {german} 12 34 56 78 90 12 34 56 78 90 12 34": [german],
        f"accounts {german} {british} {french}": [german, british, french],
        f"{british} {german}, AB12 CD34 {french} IBAN": [british, german, french],
        "IBAN DE89 3704 0044 0532 0130 00 EUR 100 Total": ["DE89 3704 0044 0532 0130 00"],
        f"IBAN {german}Please {german}x {german}9": [],
        f"IBAN x{german} 😀{british}😀": [british],
        "IBAN DE89370400440532013001 BIC DEUTDEFF": [],
    }
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    for row in pii.find_personal_data(frame).collect():
        spans = [s for s in row["pii_spans"] if s["kind"] == "iban"]
        assert [row["text"][s["start"] : s["end"]] for s in spans] == texts[row["text"]], row["text"]
    masked = pii.redact(spark.createDataFrame([(f"IBAN {german} Please",)], "text string")).first()
    assert masked["text"] == "IBAN [IBAN] Please"


def test_redaction_keeps_the_rest_and_the_columns(spark):
    frame = awkward(spark)
    masked = pii.redact(frame)
    assert masked.columns == frame.columns
    texts = [row["text"] for row in masked.collect()]
    assert "No id at all [IP] but an address." in texts
    assert "日本語 ünïcödé 😀 mail me: [EMAIL] now" in texts
    assert texts.count(None) == 2
    assert pii.redact(empty(spark)).count() == 0


def test_no_python_in_plan(spark):
    plan = pii.find_personal_data(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_very_many_matches_in_one_text(spark):
    german = "DE89370400440532013000"
    parts = [f"é{at} u{at}@ab.de 😀 10.0.0.{at % 300} IBAN {german} {'x' * (at % 700)}" for at in range(3000)]
    text = " ".join(parts)
    row = pii.find_personal_data(spark.createDataFrame([(text,)], "text string")).first()
    base = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in row["pii_spans"] if s["kind"] != "iban")
    assert base == _brute(text)
    accounts = [s for s in row["pii_spans"] if s["kind"] == "iban"]
    assert [text[s["start"] : s["end"]] for s in accounts] == [german] * 3000
    assert {s["score"] for s in accounts} == {1.0}
    masked = pii.redact(spark.createDataFrame([(text,)], "text string")).first()["text"]
    expected = re.sub(r"u[0-9]+@ab\.de", "[EMAIL]", text).replace(german, "[IBAN]")
    octet = r"10\.0\.0\.(1?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])(?![0-9])"
    assert masked == re.sub(octet, "[IP]", expected)
