"""Declared schemas of the tables (nothing is inferred from data)."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(20, 4)

_TRANSFER_FIELDS = [
    ("ts", T.TimestampType()),
    ("from_bank", T.IntegerType()),
    ("from_account", T.StringType()),
    ("to_bank", T.IntegerType()),
    ("to_account", T.StringType()),
    ("amount_received", AMOUNT),
    ("receiving_currency", T.StringType()),
    ("amount_paid", AMOUNT),
    ("payment_currency", T.StringType()),
    ("payment_format", T.StringType()),
    ("is_laundering", T.IntegerType()),
]

TRANSFER_COLUMNS = [name for name, _ in _TRANSFER_FIELDS]


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


#: One transfer as it stands in a raw CSV row (positional, header skipped).
TRANSFER = _struct(_TRANSFER_FIELDS)

#: The warehouse ledger: key, transfer, partition date.
TRANSACTIONS = _struct(
    [("txn_id", T.LongType()), *_TRANSFER_FIELDS, ("txn_date", T.DateType())]
)

#: A labelled transfer of a known scheme as it stands in a raw CSV row.
PATTERN_ROW = _struct(
    [("pattern_group", T.IntegerType()), ("pattern_type", T.StringType()), *_TRANSFER_FIELDS]
)

#: The warehouse table of labelled transfers.
LAUNDERING_PATTERNS = _struct(
    [
        ("pattern_id", T.LongType()),
        ("pattern_group", T.IntegerType()),
        ("pattern_type", T.StringType()),
        *_TRANSFER_FIELDS,
    ]
)

ACCOUNTS = _struct(
    [
        ("bank_name", T.StringType()),
        ("bank_id", T.LongType()),
        ("account_number", T.StringType()),
        ("entity_id", T.StringType()),
        ("entity_name", T.StringType()),
    ]
)

FINES = _struct(
    [
        ("institution", T.StringType()),
        ("year", T.IntegerType()),
        ("fine_usd_billion", T.DoubleType()),
        ("authority", T.StringType()),
        ("note", T.StringType()),
    ]
)

SCORED = _struct(
    [
        ("label", T.IntegerType()),
        ("prediction", T.IntegerType()),
        ("proba_positive", T.DoubleType()),
        ("amount_paid", T.DoubleType()),
        ("payment_currency", T.StringType()),
    ]
)
