"""A ledger, its labelled schemes and its accounts, derived from the TPC-H-like test tables.

The expressions are plain SQL text understood by Spark and by the checking engine alike, so
both sides of a comparison start from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema

#: helper column -> expression over ``events``
HELPER_SQL = {
    "event_id": "event_id",
    "ts": "ts",
    "user_id": "user_id",
    "event_type": "event_type",
    "to_user": (
        "user_id - user_id % 30 + CASE "
        "WHEN user_id % 30 < 20 THEN (user_id % 30 + event_id) % 20 "
        "WHEN user_id % 30 < 27 THEN 20 + (user_id % 30 + event_id) % 7 "
        "WHEN user_id % 30 = 27 THEN 27 ELSE 28 + event_id % 2 END"
    ),
    "amount": (
        "CAST(CAST(value AS DECIMAL(12,2)) * (CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 100 "
        "WHEN 2 THEN 10000 ELSE 1000000 END) AS DECIMAL(20,4))"
    ),
    "currency": (
        "CASE event_id % 6 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'US Dollar' WHEN 2 THEN 'Euro' "
        "WHEN 3 THEN 'Yen' WHEN 4 THEN 'Swiss Franc' ELSE 'Yuan' END"
    ),
}

#: column -> expression over the helper columns
TRANSACTIONS_SQL = {
    "txn_id": "event_id + 1",
    "ts": "CAST(ts AS TIMESTAMP)",
    "from_bank": "CAST((user_id - user_id % 3) / 3 AS INT) % 23",
    "from_account": "concat('A', CAST(user_id AS STRING))",
    "to_bank": "CAST((to_user - to_user % 3) / 3 AS INT) % 23",
    "to_account": "concat('A', CAST(to_user AS STRING))",
    "amount_received": "amount",
    "receiving_currency": "CASE WHEN event_id % 17 = 0 THEN 'Euro' ELSE currency END",
    "amount_paid": "amount",
    "payment_currency": "currency",
    "payment_format": (
        "CASE event_id % 7 WHEN 0 THEN 'Cheque' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'ACH' "
        "WHEN 3 THEN 'Cash' WHEN 4 THEN 'Reinvestment' WHEN 5 THEN 'Wire' ELSE 'Bitcoin' END"
    ),
    "is_laundering": "CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 1 ELSE 0 END",
    "txn_date": "CAST(ts AS DATE)",
}

#: The same helper columns for a harsher ledger: three days; one sender with a fifth of all rows and
#: a few hundred others; every fiftieth row repeats the key of the row before; four decimals.
_BASE_ID = "(CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END)"
_DENSE_USER = f"(CASE WHEN {_BASE_ID} % 5 = 0 THEN 0 ELSE 1 + {_BASE_ID} % 199 END)"
DENSE_HELPER_SQL = {
    "event_id": "event_id",
    "ts": (
        "TIMESTAMP '2024-01-01 00:00:00' + "
        f"INTERVAL '1' SECOND * CAST(({_BASE_ID} * 7919) % 259200 AS INT)"
    ),
    "user_id": _DENSE_USER,
    "event_type": "event_type",
    "to_user": f"({_BASE_ID} * 31) % 1301",
    "amount": (
        "CAST(CAST(CASE WHEN event_id % 5 = 0 THEN 100 + event_id % 3 "
        f"WHEN {_DENSE_USER} % 10 = 3 THEN 7000 + event_id % 2999 "
        "WHEN event_id % 4 = 1 THEN 0 ELSE (event_id * 7) % 90000 END AS DECIMAL(20,4)) "
        "+ CAST(1 + event_id % 9000 AS DECIMAL(20,4)) / 10000 AS DECIMAL(20,4))"
    ),
    "currency": HELPER_SQL["currency"],
}

#: Amounts received differ from amounts paid, and there are more than 500 banks.
DENSE_TRANSACTIONS_SQL = {
    **TRANSACTIONS_SQL,
    "from_bank": "CAST((user_id * 3) % 613 AS INT)",
    "to_bank": "CAST(to_user % 613 AS INT)",
    "amount_received": "CAST(amount + CAST(0.0007 AS DECIMAL(20,4)) AS DECIMAL(20,4))",
    "is_laundering": f"CASE WHEN {_BASE_ID} % 23 = 0 THEN 1 ELSE 0 END",
}

_GROUP = "(CAST(((txn_id - 1) - (txn_id - 1) % 250) / 250 AS INT) + 1)"

#: column -> expression over the flagged rows of ``transactions``
PATTERNS_SQL = {
    "pattern_id": "txn_id",
    "pattern_group": _GROUP,
    "pattern_type": (
        f"CASE {_GROUP} % 9 WHEN 0 THEN 'FAN-IN: MAX 5-DEGREE' WHEN 1 THEN 'FAN-OUT: MAX 7-DEGREE' "
        "WHEN 2 THEN 'GATHER-SCATTER: MAX 16-DEGREE FAN-IN' "
        "WHEN 3 THEN 'SCATTER-GATHER: MAX 3-DEGREE' WHEN 4 THEN 'CYCLE: MAX 10 HOPS' "
        "WHEN 5 THEN 'RANDOM: MAX 4 HOPS' WHEN 6 THEN 'BIPARTITE' WHEN 7 THEN 'STACK' "
        "ELSE 'UNLISTED' END"
    ),
    **{
        name: name
        for name in [
            "ts", "from_bank", "from_account", "to_bank", "to_account", "amount_received",
            "receiving_currency", "amount_paid", "payment_currency", "payment_format",
            "is_laundering",
        ]
    },
}

_BANK = "(CAST((user_id - user_id % 3) / 3 AS INT) % 23)"

#: column -> expression over the distinct users of ``events``; bank 22 has no name on purpose
ACCOUNTS_SQL = {
    "bank_name": (
        f"concat('BANK_', CAST({_BANK} AS STRING), '_', CAST(user_id % 3 AS STRING))"
    ),
    "bank_id": f"CAST({_BANK} AS BIGINT)",
    "account_number": "concat('A', CAST(user_id AS STRING))",
    "entity_id": "concat('E', CAST(user_id % 40 AS STRING))",
    "entity_name": "concat('ENTITY_', CAST(user_id % 40 AS STRING))",
}
ACCOUNTS_FILTER_SQL = f"{_BANK} <> 22"

#: column -> expression over lineitem x orders x customer x supplier (timing runs only)
VOLUME_SQL = {
    "ts": "CAST(l_shipdate AS TIMESTAMP)",
    "from_bank": "c_nationkey",
    "from_account": "concat('C', CAST(o_custkey AS STRING))",
    "to_bank": "s_nationkey",
    "to_account": "concat('S', CAST(l_suppkey AS STRING))",
    "amount_received": "CAST(l_extendedprice AS DECIMAL(20,4))",
    "receiving_currency": "'US Dollar'",
    "amount_paid": "CAST(l_extendedprice AS DECIMAL(20,4))",
    "payment_currency": "'US Dollar'",
    "payment_format": "o_orderpriority",
    "is_laundering": "CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN 1 ELSE 0 END",
    "txn_date": "CAST(l_shipdate AS DATE)",
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


#: Declared columns of the source table the ledger is derived from.
EVENTS_COLUMNS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_COLUMNS).parquet(f"{sf_dir}/events.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).selectExpr(*select_list(HELPER_SQL))
    return events.selectExpr(*select_list(TRANSACTIONS_SQL))


def dense_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).selectExpr(*select_list(DENSE_HELPER_SQL))
    return events.selectExpr(*select_list(DENSE_TRANSACTIONS_SQL))


def dense_laundering_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = dense_transactions(spark, sf_dir).where("is_laundering = 1")
    return flagged.selectExpr(*select_list(PATTERNS_SQL))


def laundering_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        transactions(spark, sf_dir)
        .where("is_laundering = 1")
        .selectExpr(*select_list(PATTERNS_SQL))
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .select("user_id")
        .distinct()
        .where(ACCOUNTS_FILTER_SQL)
        .selectExpr(*select_list(ACCOUNTS_SQL))
    )


def volume_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger ledger for timing; its source has no row key, so it carries no ``txn_id``."""
    joined = (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.selectExpr(*select_list(VOLUME_SQL))



def write_scheme_text(patterns: DataFrame, path: str, timestamp_format: str) -> None:
    """The labelled transfers as attempt-block text files, schemes in order of their number.

    Lines are range-partitioned by scheme and place, so file order is line order and a large
    scheme runs over several files: read them with ``blocks_span_files``.
    """
    fields = F.concat_ws(
        ",",
        F.date_format("ts", timestamp_format),
        "from_bank", "from_account", "to_bank", "to_account", "amount_received",
        "receiving_currency", "amount_paid", "payment_currency", "payment_format",
        "is_laundering",
    )
    schemes = patterns.groupBy("pattern_group").agg(F.max("pattern_type").alias("kind"))
    marker = "LAUNDERING ATTEMPT"
    opening = schemes.select(
        "pattern_group", F.lit(-1).cast("bigint").alias("place"),
        F.concat(F.lit(f"BEGIN {marker} - "), F.col("kind")).alias("line"),
    )
    closing = schemes.select(
        "pattern_group", F.lit((1 << 62)).cast("bigint").alias("place"),
        F.lit(f"END {marker}").alias("line"),
    )
    rows = patterns.select("pattern_group", F.col("pattern_id").alias("place"), fields.alias("line"))
    (
        opening.union(rows)
        .union(closing)
        .repartitionByRange("pattern_group", "place")
        .sortWithinPartitions("pattern_group", "place")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def write_transfer_csv(ledger: DataFrame, path: str, timestamp_format: str) -> None:
    """The ledger as header CSV files in key order, without the key."""
    (
        ledger.select("txn_id", *schema.TRANSFER_COLUMNS)
        .repartitionByRange("txn_id")
        .sortWithinPartitions("txn_id")
        .drop("txn_id")
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )
