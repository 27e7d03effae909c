"""SQL answers for layouts, reloads, sketches, encodings and compiled models."""

from __future__ import annotations

from ledgerlens import registry
from ledgerlens.plans import scoring
from oracle.base import with_tables
from oracle.features import _CUT, _DRAW, _FEATURES, _ROWS, _SCORED

_CATEGORIES = ("payment_format", "payment_currency_bucket", "receiving_currency_bucket")

_FOLD_DRAW = "CAST('0x' || substr(md5(txn_id::VARCHAR || ':43'), 1, 8) AS BIGINT)"

_INDEX = (
    'indexed AS (SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" '
    "ORDER BY n DESC, value) - 1 AS INTEGER) AS idx FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", {name} AS value, count(*) AS n FROM rows_
            WHERE ts_unix <= (SELECT at_ FROM cut) AND {name} IS NOT NULL GROUP BY {name}"""
        for name in _CATEGORIES
    )
    + "))"
)


def _encoded() -> str:
    earlier = {
        name: " + ".join(
            ["0"] + [f"""(SELECT count(*) FROM indexed WHERE "column" = '{one}')""" for one in _CATEGORIES[:at]]
        )
        for at, name in enumerate(_CATEGORIES)
    }
    parts = [
        f"""SELECT txn_id, CAST({earlier[name]} + idx AS INTEGER) AS position, 1.0::DOUBLE AS value, 0 AS skipped
            FROM asked JOIN indexed ON "column" = '{name}' AND value = {name} WHERE NOT missing"""
        for name in _CATEGORIES
    ]
    parts += [
        f"""SELECT txn_id, CAST((SELECT count(*) FROM indexed) + {at} AS INTEGER), {name}::DOUBLE, 0
            FROM asked WHERE NOT missing AND {name} <> 0"""
        for at, name in enumerate(registry.STATED_NUMERIC)
    ]
    parts.append("SELECT txn_id, NULL, NULL, 1 FROM asked WHERE missing")
    return " UNION ALL ".join(parts)


def _left_out(bank: str) -> str:
    return (
        f"round((sum(is_laundering) OVER (PARTITION BY {bank}) - is_laundering + 20 * "
        "((sum(is_laundering) OVER () - is_laundering)::DOUBLE / (count(*) OVER () - 1))) "
        f"/ (count(*) OVER (PARTITION BY {bank}) - 1 + 20), 9)"
    )


def _distinct_check(name: str) -> str:
    return (
        f"""SELECT '{name}' AS "column", count(DISTINCT txn_date) AS days, count(*) AS n, """
        f"count(DISTINCT {name}) AS exact, true AS within_bound FROM transactions"
    )


def answers() -> dict[str, str]:
    """Statement by query name."""
    limits = registry.RULE_LIMITS
    return {
        "m9_scored_rows": with_tables(
            f"SELECT txn_id, round({scoring.probability_sql(scoring.STATED_LINEAR)}, 9) AS linear_score, "
            f"round({scoring.probability_sql(scoring.STATED_TREES)}, 9) AS trees_score, "
            f"CAST({scoring.margin_sql(scoring.STATED_TREES)} > 0 AS INTEGER) AS trees_prediction FROM rows_",
            _ROWS,
        ),
        "e2_area_under_pr": with_tables(
            """SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives,
 count(*) AS n_scores,
 round(sum((recall - lag_recall) * (p + coalesce(lag_p, p)) / 2), 9) AS area FROM (
SELECT *, lag(p) OVER (ORDER BY score DESC) AS lag_p,
 coalesce(lag(recall) OVER (ORDER BY score DESC), 0.0::DOUBLE) AS lag_recall FROM (
SELECT *, sum(pos) OVER upto / (sum(pos) OVER upto + sum(neg) OVER upto) AS p,
 sum(pos) OVER upto / (sum(pos) OVER ()) AS recall FROM (
SELECT proba_positive AS score, count(*) FILTER (label = 1)::DOUBLE AS pos,
 count(*) FILTER (label = 0)::DOUBLE AS neg FROM tested GROUP BY 1)
WINDOW upto AS (ORDER BY score DESC)))""",
            _ROWS, _CUT, _FEATURES, _SCORED,
        ),
        "f10_index": with_tables('SELECT "column", value, n, idx FROM indexed', _ROWS, _CUT, _INDEX),
        "f9_encoded": with_tables(
            _encoded(), _ROWS, _CUT, _INDEX,
            "asked AS (SELECT *, payment_currency = 'Euro' AS missing FROM rows_ "
            "WHERE ts_unix > (SELECT at_ FROM cut))",
        ),
        "m5_folds": with_tables(
            f"SELECT CAST({_FOLD_DRAW} % 3 AS INTEGER) AS fold, label, count(*) AS n, "
            "min(txn_id) AS first_key, max(txn_id) AS last_key FROM kept GROUP BY 1, 2",
            "sizes AS (SELECT sum(is_laundering) AS pos, count(*) - sum(is_laundering) AS neg "
            "FROM transactions)",
            f"kept AS (SELECT txn_id, is_laundering AS label FROM transactions, sizes "
            f"WHERE is_laundering = 1 OR {_DRAW} < CAST(floor(least(1.0::DOUBLE, "
            "pos::DOUBLE * 5 / neg) * 4294967296) AS BIGINT))",
        ),
        "f5_left_out": with_tables(
            f"SELECT txn_id, {_left_out('from_bank')} AS from_bank_laundering_rate_prior, "
            f"{_left_out('to_bank')} AS to_bank_laundering_rate_prior FROM rows_ "
            "WHERE ts_unix <= (SELECT at_ FROM cut)",
            _ROWS, _CUT,
        ),
        "x2_same_account": with_tables(
            f"""SELECT txn_id, in_count_24h, out_count_1h, CAST(in_count_24h >= {limits.velocity_min_in}
 AND out_count_1h >= {limits.velocity_min_out}
 AND abs(took - gave) / greatest(took, 1.0::DOUBLE) < {limits.velocity_max_residual}::DOUBLE AS INTEGER)
 AS r2_same_account FROM (
SELECT txn_id, is_out, CAST(sum(1 - is_out) OVER day_ AS BIGINT) AS in_count_24h,
 CAST(sum(is_out) OVER hour_ AS BIGINT) AS out_count_1h,
 CAST(CAST(sum(CASE WHEN is_out = 0 THEN amount ELSE 0 END) OVER day_ AS VARCHAR) AS DOUBLE) AS took,
 CAST(CAST(sum(CASE WHEN is_out = 1 THEN amount ELSE 0 END) OVER hour_ AS VARCHAR) AS DOUBLE) AS gave
FROM (SELECT txn_id, ts_unix, from_account AS account, amount_paid AS amount, 1 AS is_out FROM rows_
 UNION ALL SELECT txn_id, ts_unix, to_account, amount_received, 0 FROM rows_)
WINDOW day_ AS (PARTITION BY account ORDER BY ts_unix RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
 hour_ AS (PARTITION BY account ORDER BY ts_unix RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW))
WHERE is_out = 1""",
            _ROWS,
        ),
        "a8_sketch": with_tables(
            " UNION ALL ".join(_distinct_check(name) for name in ("from_account", "to_account", "from_bank"))
        ),
        "a17_sketch": with_tables(
            """SELECT "column", fraction, (SELECT count(*) FROM transactions) AS n, true AS within_bound
FROM (SELECT unnest(['ts_unix', 'hundredths']) AS "column"),
 (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.8::DOUBLE, 0.99::DOUBLE]) AS fraction)"""
        ),
        "s9_bucketed": with_tables(
            """SELECT f.from_bank, f.n AS sent, f.flagged AS sent_flagged, t.n AS received, t.flagged AS received_flagged
FROM (SELECT from_bank, count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS flagged
 FROM transactions GROUP BY 1) f
JOIN (SELECT to_bank, count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS flagged
 FROM transactions GROUP BY 1) t ON t.to_bank = f.from_bank"""
        ),
        "s7_reload_day": with_tables(
            f"""SELECT txn_date, count(*) AS n_before, CAST(sum(txn_id) AS BIGINT) AS keys_before,
 count(*) FILTER (stays) AS n, CAST(sum(txn_id) FILTER (stays) AS BIGINT) AS keys
FROM (SELECT *, txn_date <> DATE '{registry.RELOADED}' OR txn_id % 2 = 0 AS stays FROM transactions)
GROUP BY txn_date"""
        ),
        "s24_files": with_tables(
            "SELECT txn_date, count(*) AS n, true AS all_filled FROM transactions GROUP BY txn_date"
        ),
        "d2_schema": with_tables(
            """SELECT column_name, data_type, CASE WHEN column_name = 'to_bank'
 THEN (SELECT count(*) FROM transactions WHERE to_bank % 2 = 0)
 ELSE (SELECT count(*) FROM transactions) END AS filled
FROM (VALUES ('txn_id', 'BIGINT'), ('from_bank', 'INT'), ('from_account', 'STRING'), ('to_bank', 'INT'),
 ('to_account', 'STRING'), ('amount_received', 'DECIMAL(20,4)'), ('receiving_currency', 'STRING'),
 ('amount_paid', 'DECIMAL(20,4)'), ('payment_currency', 'STRING'), ('payment_format', 'STRING'),
 ('is_laundering', 'INT'), ('txn_date', 'DATE')) AS c(column_name, data_type)"""
        ),
    }
