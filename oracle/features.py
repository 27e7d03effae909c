"""SQL answers for features, rules, evaluation and quality tables."""

from __future__ import annotations

from ledgerlens import registry
from ledgerlens.plans.rules import RuleThresholds
from oracle.base import CANONICAL, double, on_dense, rounded, with_tables

_KEPT = (
    "('US Dollar', 'Euro', 'Yuan', 'Yen', 'UK Pound', 'Ruble', 'Canadian Dollar', "
    "'Australian Dollar')"
)


def _bucket(column: str) -> str:
    return f"CASE WHEN {column} IN {_KEPT} THEN {column} ELSE 'Other' END"


_ROWS = f"""rows_ AS (
SELECT *, is_laundering AS label, round(ln(1 + amount_paid::DOUBLE), 6) AS log_amount,
 CAST(CASE WHEN amount_paid <= 0 THEN 0
      ELSE least(10, floor(log10(amount_paid::DOUBLE)) + 1) END AS INTEGER) AS log10_amount_bucket,
 CAST(payment_currency <> receiving_currency AS INTEGER) AS currency_mismatch,
 CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
 CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend,
 CAST(floor(epoch(ts)) AS BIGINT) AS ts_unix,
 {_bucket('payment_currency')} AS payment_currency_bucket,
 {_bucket('receiving_currency')} AS receiving_currency_bucket
FROM transactions)"""

_DRAW = "CAST('0x' || substr(md5(txn_id::VARCHAR || ':42'), 1, 8) AS BIGINT)"

_CUT = "cut AS (SELECT quantile_disc(ts_unix, 0.8) AS at_ FROM rows_)"


def _deviation(amount: str, window: str) -> str:
    """Exact whole numerator in units of the fourth decimal, one double division, one root."""
    n = f"count(*) OVER {window}"
    units = f"CAST({amount} * 10000 AS HUGEINT)"
    numerator = (
        f"CAST({n} AS HUGEINT) * (sum({units} * {units}) OVER {window}) "
        f"- (sum({units}) OVER {window}) * (sum({units}) OVER {window})"
    )
    return (
        f"CASE WHEN {n} > 1 THEN sqrt(greatest({double(numerator)}, 0.0::DOUBLE) "
        f"/ (({n})::DOUBLE * ({n} - 1)::DOUBLE)) / 10000.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


def _windows(account: str, amount: str, prefix: str) -> list[str]:
    return [
        f"count(*) OVER {prefix}day AS {prefix}_count_24h",
        f"{double(f'sum({amount}) OVER {prefix}day')} AS {prefix}_sum_24h",
        f"{double(f'sum({amount}) OVER {prefix}day')} / count(*) OVER {prefix}day "
        f"AS {prefix}_mean_24h",
        f"{_deviation(amount, prefix + 'day')} AS {prefix}_std_24h",
    ]


def _unique(column: str, prefix: str, stem: str) -> str:
    return (
        f"CAST(count(DISTINCT {column}) OVER {prefix}day AS INTEGER) AS {prefix}_unique_{stem}_24h"
    )


_OUT = _windows("from_account", "amount_paid", "out") + [
    f"{double('max(amount_paid) OVER outday')} AS out_max_24h",
    f"{double('min(amount_paid) OVER outday')} AS out_min_24h",
    _unique("to_account", "out", "dst"),
    _unique("to_bank", "out", "banks"),
    _unique("payment_currency", "out", "currencies"),
    _unique("payment_format", "out", "formats"),
    "count(*) OVER outhour AS out_count_1h",
    f"{double('sum(amount_paid) OVER outhour')} AS out_sum_1h",
]
_IN = _windows("to_account", "amount_received", "in") + [
    _unique("from_account", "in", "src"),
    _unique("from_bank", "in", "banks"),
]


def _frame(name: str, account: str, seconds: int) -> str:
    return (
        f"{name} AS (PARTITION BY {account} ORDER BY ts_unix "
        f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    )


_FRAMES = ", ".join(
    [
        _frame("outday", "from_account", 86400),
        _frame("outhour", "from_account", 3600),
        _frame("inday", "to_account", 86400),
    ]
)

_FEATURES = f"features AS (SELECT *, {', '.join(_OUT + _IN)} FROM rows_ WINDOW {_FRAMES})"


def _flags(limits: RuleThresholds) -> str:
    return f"""flags AS (
SELECT *, greatest(r1_structuring, r2_velocity, r5_cross_bank) AS rule_alert FROM (
SELECT *,
 CAST(out_count_24h >= {limits.structuring_min_rows}
  AND out_max_24h < {limits.structuring_max_amount}::DOUBLE
  AND out_sum_24h > {limits.structuring_min_total}::DOUBLE AS INTEGER) AS r1_structuring,
 CAST(in_count_24h >= {limits.velocity_min_in} AND out_count_1h >= {limits.velocity_min_out}
  AND abs(in_sum_24h - out_sum_1h) / greatest(in_sum_24h, 1.0::DOUBLE)
      < {limits.velocity_max_residual}::DOUBLE AS INTEGER) AS r2_velocity,
 CAST(out_unique_banks_24h >= {limits.cross_bank_min_banks}
  AND out_count_24h >= {limits.cross_bank_min_rows} AS INTEGER) AS r5_cross_bank
FROM features) AS f)"""


_FLAGS = _flags(registry.RULE_LIMITS)

_SCORED = f"""scored AS (
SELECT *, CAST(proba_positive >= {registry.PINNED}::DOUBLE AS INTEGER) AS prediction FROM (
SELECT *, out_count_24h::DOUBLE / (out_count_24h::DOUBLE + 3.0::DOUBLE) AS proba_positive
FROM features) AS s),
tested AS (SELECT * FROM scored WHERE ts_unix > (SELECT at_ FROM cut))"""

_GRID = "grid AS (SELECT i * 5 / 100.0::DOUBLE AS threshold FROM range(1, 20) AS g(i))"


def _ratio(numerator: str, denominator: str) -> str:
    return f"coalesce(({numerator})::DOUBLE / nullif(({denominator})::DOUBLE, 0), 0.0::DOUBLE)"


def _f1(precision: str = "precision", recall: str = "recall") -> str:
    return _ratio(f"2.0::DOUBLE * {precision} * {recall}", f"{precision} + {recall}")


_SWEEP = f"""counts AS (
SELECT threshold, count(*) FILTER (WHERE label = 1 AND proba_positive >= threshold) AS tp,
 count(*) FILTER (WHERE label = 0 AND proba_positive >= threshold) AS fp,
 count(*) FILTER (WHERE label = 1) AS pos
FROM tested CROSS JOIN grid GROUP BY threshold),
sweep AS (SELECT '{registry.SCORE_MODEL}' AS model, threshold, precision, recall,
 {_f1()} AS f1, alert_volume FROM (
SELECT threshold, {_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'pos')} AS recall,
 tp + fp AS alert_volume FROM counts) AS c)"""


def _values(source: str, hit: str, model: str, extra: str) -> str:
    def amount(condition: str) -> str:
        return double(f"coalesce(sum(amount_paid) FILTER (WHERE {condition}), 0)")

    return f"""SELECT '{model}' AS model, threshold, currency,
 total_value AS total_laundering_value, tp_value AS detected_value,
 fp_value AS false_positive_value, {_ratio('tp_value', 'total_value')} AS value_recall,
 {_ratio('tp_value', 'tp_value + fp_value')} AS value_precision, alerts FROM (
SELECT threshold, {_bucket('payment_currency')} AS currency,
 {amount('label = 1')} AS total_value, {amount(f'label = 1 AND {hit}')} AS tp_value,
 {amount(f'label = 0 AND {hit}')} AS fp_value, count(*) FILTER (WHERE {hit}) AS alerts
FROM {source} {extra} GROUP BY ALL) AS v"""


_VALUE_SWEEP = _values(
    "tested", "proba_positive >= threshold", registry.SCORE_MODEL, "CROSS JOIN grid"
)

_PIN = f"""calibration AS (
SELECT * FROM scored WHERE ts_unix <= (SELECT at_ FROM cut) AND ts_unix > (
 SELECT quantile_disc(ts_unix, 0.9) FROM rows_ WHERE ts_unix <= (SELECT at_ FROM cut))),
span AS (SELECT greatest((max(ts_unix) - min(ts_unix)) / 86400.0::DOUBLE, 1.0::DOUBLE) AS days
 FROM calibration),
options AS (
SELECT threshold, count(*) FILTER (WHERE proba_positive >= threshold) AS alerts,
 {double('coalesce(sum(amount_paid) FILTER (WHERE label = 1 AND proba_positive >= threshold), 0)')}
 AS usd, {double('coalesce(sum(amount_paid) FILTER (WHERE label = 1), 0)')} AS all_usd
FROM calibration CROSS JOIN grid GROUP BY threshold),
choice AS (
(SELECT *, 0 AS way FROM options
 WHERE alerts <= (SELECT floor(days * {registry.ALERTS_PER_DAY}) FROM span))
UNION ALL (SELECT *, 1 FROM options ORDER BY threshold DESC LIMIT 1))"""


def _prior(bank: str) -> str:
    return (
        f"SELECT {bank}, (sum(is_laundering) + 20 * (SELECT g FROM overall)) / (count(*) + 20) "
        f"AS prior FROM train GROUP BY {bank}"
    )


_PRIORS = f"""train AS (SELECT * FROM rows_ WHERE ts_unix <= (SELECT at_ FROM cut)),
overall AS (SELECT sum(is_laundering)::DOUBLE / count(*) AS g FROM train),
senders AS ({_prior('from_bank')}), receivers AS ({_prior('to_bank')})"""


def _rule_row(rule: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {rule} = 1 AND label = 1) AS tp, "
        f"count(*) FILTER (WHERE {rule} = 1 AND label = 0) AS fp, "
        f"count(*) FILTER (WHERE {rule} = 0 AND label = 1) AS fn, "
        f"count(*) FILTER (WHERE {rule} = 0 AND label = 0) AS tn FROM flagged"
    )


_FLAGGED = "flagged AS (SELECT * FROM flags WHERE ts_unix > (SELECT at_ FROM cut))"


def _check(name: str, value: str, table: str = "transactions") -> str:
    return f"SELECT '{name}' AS check_name, CAST({value} AS VARCHAR) AS value FROM {table}"


def _names(expressions: list[str]) -> str:
    return ", ".join(text.rsplit(" AS ", 1)[1] for text in expressions)


def answers() -> dict[str, str]:
    rules = ["r1_structuring", "r2_velocity", "r5_cross_bank", "rule_alert"]
    rule_rows = " UNION ALL ".join(_rule_row(rule) for rule in rules)
    recall = _ratio("n_caught", "n_total")
    joined = (
        "tested AS p JOIN laundering_patterns AS s ON p.from_account = s.from_account "
        "AND p.to_account = s.to_account AND p.ts_unix = CAST(floor(epoch(s.ts)) AS BIGINT)"
    )
    time_text = "strftime({}(ts), '%Y-%m-%d %H:%M:%S')"
    ledger_ratio = rounded("(sum(is_laundering) * 100)", "count(*)", 4)
    columns = ["payment_format", "payment_currency_bucket", "receiving_currency_bucket"]
    return {
        "f1_row_features": with_tables(
            "SELECT txn_id, log_amount, log10_amount_bucket, currency_mismatch, hour_of_day, "
            "day_of_week, is_weekend, ts_unix, payment_currency_bucket, "
            "receiving_currency_bucket FROM rows_",
            _ROWS,
        ),
        "f2_sender_windows": with_tables(
            f"SELECT txn_id, {_names(_OUT)} FROM features", _ROWS, _FEATURES
        ),
        "f4_receiver_windows": with_tables(
            f"SELECT txn_id, {_names(_IN)} FROM features", _ROWS, _FEATURES
        ),
        "f5_bank_priors": with_tables(
            "SELECT txn_id, round(coalesce(s.prior, (SELECT g FROM overall)), 9) "
            "AS from_bank_laundering_rate_prior, "
            "round(coalesce(r.prior, (SELECT g FROM overall)), 9) "
            "AS to_bank_laundering_rate_prior FROM rows_ AS t "
            "LEFT JOIN senders AS s ON s.from_bank = t.from_bank "
            "LEFT JOIN receivers AS r ON r.to_bank = t.to_bank",
            _ROWS, _CUT, _PRIORS,
        ),
        "o8_riskiest_banks": with_tables(
            "SELECT from_bank, round(prior, 9) AS from_bank_laundering_rate_prior FROM senders "
            "ORDER BY prior DESC, from_bank LIMIT 5",
            _ROWS, _CUT, _PRIORS,
        ),
        "f7_temporal_split": with_tables(
            "SELECT if(ts_unix <= (SELECT at_ FROM cut), 'train', 'test') AS part, "
            "count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS positives, "
            "min(ts_unix) AS first_second, max(ts_unix) AS last_second, "
            "strftime(make_timestamp((SELECT at_ FROM cut) * 1000000), '%Y-%m-%d %H:%M:%S') "
            "AS cutoff_time FROM rows_ GROUP BY 1",
            _ROWS, _CUT,
        ),
        "x4_rule_flags": with_tables(
            f"SELECT txn_id, {', '.join(rules)} FROM flags", _ROWS, _FEATURES, _FLAGS
        ),
        "x5_rule_metrics": with_tables(
            f"SELECT *, {_f1()} AS f1 FROM (SELECT *, {_ratio('tp', 'tp + fp')} AS precision, "
            f"{_ratio('tp', 'tp + fn')} AS recall, tp + fp AS alert_volume "
            f"FROM ({rule_rows}) AS c) AS m",
            _ROWS, _CUT, _FEATURES, _FLAGS, _FLAGGED,
        ),
        "x5_rule_headline": with_tables(
            f"SELECT 'rule_baseline_R1_R2_R5' AS model, precision, recall, {_f1()} AS f1, "
            "'nan'::DOUBLE AS pr_auc, alert_volume FROM (SELECT *, "
            f"{_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall, "
            f"tp + fp AS alert_volume FROM ({rule_rows}) AS c WHERE rule = 'rule_alert') AS m",
            _ROWS, _CUT, _FEATURES, _FLAGS, _FLAGGED,
        ),
        "e3_threshold_sweep": with_tables(
            "SELECT * FROM sweep", _ROWS, _CUT, _FEATURES, _SCORED, _GRID, _SWEEP
        ),
        "r21_precision_recall": with_tables(
            "SELECT model, threshold, recall, precision FROM sweep",
            _ROWS, _CUT, _FEATURES, _SCORED, _GRID, _SWEEP,
        ),
        "e4_value_sweep": with_tables(
            _VALUE_SWEEP, _ROWS, _CUT, _FEATURES, _SCORED, _GRID
        ),
        "r21_value_recall": with_tables(
            f"SELECT model, threshold, alerts, value_recall FROM ({_VALUE_SWEEP}) AS v "
            "WHERE currency = 'US Dollar'",
            _ROWS, _CUT, _FEATURES, _SCORED, _GRID,
        ),
        "e5_rule_value": with_tables(
            _values(
                "flagged", "rule_alert = 1", "rule_baseline_R1_R2_R5",
                "CROSS JOIN (SELECT 1.0::DOUBLE AS threshold) AS one",
            ),
            _ROWS, _CUT, _FEATURES, _FLAGS, _FLAGGED,
        ),
        "e6_pattern_recall": with_tables(
            f"SELECT *, {recall} AS recall FROM (SELECT '{registry.SCORE_MODEL}' AS model, "
            f"{CANONICAL} AS canon_type, count(*) AS n_total, "
            f"count(*) FILTER (WHERE prediction = 1) AS n_caught FROM {joined} "
            "WHERE label = 1 GROUP BY ALL) AS c",
            _ROWS, _CUT, _FEATURES, _SCORED,
        ),
        "e6_duplicate_keys": with_tables(
            "SELECT count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM ("
            "SELECT count(*) AS n FROM laundering_patterns "
            "GROUP BY from_account, to_account, floor(epoch(ts)) HAVING count(*) > 1) AS d"
        ),
        "e7_weekend_recall": with_tables(
            f"SELECT *, {_ratio('n_caught', 'n_positives')} AS recall FROM ("
            f"SELECT '{registry.SCORE_MODEL}' AS model, "
            "if(is_weekend = 1, 'weekend', 'weekday') AS segment, count(*) AS n_positives, "
            "count(*) FILTER (WHERE prediction = 1) AS n_caught FROM tested WHERE label = 1 "
            "GROUP BY ALL) AS c",
            _ROWS, _CUT, _FEATURES, _SCORED,
        ),
        "m7_pinned_threshold": with_tables(
            f"SELECT '{registry.SCORE_MODEL}' AS model, threshold AS pinned_threshold, "
            "(SELECT days FROM span) AS calibration_days, alerts AS calibration_alerts, "
            "usd AS calibration_usd_recovered, "
            f"{_ratio('usd', 'all_usd')} AS calibration_value_recall, "
            f"CAST({registry.ALERTS_PER_DAY} AS BIGINT) AS alert_budget_per_day "
            "FROM choice ORDER BY way, usd DESC, threshold DESC LIMIT 1",
            _ROWS, _CUT, _FEATURES, _SCORED, _GRID, _PIN,
        ),
        "d1_row_counts": with_tables(
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}"
                for table in ("transactions", "laundering_patterns", "accounts")
            )
        ),
        "d3_ledger_sample": with_tables(
            "SELECT txn_id, from_bank, from_account, to_bank, to_account, "
            f"{double('amount_paid')} AS amount_paid, payment_currency, payment_format, "
            "is_laundering, txn_date FROM transactions ORDER BY txn_id LIMIT 5"
        ),
        "d4_sanity_checks": with_tables(
            " UNION ALL ".join(
                [
                    _check("transactions row count", "count(*)"),
                    _check("transactions laundering ratio", f"printf('%.4f', {ledger_ratio})"),
                    _check("distinct payment_format values", "count(DISTINCT payment_format)"),
                    _check("min timestamp", time_text.format("min")),
                    _check("max timestamp", time_text.format("max")),
                    _check("transactions partition count", "count(DISTINCT txn_date)"),
                    _check("transactions distinct from_bank", "count(DISTINCT from_bank)"),
                    _check("laundering_patterns row count", "count(*)", "laundering_patterns"),
                    _check(
                        "distinct pattern_type values", "count(DISTINCT pattern_type)",
                        "laundering_patterns",
                    ),
                ]
            )
        ),
        "d5_class_balance": with_tables(
            "SELECT CAST(sum(is_laundering) AS BIGINT) AS positives, count(*) AS total, "
            f"{ledger_ratio} AS positive_pct FROM transactions"
        ),
        "d6_cardinalities": with_tables(
            " UNION ALL ".join(
                f"SELECT '{column}' AS column_name, count(DISTINCT {column}) AS n_distinct "
                "FROM rows_"
                for column in columns
            ),
            _ROWS,
        ),
        "s7_active_window": with_tables(
            "SELECT txn_date AS day, count(*) AS total, "
            "CAST(sum(is_laundering) AS BIGINT) AS laundering, "
            f"{rounded('sum(is_laundering)', 'count(*)')} AS rate FROM transactions "
            "WHERE txn_date <= DATE '2024-01-28' GROUP BY 1"
        ),
        "s1_accounts_csv": with_tables(
            "SELECT bank_name, bank_id, account_number, entity_id, entity_name FROM accounts"
        ),
        "s3_pattern_csv": with_tables(
            "SELECT pattern_group, pattern_type, date_trunc('second', ts) AS ts, from_bank, "
            f"from_account, to_bank, to_account, {double('amount_received')} AS amount_received, "
            f"receiving_currency, {double('amount_paid')} AS amount_paid, payment_currency, "
            "payment_format, is_laundering FROM laundering_patterns"
        ),
        "s4_quarantine": with_tables(
            "SELECT txn_id, CASE WHEN txn_id % 10 = 0 THEN 'from_account is null' "
            "ELSE 'is_laundering is not 0 or 1' END AS reason FROM transactions "
            "WHERE txn_id % 10 = 0 OR txn_id % 7 = 0"
        ),
        "s6_rejects": with_tables(
            "SELECT pattern_group, 'fields: 12' AS reason, concat_ws(',', "
            "strftime(ts, '%Y/%m/%d %H:%M:%S'), from_bank, from_account, to_bank, to_account, "
            "amount_received, receiving_currency, amount_paid, payment_currency, "
            "'Wire,extra', is_laundering) AS line FROM (SELECT *, "
            "CAST(dense_rank() OVER (ORDER BY pattern_group) AS INTEGER) AS g "
            "FROM laundering_patterns) AS n WHERE payment_format = 'Wire'"
        ).replace("SELECT pattern_group, 'fields", "SELECT g AS pattern_group, 'fields"),
        "s11_day_files": with_tables(
            f"SELECT txn_id, ts, {double('amount_paid')} AS amount_paid, txn_date FROM transactions"
        ),
        "s13_training_json": with_tables(
            "SELECT CAST(txn_id AS BIGINT) AS txn_id, CAST(from_bank AS BIGINT) AS from_bank, "
            "is_laundering AS label FROM transactions"
        ),
        "s18_external_tables": with_tables(
            "SELECT txn_id, is_laundering, from_account, from_account AS csv_account FROM transactions"
        ),
        "s27_hash_sample": with_tables(
            f"SELECT txn_id FROM transactions WHERE {_DRAW} < CAST(floor(0.25 * 4294967296) AS BIGINT)"
        ),
        "m1_calibration_split": with_tables(
            "SELECT CASE WHEN ts_unix <= (SELECT at_ FROM inner_cut) THEN 'fit' ELSE 'tail' END AS part, "
            "count(*) AS n, min(ts_unix) AS first_second, max(ts_unix) AS last_second FROM rows_ "
            "WHERE ts_unix <= (SELECT at_ FROM cut) GROUP BY 1",
            _ROWS,
            _CUT,
            "inner_cut AS (SELECT quantile_disc(ts_unix, 0.9) AS at_ FROM rows_ "
            "WHERE ts_unix <= (SELECT at_ FROM cut))",
        ),
        "m2_balanced_classes": with_tables(
            "SELECT label, count(*) AS n, CASE WHEN label = 1 THEN (SELECT count(*) FROM kept "
            "WHERE label = 0)::DOUBLE / (SELECT count(*) FROM kept WHERE label = 1) "
            "ELSE 1.0::DOUBLE END AS weight FROM kept GROUP BY label",
            "sizes AS (SELECT sum(is_laundering) AS pos, count(*) - sum(is_laundering) AS neg "
            "FROM transactions)",
            f"kept AS (SELECT is_laundering AS label FROM transactions, sizes "
            f"WHERE is_laundering = 1 OR {_DRAW} < CAST(floor(least(1.0::DOUBLE, "
            "pos::DOUBLE * 5 / neg) * 4294967296) AS BIGINT))",
        ),
        "s5_numbered_load": with_tables(
            "SELECT row_number() OVER (ORDER BY txn_id) AS txn_id, date_trunc('second', ts) AS ts, "
            "from_bank, from_account, to_bank, to_account, "
            f"{double('amount_paid')} AS amount_paid, payment_currency, payment_format, "
            "is_laundering FROM transactions"
        ),
        "s6_scheme_text": with_tables(
            "SELECT CAST(dense_rank() OVER (ORDER BY pattern_group) AS INTEGER) AS pattern_group, "
            "pattern_type, strftime(ts, '%Y/%m/%d %H:%M:%S') AS timestamp, "
            "from_bank::VARCHAR AS from_bank, from_account, to_bank::VARCHAR AS to_bank, "
            "to_account, amount_received::VARCHAR AS amount_received, receiving_currency, "
            "amount_paid::VARCHAR AS amount_paid, payment_currency, payment_format, "
            "is_laundering::VARCHAR AS is_laundering FROM laundering_patterns"
        ),
        "s7_warehouse_load": with_tables(
            "SELECT txn_id, date_trunc('milliseconds', ts) AS ts, from_bank, from_account, "
            f"to_bank, to_account, {double('amount_received')} AS amount_received, "
            f"receiving_currency, {double('amount_paid')} AS amount_paid, payment_currency, "
            "payment_format, is_laundering, txn_date FROM transactions "
            "WHERE txn_date <= DATE '2024-01-28'"
        ),
        "s8_pattern_load": with_tables(
            "SELECT pattern_id, pattern_group, pattern_type, "
            "date_trunc('milliseconds', ts) AS ts, from_bank, from_account, to_bank, to_account, "
            f"{double('amount_received')} AS amount_received, receiving_currency, "
            f"{double('amount_paid')} AS amount_paid, payment_currency, payment_format, "
            "is_laundering FROM laundering_patterns"
        ),
        "s27_first_days": with_tables(
            "SELECT txn_date AS day, count(*) AS total, "
            "CAST(sum(is_laundering) AS BIGINT) AS laundering, "
            f"{rounded('sum(is_laundering)', 'count(*)')} AS rate FROM transactions "
            "WHERE txn_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' GROUP BY 1"
        ),
        "f8_cyclic_encoding": with_tables(
            "SELECT txn_id, "
            + ", ".join(
                f"round({part}(2 * pi() * {column} / {period}) + 0.0, 9) + 0.0 AS {column}_{part}"
                for column, period in (("hour_of_day", 24), ("day_of_week", 7))
                for part in ("sin", "cos")
            )
            + " FROM rows_",
            _ROWS,
        ),
    }


def dense_answers(named: dict[str, str]) -> dict[str, str]:
    """The answers of the queries on the harsher ledger, the rules with their published limits."""
    published = _flags(RuleThresholds())
    return {
        f"h_{name}": on_dense(named[name].replace(_FLAGS, published))
        for name in registry.DENSE_QUERIES
    }
