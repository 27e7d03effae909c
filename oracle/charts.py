"""SQL answers for the chart tables; each starts from the answer of its report."""

from __future__ import annotations

from oracle.base import CANONICAL, double, rounded, with_tables
from oracle.reports import answers as report_answers

_EIGHT = (
    "('FAN-IN', 'FAN-OUT', 'GATHER-SCATTER', 'SCATTER-GATHER', 'CYCLE', 'RANDOM', "
    "'BIPARTITE', 'STACK')"
)


def _total(expression: str) -> str:
    return f"CAST(sum({expression}) AS BIGINT)"


def _density(bin_column: str, label: str, amount: str, spine: str | None = None) -> str:
    counts = (
        f"SELECT {bin_column}, coalesce(sum({amount}) FILTER (WHERE {label} = 0), 0) AS clean, "
        f"coalesce(sum({amount}) FILTER (WHERE {label} = 1), 0) AS flagged "
        f"FROM report GROUP BY {bin_column}"
    )
    if spine:
        counts = (
            f"SELECT CAST(i AS INTEGER) AS {bin_column}, coalesce(clean, 0) AS clean, "
            f"coalesce(flagged, 0) AS flagged FROM range({spine}) AS s(i) "
            f"LEFT JOIN ({counts}) AS c ON c.{bin_column} = s.i"
        )

    def share(column: str) -> str:
        whole = f"greatest(sum({column}) OVER (), 1)"
        return rounded(f"({column} * 100)", whole)

    return (
        f"SELECT {bin_column}, {share('clean')} AS legitimate_pct, "
        f"{share('flagged')} AS laundering_pct FROM ({counts}) AS c"
    )


def _hours() -> str:
    return ", ".join(
        f"coalesce(max(rate) FILTER (WHERE hour_of_day = {h}), 0.0::DOUBLE) AS h{h:02d}"
        for h in range(24)
    )


_LABEL = "CASE WHEN name IS NULL THEN bank_id::VARCHAR ELSE bank_id || ' — ' || name END"

_BINS = (
    "CASE log10_bin WHEN -1 THEN '<$1' WHEN 0 THEN '$1–10' WHEN 1 THEN '$10–100' "
    "WHEN 2 THEN '$100–1K' WHEN 3 THEN '$1K–10K' WHEN 4 THEN '$10K–100K' "
    "WHEN 5 THEN '$100K–1M' WHEN 6 THEN '$1M–10M' WHEN 7 THEN '$10M–100M' "
    "WHEN 8 THEN '$100M–1B' ELSE '$1B+' END"
)


def _panel(column: str) -> str:
    return (
        f"SELECT bank_id, {_LABEL} AS label, in_transactions, out_transactions, "
        "laundering_ratio FROM report WHERE in_transactions + out_transactions >= 100 "
        f"ORDER BY {column} DESC, bank_id LIMIT 20"
    )


def _share(scope: str) -> str:
    share = rounded("(n * 100)", "sum(n) OVER (PARTITION BY is_laundering)")
    return f"SELECT is_laundering, {scope}, n, {share} AS share_pct FROM report"


def _corridors(column: str) -> str:
    return (
        "SELECT from_bank || ' -> ' || to_bank AS corridor, n_total, n_laundering, "
        f"laundering_rate FROM report ORDER BY {column} DESC, from_bank, to_bank LIMIT 25"
    )


def _log(source: str, target: str) -> str:
    return f"SELECT {source}, {target}, n, round(log10(n + 1), 6) AS log10_n FROM report"


def _spread_cell(low: int, high: int, name: str) -> str:
    return (
        f"CAST(coalesce(sum(n_patterns) FILTER (WHERE n_banks BETWEEN {low} AND {high}), 0) "
        f"AS BIGINT) AS banks_{name}"
    )


def _coverage_at(point: int) -> str:
    part = f"(coalesce(sum(n_at_k) FILTER (WHERE k <= {point}), 0) * 100)"
    return f"{rounded(part, 'sum(n_at_k)')} AS k{point}_pct"


def _mean(column: str, name: str) -> str:
    return f"round(avg({column}::DOUBLE / n_edges_total), 6) AS {name}"


def answers() -> dict[str, str]:
    reports = report_answers()
    canonical_report = f"(SELECT *, {CANONICAL} AS canonical FROM report) AS c"
    spread_cells = ", ".join(
        _spread_cell(*cell)
        for cell in [
            (0, 1, "1"), (2, 2, "2"), (3, 5, "3_5"), (6, 10, "6_10"), (11, 20, "11_20"),
            (21, 1000000000, "21_up"),
        ]
    )
    from_report = {
        "r1_format_share": (
            "q2",
            "SELECT payment_format, "
            + rounded("(coalesce(sum(n) FILTER (WHERE is_laundering = 0), 0) * 100)", "sum(n)")
            + " AS legitimate_pct, "
            + rounded("(coalesce(sum(n) FILTER (WHERE is_laundering = 1), 0) * 100)", "sum(n)")
            + " AS laundering_pct FROM report GROUP BY payment_format",
        ),
        "r2_scope_share": ("q4", _share("scope")),
        "r2_currency_scope_share": ("q13", _share("currency_scope")),
        "r3_canonical_sizes": (
            "q6",
            f"SELECT canonical, {_total('n_patterns')} AS n_patterns, "
            f"{_total('n_transactions')} AS n_transactions, "
            f"{rounded('sum(n_transactions)', 'sum(n_patterns)', 1)} AS avg_tx_per_pattern "
            f"FROM {canonical_report} GROUP BY canonical",
        ),
        "r4_busiest_receivers": ("q8", _panel("in_transactions")),
        "r4_busiest_senders": ("q8", _panel("out_transactions")),
        "r5_bank_spread_summary": (
            "q9",
            "SELECT (SELECT n_banks FROM report ORDER BY n_patterns DESC, n_banks LIMIT 1) "
            "AS mode_banks, max(n_patterns) AS mode_patterns, max(n_banks) AS max_banks, "
            "CAST(coalesce(sum(n_patterns) FILTER (WHERE n_banks = 1), 0) AS BIGINT) "
            f"AS intra_patterns, {_total('n_patterns')} AS total_patterns, "
            + rounded(
                "(coalesce(sum(n_patterns) FILTER (WHERE n_banks = 1), 0) * 100)",
                "sum(n_patterns)",
                2,
            )
            + " AS intra_pct FROM report",
        ),
        "r6_amount_shape": (
            "q11",
            f"SELECT payment_currency, log10_bin, {_BINS} AS bin_label, "
            + rounded("(a * 100)", "greatest(sum(a) OVER cur, 1)")
            + " AS legitimate_pct, "
            + rounded("(b * 100)", "greatest(sum(b) OVER cur, 1)")
            + " AS laundering_pct FROM (SELECT payment_currency, log10_bin, "
            "coalesce(sum(n) FILTER (WHERE is_laundering = 0), 0) AS a, "
            "coalesce(sum(n) FILTER (WHERE is_laundering = 1), 0) AS b FROM report "
            "WHERE payment_currency IN (SELECT payment_currency FROM report "
            "GROUP BY payment_currency ORDER BY sum(n) DESC, payment_currency LIMIT 6) "
            "GROUP BY payment_currency, log10_bin) AS t "
            "WINDOW cur AS (PARTITION BY payment_currency)",
        ),
        "r7_weekday_grid": (
            "q12",
            "SELECT CAST((day_of_week + 5) % 7 + 1 AS INTEGER) AS position, "
            "['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week] AS weekday, "
            f"{_hours()} FROM report GROUP BY day_of_week",
        ),
        "r8_duration_boxes": (
            "q14",
            "WITH h AS (SELECT canonical, greatest(duration_hours, 0.01::DOUBLE) AS hours "
            f"FROM {canonical_report} WHERE canonical IN {_EIGHT}), "
            "q AS (SELECT canonical, count(*) AS n_patterns, quantile_cont(hours, 0.25) AS a, "
            "quantile_cont(hours, 0.5) AS b, quantile_cont(hours, 0.75) AS c "
            "FROM h GROUP BY canonical), "
            "f AS (SELECT *, hours BETWEEN a - (c - a) * 1.5 AND c + (c - a) * 1.5 AS ok "
            "FROM h JOIN q USING (canonical)) "
            "SELECT canonical, n_patterns, round(a, 6) AS q1, round(b, 6) AS median, "
            "round(c, 6) AS q3, min(hours) FILTER (WHERE ok) AS whisker_low, "
            "max(hours) FILTER (WHERE ok) AS whisker_high, "
            "count(*) FILTER (WHERE NOT ok) AS n_outliers FROM f "
            "GROUP BY canonical, n_patterns, a, b, c",
        ),
        "r9_degree_ccdf": (
            "q15",
            "SELECT direction, ever_laundering, deg, "
            "(sum(n_accounts) OVER (PARTITION BY direction, ever_laundering ORDER BY deg DESC))"
            "::DOUBLE / (sum(n_accounts) OVER (PARTITION BY direction, ever_laundering))"
            "::DOUBLE AS ccdf FROM report",
        ),
        "r10_component_buckets": (
            "q16",
            "SELECT CAST(list_position(['1', '2', '3-9', '10-99', '100-999', '1K-9.9K', "
            "'10K-99.9K', '100K-999K', '1M+'], size_bucket) AS INTEGER) AS position, * "
            "FROM report",
        ),
        "r11_gap_density": ("q17", _density('"decade"', "is_laundering", "n")),
        "r11_structuring_density": ("b1", _density("bin_lo", "is_laundering", "n")),
        "r11_lifetime_density": (
            "b15", _density("lifetime_bucket", "ever_laundering", "n_accounts", "7")
        ),
        "r11_hour_density": ("b16", _density("hour_of_day", "is_laundering", "n", "24")),
        "r12_bank_spread_grid": (
            "q18",
            f"SELECT t.canonical, {spread_cells} FROM (SELECT unnest(["
            + _EIGHT.strip("()")
            + f"]) AS canonical) AS t LEFT JOIN {canonical_report} USING (canonical) "
            "GROUP BY t.canonical",
        ),
        "r13_currency_grid": (
            "q19",
            "WITH top AS (SELECT currency FROM (SELECT payment_currency AS currency, n "
            "FROM report UNION ALL SELECT receiving_currency, n FROM report) AS l "
            "GROUP BY currency ORDER BY sum(n) DESC, currency LIMIT 10) "
            "SELECT a.currency AS payment_currency, b.currency AS receiving_currency, "
            "k.is_laundering, coalesce(any_value(n), 0) AS n, "
            "round(log10(coalesce(any_value(n), 0) + 1), 6) AS log10_n "
            "FROM top AS a CROSS JOIN top AS b CROSS JOIN (VALUES (0), (1)) AS k(is_laundering) "
            "LEFT JOIN report AS r ON r.payment_currency = a.currency "
            "AND r.receiving_currency = b.currency AND r.is_laundering = k.is_laundering "
            "GROUP BY ALL",
        ),
        "r14_corridors_by_volume": ("q20", _corridors("n_total")),
        "r14_corridors_by_rate": ("q20", _corridors("laundering_rate")),
        "r15_visibility_by_type": (
            "b4",
            "SELECT canonical, count(*) AS n_patterns, "
            f"{_mean('isolated_visible_edges', 'isolated')}, 1.0::DOUBLE AS shared, "
            f"{_mean('loose_consortium_edges', 'consort_loose')}, "
            f"{_mean('strict_consortium_edges', 'consort_strict')} "
            f"FROM {canonical_report} WHERE canonical IN {_EIGHT} GROUP BY canonical",
        ),
        "r16_coverage_curve": (
            "b5",
            "SELECT coverage_type, is_laundering, k, "
            + rounded(
                "(100 * sum(n_at_k) OVER (PARTITION BY coverage_type, is_laundering ORDER BY k))",
                "sum(n_at_k) OVER (PARTITION BY coverage_type, is_laundering)",
            )
            + " AS coverage_pct FROM report",
        ),
        "r16_coverage_at": (
            "b5",
            "SELECT coverage_type, is_laundering, "
            + ", ".join(_coverage_at(point) for point in (5, 10, 20, 50))
            + " FROM report GROUP BY coverage_type, is_laundering",
        ),
        "r17_cross_bank_by_type": (
            "b6",
            f"SELECT canonical, {_total('n_patterns')} AS n_patterns, "
            f"{_total('n_with_inter_edge')} AS n_with_inter_edge, "
            f"{_total('total_intra_edges')} AS total_intra, "
            f"{_total('total_inter_edges')} AS total_inter, "
            "sum(n_with_inter_edge)::DOUBLE / sum(n_patterns)::DOUBLE AS frac_inter_instances, "
            f"{_total('total_intra_edges + total_inter_edges')} AS total_edges "
            f"FROM {canonical_report} WHERE canonical IN {_EIGHT} GROUP BY canonical",
        ),
        "r19_scatter_accounts": (
            "q5",
            "SELECT * FROM report WHERE CAST('0x' || substr(md5(account || ':42'), 1, 8) AS BIGINT) "
            "< CAST(floor(0.4 * 4294967296) AS BIGINT)",
        ),
        "r20_bank_matrix_log": ("q7", _log("from_bank", "to_bank")),
        "r20_rank_matrix_log": ("q7b", _log("from_rank", "to_rank")),
        "r22_daily_rate_percent": (
            "q1", "SELECT day, CAST(round(rate * 1000000) AS DOUBLE) / 10000 AS rate_pct FROM report"
        ),
        "r22_bank_rank_size": (
            "q3",
            "SELECT bank, tx_count, CAST(row_number() OVER (ORDER BY tx_count DESC, bank) "
            "AS INTEGER) AS rank FROM report",
        ),
    }
    sql = {}
    for name, (report, body) in from_report.items():
        inner = f"report AS (\n{reports[report]}\n)"
        if body.startswith("WITH "):
            sql[name] = f"WITH {inner},\n{body[5:]}"
        else:
            sql[name] = f"WITH {inner}\n{body}"
    sql["r18_value_by_type"] = with_tables(
        "SELECT canonical, count(*) AS n_transactions, "
        "count(DISTINCT (pattern_type, pattern_group)) AS n_pattern_instances, "
        f"{double('sum(amount_paid)')} AS total_usd FROM (SELECT *, {CANONICAL} AS canonical "
        "FROM laundering_patterns WHERE payment_currency = 'US Dollar') AS c "
        f"WHERE canonical IN {_EIGHT} GROUP BY canonical"
    )
    return sql
