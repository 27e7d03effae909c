"""SQL answers for the named reports."""

from __future__ import annotations

from oracle.base import (
    ACCOUNT_ENDS,
    BANK_VOLUME,
    ENDS,
    SCHEME_BANKS,
    double,
    rounded,
    with_tables,
)

_FLAGGED = "CAST(sum(is_laundering) AS BIGINT)"

_BANK_SIDES = """bank_sides AS (
SELECT bank, count(*) FILTER (WHERE sent = 0) AS n_in, count(*) FILTER (WHERE sent = 1) AS n_out,
       count(*) AS n_all, CAST(sum(is_laundering) AS BIGINT) AS n_flagged
FROM ends GROUP BY bank),
bank_names AS (SELECT bank_id, min(bank_name) AS name FROM accounts GROUP BY bank_id)"""

_DECADE = """CASE WHEN amount_paid >= 1000000000 THEN 9 WHEN amount_paid >= 100000000 THEN 8
 WHEN amount_paid >= 10000000 THEN 7 WHEN amount_paid >= 1000000 THEN 6
 WHEN amount_paid >= 100000 THEN 5 WHEN amount_paid >= 10000 THEN 4
 WHEN amount_paid >= 1000 THEN 3 WHEN amount_paid >= 100 THEN 2
 WHEN amount_paid >= 10 THEN 1 WHEN amount_paid >= 1 THEN 0 ELSE -1 END"""

LIVES = """lives AS (
SELECT account, max(is_laundering) AS ever_laundering,
       floor(epoch(max(ts))) - floor(epoch(min(ts))) AS span
FROM account_ends GROUP BY account)"""

LIFETIMES = (
    "SELECT ever_laundering, CASE WHEN span >= 14 * 86400 THEN 6 WHEN span >= 11 * 86400 THEN 5 "
    "WHEN span >= 7 * 86400 THEN 4 WHEN span >= 4 * 86400 THEN 3 WHEN span >= 2 * 86400 THEN 2 "
    "WHEN span >= 86400 THEN 1 ELSE 0 END AS lifetime_bucket, count(*) AS n_accounts "
    "FROM lives GROUP BY ALL"
)

GAPS = """steps AS (
SELECT is_laundering, direction, CAST(floor(epoch(ts)) AS BIGINT) AS t,
       lag(direction) OVER w AS before, lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER w AS t_before
FROM account_ends
WINDOW w AS (PARTITION BY account ORDER BY floor(epoch(ts)), direction, txn_id)),
gaps AS (SELECT is_laundering, t - t_before AS gap FROM steps
         WHERE before = 'in' AND direction = 'out')"""

GAP_BINS = (
    "SELECT is_laundering, CASE WHEN gap >= 604800 THEN 4 WHEN gap >= 86400 THEN 3 "
    "WHEN gap >= 3600 THEN 2 WHEN gap >= 60 THEN 1 WHEN gap >= 1 THEN 0 ELSE -1 END "
    'AS "decade", count(*) AS n FROM gaps GROUP BY ALL'
)

COMPONENTS = """links AS (
SELECT from_account AS a, to_account AS b FROM transactions
UNION SELECT to_account, from_account FROM transactions),
reach(a, b) AS (
SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a),
components AS (SELECT component, count(*) AS size
  FROM (SELECT a, min(b) AS component FROM reach GROUP BY a) AS t GROUP BY component)"""

COMPONENT_BUCKETS = (
    "SELECT CASE WHEN size >= 1000000 THEN '1M+' WHEN size >= 100000 THEN '100K-999K' "
    "WHEN size >= 10000 THEN '10K-99.9K' WHEN size >= 1000 THEN '1K-9.9K' "
    "WHEN size >= 100 THEN '100-999' WHEN size >= 10 THEN '10-99' WHEN size >= 3 THEN '3-9' "
    "WHEN size = 2 THEN '2' ELSE '1' END AS size_bucket, count(*) AS n_components, "
    "CAST(sum(size) AS BIGINT) AS n_vertices_in_bucket, max(size) AS max_size_in_bucket "
    "FROM components GROUP BY ALL"
)

VISIBILITY = """members AS (SELECT bank FROM bank_volume WHERE place <= {k}),
edges AS (
SELECT pattern_group, pattern_type, from_bank, to_bank,
       (from_bank IN (SELECT bank FROM members))::INT
       + (to_bank IN (SELECT bank FROM members))::INT AS inside
FROM laundering_patterns),
best AS (
SELECT pattern_group, max(seen) AS seen FROM (
  SELECT pattern_group, bank, count(*) AS seen FROM (
    SELECT pattern_group, unnest(list_distinct([from_bank, to_bank])) AS bank FROM edges) AS u
  GROUP BY pattern_group, bank) AS v GROUP BY pattern_group),
visibility AS (
SELECT e.pattern_group, max(e.pattern_type) AS pattern_type, count(*) AS n_edges_total,
       any_value(b.seen) AS isolated_visible_edges,
       count(*) FILTER (WHERE inside >= 1) AS loose_consortium_edges,
       count(*) FILTER (WHERE inside = 2) AS strict_consortium_edges
FROM edges AS e JOIN best AS b USING (pattern_group) GROUP BY e.pattern_group)"""

COVERAGE = """places AS (
SELECT t.is_laundering, least(f.place, g.place) AS first_in, greatest(f.place, g.place) AS both_in
FROM transactions AS t JOIN bank_volume AS f ON t.from_bank = f.bank
JOIN bank_volume AS g ON t.to_bank = g.bank),
coverage AS (
SELECT 'loose' AS coverage_type, is_laundering, CAST(first_in AS INTEGER) AS k,
       count(*) AS n_at_k FROM places GROUP BY ALL
UNION ALL
SELECT 'strict', is_laundering, CAST(both_in AS INTEGER), count(*) FROM places GROUP BY ALL)"""


def answers() -> dict[str, str]:
    sql = {
        "q1": (
            f"SELECT txn_date AS day, count(*) AS total, {_FLAGGED} AS laundering, "
            f"{rounded('sum(is_laundering)', 'count(*)')} AS rate FROM transactions GROUP BY 1"
        ),
        "q2": (
            "SELECT payment_format, is_laundering, count(*) AS n FROM transactions GROUP BY ALL"
        ),
        "q4": (
            "SELECT is_laundering, if(from_bank = to_bank, 'intra', 'inter') AS scope, "
            "count(*) AS n FROM transactions GROUP BY ALL"
        ),
        "q6": (
            "SELECT pattern_type, count(DISTINCT pattern_group) AS n_patterns, "
            "count(*) AS n_transactions FROM laundering_patterns GROUP BY ALL"
        ),
        "q11": (
            f"SELECT payment_currency, is_laundering, {_DECADE} AS log10_bin, count(*) AS n, "
            f"{double('round(min(amount_paid), 2)')} AS bin_min, "
            f"{double('round(max(amount_paid), 2)')} AS bin_max "
            "FROM transactions WHERE amount_paid > 0 GROUP BY ALL"
        ),
        "q12": (
            "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, "
            "CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, count(*) AS total, "
            f"{_FLAGGED} AS laundering, {rounded('sum(is_laundering)', 'count(*)')} AS rate "
            "FROM transactions GROUP BY ALL"
        ),
        "q13": (
            "SELECT is_laundering, if(payment_currency = receiving_currency, 'same', 'mismatch') "
            "AS currency_scope, count(*) AS n FROM transactions GROUP BY ALL"
        ),
        "q14": (
            "SELECT pattern_group, pattern_type, span AS duration_seconds, "
            f"{rounded('span', '3600', 2)} AS duration_hours, "
            f"{rounded('span', '86400', 2)} AS duration_days FROM ("
            "SELECT pattern_group, max(pattern_type) AS pattern_type, "
            "CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS span "
            "FROM laundering_patterns GROUP BY pattern_group) AS s"
        ),
        "q19": (
            "SELECT payment_currency, receiving_currency, is_laundering, count(*) AS n, "
            f"{double('sum(amount_paid)')} AS total_amount FROM transactions GROUP BY ALL"
        ),
        "q20": (
            "SELECT from_bank, to_bank, count(*) AS n_total, "
            f"{_FLAGGED} AS n_laundering, sum(is_laundering)::DOUBLE / count(*) AS laundering_rate "
            "FROM transactions GROUP BY ALL HAVING count(*) >= 50"
        ),
        "b1": (
            "SELECT is_laundering, CAST(floor(amount_paid / 50) AS INTEGER) * 50 AS bin_lo, "
            "count(*) AS n FROM transactions WHERE amount_paid >= 7000 AND amount_paid <= 12000 "
            "GROUP BY ALL"
        ),
        "b6": (
            "SELECT pattern_type, count(*) AS n_patterns, "
            "count(*) FILTER (WHERE crossing > 0) AS n_with_inter_edge, "
            "CAST(sum(n - crossing) AS BIGINT) AS total_intra_edges, "
            "CAST(sum(crossing) AS BIGINT) AS total_inter_edges FROM ("
            "SELECT pattern_group, max(pattern_type) AS pattern_type, count(*) AS n, "
            "count(*) FILTER (WHERE from_bank <> to_bank) AS crossing "
            "FROM laundering_patterns GROUP BY pattern_group) AS s GROUP BY pattern_type"
        ),
        "b14": (
            "SELECT pattern_type, count(*) AS n_transactions, "
            "count(DISTINCT pattern_group) AS n_pattern_instances, "
            f"{double('sum(amount_paid)')} AS total_usd FROM laundering_patterns "
            "WHERE payment_currency = 'US Dollar' GROUP BY ALL"
        ),
        "b16": (
            "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, is_laundering, count(*) AS n "
            "FROM transactions GROUP BY ALL"
        ),
    }
    full = {name: with_tables(body) for name, body in sql.items()}
    full["q3"] = with_tables(
        f"SELECT bank, count(*) AS tx_count, {_FLAGGED} AS laundering_count, "
        f"{rounded('sum(is_laundering)', 'count(*)')} AS laundering_rate FROM ends GROUP BY bank",
        ENDS,
    )
    full["q5"] = with_tables(
        "SELECT account, count(*) FILTER (WHERE direction = 'out') AS out_deg, "
        "count(*) FILTER (WHERE direction = 'in') AS in_deg, "
        "max(is_laundering) AS ever_laundering FROM account_ends GROUP BY account",
        ACCOUNT_ENDS,
    )
    full["q7"] = with_tables(
        f"SELECT from_bank, to_bank, count(*) AS n, {_FLAGGED} AS laundering_n FROM transactions "
        "WHERE from_bank IN (SELECT bank FROM bank_volume WHERE place <= 20) "
        "AND to_bank IN (SELECT bank FROM bank_volume WHERE place <= 20) GROUP BY ALL",
        ENDS, BANK_VOLUME,
    )
    full["q7b"] = with_tables(
        "SELECT CAST(f.place AS INTEGER) AS from_rank, CAST(g.place AS INTEGER) AS to_rank, "
        f"count(*) AS n, {_FLAGGED} AS laundering_n FROM transactions AS t "
        "JOIN bank_volume AS f ON f.bank = t.from_bank AND f.place <= 500 "
        "JOIN bank_volume AS g ON g.bank = t.to_bank AND g.place <= 500 GROUP BY ALL",
        ENDS, BANK_VOLUME,
    )
    bank_row = (
        "SELECT bank AS bank_id, name, n_in AS in_transactions, n_out AS out_transactions, "
    )
    ratio = rounded("n_flagged", "n_all")
    named = "FROM bank_sides LEFT JOIN bank_names ON bank_id = bank"
    full["q8"] = with_tables(
        f"{bank_row}{ratio} AS laundering_ratio {named}", ENDS, _BANK_SIDES
    )
    full["q10"] = with_tables(
        f"{bank_row}n_all AS total_tx, {ratio} AS laundering_ratio {named} "
        "ORDER BY n_all DESC, bank LIMIT 20",
        ENDS, _BANK_SIDES,
    )
    full["q9"] = with_tables(
        "SELECT n_banks, count(*) AS n_patterns FROM scheme_banks GROUP BY n_banks", SCHEME_BANKS
    )
    full["q18"] = with_tables(
        "SELECT pattern_type, n_banks, count(*) AS n_patterns FROM scheme_banks GROUP BY ALL",
        SCHEME_BANKS,
    )
    full["q15"] = with_tables(
        "SELECT direction, ever_laundering, deg, count(*) AS n_accounts FROM ("
        "SELECT direction, account, count(*) AS deg, max(is_laundering) AS ever_laundering "
        "FROM account_ends GROUP BY direction, account) AS d GROUP BY ALL",
        ACCOUNT_ENDS,
    )
    full["q16"] = with_tables(COMPONENT_BUCKETS, COMPONENTS).replace("WITH ", "WITH RECURSIVE ", 1)
    full["q17"] = with_tables(GAP_BINS, ACCOUNT_ENDS, GAPS)
    full["b4"] = with_tables(
        "SELECT * FROM visibility", ENDS, BANK_VOLUME, VISIBILITY.format(k=20)
    )
    full["b5"] = with_tables("SELECT * FROM coverage", ENDS, BANK_VOLUME, COVERAGE)
    full["b15"] = with_tables(LIFETIMES, ACCOUNT_ENDS, LIVES)
    return full


def graph_answers() -> dict[str, str]:
    body = "SELECT a AS id, min(b) AS component FROM reach GROUP BY a"
    return {
        "g2_components": with_tables(body, COMPONENTS).replace("WITH ", "WITH RECURSIVE ", 1)
    }
