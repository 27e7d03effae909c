"""Shared SQL text: the derived tables and exact rounding helpers."""

from __future__ import annotations

from ledgerlens.sources import derived


def _select(columns: dict[str, str]) -> str:
    return ",\n       ".join(derived.select_list(columns))


_TRANSACTIONS = (
    f"helper AS (\nSELECT {_select(derived.HELPER_SQL)}\nFROM events),\n"
    f"transactions AS (\nSELECT {_select(derived.TRANSACTIONS_SQL)}\nFROM helper)"
)
_PATTERNS = (
    f"laundering_patterns AS (\nSELECT {_select(derived.PATTERNS_SQL)}\n"
    "FROM transactions WHERE is_laundering = 1)"
)
_ACCOUNTS = (
    f"accounts AS (\nSELECT {_select(derived.ACCOUNTS_SQL)}\n"
    f"FROM (SELECT DISTINCT user_id FROM events) AS u WHERE {derived.ACCOUNTS_FILTER_SQL})"
)


def with_tables(body: str, *extra: str) -> str:
    """Full statement: derived tables, further named subqueries, final select."""
    return "WITH " + ",\n".join([_TRANSACTIONS, _PATTERNS, _ACCOUNTS, *extra]) + "\n" + body


_VOLUME = (
    f"transactions AS (\nSELECT {_select(derived.VOLUME_SQL)}\nFROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN supplier ON l_suppkey = s_suppkey)"
)


def on_volume(statement: str) -> str:
    """A report's statement with the larger ledger in place of the derived tables."""
    head = "WITH " + ",\n".join([_TRANSACTIONS, _PATTERNS, _ACCOUNTS])
    if not statement.startswith(head):
        raise ValueError("not a statement over the derived tables")
    # Keys order events inside a second; the reports on this ledger do not use them.
    return f"WITH {_VOLUME}" + statement.removeprefix(head).replace(", txn_id", "")


_DENSE = (
    f"helper AS (\nSELECT {_select(derived.DENSE_HELPER_SQL)}\nFROM events),\n"
    f"transactions AS (\nSELECT {_select(derived.DENSE_TRANSACTIONS_SQL)}\nFROM helper)"
)


def on_dense(statement: str) -> str:
    """A statement over the derived tables with the harsher ledger in their place."""
    if _TRANSACTIONS not in statement:
        raise ValueError("not a statement over the derived tables")
    return statement.replace(_TRANSACTIONS, _DENSE)


def rounded(numerator: str, denominator: str, places: int = 6) -> str:
    """Half-up rounding of an integer ratio in integer arithmetic (no binary ties)."""
    unit = 10**places
    return (
        f"(CAST((CAST({numerator} AS HUGEINT) * {2 * unit} + ({denominator})) "
        f"// (2 * ({denominator})) AS DOUBLE) / {unit})"
    )


def double(expression: str) -> str:
    """Correctly rounded double of an exact decimal."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DOUBLE)"


ENDS = """ends AS (
SELECT from_bank AS bank, is_laundering, 1 AS sent FROM transactions
UNION ALL
SELECT to_bank, is_laundering, 0 FROM transactions)"""

BANK_VOLUME = """bank_volume AS (
SELECT bank, count(*) AS volume, row_number() OVER (ORDER BY count(*) DESC, bank) AS place
FROM ends GROUP BY bank)"""

SCHEME_BANKS = """scheme_banks AS (
SELECT pattern_group, max(pattern_type) AS pattern_type, count(DISTINCT bank) AS n_banks
FROM (SELECT pattern_group, pattern_type, unnest([from_bank, to_bank]) AS bank
      FROM laundering_patterns) AS t
GROUP BY pattern_group)"""

ACCOUNT_ENDS = """account_ends AS (
SELECT from_account AS account, ts, is_laundering, 'out' AS direction, txn_id FROM transactions
UNION ALL
SELECT to_account, ts, is_laundering, 'in', txn_id FROM transactions)"""

CANONICAL = """CASE
 WHEN starts_with(upper(pattern_type), 'GATHER-SCATTER') THEN 'GATHER-SCATTER'
 WHEN starts_with(upper(pattern_type), 'SCATTER-GATHER') THEN 'SCATTER-GATHER'
 WHEN starts_with(upper(pattern_type), 'BIPARTITE') THEN 'BIPARTITE'
 WHEN starts_with(upper(pattern_type), 'FAN-OUT') THEN 'FAN-OUT'
 WHEN starts_with(upper(pattern_type), 'FAN-IN') THEN 'FAN-IN'
 WHEN starts_with(upper(pattern_type), 'RANDOM') THEN 'RANDOM'
 WHEN starts_with(upper(pattern_type), 'CYCLE') THEN 'CYCLE'
 WHEN starts_with(upper(pattern_type), 'STACK') THEN 'STACK'
 ELSE 'OTHER' END"""
