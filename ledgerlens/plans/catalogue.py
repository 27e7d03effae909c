"""The named reports and the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlens.plans import accounts, activity, banks, patterns

LEDGER, SCHEMES, ACCOUNTS = "transactions", "laundering_patterns", "accounts"


@dataclass(frozen=True)
class Report:
    plan: Callable[..., DataFrame]
    tables: tuple[str, ...]


REPORTS: dict[str, Report] = {
    "q1": Report(activity.daily_rate, (LEDGER,)),
    "q2": Report(activity.format_by_label, (LEDGER,)),
    "q3": Report(banks.bank_activity, (LEDGER,)),
    "q4": Report(activity.scope_by_label, (LEDGER,)),
    "q5": Report(accounts.account_degrees, (LEDGER,)),
    "q6": Report(patterns.type_sizes, (SCHEMES,)),
    "q7": Report(banks.top_bank_matrix, (LEDGER,)),
    "q7b": Report(banks.top_rank_matrix, (LEDGER,)),
    "q8": Report(banks.bank_risk, (LEDGER, ACCOUNTS)),
    "q9": Report(patterns.bank_spread, (SCHEMES,)),
    "q10": Report(banks.largest_banks, (LEDGER, ACCOUNTS)),
    "q11": Report(activity.amount_decades, (LEDGER,)),
    "q12": Report(activity.hour_by_weekday, (LEDGER,)),
    "q13": Report(activity.currency_scope_by_label, (LEDGER,)),
    "q14": Report(patterns.scheme_durations, (SCHEMES,)),
    "q15": Report(accounts.degree_histogram, (LEDGER,)),
    "q16": Report(accounts.component_histogram, (LEDGER,)),
    "q17": Report(accounts.pass_through_histogram, (LEDGER,)),
    "q18": Report(patterns.bank_spread_by_type, (SCHEMES,)),
    "q19": Report(activity.currency_pairs, (LEDGER,)),
    "q20": Report(banks.busy_corridors, (LEDGER,)),
    "b1": Report(activity.structuring_histogram, (LEDGER,)),
    "b4": Report(banks.scheme_visibility, (LEDGER, SCHEMES)),
    "b5": Report(banks.consortium_histogram, (LEDGER,)),
    "b6": Report(patterns.cross_bank_share, (SCHEMES,)),
    "b14": Report(patterns.value_by_type, (SCHEMES,)),
    "b15": Report(accounts.lifetime_histogram, (LEDGER,)),
    "b16": Report(activity.hourly_by_label, (LEDGER,)),
}
