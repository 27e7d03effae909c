"""Category expressions: scopes, canonical scheme types, currency buckets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eight canonical scheme types, in report order.
CANONICAL_TYPES = [
    "FAN-IN",
    "FAN-OUT",
    "GATHER-SCATTER",
    "SCATTER-GATHER",
    "CYCLE",
    "RANDOM",
    "BIPARTITE",
    "STACK",
]
OTHER_TYPE = "OTHER"

# Currencies kept apart; all others become "Other".
KEPT_CURRENCIES = [
    "US Dollar",
    "Euro",
    "Yuan",
    "Yen",
    "UK Pound",
    "Ruble",
    "Canadian Dollar",
    "Australian Dollar",
]
OTHER_CURRENCY = "Other"


def canonical_type(raw: Column, names: Iterable[str] = CANONICAL_TYPES) -> Column:
    """Canonical type whose name starts the raw label, whatever its case.

    Longer names are tried first, so no name can be hidden by a shorter prefix of itself.
    """
    label = F.upper(raw)
    matches = [
        F.when(label.startswith(name), F.lit(name))
        for name in sorted(names, key=lambda name: (-len(name), name))
    ]
    return F.coalesce(*matches, F.lit(OTHER_TYPE))


def currency_bucket(currency: Column, kept: Iterable[str] = KEPT_CURRENCIES) -> Column:
    return F.when(currency.isin(list(kept)), currency).otherwise(F.lit(OTHER_CURRENCY))


def bank_scope() -> Column:
    """``intra`` when both ends are the same bank, else ``inter``."""
    return F.when(F.col("from_bank") == F.col("to_bank"), F.lit("intra")).otherwise(
        F.lit("inter")
    )


def currency_scope() -> Column:
    return F.when(
        F.col("payment_currency") == F.col("receiving_currency"), F.lit("same")
    ).otherwise(F.lit("mismatch"))


def bank_label(bank_id: Column, name: Column) -> Column:
    """Axis label ``id — name``; the bare id where the name is unknown."""
    return F.concat_ws(" — ", bank_id.cast("string"), name)
