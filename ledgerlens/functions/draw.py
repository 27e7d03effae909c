"""Draws that depend on a row's key only, so they repeat under any partitioning and in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Draws are whole numbers below this.
STEPS = 1 << 32


def key_draw(key: str, seed: int = 42) -> Column:
    """The first 32 bits of the MD5 of ``key:seed`` as a number; a null key counts as empty."""
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def drawn(key: str, share: float, seed: int = 42) -> Column:
    """Whether a row belongs to a share of all keys."""
    return key_draw(key, seed) < F.lit(int(share * STEPS))
