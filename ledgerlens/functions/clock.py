"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_SECONDS = 3600
DAY_SECONDS = 86400


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, for TIMESTAMP and TIMESTAMP_NTZ alike.

    ``CAST(ts AS BIGINT)`` is refused for TIMESTAMP_NTZ; this is not.
    """
    return F.unix_timestamp(ts)


def day_number(seconds: Column) -> Column:
    """Index of the day (from the epoch) a second lies in."""
    return F.floor(seconds / F.lit(DAY_SECONDS)).cast("long")


def is_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday (DAYOFWEEK counts from Sunday = 1)."""
    return F.dayofweek(ts).isin(1, 7).cast("int")
