"""One-scan summaries of the ledger that most reports start from.

Each of them reads the ledger once, turns a transfer into its two ends inside the scan
stage, and lets map-side partial aggregation collapse a hot bank or account before any row
is shuffled. Columns are not pruned through the row expansion, so a caller names the groups
of measures it needs and the scan reads only their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ordering import global_row_number


def _ends(frame: DataFrame, key: str, outgoing: dict[str, Column], incoming: dict[str, Column],
          source: str, target: str) -> DataFrame:
    """Two rows per input row: one for the sending end, one for the receiving end."""
    out_leg = F.struct(F.col(source).alias(key), *[v.alias(k) for k, v in outgoing.items()])
    in_leg = F.struct(F.col(target).alias(key), *[v.alias(k) for k, v in incoming.items()])
    return frame.select(F.inline(F.array(out_leg, in_leg)))


def bank_profile(ledger: DataFrame, flags: bool = True) -> DataFrame:
    """bank, out_tx, in_tx and, with ``flags``, out_flagged, in_flagged.

    An intra-bank transfer counts on both sides.
    """
    one, zero = F.lit(1), F.lit(0)
    sent, received = {"out_tx": one, "in_tx": zero}, {"out_tx": zero, "in_tx": one}
    if flags:
        flag = F.col("is_laundering")
        sent |= {"out_flagged": flag, "in_flagged": zero}
        received |= {"out_flagged": zero, "in_flagged": flag}
    ends = _ends(ledger, "bank", sent, received, "from_bank", "to_bank")
    return ends.groupBy("bank").agg(*[F.sum(name).alias(name) for name in sent])


def account_profile(ledger: DataFrame, flags: bool = True, times: bool = False) -> DataFrame:
    """account, out_deg, in_deg; with ``flags``, out_flagged and in_flagged (0/1, NULL if that
    side is empty); with ``times``, first_ts and last_ts."""
    one, zero, none = F.lit(1), F.lit(0), F.lit(None).cast("int")
    sent, received = {"out_deg": one, "in_deg": zero}, {"out_deg": zero, "in_deg": one}
    measures = [F.sum("out_deg").alias("out_deg"), F.sum("in_deg").alias("in_deg")]
    if flags:
        flag = F.col("is_laundering")
        sent |= {"out_flagged": flag, "in_flagged": none}
        received |= {"out_flagged": none, "in_flagged": flag}
        measures += [F.max(name).alias(name) for name in ("out_flagged", "in_flagged")]
    if times:
        sent |= {"ts": F.col("ts")}
        received |= {"ts": F.col("ts")}
        measures += [F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]
    ends = _ends(ledger, "account", sent, received, "from_account", "to_account")
    return ends.groupBy("account").agg(*measures)


def ever_flagged() -> Column:
    """1 if the account of an ``account_profile`` row was ever on either end of a flagged row."""
    return F.greatest(
        F.coalesce(F.col("out_flagged"), F.lit(0)), F.coalesce(F.col("in_flagged"), F.lit(0))
    )


def bank_pairs(ledger: DataFrame) -> DataFrame:
    """from_bank, to_bank, n, flagged: the ledger compressed to one row per corridor."""
    return ledger.groupBy("from_bank", "to_bank").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_laundering").alias("flagged")
    )


def bank_volume(pairs: DataFrame) -> DataFrame:
    """bank, volume (both ends counted) from the corridors, without another ledger scan."""
    n = F.col("n")
    ends = _ends(pairs, "bank", {"n": n}, {"n": n}, "from_bank", "to_bank")
    return ends.groupBy("bank").agg(F.sum("n").alias("volume"))


def _by_volume() -> list[Column]:
    return [F.col("volume").desc(), F.col("bank").asc()]


def top_banks(volume: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest banks; ties go to the smaller bank id. At most ``k`` rows."""
    return volume.orderBy(*_by_volume()).limit(k)


def ranked_banks(volume: DataFrame) -> DataFrame:
    """bank, volume, rnk (1 = largest) for every bank, numbered without a one-task sort."""
    return global_row_number(volume, _by_volume(), "rnk")
