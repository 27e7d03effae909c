"""Trailing time-window statistics per account, linear in rows for accounts of any size.

Every row gets statistics over the rows of the same account in the last 24 hours (and last
hour), itself and its peers of the same second included. Time is cut into buckets as long as the
window, so a trailing frame is the tail of one bucket plus the head of the next. The rows of an
account are merged by second, and every second goes to its own bucket and the next one. There it
adds its values, and takes them back where it leaves the frame; a running sum per bucket then is the
frame's sum. What a second adds and takes back is spelled out only behind the shuffle. Whole
numbers are summed in 64-bit parts, so nothing is lost by adding and taking back. Only the extremes
need a second, backward pass. A bucket holds at most about 170,000 merged seconds of amounts and as
many moments at which distinct counts change, however many rows it stands for. Statistics that
nobody asks for (``TrailingSide.only``) are not computed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.clock import DAY_SECONDS, HOUR_SECONDS

#: A trailing frame [t - 86400, t] covers this many distinct seconds.
SPAN = DAY_SECONDS + 1
HOUR_SPAN = HOUR_SECONDS + 1

#: Amounts are held in units of their last decimal, so that their squares are whole numbers.
UNITS = 10_000

#: Whole numbers are summed in parts of this many bits, so that 2**30 rows do not overflow a part.
PART_BITS = 31
_PART = 1 << PART_BITS

#: Amounts from here on are taken apart as decimals: their units exceed 64 bits.
_LARGE = 9 * 10**14


@dataclass(frozen=True)
class TrailingSide:
    """What to compute for one end of the transfers."""

    prefix: str
    account: str
    amount: str
    distinct: dict[str, str] = field(hash=False)  # output stem -> counted column
    extremes: bool = False
    hourly: bool = False
    deviation: bool = True

    def name(self, stem: str) -> str:
        return f"{self.prefix}_{stem}"

    def columns(self) -> list[str]:
        stems = ["count_24h", "sum_24h", "mean_24h"]
        stems += ["std_24h"] if self.deviation else []
        stems += ["max_24h", "min_24h"] if self.extremes else []
        stems += [f"unique_{stem}_24h" for stem in self.distinct]
        stems += ["count_1h", "sum_1h"] if self.hourly else []
        return [self.name(stem) for stem in stems]

    def only(self, columns: Iterable[str]) -> TrailingSide:
        """This side without the statistics, beyond count, sum and mean, that are not in ``columns``."""
        asked = {stem for stem in (column.removeprefix(f"{self.prefix}_") for column in columns)}
        return replace(
            self,
            distinct={stem: column for stem, column in self.distinct.items() if f"unique_{stem}_24h" in asked},
            extremes=self.extremes and bool(asked & {"max_24h", "min_24h"}),
            hourly=self.hourly and bool(asked & {"count_1h", "sum_1h"}),
            deviation=self.deviation and "std_24h" in asked,
        )


SENDER = TrailingSide(
    prefix="out",
    account="from_account",
    amount="amount_paid",
    distinct={
        "dst": "to_account",
        "banks": "to_bank",
        "currencies": "payment_currency",
        "formats": "payment_format",
    },
    extremes=True,
    hourly=True,
)

RECEIVER = TrailingSide(
    prefix="in",
    account="to_account",
    amount="amount_received",
    distinct={"src": "from_account", "banks": "from_bank"},
)


def _parts(amount: Column) -> list[Column]:
    """An amount in units, as the parts of lowest and next bits; the last one holds the sign."""
    units = amount * F.lit(UNITS)
    whole = units.cast("long")
    wide = units.cast("decimal(24,0)")
    above = F.floor(wide / F.lit(_PART).cast("decimal(10,0)"))
    small = F.abs(amount) < F.lit(_LARGE)
    low = F.when(small, whole.bitwiseAND(F.lit(_PART - 1))).otherwise(
        (wide - above * F.lit(_PART).cast("decimal(10,0)")).cast("long")
    )
    return [low, F.when(small, F.shiftright(whole, PART_BITS)).otherwise(above.cast("long"))]


def _square_parts(low: Column, high: Column) -> list[Column]:
    """The square of ``high * 2**31 + low`` in parts of 31 bits, from products below 2**63."""
    mask = F.lit(_PART - 1)
    negative = (high < 0) & (low > 0)  # |x| = (-high - 1) * 2**31 + (2**31 - low)
    below = F.when(negative, F.lit(_PART) - low).otherwise(low)
    above = F.abs(high + F.when(negative, F.lit(1)).otherwise(F.lit(0)))
    mid, top = above.bitwiseAND(mask), F.shiftright(above, PART_BITS)

    def lower(product: Column) -> Column:
        return product.bitwiseAND(mask)

    def upper(product: Column) -> Column:
        return F.shiftright(product, PART_BITS)

    p0, p1, p2 = below * below, below * mid, mid * mid
    p3, p4 = below * top, mid * top
    two = F.lit(2)
    return [
        lower(p0),
        upper(p0) + two * lower(p1),
        two * upper(p1) + lower(p2) + two * lower(p3),
        upper(p2) + two * upper(p3) + two * lower(p4),
        two * upper(p4) + top * top,
    ]


def _whole(parts: list[Column]) -> Column:
    """The number that parts of 31 bits stand for; NULL beyond 38 digits."""
    number = parts[-1].cast("decimal(38,0)")
    for part in reversed(parts[:-1]):
        number = F.try_add(
            F.try_multiply(number, F.lit(_PART).cast("decimal(10,0)")), part.cast("decimal(20,0)")
        ).cast("decimal(38,0)")
    return number


def _rough(parts: list[Column]) -> Column:
    number = F.lit(0.0)
    for part in reversed(parts):
        number = number * F.lit(float(_PART)) + part.cast("double")
    return number


def sample_deviation(count: Column, total: list[Column], squares: list[Column]) -> Column:
    """Sample standard deviation from count, sum and sum of squares (in parts); 0 for a single row.

    Both count units of the last decimal, so the numerator is a whole number and exact. Only
    where it outgrows 38 digits (NULL) do doubles step in.
    """
    rows, whole = count.cast("decimal(18,0)"), _whole(total)
    exact = F.try_subtract(F.try_multiply(rows, _whole(squares)), F.try_multiply(whole, whole))
    rough = count * _rough(squares) - _rough(total) * _rough(total)
    numerator = F.greatest(F.coalesce(exact.cast("double"), rough), F.lit(0.0))
    freedom = count.cast("double") * (count - F.lit(1)).cast("double")
    return F.when(
        count > 1, F.sqrt(numerator / F.nullif(freedom, F.lit(0.0))) / F.lit(float(UNITS))
    ).otherwise(F.lit(0.0))


def _amount(parts: list[Column]) -> Column:
    """A sum of units as an amount."""
    return (_whole(parts).cast("decimal(28,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(30,4)")


def _finish(side: TrailingSide, sums: dict[str, Column]) -> list[Column]:
    """Named outputs from the running sums."""
    count = sums["n"]
    total = [sums["s0"], sums["s1"]]
    outputs = {
        "count_24h": count,
        "sum_24h": _amount(total),
        "mean_24h": _amount(total).cast("double") / F.nullif(count, F.lit(0)),
        **{f"unique_{stem}_24h": sums[f"d_{stem}"].cast("int") for stem in side.distinct},
    }
    if side.deviation:
        outputs["std_24h"] = sample_deviation(count, total, [sums[name] for name in _SQUARES])
    if side.extremes:
        outputs["max_24h"], outputs["min_24h"] = sums["max"], sums["min"]
    if side.hourly:
        outputs["count_1h"], outputs["sum_1h"] = sums["hn"], _amount([sums["hs0"], sums["hs1"]])
    return [outputs[name.removeprefix(f"{side.prefix}_")].alias(name) for name in side.columns()]


def _bucket(second: Column) -> Column:
    return F.floor(second / F.lit(SPAN)).cast("long")


def _start(bucket: Column) -> Column:
    return bucket * F.lit(SPAN)


#: Parts of the squares.
_SQUARES = [f"q{at}" for at in range(5)]


def _seconds(frame: DataFrame, side: TrailingSide) -> DataFrame:
    """account, bucket, second and what the account's rows of that second add up to.

    Every second stands in its own bucket and in the next one.
    """
    amount = F.col(side.amount).cast("decimal(20,4)")
    low, high = _parts(amount)
    rows = frame.select(
        F.col(side.account).alias("account"), F.col("ts_unix").alias("second"),
        amount.alias("amount"), low.alias("s0"), high.alias("s1"),
    )
    summed = {"s0": F.col("s0"), "s1": F.col("s1")}
    if side.deviation:
        summed |= dict(zip(_SQUARES, _square_parts(F.col("s0"), F.col("s1"))))
    merged = [F.count(F.lit(1)).alias("n")]
    merged += [F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in summed.items()]
    if side.extremes:
        merged += [F.max("amount").alias("max"), F.min("amount").alias("min")]
    own = _bucket(F.col("second"))
    return (
        rows.groupBy("account", "second")
        .agg(*merged)
        .select("*", F.explode(F.array(own, own + 1)).alias("bucket"))
    )


#: What an event adds: its share of the day's sums and of the hour's sums; ``own`` is 1 at the
#: second of a row, in its own bucket.
_EVENT = "struct<pos: bigint, own: int, day: int, hour: int>"


def _events(side: TrailingSide) -> Column:
    """Where a row of ``_seconds`` adds its values in its bucket, and where it takes them back."""
    second, leaves = F.col("second"), F.col("second") + HOUR_SPAN
    is_own = _bucket(second) == F.col("bucket")

    def event(pos: Column, own: int, day: int, hour: int) -> Column:
        return F.struct(pos, F.lit(own), F.lit(day), F.lit(hour)).cast(_EVENT)

    own = [event(second, 1, 1, 1)]
    carried = [event(second, 0, 1, 0), event(second + SPAN, 0, -1, 0)]
    if not side.hourly:
        return F.when(is_own, F.array(*own)).otherwise(F.array(*carried))
    # The last hour of a bucket reaches into the next one; all others leave where they came.
    leaving = event(leaves, 0, 0, -1)
    reaches = [event(second, 0, 1, 1), carried[1], leaving]
    stays = _bucket(leaves) == F.col("bucket")
    return (
        F.when(is_own & stays, F.array(*own, leaving))
        .when(is_own, F.array(*own))
        .when(stays, F.array(*reaches))
        .otherwise(F.array(*carried))
    )


#: Buckets in which the occurrences of one value are put in order together.
_EPOCH = 32


def _distinct_events(frame: DataFrame, side: TrailingSide) -> DataFrame:
    """Changes of the distinct counts: account, bucket, pos and a change per counted column.

    A value is there from an occurrence until a day has passed without another one. Its count
    goes up where it comes, down where it goes, and up at the start of every bucket that it
    reaches into.
    """
    kinds = F.array(
        *[
            F.struct(F.lit(at).alias("kind"), F.col(column).cast("string").alias("value"))
            for at, column in enumerate(side.distinct.values())
        ]
    )
    seen = (
        frame.select(
            F.col(side.account).alias("account"), F.col("ts_unix").alias("s"), F.inline(kinds)
        )
        .where(F.col("value").isNotNull())
        .distinct()
    )
    # The first occurrences of an epoch also end the last intervals of the one before.
    epoch = F.floor(_bucket(F.col("s")) / F.lit(_EPOCH)).cast("long")
    is_early = _bucket(F.col("s")) % F.lit(_EPOCH) == 0
    seen = seen.withColumn(
        "epoch", F.explode(F.when(is_early, F.array(epoch, epoch - 1)).otherwise(F.array(epoch)))
    )
    in_order = Window.partitionBy("account", "kind", "value", "epoch").orderBy("s")
    before, after, gone = F.col("before"), F.col("after"), F.col("s") + SPAN
    intervals = (
        seen.withColumns({"before": F.lag("s").over(in_order), "after": F.lead("s").over(in_order)})
        .where(F.col("epoch") == epoch)
        # Where an occurrence follows in time, one going and one coming cancel each other; between
        # epochs, which do not see each other's rows both ways, both are kept.
        .withColumns(
            {
                "comes": F.coalesce(before + SPAN < F.col("s"), F.lit(True)),
                "goes": F.coalesce((after > gone) | (F.floor(_bucket(after) / F.lit(_EPOCH)) != epoch), F.lit(True)),
                "end": F.least(after, gone),
            }
        )
        .withColumns({"first": _bucket(F.col("s")), "last": _bucket(F.col("end"))})
    )

    def event(is_one: Column, bucket: Column, pos: Column, change: int) -> Column:
        one = F.struct(bucket.alias("bucket"), pos.alias("pos"), F.lit(change).alias("change"))
        return F.when(is_one, F.array(one)).otherwise(F.array().cast("array<struct<bucket:bigint,pos:bigint,change:int>>"))

    first, last = F.col("first"), F.col("last")
    changes = F.concat(
        event(F.col("comes"), first, F.col("s"), 1),
        event(F.col("goes"), last, F.col("end"), -1),
        event(first != last, last, _start(last), 1),
    )
    counted = [
        F.coalesce(F.sum(F.when(F.col("kind") == at, F.col("change"))), F.lit(0)).alias(f"d_{stem}")
        for at, stem in enumerate(side.distinct)
    ]
    return (
        intervals.select("account", "kind", F.inline(changes))
        .groupBy("account", "bucket", "pos")
        .agg(*counted)
        .where(F.greatest(*[F.abs(F.col(f"d_{stem}")) for stem in side.distinct], F.lit(0)) > 0)
    )


def per_second(
    frame: DataFrame, side: TrailingSide, asked: DataFrame | None = None
) -> DataFrame:
    """One row per account and second of ``frame`` with the statistics of ``side``.

    ``asked`` (account, second) names other moments to report on: the frame that ends there,
    whether or not the account has a row of this side in it.
    """
    merged = _seconds(frame, side)
    if side.distinct:
        merged = merged.unionByName(_distinct_events(frame, side), allowMissingColumns=True)
    if asked is not None:
        merged = merged.unionByName(
            asked.select(
                F.col("account"), _bucket(F.col("second")).alias("bucket"),
                F.col("second").alias("pos"), F.lit(1).alias("asked"),
            ),
            allowMissingColumns=True,
        )
    # What is there besides the seconds has its place already and is neither added nor taken back.
    events = _events(side)
    if "pos" in merged.columns:
        merged = merged.withColumnRenamed("pos", "at")
        placed = F.struct(F.col("at"), *[F.lit(0)] * 3).cast(_EVENT)
        events = F.when(F.col("at").isNotNull(), F.array(placed)).otherwise(events)
    reported = F.col("own") == 1 if asked is None else F.col("asked").isNotNull()
    spelled = merged.repartition("account", "bucket").select("*", F.inline(events)).withColumn("reported", reported)
    day, hour = F.col("day"), F.col("hour")
    added = {"n": day * F.col("n")}
    added |= {name: day * F.col(name) for name in ("s0", "s1")}
    if side.deviation:
        added |= {name: day * F.col(name) for name in _SQUARES}
    if side.hourly:
        added |= {f"h{name}": hour * F.col(name) for name in ("n", "s0", "s1")}
    added |= {f"d_{stem}": F.col(f"d_{stem}") for stem in side.distinct}
    changes = [F.coalesce(value, F.lit(0).cast("long")).alias(name) for name, value in added.items()]
    if side.extremes:
        for name in ("max", "min"):
            changes += [F.when(F.col("own") == 1, F.col(name)).alias(f"{name}_here")]
            changes += [F.when(day == -1, F.col(name)).alias(f"{name}_before")]
    per_bucket = Window.partitionBy("account", "bucket")
    # One event at most is reported at a time; the forward pass has it behind all others of its time,
    # the backward pass before them, as there only what leaves later counts.
    start = (Window.unboundedPreceding, Window.currentRow)
    forward = per_bucket.orderBy("pos", "reported").rowsBetween(*start)
    backward = per_bucket.orderBy(F.col("pos").desc(), F.col("reported").desc()).rowsBetween(*start)
    running = {name: F.sum(name).over(forward) for name in added}
    if side.extremes:
        running["max"] = F.greatest(F.max("max_here").over(forward), F.max("max_before").over(backward))
        running["min"] = F.least(F.min("min_here").over(forward), F.min("min_before").over(backward))
    return (
        spelled.select("account", "bucket", "pos", "reported", *changes)
        .select(
            "account", "pos", "reported", *[total.alias(f"_{name}") for name, total in running.items()]
        )
        .where("reported")
        .select(
            F.col("account").alias(side.account),
            F.col("pos").alias("ts_unix"),
            *_finish(side, {name: F.col(f"_{name}") for name in running}),
        )
    )


def add_trailing(frame: DataFrame, side: TrailingSide, base: DataFrame) -> DataFrame:
    """Append the statistics of one side to ``frame``.

    ``base`` holds the same rows without earlier features: accounts are summarised from it, so
    that features computed before are not computed again. One row per account and second meets
    the rows of that second, so a large account is spread over its seconds.
    """
    return frame.join(per_second(base, side), [side.account, "ts_unix"])


def add_counterpart(frame: DataFrame, side: TrailingSide, account: str, base: DataFrame) -> DataFrame:
    """Append the statistics of ``side`` of the account in column ``account``, at the row's second.

    With the receiving side and the sender's column: what the sender itself took in before it
    sent. An account without such rows has counts and sums of zero.
    """
    asked = frame.select(F.col(account).alias("account"), F.col("ts_unix").alias("second")).distinct()
    found = per_second(base, side, asked).withColumnRenamed(side.account, account)
    return frame.join(found, [account, "ts_unix"])
