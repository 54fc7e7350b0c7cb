"""Strictly-prior behaviour per card, merchant and (card, merchant).

Order is ``(ts, transaction_id)`` with NULL times last; a row never sees itself or
anything later. Without hot keys these are plain windows, and applied in the order
merchant, card, both they cost one shuffle by merchant and one by card (the pair
window rides on the card shuffle).

A hot key would put its whole history into one task. Its rows are cut into time
slots instead: each slot runs the same window on its own rows, and what came
before the slot is added from a table with one row per key and slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import checkpointed
from .skew import Slots, fit_slots, fits_broadcast, flag_hot, hot_keys, hot_row_limit

SLOT = ["_slot", "_sub"]


def _order(ts: str, tie: str) -> list[Column]:
    return [F.col(ts).asc_nulls_last(), F.col(tie)]


def _before(partition: list[str], ts: str, tie: str):
    """All earlier rows of the partition."""
    return (
        Window.partitionBy(*partition)
        .orderBy(*_order(ts, tie))
        .rowsBetween(Window.unboundedPreceding, -1)
    )


@dataclass(frozen=True)
class Split:
    """Hot values of ``keys`` and the cuts of their time order.

    ``source`` holds the rows as they were before any window was added, so that
    planning and carrying read no more than the key, the order and the amount.
    """

    source: DataFrame
    keys: list[str]
    ts: str
    tie: str
    hot: DataFrame
    slots: Slots

    def place(self, df: DataFrame) -> DataFrame:
        """Add ``_hot`` and the time slot; rows of other keys are in slot 0."""
        placed = self.slots.assign(
            flag_hot(df, self.keys, self.hot), C.epoch_seconds(F.col(self.ts)), F.col(self.tie)
        )
        return placed.withColumns({name: F.when(F.col("_hot"), F.col(name)).otherwise(0) for name in SLOT})

    def hot_rows(self) -> DataFrame:
        return self.place(self.source).filter("_hot")


def plan_split(
    df: DataFrame, keys: list[str], ts: str, tie: str, hot_rows: float | None = None
) -> Split | None:
    """How to cut the hot values of ``keys``; None if there are none."""
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return None
    rows = flag_hot(df, keys, hot).filter("_hot")
    return Split(df, keys, ts, tie, hot, fit_slots(rows, C.epoch_seconds(F.col(ts)), F.col(tie)))


def _attach_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Join what happened before each slot; cold rows find nothing and keep NULL.

    The carry is a written checkpoint, so counting it to decide on a broadcast
    does not compute it twice.
    """
    on = [*keys, *SLOT]
    renamed = checkpointed(
        carry.select(
            *[F.col(k).alias(f"_c_{k}") for k in on],
            *[c for c in carry.columns if c not in on],
        )
    )
    if fits_broadcast(renamed):
        renamed = F.broadcast(renamed)
    same = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in on]
    return df.join(renamed, same, "left").drop(*[f"_c_{k}" for k in on])


def with_prior_count(
    df: DataFrame,
    keys: list[str],
    name: str,
    ts: str = "ts",
    tie: str = "transaction_id",
    hot_rows: float | None = None,
) -> DataFrame:
    """Number of earlier rows with the same ``keys``."""
    return _prior_count(df, keys, name, ts, tie, plan_split(df, keys, ts, tie, hot_rows))


def _prior_count(df: DataFrame, keys: list[str], name: str, ts: str, tie: str, split: Split | None) -> DataFrame:
    if split is None:
        return df.withColumn(name, F.count("*").over(_before(keys, ts, tie)))
    local = split.place(df).withColumn(name, F.count("*").over(_before([*keys, *SLOT], ts, tie)))
    per_slot = split.hot_rows().groupBy(*keys, *SLOT).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(*SLOT).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slot.select(*keys, *SLOT, F.sum("_n").over(earlier).alias("_carry_n"))
    return (
        _attach_carry(local, carry, keys)
        .withColumn(name, F.col(name) + F.coalesce("_carry_n", F.lit(0)))
        .drop("_carry_n", "_hot", *SLOT)
    )


def with_card_history(
    df: DataFrame,
    key: str = "card_id",
    ts: str = "ts",
    tie: str = "transaction_id",
    amount: str = "amount",
    hot_rows: float | None = None,
) -> DataFrame:
    """Prior count, mean, population deviation and maximum of the amount, and the previous time.

    Mean, deviation and maximum are NULL on the first row of a card.
    """
    return _card_history(df, key, ts, tie, amount, plan_split(df, [key], ts, tie, hot_rows))


def _card_history(
    df: DataFrame, key: str, ts: str, tie: str, amount: str, split: Split | None
) -> DataFrame:
    rows = df if split is None else split.place(df)
    partition = [key] if split is None else [key, *SLOT]
    before = _before(partition, ts, tie)
    in_order = Window.partitionBy(*partition).orderBy(*_order(ts, tie))
    windows = {
        "card_prior_txn_count": F.count("*").over(before),
        "card_prior_avg_amount": F.avg(amount).over(before),
        # a constant history deviates by exactly nothing, whatever the rounding
        "card_prior_std_amount": F.when(
            F.max(amount).over(before) == F.min(amount).over(before), F.lit(0.0)
        ).otherwise(F.stddev_pop(amount).over(before)),
        "card_prior_max_amount": F.max(amount).over(before),
        "card_prev_ts": F.lag(ts).over(in_order),
    }
    if split is None:
        return rows.withColumns(windows)

    extra = {"_min": F.min(amount).over(before), "_known": F.count(amount).over(before)}
    local = rows.withColumns({**windows, **extra})
    joined = _attach_carry(local, _card_carry(split.hot_rows(), key, ts, amount), [key])
    return _add_carry(joined).drop("_hot", *SLOT, "_min", "_known", *[f"_carry_{c}" for c in _CARRIED])


_CARRIED = ["n", "known", "avg", "m2", "max", "min", "prev"]


def _card_carry(hot_rows: DataFrame, key: str, ts: str, amount: str) -> DataFrame:
    """Per hot card and slot: the statistics of everything before the slot.

    Squared deviations are combined around the mean of the card, which keeps the
    sums small, and not around zero.
    """
    per_slot = hot_rows.groupBy(key, *SLOT).agg(
        F.count("*").alias("n"),
        F.count(amount).alias("known"),
        F.avg(amount).alias("avg"),
        F.var_pop(amount).alias("var"),
        F.max(amount).alias("max"),
        F.min(amount).alias("min"),
        F.max(ts).alias("last"),
        F.count_if(F.col(ts).isNull()).alias("timeless"),
    )
    whole = Window.partitionBy(key)
    in_order = whole.orderBy(*SLOT)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    centred = per_slot.withColumn(
        "centre", F.sum(F.col("avg") * F.col("known")).over(whole) / F.sum("known").over(whole)
    ).withColumn("off", F.col("avg") - F.col("centre"))
    known = F.sum("known").over(earlier)
    shift = F.sum(F.col("known") * F.col("off")).over(earlier) / F.nullif(known, F.lit(0))
    squares = F.sum(F.col("known") * (F.col("var") + F.col("off") * F.col("off"))).over(earlier)
    # NULL times sort last, so the last row of a slot is timeless if any row is.
    last = F.when(F.col("timeless") == 0, F.col("last"))
    return centred.select(
        key,
        *SLOT,
        F.sum("n").over(earlier).alias("_carry_n"),
        known.alias("_carry_known"),
        (F.col("centre") + shift).alias("_carry_avg"),
        F.greatest(squares - known * shift * shift, F.lit(0.0)).alias("_carry_m2"),
        F.max("max").over(earlier).alias("_carry_max"),
        F.min("min").over(earlier).alias("_carry_min"),
        F.lag(last).over(in_order).alias("_carry_prev"),
    )


def _add_carry(df: DataFrame) -> DataFrame:
    """Merge the statistics before the slot with those before the row inside the slot."""
    zero = F.lit(0)
    n_here, n_there = F.col("_known"), F.coalesce("_carry_known", zero)
    n_both = n_here + n_there
    gap = F.col("card_prior_avg_amount") - F.col("_carry_avg")
    mean = F.col("_carry_avg") + gap * n_here / n_both
    m2 = (
        F.col("_carry_m2")
        + F.col("card_prior_std_amount") * F.col("card_prior_std_amount") * n_here
        + gap * gap * n_here * n_there / n_both
    )
    highest = F.greatest("card_prior_max_amount", "_carry_max")
    lowest = F.least("_min", "_carry_min")
    # A constant history deviates by exactly nothing, whatever the rounding.
    deviation = F.when(highest == lowest, F.lit(0.0)).otherwise(F.sqrt(m2 / n_both))
    carried_only = F.when(highest == lowest, F.lit(0.0)).otherwise(F.sqrt(F.col("_carry_m2") / n_there))

    def merged(here: Column, there: Column, both: Column) -> Column:
        return F.when(n_there == 0, here).when(n_here == 0, there).otherwise(both)

    return df.withColumns(
        {
            "card_prev_ts": F.when(F.col("card_prior_txn_count") == 0, F.col("_carry_prev")).otherwise(
                F.col("card_prev_ts")
            ),
            "card_prior_txn_count": F.col("card_prior_txn_count") + F.coalesce("_carry_n", zero),
            "card_prior_avg_amount": merged(F.col("card_prior_avg_amount"), F.col("_carry_avg"), mean),
            "card_prior_std_amount": merged(F.col("card_prior_std_amount"), carried_only, deviation),
            "card_prior_max_amount": highest,
        }
    )


def with_history(
    df: DataFrame,
    card: str = "card_id",
    merchant: str = "merchant_id",
    ts: str = "ts",
    tie: str = "transaction_id",
    amount: str = "amount",
    hot_rows: float | None = None,
) -> DataFrame:
    """All prior-behaviour columns, in the window order that shuffles least."""
    if hot_rows is None:
        hot_rows = hot_row_limit(df)
    merchants = plan_split(df, [merchant], ts, tie, hot_rows)
    cards = plan_split(df, [card], ts, tie, hot_rows)
    pairs = None
    if merchants and cards:
        # A pair can only be hot where both of its sides are.
        both = flag_hot(flag_hot(df, [merchant], merchants.hot).filter("_hot").drop("_hot"), [card], cards.hot)
        hot_pairs = hot_keys(both.filter("_hot"), [card, merchant], hot_rows)
        if hot_pairs is not None:
            rows = flag_hot(df, [card, merchant], hot_pairs).filter("_hot")
            slots = fit_slots(rows, C.epoch_seconds(F.col(ts)), F.col(tie))
            pairs = Split(df, [card, merchant], ts, tie, hot_pairs, slots)
    rows = _prior_count(df, [merchant], "merchant_prior_count", ts, tie, merchants)
    rows = _card_history(rows, card, ts, tie, amount, cards)
    return _prior_count(rows, [card, merchant], "card_merchant_prior_count", ts, tie, pairs)
