"""Splitting hot groups and totally ordered data into evenly filled pieces.

Two facts keep every task bounded whatever the data looks like:

* at most ``n / share`` keys can hold more than ``share`` rows, so the list of hot
  keys is small by construction and safe to broadcast;
* cutting the order at its ``p`` quantiles leaves about ``n / p`` rows between two
  cuts. A value that alone exceeds that becomes a slot of its own, and its rows
  are cut again by the tie-break column.

Slots depend only on the order columns, so they can be recomputed at any time
with the same result, and walking the slots in order walks the rows in order.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import task_count

# Below this many rows a group is never worth splitting: one task sorts it in seconds.
SMALLEST_HOT_GROUP = 1_000_000
# A group is hot when it holds several times the rows of an average task.
HOT_FACTOR = 5
# Rows sampled per hot key, and per slot, when looking for keys and cuts.
SAMPLED_PER_HOT_KEY = 2_000
SAMPLED_PER_SLOT = 500
SAMPLE_SEED = 7
# A table this short may be broadcast.
BROADCAST_ROWS = 200_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has been counted and has at most ``rows`` rows."""
    return df.count() <= rows


def hot_row_limit(df: DataFrame) -> float:
    """Rows above which a key is hot; infinite for a table too small to have one."""
    total = df.select(*df.columns[:1]).count()
    limit = max(SMALLEST_HOT_GROUP, HOT_FACTOR * total // task_count(df.sparkSession))
    return limit if total > limit else math.inf


def hot_keys(df: DataFrame, keys: list[str], hot_rows: float | None = None) -> DataFrame | None:
    """The key values holding more than ``hot_rows`` rows, or None if there are none.

    The default is ``HOT_FACTOR`` average tasks, so fewer keys than tasks qualify.
    The result is checked and local to the plan: a handful of literal rows.
    """
    narrow = df.select(*keys)
    if hot_rows is None:
        hot_rows = hot_row_limit(narrow)
    if hot_rows == math.inf:
        return None
    # A key worth splitting shows up in a thin sample already; a wrong guess near the
    # limit costs some balance and never a row, and no list of all keys is shuffled.
    fraction = min(1.0, SAMPLED_PER_HOT_KEY / hot_rows)
    seen = narrow if fraction == 1.0 else narrow.sample(fraction, SAMPLE_SEED)
    found = seen.groupBy(*keys).agg(F.count("*").alias("_rows"))
    rows = found.filter(F.col("_rows") > int(hot_rows * fraction)).select(*keys).collect()
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, narrow.schema)


def flag_hot(df: DataFrame, keys: list[str], hot: DataFrame, name: str = "_hot") -> DataFrame:
    """Add a boolean: does the row belong to a hot key? NULL keys count as one key."""
    marks = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(name)))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    joined = df.join(marks, same, "left").drop(*[f"_hot_{k}" for k in keys])
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


@dataclass(frozen=True)
class Slots:
    """Cuts of an order ``(value, tie)`` into slots ``(_slot, _sub)`` of similar size.

    ``tied`` maps a slot that holds a single value to how many shares of all rows it has, and so into how many it is cut by the tie.
    """

    cuts: list[float]
    tied: dict[int, int]
    tie_cuts: list[float]
    totals: dict = field(default_factory=dict)
    prefix: str = ""

    def assign(self, df: DataFrame, value: Column, tie: Column | None = None) -> DataFrame:
        """Add ``_slot`` and ``_sub``; NULL values go to the last slot."""
        placed = _bucket(df, value, self.cuts, "_slot")
        if not self.tied or tie is None:
            return placed.withColumn("_sub", F.lit(0))
        placed = _bucket(placed, tie_number(placed, tie, self.prefix), self.tie_cuts, "_at")
        # one bucket of the tie for each share, so the slots of all values are at most twice the pieces
        shares = F.array(*[F.lit(self.tied.get(slot, 1)) for slot in range(len(self.cuts) + 2)])
        sub = F.floor(F.col("_at") * F.get(shares, F.col("_slot")) / (len(self.tie_cuts) + 2)).cast("int")
        return placed.withColumn("_sub", sub).drop("_at")

    def span(self, slot: int) -> tuple[float, float]:
        """Smallest value of a slot, and the smallest of the next one."""
        edges = [-math.inf, *self.cuts, math.inf]
        return edges[slot], edges[slot + 1] if slot + 1 < len(edges) else math.inf


def fit_slots(
    df: DataFrame,
    value: Column,
    tie: Column | None = None,
    totals: dict[str, Column] | None = None,
    pieces: int | None = None,
) -> Slots:
    """Choose the cuts; ``totals`` are aggregates over all rows wanted on the way.

    Cuts only decide how evenly the slots are filled, so quantiles of a sample are
    enough: a few hundred rows per slot, whatever the size of the table.
    """
    pieces = pieces or task_count(df.sparkSession)
    # all texts between the smallest and the largest share what these two begin with
    text = [F.min(tie).alias("_low"), F.max(tie).alias("_high")] if tie is not None and _is_text(df, tie) else []
    counted = df.agg(F.count("*").alias("_n"), *text, *[c.alias(k) for k, c in (totals or {}).items()])
    counted = counted.first().asDict()
    n, low, high = (counted.pop(k, None) for k in ("_n", "_low", "_high"))
    prefix = os.path.commonprefix([low or "", high or ""])
    shares = [i / pieces for i in range(1, pieces)]
    if not shares or not n:
        return Slots([], {}, [], counted, prefix)

    fraction = min(1.0, SAMPLED_PER_SLOT * pieces / n)
    orders = [value.cast("double").alias("v"), *([] if tie is None else [tie_number(df, tie, prefix).alias("t")])]
    seen = df.select(*orders)
    if fraction < 1.0:
        seen = seen.sample(fraction, SAMPLE_SEED)
    accuracy = max(10_000, 10 * pieces)
    found = seen.agg(
        F.count("*"),
        F.count_if(F.col("v").isNull()),
        *[F.percentile_approx(c, shares, accuracy) for c in seen.columns],
    ).first()
    drawn, nulls = found[:2]
    raw, raw_ties = ([c for c in cuts or [] if math.isfinite(c)] for cuts in [*found[2:], None][:2])

    # A value found at two quantiles holds more than one share: close its slot.
    heavy = {cut: times for cut, times in Counter(raw).items() if times > 1}
    cuts = sorted(set(raw) | {math.nextafter(c, math.inf) for c in heavy})
    tied = {cuts.index(c) + 1: times for c, times in sorted(heavy.items())}
    if nulls * pieces > drawn:
        tied[len(cuts) + 1] = math.ceil(nulls * pieces / drawn)
    return Slots(cuts, tied, sorted(set(raw_ties)), counted, prefix)


def _is_text(df: DataFrame, column: Column) -> bool:
    return df.select(column.alias("c")).dtypes[0][1] == "string"


def tie_number(df: DataFrame, tie: Column, prefix: str) -> Column:
    """A number that never falls as the tie rises: a text counts by the six bytes after what all texts begin with.

    It only decides how evenly slots are filled; rows of one slot are ordered by the tie itself.
    """
    if not _is_text(df, tie):
        return tie.cast("double")
    start = len(prefix.encode("utf-8", "surrogatepass")) + 1
    digits = F.rpad(F.hex(F.substring(tie.cast("binary"), start, 6)), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def _bucket(df: DataFrame, value: Column, cuts: list[float], name: str) -> DataFrame:
    if not cuts:
        # One slot, and one more for NULL when NULLs are split off.
        return df.withColumn(name, F.when(value.isNull(), 1).otherwise(0))
    splits = [-math.inf, *cuts, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="_value", outputCol="_bucket", handleInvalid="keep")
    placed = bucketizer.transform(df.withColumn("_value", value.cast("double")))
    # NULL sorts behind everything, NaN included.
    last = len(cuts) + 1
    bucket = F.when(F.col("_value").isNull(), last).otherwise(F.least(F.col("_bucket"), F.lit(last - 1)))
    return placed.withColumn(name, bucket.cast("int")).drop("_value", "_bucket")
