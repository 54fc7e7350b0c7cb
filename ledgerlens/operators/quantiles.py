"""Exact order statistics without holding a group in one task.

Rows are counted per slot of the value order; only the slots a wanted position
falls into are opened, and there only their distinct values are put in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .skew import fit_slots

MOST_LITERALS = 10_000
#: Accuracy of the sketch: a position is known to one in so many of all rows. Groups that quantiles are taken of.
ACCURACY = 100_000
MOST_GROUPS = 1_000


def kth_values(
    df: DataFrame,
    value: str,
    wanted: Callable[[Column], dict[str, Column]],
    by: tuple[str, ...] = (),
) -> DataFrame:
    """The values at 0-based positions of the sorted non-NULL ``value`` per group.

    ``wanted`` maps the group's row count to named positions. Result: one row
    ``(*by, name, value, total)`` per group and name.
    """
    rows = df.select(*by, value).filter(F.col(value).isNotNull())
    timed = dict(df.dtypes)[value].startswith("timestamp")
    number = C.epoch_seconds(F.col(value)) if timed else F.col(value)
    # Distinct values are counted before anything is shuffled, so ties cost nothing.
    slots = fit_slots(rows, number)
    placed = slots.assign(rows, number)

    per_slot = placed.groupBy(*by, "_slot").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_slot.select(
        *by,
        "_slot",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("total"),
    )
    positions = F.array(
        *[
            F.struct(F.lit(name).alias("name"), at.cast("long").alias("at"))
            for name, at in wanted(F.col("total")).items()
        ]
    )
    targets = (
        spans.withColumn("_target", F.explode(positions))
        .select("*", "_target.*")
        .filter((F.col("at") >= F.col("_before")) & (F.col("at") < F.col("_before") + F.col("_n")))
        .select(*by, "_slot", "name", "total", (F.col("at") - F.col("_before")).alias("_offset"))
    )
    # A row per wanted value. As long as they are few they become literals of the plan,
    # and rows outside the wanted slots do not pass the scan.
    first = targets.limit(MOST_LITERALS + 1).collect()
    if len(first) <= MOST_LITERALS:
        targets = F.broadcast(df.sparkSession.createDataFrame(first, targets.schema))
        spans_wanted = [slots.span(slot) for slot in sorted({r["_slot"] for r in first})]
        placed = slots.assign(rows.filter(_near(value, spans_wanted, timed)), number)
    opened = placed.groupBy(*by, "_slot", value).agg(F.count("*").alias("_times"))
    upto = Window.partitionBy(*by, "_slot").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counted = opened.withColumn("_end", F.sum("_times").over(upto))
    found = counted.join(targets, [*by, "_slot"]).filter(
        (F.col("_offset") < F.col("_end")) & (F.col("_offset") >= F.col("_end") - F.col("_times"))
    )
    return found.select(*by, "name", F.col(value).alias("value"), "total")


def _near(value: str, spans: list[tuple[float, float]], timed: bool) -> Column:
    """Plain ranges around the spans, which reach the Parquet scan.

    They may let neighbours through (times get a margin for rounding); the slot
    number decides in the end.
    """

    def literal(edge: float, margin: int) -> Column:
        if not timed:
            return F.lit(edge)
        return C.naive_instant(datetime(1970, 1, 1) + timedelta(seconds=edge, milliseconds=margin))

    near = F.lit(False)
    for low, high in spans:
        inside = F.lit(True)
        if math.isfinite(low):
            inside = inside & (F.col(value) >= literal(low, -1))
        if math.isfinite(high):
            inside = inside & (F.col(value) <= literal(high, 1))
        near = near | inside
    return near


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: tuple[str, ...] = (),
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, one column each, one row per group, and the aggregates ``more`` over all rows of the group.

    Two passes. The first takes the counts and, from a mergeable sketch, two values that surely enclose each wanted position. The second counts the rows between
    those values one by one, a few hundred-thousandths of all rows, and all other rows by where they lie. Groups are few: they become literals of the plan. Missing and NaN values are left out.
    """
    x = F.col(value).cast("double")
    held = F.when(~F.isnan(x), x)
    margin = 3.0 / ACCURACY
    asked = sorted({min(1.0, max(0.0, q + side)) for q in quantiles.values() for side in (-margin, margin)})
    first = df.groupBy(*by).agg(
        F.count(held).alias("_total"), F.min(held).alias("_least"), F.max(held).alias("_most"), F.percentile_approx(held, asked, ACCURACY).alias("_near"),
        *[c.alias(k) for k, c in (more or {}).items()],
    )
    kept = first.drop("_least", "_most", "_near")
    groups = first.collect()
    if len(groups) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    same = lambda row: F.lit(True) if not by else _all(F.col(k).eqNullSafe(F.lit(row[k])) for k in by)
    place, fine = F.lit(None).cast("int"), F.lit(False)
    for row in groups:
        if not row["_total"]:
            continue
        at = dict(zip(asked, row["_near"], strict=True))
        spans = []
        for q in quantiles.values():
            # fewer rows than the sketch can tell apart are all counted one by one
            low, high = (q - margin, q + margin) if row["_total"] > ACCURACY else (0.0, 1.0)
            spans.append((row["_least"] if low <= 0 else at[low], row["_most"] if high >= 1 else at[high]))
        edges = sorted({e for span in spans for e in span})
        here = sum((F.when(held > e, 2).when(held == e, 1).otherwise(0) for e in edges), F.lit(0))
        place = F.when(same(row), here).otherwise(place)
        inside = F.lit(False)
        for low, high in spans:
            inside = inside | ((held >= low) & (held <= high))
        fine = F.when(same(row), inside).otherwise(fine)
    counted = (
        df.select(*by, held.alias("_x"), place.alias("_place"), fine.alias("_fine")).filter(F.col("_x").isNotNull())
        .groupBy(*by, "_place", F.when(F.col("_fine"), F.col("_x")).alias("_value")).agg(F.count("*").alias("_n"))
    )
    upto = Window.partitionBy(*by).orderBy("_place", "_value").rowsBetween(Window.unboundedPreceding, 0)
    ends = counted.withColumn("_end", F.sum("_n").over(upto)).withColumn("_begin", F.col("_end") - F.col("_n"))
    keys = [F.col(k).alias(f"_by_{k}") for k in by]
    totals = F.broadcast(kept.sparkSession.createDataFrame([tuple(r[c] for c in kept.columns) for r in groups], kept.schema).select(*keys, *[c for c in kept.columns if c not in by]))
    joined = totals.join(ends, _all(F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by), "left") if by else totals.join(ends, F.lit(True), "left")

    def at_place(place: Column) -> Column:
        return F.max(F.when((F.col("_begin") <= place) & (place < F.col("_end")), F.col("_value")))

    found = {}
    for name, q in quantiles.items():
        spot = (F.col("_total") - 1).cast("double") * F.lit(q)
        found[f"_{name}_low"], found[f"_{name}_high"] = at_place(F.floor(spot)), at_place(F.ceil(spot))
    names = [c for c in kept.columns if c not in by]
    wide = joined.groupBy(*[f"_by_{k}" for k in by], *names).agg(*[c.alias(k) for k, c in found.items()])
    results = []
    for name, q in quantiles.items():
        spot = (F.col("_total") - 1).cast("double") * F.lit(q)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return wide.select(*[F.col(f"_by_{k}").alias(k) for k in by], *(more or {}), *results)


def _all(conditions) -> Column:
    found = F.lit(True)
    for condition in conditions:
        found = found & condition
    return found
