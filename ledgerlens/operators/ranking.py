"""Global ranks and cumulative counts of scored rows, without one global task.

Order is score descending, ties by row id. The order is cut into slots of similar
size; each slot ranks its own rows and adds the totals of the slots before it. A
score shared by very many rows becomes a slot of its own, cut again by id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import fit_slots

SLOT = ["_slot", "_sub"]
#: Slots of several rankings one task holds at once.
SLOTS_OF_A_TASK = 16


@dataclass(frozen=True)
class Ranked:
    """Ranked rows, and how many rows and positives there are in all."""

    rows: DataFrame
    n: int
    n_pos: int

    @property
    def n_neg(self) -> int:
        return self.n - self.n_pos


def _so_far(columns: dict[str, Column]) -> dict[str, Column]:
    """Totals of the slots before each slot; runs on one row per slot."""
    before = Window.orderBy(*SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return {name: F.coalesce(F.sum(c).over(before), F.lit(0)) for name, c in columns.items()}


def rank_scores(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
    keep: tuple[str, ...] = (),
    thresholds: bool = False,
) -> Ranked:
    """Rows ``(tie, *keep, label, score, flagged, tp)``.

    ``flagged`` is the 1-based rank, ``tp`` the number of positives down to the row. With ``thresholds`` a row also has those of its score:
    ``pos`` positives, and ``end_tp`` positives and ``end_fp`` others at or above it. All of it needs one shuffle of the rows.
    """
    rows = df.select(
        tie, *keep, F.col(label).cast("int").alias("label"), F.col(score).cast("double").alias("score")
    )
    value = -F.col("score")
    slots = fit_slots(rows, value, F.col(tie), {"n": F.count("*"), "n_pos": F.sum("label")})
    placed = slots.assign(rows, value, F.col(tie))
    per_slot = placed.groupBy(*SLOT).agg(F.count("*").alias("_n"), F.sum("label").alias("_pos"))
    carried = _so_far({"_n0": F.col("_n"), "_p0": F.col("_pos")})
    whole = Window.partitionBy("_slot")
    upto = Window.orderBy("_slot").rangeBetween(Window.unboundedPreceding, 0)
    if thresholds:
        # a score that is cut into several slots ends with the last of them
        carried |= {"_all": F.sum("_pos").over(whole), "_n1": F.sum("_n").over(upto), "_p1": F.sum("_pos").over(upto)}
    carry = per_slot.select(*SLOT, *[c.alias(n) for n, c in carried.items()])
    in_slot = Window.partitionBy(*SLOT).orderBy(value.asc_nulls_last(), F.col(tie))
    in_slot_order = Window.partitionBy(*SLOT).orderBy(value.asc_nulls_last())
    down_to = in_slot.rowsBetween(Window.unboundedPreceding, 0)
    # Ranked inside the slot first: the join then finds the rows already in place.
    local = placed.withColumns(
        {"_at": F.row_number().over(in_slot).cast("long"), "_tp": F.sum("label").over(down_to)}
    )
    ends = []
    if thresholds:
        with_ties = in_slot_order.rangeBetween(Window.unboundedPreceding, 0)
        local = local.withColumns({"_end": F.count("*").over(with_ties), "_end_tp": F.sum("label").over(with_ties)})
        local = local.withColumn("_own", F.sum("label").over(Window.partitionBy(*SLOT, "score")))
        cut = F.col("_slot").isin(list(slots.tied))
        end, end_tp = F.when(cut, F.col("_n1")).otherwise(F.col("_end") + F.col("_n0")), F.when(cut, F.col("_p1")).otherwise(F.col("_end_tp") + F.col("_p0"))
        ends = [F.when(cut, F.col("_all")).otherwise(F.col("_own")).alias("pos"), end_tp.alias("end_tp"), (end - end_tp).alias("end_fp")]
    ranked = local.join(F.broadcast(carry), SLOT).select(
        tie,
        *keep,
        "label",
        "score",
        (F.col("_at") + F.col("_n0")).alias("flagged"),
        (F.col("_tp") + F.col("_p0")).alias("tp"),
        *ends,
    )
    return Ranked(ranked, slots.totals["n"], slots.totals["n_pos"] or 0)


def thresholds(df: DataFrame, score: str = "score", label: str = "is_fraud") -> Ranked:
    """One row per distinct score, from high to low, ties resolved.

    ``pos``/``neg`` count the score's own rows, ``tp``/``fp`` all rows at or above it.
    ``place`` is the 1-based position of the threshold and ``places`` their number;
    ``next_pos``/``next_neg`` belong to the next lower score (NULL at the end).
    """
    rows = df.select(F.col(label).cast("int").alias("label"), F.col(score).cast("double").alias("score"))
    value = -F.col("score")
    slots = fit_slots(rows, value, totals={"n": F.count("*"), "n_pos": F.sum("label")})
    # Equal scores shrink to one row before they are shuffled.
    grouped = rows.groupBy("score").agg(
        F.sum("label").alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    placed = slots.assign(grouped, value)
    per_slot = placed.groupBy(*SLOT).agg(
        F.count("*").alias("_m"),
        F.sum("pos").alias("_pos"),
        F.sum("neg").alias("_neg"),
        F.max_by("pos", "score").alias("_first_pos"),
        F.max_by("neg", "score").alias("_first_neg"),
    )
    in_order = Window.orderBy(*SLOT)
    carry = per_slot.select(
        *SLOT,
        F.sum("_m").over(Window.partitionBy()).alias("places"),
        F.lead("_first_pos").over(in_order).alias("_next_pos"),
        F.lead("_first_neg").over(in_order).alias("_next_neg"),
        *[
            c.alias(n)
            for n, c in _so_far({"_m0": F.col("_m"), "_p0": F.col("_pos"), "_q0": F.col("_neg")}).items()
        ],
    )
    in_slot = Window.partitionBy(*SLOT).orderBy(value.asc_nulls_last())
    down_to = in_slot.rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns(
        {
            "_tp": F.sum("pos").over(down_to),
            "_fp": F.sum("neg").over(down_to),
            "_at": F.row_number().over(in_slot).cast("long"),
            "_pos": F.lead("pos").over(in_slot),
            "_neg": F.lead("neg").over(in_slot),
        }
    )
    points = local.join(carry, SLOT).select(
        *SLOT,
        "score",
        "pos",
        "neg",
        (F.col("_tp") + F.col("_p0")).alias("tp"),
        (F.col("_fp") + F.col("_q0")).alias("fp"),
        (F.col("_at") + F.col("_m0")).alias("place"),
        "places",
        F.coalesce("_pos", "_next_pos").alias("next_pos"),
        F.coalesce("_neg", "_next_neg").alias("next_neg"),
    )
    return Ranked(points, slots.totals["n"], slots.totals["n_pos"] or 0)


def _counted(scores: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores from high to low, with the positives and negatives of each."""
    order = np.argsort(-scores)
    scores = scores[order]
    starts = np.flatnonzero(np.append(True, scores[1:] != scores[:-1])) if len(scores) else order
    return scores[starts], *[np.add.reduceat(c[order], starts) if len(starts) else c for c in (pos, neg)]


def counted_piece(piece: tuple) -> tuple:
    """``key, scores, pos, neg`` of ``key, scores, labels``, one item for each distinct score; a missing label counts as none."""
    key, scores, labels = piece
    pos = np.where(np.isnan(labels), 0, labels).astype(np.int32)
    return key, *_counted(np.asarray(scores), pos, (labels == 0).astype(np.int32))


def _marks(piece: tuple, most: int = 32) -> tuple:
    """Up to ``most`` evenly spaced scores of a piece, each for an equal share of them."""
    key, scores, *_ = piece
    return key, len(scores), scores[np.linspace(0, len(scores) - 1, min(most, len(scores))).astype(int)] if len(scores) else scores


def _slotted(piece: tuple, bounds: dict) -> list[tuple]:
    key, scores, pos, neg = piece
    ends = np.searchsorted(-scores, -bounds[key], "left")
    pieces = zip(*[np.split(c, ends) for c in (scores, pos, neg)], strict=True)
    return [((key, slot), part) for slot, part in enumerate(pieces) if len(part[0])]


def _slot_totals(parts) -> list[tuple]:
    totals: dict[tuple, list] = {}
    for at, (_, pos, neg) in parts:
        held = totals.setdefault(at, [0, 0])
        held[0], held[1] = held[0] + int(pos.sum()), held[1] + int(neg.sum())
    return list(totals.items())


def _thresholds_of(parts, before: dict) -> list[tuple]:
    slots: dict[tuple, list] = {}
    for at, part in parts:
        slots.setdefault(at, []).append(part)
    for at in list(slots):
        scores, pos, neg = _counted(*[np.concatenate(c) for c in zip(*slots.pop(at), strict=True)])
        tp, fp = before.get(at, (0, 0))
        yield at[0], scores, pos, neg, np.cumsum(pos, dtype=np.int64) + tp, np.cumsum(neg, dtype=np.int64) + fp


def thresholds_by(counted: RDD, slot_scores: int = 1 << 17) -> RDD:
    """Distinct scores of several rankings: ``key, scores, pos, neg`` and ``tp`` and ``fp`` at or above each, as arrays.

    ``counted`` holds each ranking in pieces as ``counted_piece`` gives them, so equal scores of a piece are one before they move. Each key is cut at marks of its
    order into slots of about ``slot_scores``, and one task ranks a slot and adds the totals before it.
    """
    marks: dict = {}
    for key, n, found in counted.map(_marks).collect():
        marks.setdefault(key, []).append((n, found))
    bounds = {}
    for key, found in marks.items():
        scores = np.concatenate([m for _, m in found])
        shares = np.concatenate([np.full(len(m), n / max(len(m), 1)) for n, m in found])
        order = np.argsort(-scores, kind="stable")
        reached, slots = np.cumsum(shares[order]), -(-sum(n for n, _ in found) // slot_scores)
        at = np.searchsorted(reached, reached[-1] * np.arange(1, slots) / slots) if slots > 1 else []
        bounds[key] = np.unique(scores[order][at])[::-1] if slots > 1 else scores[:0]
    parts = counted.flatMap(partial(_slotted, bounds=bounds))
    before: dict = {}
    if any(len(b) for b in bounds.values()):
        totals: dict[tuple, list] = {}
        for at, (pos, neg) in parts.mapPartitions(_slot_totals).collect():
            held = totals.setdefault(at, [0, 0])
            held[0], held[1] = held[0] + pos, held[1] + neg
        so_far: dict = {}
        for at in sorted(totals):
            before[at] = so_far.get(at[0], (0, 0))
            so_far[at[0]] = (before[at][0] + totals[at][0], before[at][1] + totals[at][1])
    numbers = {at: i for i, at in enumerate((key, slot) for key, b in bounds.items() for slot in range(len(b) + 1))}
    tasks = max(1, min(len(numbers), max(counted.context.defaultParallelism, -(-len(numbers) // SLOTS_OF_A_TASK))))
    return parts.partitionBy(tasks, numbers.__getitem__).mapPartitions(partial(_thresholds_of, before=before))


def renumber(points: DataFrame) -> DataFrame:
    """Number what a filter left of ``thresholds`` again: new ``place`` and ``places``."""
    per_slot = points.groupBy(*SLOT).agg(F.count("*").alias("_m"))
    carry = per_slot.select(
        *SLOT,
        F.sum("_m").over(Window.partitionBy()).alias("places"),
        *[c.alias(n) for n, c in _so_far({"_m0": F.col("_m")}).items()],
    )
    in_slot = Window.partitionBy(*SLOT).orderBy("place")
    local = points.drop("places").withColumn("_at", F.row_number().over(in_slot).cast("long"))
    numbered = local.join(carry, SLOT)
    return numbered.withColumn("place", F.col("_at") + F.col("_m0")).drop("_at", "_m0")


def evenly_spaced(index: Column, total: Column, points: int) -> Column:
    """True for the 0-based rows that thin ``total`` rows to ``points`` evenly spaced ones.

    Row ``i`` of the thinned curve is row ``trunc(i * (total - 1) / (points - 1))``.
    """
    step = (total - 1).cast("double") / F.lit(float(points - 1))
    nearest = F.floor(index / step)

    def hit(i: Column) -> Column:
        return (F.floor(i * step) == index) & (i <= points - 2)

    return (total <= points) | (index == total - 1) | hit(nearest) | hit(nearest + 1)
