import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import metrics, ranking
from ledgerlens.operators.skew import fit_slots

SCHEMA = "transaction_id long, is_fraud int, score double"


def frame(spark, y, s, parts=4):
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def random_case(seed, n=1000):
    """Half of the scores are one value, a few others repeat."""
    chance = random.Random(seed)
    y = [int(chance.random() < 0.1) for _ in range(n)]
    s = [0.25 if chance.random() < 0.5 else round(chance.random() + 0.3 * a, 2 if chance.random() < 0.5 else 9) for a in y]
    return y, s


def ranked(y, s):
    """(ids in rank order, cumulative positives)"""
    order = sorted(range(len(y)), key=lambda i: (-s[i], i))
    return order, np.cumsum([y[i] for i in order])


def points(y, s):
    """Threshold, tp and fp per distinct score from high to low."""
    out, tp, fp = [], 0, 0
    for score in sorted(set(s), reverse=True):
        hits = [a for a, b in zip(y, s) if b == score]
        tp, fp = tp + sum(hits), fp + len(hits) - sum(hits)
        out.append((score, tp, fp))
    return out


def brute_ap(y, s):
    total, before = 0.0, 0
    for _, tp, fp in points(y, s):
        total += (tp - before) / sum(y) * tp / (tp + fp)
        before = tp
    return total


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a]
    neg = [b for a, b in zip(y, s) if not a]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def thinned(n, k=300):
    return [int(i) for i in np.linspace(0, n - 1, min(k, n)).astype(int)]


def test_hand_case_with_ties(spark):
    df = frame(spark, [0, 1, 0, 1, 1, 0, 0, 1], [0.9, 0.9, 0.8, 0.7, 0.4, 0.4, 0.2, 0.1])
    assert metrics.average_precision(df).first()[0] == pytest.approx(0.5)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.4375)


def test_perfect_ranking(spark):
    row = metrics.evaluate(frame(spark, [0, 0, 0, 1, 1], [0.1, 0.2, 0.3, 0.9, 0.95])).first()
    assert row["roc_auc"] == 1.0 and row["pr_auc"] > 0.99


def test_cost_threshold_of_separable_scores(spark):
    df = frame(spark, [0, 0, 0, 1, 1, 1], [0.05, 0.2, 0.4, 0.6, 0.8, 0.9])
    row = metrics.cost_threshold(df, metrics.Costs(100.0, 1.0)).first()
    assert row["total_cost"] == 0.0 and row["threshold"] == 0.6


def test_at_least_one_row_is_flagged(spark):
    """Where every alert is wrong the cheapest choice still flags one row."""
    y, s = [0] * 50 + [1], [float(i) for i in range(51, 0, -1)]
    row = metrics.cost_threshold(frame(spark, y, s), metrics.Costs(10.0, 5.0)).first()
    assert (row["total_cost"], row["flagged"], row["threshold"]) == (15.0, 1, 51.0)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_metrics_equal_brute_force(spark, seed):
    y, s = random_case(seed)
    n, n_pos = len(y), sum(y)
    df = frame(spark, y, s).persist()
    row = metrics.evaluate(df).first()
    assert row["pr_auc"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert metrics.average_precision(df).first()[0] == pytest.approx(row["pr_auc"], abs=1e-12)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(row["roc_auc"], abs=1e-12)

    line = [(0.0, 0.0)] + [(fp / (n - n_pos), tp / n_pos) for _, tp, fp in points(y, s)]
    for target in (0.001, 0.005, 0.01, 0.05):
        wanted = np.interp(target, [a for a, _ in line], [b for _, b in line])
        assert row["recall_at_fpr"][f"recall@fpr={target:.3f}"] == pytest.approx(wanted, abs=1e-12)

    order, tp = ranked(y, s)
    for fraction, key in ((0.001, "precision@top0.1%"), (0.01, "precision@top1%")):
        k = max(1, int(n * fraction))
        assert row["precision_at_k"][key] == pytest.approx(tp[k - 1] / k)
    # by definition: flag the first rows of the ranking, pay for each missed fraud and each false alarm
    cost = []
    for k in range(1, n + 1):
        caught = sum(y[i] for i in order[:k])
        cost.append(200.0 * (n_pos - caught) + 5.0 * (k - caught))
    best = cost.index(min(cost))
    assert row["total_cost"] == cost[best] and row["best_threshold"] == s[order[best]]
    assert (row["n"], row["n_pos"]) == (n, n_pos)

    curve = metrics.cost_curve(df).collect()
    assert [r["flagged"] for r in curve if r["point"] == "curve"] == [i + 1 for i in thinned(n)]
    assert [r["cost_per_txn"] for r in curve if r["point"] == "curve"] == pytest.approx(
        [cost[i] / n for i in thinned(n)]
    )
    assert [r["flagged"] for r in curve if r["point"] == "optimal"] == [best + 1]

    deciles = metrics.decile_lift(df).collect()
    parts = np.array_split(np.array([y[i] for i in order]), 10)
    assert [(r["n"], r["frauds"]) for r in deciles] == [(len(p), p.sum()) for p in parts]
    assert deciles[-1]["cumulative_recall"] == pytest.approx(1.0)

    for r, f in zip(metrics.budget_scan(df).collect(), np.linspace(0.0005, 0.1, 60), strict=True):
        k = max(1, int(n * f))
        assert (r["budget"], r["recall"], r["precision"]) == pytest.approx((k / n, tp[k - 1] / n_pos, tp[k - 1] / k))


@pytest.mark.parametrize("seed", [3, 4])
def test_curves_equal_brute_force(spark, seed):
    y, s = random_case(seed, 2500)
    n_pos, n_neg = sum(y), len(y) - sum(y)
    df = frame(spark, y, s)
    steps = points(y, s)

    rising = [(tp / n_pos, tp / (tp + fp)) for _, tp, fp in reversed(steps)] + [(0.0, 1.0)]
    wanted = [rising[i] for i in thinned(len(rising))]
    found = [(r["recall"], r["precision"]) for r in metrics.pr_curve(df).collect()]
    assert np.allclose(found, wanted)

    tps, fps = [t for _, t, _ in steps], [f for _, _, f in steps]
    bend = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    corners = [(0.0, 0.0)] + [(f / n_neg, t / n_pos) for t, f, b in zip(tps, fps, bend) if b]
    wanted = [corners[i] for i in thinned(len(corners))]
    found = [(r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect()]
    assert np.allclose(found, wanted)


def test_thinning_matches_linspace(spark):
    for n in (1, 2, 299, 300, 301, 599, 600, 1000, 89_701, 1_337_243):
        step = max(1, n // 4000)
        kept = (
            spark.range(n)
            .filter(ranking.evenly_spaced(F.col("id"), F.lit(n), 300))
            .orderBy("id")
            .select("id")
            .collect()
        )
        assert [r[0] for r in kept] == thinned(n), (n, step)


def test_recall_keys_are_reported(spark):
    y, s = random_case(5)
    row = metrics.evaluate(frame(spark, y, s)).first()
    assert set(row["recall_at_fpr"]) == {
        "recall@fpr=0.001", "recall@fpr=0.005", "recall@fpr=0.010", "recall@fpr=0.050"
    }


def test_confusion_counts_ties_at_the_threshold(spark):
    df = frame(spark, [1, 0, 1, 0], [0.5, 0.5, 0.2, 0.1])
    row = metrics.confusion_matrix(df, 0.5).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 1)
    none = metrics.confusion_matrix(df, 9.0).first()
    assert (none["precision"], none["recall"], none["fpr"], none["flagged_frac"]) == (0, 0, 0, 0)


def test_slots_stay_even_when_a_third_of_the_rows_share_a_score(spark):
    n, pieces = 30_000, 16
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("score"),
    )
    df = df.repartition(4).persist()
    value = -F.col("score")
    slots = fit_slots(df, value, F.col("transaction_id"), pieces=pieces)
    placed = slots.assign(df, value, F.col("transaction_id"))
    sizes = [r["count"] for r in placed.groupBy("_slot", "_sub").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / pieces
    # Slots follow the order: no score of a later slot is above one of an earlier slot.
    spans = placed.groupBy("_slot").agg(F.min("score"), F.max("score")).orderBy("_slot").collect()
    assert all(a[1] >= b[2] for a, b in zip(spans, spans[1:]))


def test_ranking_uses_no_single_partition_over_the_rows(spark):
    df = spark.range(5000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 2).cast("int").alias("is_fraud"), F.rand(1).alias("score")
    )
    rows = ranking.rank_scores(df).rows
    order = [r["flagged"] for r in rows.orderBy(F.desc("score"), "transaction_id").collect()]
    assert order == list(range(1, 5001))
    assert math.isclose(rows.agg(F.max("tp")).first()[0], 2500)
