"""Trees grown on blocks of coded rows, against Spark ML, plain Python and Spark's own hash."""

import math
import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from ledgerlens.operators import boosting, growth, metrics, ranking

SMALL = {"min_rows_per_leaf": 20, "max_depth": 3}


@pytest.fixture(scope="module")
def table(spark):
    """Two numbers, one of them with few values and gaps, and a category; a keys' twice, one id missing."""
    chance = np.random.default_rng(5)
    rows = []
    for i in range(2500):
        a, b, c = float(chance.normal()), float(chance.integers(0, 6)), int(chance.integers(0, 9))
        y = int(chance.random() < 1 / (1 + math.exp(-(1.5 * a + (c in (1, 4, 7)) - 2))))
        rows.append((None if i == 3 else i - i % 50 % 2, y, a, None if i % 7 == 0 else b, f"c{c}"))
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, a double, b double, c string")
    return df.withColumn("ts", F.lit("2019-01-01").cast("timestamp_ntz")).repartition(3).persist()


def test_a_round_draws_by_the_hash_of_spark(spark):
    ids = [0, 1, -1, 7, 2**40 + 3, -(2**62), None]
    df = growth.with_id(spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string"), "id")
    for seed, round_ in ((42, 0), (7, 1499), (-3, 20)):
        draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(round_), "id"), F.lit(1 << 30)) < int(0.5 * (1 << 30))
        found = df.select("_id", draw.alias("draw")).toArrow()
        drawn = growth.drawn_rows(*growth._ids(found.column("_id")), seed, round_, 0.5)
        assert drawn.tolist() == found.column("draw").to_pylist()
    named = growth.with_id(df.drop("_id"), "name").select("_id").distinct()
    assert dict(named.dtypes)["_id"] == "bigint" and named.count() == len(ids)


def _splits(tree):
    """Inner nodes in order; a category is told from its complement by the rows on the left."""
    return [(f, c, None if k is None else tuple(k)) for f, c, k in zip(tree.feature, tree.cut, tree.left_codes, strict=True)]


def test_a_tree_is_that_of_spark_ml(spark, table):
    fitted = boosting.fit_boosted(table, table, columns=["a", "b"], categories=["c"], rounds=1, column_share=1.0, row_share=1.0, **SMALL)
    rows = boosting._table(table, ["a", "b"], fitted.categories)
    marked = F.col("c_code").cast("double").alias("c_code", metadata={"ml_attr": {"type": "nominal", "num_vals": 10}})
    rows = rows.withColumn("c_code", marked).withColumn("g", F.col("is_fraud") - F.lit(1 / (1 + math.exp(-fitted.base))))
    vectors = VectorAssembler(inputCols=fitted.inputs, outputCol="features").transform(rows)
    model = DecisionTreeRegressor(labelCol="g", maxDepth=3, maxBins=64, minInstancesPerNode=20).fit(vectors)
    wanted = []
    for line in model.toDebugString.splitlines()[1:]:
        if line.strip().startswith("Predict"):
            wanted.append((-1, 0.0, None))
        elif found := re.match(r"\s*If \(feature (\d+) (?:<= (\S+)|in \{([^}]*)\})\)", line):
            codes = found[3] and tuple(sorted(int(float(c)) for c in found[3].split(",")))
            wanted.append((int(found[1]), float(found[2] or 0.0), codes))
    assert _splits(fitted.trees[0]) == wanted and len(wanted) >= 9 and any(w[2] for w in wanted)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 64}, {"EXACT_ROWS": 100, "BLOCK_ROWS": 100}, {"EXACT_ROWS": 100, "CUT_ROWS": 400, "DIRECT_TASKS": 1}])
def test_leaves_hold_the_rows_that_reach_them(spark, table, monkeypatch, limits):
    """Whatever the blocks and wherever the cuts come from: newton steps of the drawn rows, and the margins of all."""
    for name, limit in limits.items():
        monkeypatch.setattr(growth, name, limit)
    fitted = boosting.fit_boosted(table, table, columns=["a", "b"], categories=["c"], rounds=4, column_share=0.7, stretch=3, **SMALL)
    rows = boosting._table(table, ["a", "b"], fitted.categories).select("transaction_id", "is_fraud", *fitted.inputs)
    rows = rows.select("*", *[(F.pmod(F.xxhash64(F.lit(42), F.lit(r), "transaction_id"), F.lit(1 << 30)) < int(0.8 * (1 << 30))).alias(f"d{r}") for r in range(4)]).collect()
    margin = [fitted.base] * len(rows)
    for r, tree in enumerate(fitted.trees):
        sums, reached = {}, []
        for row, m in zip(rows, margin, strict=True):
            at = 0
            while tree.feature[at] >= 0:
                x = row[fitted.inputs[tree.feature[at]]]
                left = x in tree.left_codes[at] if tree.left_codes[at] is not None else x <= tree.cut[at]
                at = tree.left[at] if left else tree.right[at]
            reached.append(at)
            if row[f"d{r}"]:
                p = 1 / (1 + math.exp(-m))
                g, h, n = sums.get(at, (0.0, 0.0, 0))
                sums[at] = g + row["is_fraud"] - p, h + p * (1 - p), n + 1
        assert set(sums) == set(tree.leaves) and len(sums) > 2 and min(n for _, _, n in sums.values()) >= 20
        assert all(tree.value[i] == pytest.approx(0.05 * g / (h + 1.0), rel=1e-9) for i, (g, h, _) in sums.items())
        assert all(g > 0 for f, g in zip(tree.feature, tree.gain, strict=True) if f >= 0)
        margin = [m + tree.value[i] for m, i in zip(margin, reached, strict=True)]
    for i in range(1, 5):
        assert metrics.average_precision(fitted.score(table, i)).first()[0] == pytest.approx(fitted.history[i - 1], abs=1e-12)


def test_a_round_is_one_pass_for_each_level(spark, table):
    """Before, a round took some ten jobs of Spark ML, each of which read all inputs as numbers."""
    context, jobs = spark.sparkContext, []
    for rounds in (2, 6):
        context.setJobGroup(f"rounds-{rounds}", "")
        boosting.fit_boosted(table, table, columns=["a", "b"], rounds=rounds, **SMALL)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
        context.setJobGroup("", "")
    assert 0 < jobs[1] - jobs[0] <= 4 * (SMALL["max_depth"] + 1)


def test_cuts_are_shares_of_the_rows():
    few = growth.cuts_between(np.array([0.0, 1.0, 4.0]), np.array([5, 1, 1]), 64)
    assert few.tolist() == [0.5, 2.5]
    assert growth.cuts_between(np.arange(8.0), np.ones(8, dtype=int), 4).tolist() == [1.5, 3.5, 5.5]
    assert growth.cuts_between(np.arange(6.0), np.array([10, 1, 1, 1, 1, 10]), 3).tolist() == [0.5, 4.5]
    assert growth.cuts_between(np.array([2.0]), np.array([9]), 64).tolist() == []


def test_rows_without_numbers_are_refused(spark, table):
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit_boosted(table.limit(0), table, columns=["a"], rounds=1)
    with pytest.raises(Exception, match="NaN"):
        boosting.fit_boosted(table.withColumn("a", F.lit(float("nan"))), table, columns=["a"], rounds=1)


def test_rankings_are_cut_into_slots(spark):
    """Several rankings in pieces and small slots, with a score that most rows share, against the ranking of one table."""
    chance = np.random.default_rng(3)
    scores = {0: chance.normal(size=900).round(2), 1: np.where(chance.random(900) < 0.7, 0.5, chance.normal(size=900)), 2: np.zeros(900), 5: chance.normal(size=900)}
    labels = {k: (chance.random(900) < 0.2).astype(float) if k < 5 else np.zeros(900) for k in scores}
    labels[1][:5] = np.nan
    pieces = spark.sparkContext.parallelize([(k, scores[k][i : i + 200], labels[k][i : i + 200]) for k in scores for i in range(0, 1000, 200)], 3)
    found, counted = metrics.average_precision_by(pieces), pieces.map(ranking.counted_piece)
    slotted = ranking.thresholds_by(counted, slot_scores=64).collect()
    assert len(slotted) > 20
    for k in scores:
        known = [(float(s), int(y)) for s, y in zip(scores[k], labels[k], strict=True) if not math.isnan(y)]
        wanted = metrics.average_precision(spark.createDataFrame(known, "score double, is_fraud int")).first()[0]
        assert found[k] == (None if wanted is None else pytest.approx(wanted, abs=1e-12))
        parts = sorted((p for p in slotted if p[0] == k), key=lambda p: -p[1][0])
        at = np.concatenate([p[1] for p in parts])
        assert (np.diff(at) < 0).all() and len(at) == len(np.unique(scores[k]))
        points = {float(s): (int(tp), int(fp)) for p in parts for s, tp, fp in zip(p[1], p[4], p[5], strict=True)}
        assert all(points[float(s)] == (sum(y for x, y in known if x >= s), sum(1 - y for x, y in known if x >= s)) for s in at[:: max(1, len(at) // 20)])
