import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import anomaly, boosting, categories, matrix, metrics, supervised


@pytest.fixture(scope="module")
def points(spark):
    """Two clusters, exact copies among them, and a far outlier."""
    chance = np.random.default_rng(5)
    data = np.vstack([chance.normal(0, 1, (150, 3)), chance.normal(6, 0.5, (100, 3)), [[40.0, 40.0, 40.0]]])
    data[10] = data[11]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(data)]
    return data, spark.createDataFrame(rows, "id long, x array<double>").repartition(4).persist()


def brute_lof(data, k):
    n = len(data)
    distance = np.sqrt(((data[:, None, :] - data[None, :, :]) ** 2).sum(axis=2))
    near = [sorted((j for j in range(n) if j != i), key=lambda j: (distance[i, j], j))[:k] for i in range(n)]
    reach = [distance[i, near[i][-1]] for i in range(n)]
    density = [1 / (np.mean([max(distance[i, j], reach[j]) for j in near[i]]) + 1e-10) for i in range(n)]
    return [np.mean([density[j] for j in near[i]]) / density[i] for i in range(n)]


@pytest.mark.parametrize("k", [1, 20])
def test_lof_equals_brute_force(points, k):
    data, df = points
    found = {r["id"]: r["anomaly_score"] for r in anomaly.local_outlier_factor(df, "id", k).collect()}
    expected = brute_lof(data, k)
    assert len(found) == len(data)
    assert [found[i] for i in range(len(data))] == pytest.approx(expected, rel=1e-9)


def test_lof_scores_every_row(points):
    assert anomaly.local_outlier_factor(points[1], "id", 5).count() == points[1].count()


def test_isolation_forest_ranks_the_outlier_first_and_repeats(points):
    _, df = points
    forest = anomaly.fit_isolation_forest(df, "id", trees=60, rows_per_tree=64)
    scores = {r["id"]: r["anomaly_score"] for r in forest.score(df, "id").collect()}
    assert max(scores, key=scores.get) == 250 and scores[250] > 0.6
    assert all(0 < s < 1 for s in scores.values())
    again = anomaly.fit_isolation_forest(df.repartition(2), "id", trees=60, rows_per_tree=64)
    assert {r["id"]: r["anomaly_score"] for r in again.score(df, "id").collect()} == scores


def test_trees_use_distinct_rows_of_the_wanted_number(points):
    drawn = anomaly.tree_samples(points[1], "id", trees=7, rows=64, seed=1)
    sizes = drawn.groupBy("tree").agg(F.count("*"), F.countDistinct("id")).collect()
    assert len(sizes) == 7 and all(r[1] == r[2] == 64 for r in sizes)


def test_path_of_every_training_row_ends_in_a_leaf(points):
    nodes = anomaly.fit_isolation_forest(points[1], "id", trees=5, rows_per_tree=32).nodes
    for _, tree in nodes.groupby("tree"):
        inner = tree[tree.feature >= 0]
        assert (tree[tree.feature < 0].path > 0).all()
        assert sorted([*inner.left, *inner.right, 0]) == list(range(len(tree)))
    assert anomaly.expected_path(2) == 1.0 and anomaly.expected_path(1) == 0.0
    assert math.isclose(anomaly.expected_path(256), 10.2448, rel_tol=1e-4)


def test_model_inputs(spark):
    df = spark.sql(
        """SELECT 1L AS transaction_id, CAST('NaN' AS DOUBLE) AS a, CAST('Infinity' AS DOUBLE) AS b,
                  CAST(NULL AS DOUBLE) AS c, 2.5D AS d, 'text' AS e"""
    )
    keys = ("transaction_id",)
    assert tuple(matrix.finite_filled(df, ["a", "b", "c", "d", "e"], keys).first())[1:] == (0, 0, 0, 2.5, 0)
    assert tuple(matrix.zero_filled(df, ["c", "d", "e"], keys).first())[1:] == (0, 2.5, 0)
    flagged = matrix.with_missing_flags(df, ["c", "d"], keys).first().asDict()
    assert flagged == {"transaction_id": 1, "c": 0.0, "d": 2.5, "c_missing": 1.0, "d_missing": 0.0}


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (6.0, 4.0)], "a double, b double")
    scaled = matrix.fit_scaler(df, ["a", "b"]).transform(df).collect()
    assert [r["a"] for r in scaled] == pytest.approx(((np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])).tolist())
    assert [r["b"] for r in scaled] == [0, 0, 0]


def test_category_codes_are_alphabetical(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "transaction_id long, c string")
    codes = {r["transaction_id"]: r["c_code"] for r in matrix.category_encode(df, ["c"]).collect()}
    assert codes == {1: 2, 2: 0, 3: 1, 4: 2}


@pytest.fixture(scope="module")
def labeled(spark):
    chance = np.random.default_rng(11)
    rows = []
    for i in range(3000):
        a, b = chance.normal(), chance.normal()
        y = int(chance.random() < 1 / (1 + math.exp(-(2 * a - 3))))
        rows.append((i, y, float(a), float(b) if i % 4 else None))
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, a double, b double")
    return df.withColumn("ts", F.lit("2019-01-01").cast("timestamp_ntz")).repartition(4).persist()


def test_baseline_solves_the_balanced_l2_problem(labeled):
    """At the optimum the gradient of the penalised weighted loss vanishes."""
    model = supervised.fit_baseline(labeled, columns=["a", "b"])
    rows = labeled.toPandas().fillna({"b": 0.0})
    x = rows[["a", "b"]].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = rows["is_fraud"].to_numpy()
    n, n_pos = len(y), y.sum()
    weight = np.where(y == 1, n / (2 * n_pos), n / (2 * (n - n_pos)))
    beta, bias = model.model.coefficients.toArray(), model.model.intercept
    residual = weight * (1 / (1 + np.exp(-(x @ beta + bias))) - y)
    assert np.abs(x.T @ residual + beta).max() < 0.05 and abs(residual.sum()) < 0.05
    scores = model.score(labeled)
    assert scores.columns == ["transaction_id", "ts", "is_fraud", "score"] and scores.count() == 3000


SMALL = {"min_rows_per_leaf": 20, "max_depth": 3, "stretch": 4}


def test_boosted_scores_follow_the_definition(spark, labeled, tmp_path):
    """Base margin plus the leaf each row reaches in every tree; leaves are Newton steps of the rows drawn."""
    boosted = boosting.fit_boosted(labeled, labeled, columns=["a", "b"], rounds=6, row_share=1.0, column_share=1.0, **SMALL)
    assert len(boosted.trees) == 6 and len(boosted.history) == 6 and 1 <= boosted.best_rounds <= 6
    rows = {r["transaction_id"]: r for r in labeled.collect()}
    inputs = {k: [r["a"], r["b"] or 0.0, 0.0, float(r["b"] is None)] for k, r in rows.items()}
    y = {k: r["is_fraud"] for k, r in rows.items()}
    mean = sum(y.values()) / len(y)
    margin = dict.fromkeys(rows, math.log(mean / (1 - mean)))
    for tree in boosted.trees:
        sums, leaf_of = {}, {}
        for k, x in inputs.items():
            at = 0
            while tree.feature[at] >= 0:
                at = tree.left[at] if x[tree.feature[at]] <= tree.cut[at] else tree.right[at]
            p = 1 / (1 + math.exp(-margin[k]))
            g, h, n = sums.get(at, (0.0, 0.0, 0))
            sums[at], leaf_of[k] = (g + y[k] - p, h + p * (1 - p), n + 1), at
        assert set(sums) == set(tree.leaves) and min(n for _, _, n in sums.values()) >= 20
        assert all(tree.value[i] == pytest.approx(0.05 * g / (h + 1.0), rel=1e-9) for i, (g, h, _) in sums.items())
        margin = {k: m + tree.value[leaf_of[k]] for k, m in margin.items()}
    found = {r["transaction_id"]: r["score"] for r in boosted.score(labeled, 6).collect()}
    assert all(found[k] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-12) for k, m in margin.items())
    precision = metrics.average_precision(boosted.score(labeled, boosted.best_rounds)).first()[0]
    assert precision == pytest.approx(max(boosted.history), abs=1e-12)
    boosted.save(spark, str(tmp_path / "m"))
    again = boosting.Boosted.load(spark, str(tmp_path / "m"))
    assert again.trees == boosted.trees and again.best_rounds == boosted.best_rounds and again.columns == ["a", "b"]
    assert sorted(boosted.score(labeled).collect()) == sorted(again.score(labeled).collect())


def test_boosting_stops_at_the_exact_round(labeled):
    """The validation labels are turned around, so every further tree only loses."""
    against = labeled.withColumn("is_fraud", 1 - F.col("is_fraud"))
    boosted = boosting.fit_boosted(labeled, against, columns=["a"], patience=5, **SMALL)
    best = max(range(len(boosted.history)), key=lambda i: (boosted.history[i], -i))
    assert boosted.best_rounds == best + 1 and len(boosted.trees) == len(boosted.history) == best + 1 + 5
    for i, rounds in enumerate(range(1, 4)):
        assert metrics.average_precision(boosted.score(against, rounds)).first()[0] == pytest.approx(boosted.history[i], abs=1e-12)


def test_where_a_history_stops():
    assert boosting._stop([0.1, 0.3, 0.2, 0.3, 0.1], 3) == 5 and boosting._stop([0.1, 0.3, 0.2, 0.3], 3) is None
    assert boosting._stop([0.0, 0.0, 0.0], 2) == 3 and boosting._stop([], 1) is None and boosting.Boosting().rounds == 1500


def test_a_fit_can_be_continued(labeled):
    whole = boosting.fit_boosted(labeled, labeled, columns=["a", "b"], rounds=6, **SMALL)
    half = boosting.fit_boosted(labeled, labeled, columns=["a", "b"], rounds=4, **SMALL)
    more = boosting.fit_boosted(labeled, labeled, rounds=6, start=half, **SMALL)
    assert [t.feature for t in more.trees] == [t.feature for t in whole.trees]
    assert [v for t in more.trees for v in t.value] == pytest.approx([v for t in whole.trees for v in t.value])


def test_a_round_reads_kept_rows_on_all_cores(spark, labeled, monkeypatch):
    """Before, each pass of a round applied all earlier trees of the stretch again, in the few partitions of the input."""
    seen, grow = [], boosting._grow
    held = {int(k) for k in spark.sparkContext._jsc.getPersistentRDDs()}

    def spy(rows, *more):
        seen.append((rows.storageLevel.useMemory, rows.rdd.getNumPartitions()))
        return grow(rows, *more)

    monkeypatch.setattr(boosting, "_grow", spy)
    fitted = boosting.fit_boosted(labeled.coalesce(1), labeled, columns=["a", "b"], rounds=6, **SMALL)
    assert len(fitted.trees) == len(seen) == 6
    assert all(kept and parts >= spark.sparkContext.defaultParallelism for kept, parts in seen)
    assert {int(k) for k in spark.sparkContext._jsc.getPersistentRDDs()} <= held


def test_categories_reach_the_trees(spark):
    chance = np.random.default_rng(2)
    rows = [(i, int(i % 7 in (1, 4)), float(chance.normal()), f"c{i % 7}", f"v{i % 500}") for i in range(1400)]
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, a double, c string, v string").withColumn("ts", F.lit("2019-01-01").cast("timestamp_ntz"))
    boosted = boosting.fit_boosted(df, df, columns=["a"], categories=["c", "v"], rounds=3, column_share=1.0, row_share=1.0, **SMALL)
    assert boosted.inputs == ["a", "a_missing", "c_code", "v_code"] and boosted.importance()["c"] > 0.99
    assert boosted.trees[0].left_codes[0] in ([1, 4], [0, 2, 3, 5, 6])
    scores = {r["transaction_id"]: r["score"] for r in boosted.score(df).collect()}
    assert min(s for k, s in scores.items() if k % 7 in (1, 4)) > max(s for k, s in scores.items() if k % 7 not in (1, 4))
    unseen = df.limit(3).withColumn("c", F.lit("new")).withColumn("v", F.lit(None).cast("string"))
    assert boosted.score(unseen).filter("score is not null").count() == 3


def test_feature_importance_is_ordered(spark, labeled):
    boosted = boosting.fit_boosted(labeled, labeled, columns=["a", "b"], rounds=3, **SMALL)
    rows = supervised.feature_importance(spark, boosted).collect()
    assert [r["feature"] for r in rows] == ["a", "b"]
    assert sum(r["gain"] for r in rows) == pytest.approx(1.0)


def test_boosted_queries_fit_the_default_rounds(monkeypatch):
    from types import SimpleNamespace

    from ledgerlens.registry import queries

    monkeypatch.setattr(boosting, "fit_boosted", lambda *parts, **options: (parts, options))
    assert queries._boosted(SimpleNamespace(part=str)) == (("train", "valid"), {})


def test_very_many_categories(spark, monkeypatch):
    df = spark.range(300_000).select(F.col("id").alias("transaction_id"), F.concat(F.lit("v"), F.col("id") * 7919 % 300_007).alias("c"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("d"))
    for rows in (categories.BROADCAST_ROWS, 1000):
        monkeypatch.setattr(categories, "BROADCAST_ROWS", rows)
        coded = matrix.category_encode(df, ["c", "d"])
        held = coded.join(df, "transaction_id").agg(F.count("*"), F.countDistinct("c_code"), F.min("c_code"), F.max("c_code"), F.countDistinct("d_code"), F.max("d_code")).first()
        assert tuple(held) == (300_000, 300_000, 0, 299_999, 100_001, 100_000)
        some = coded.join(df, "transaction_id").filter("transaction_id % 3000 < 2").select("c", "c_code").orderBy("c").collect()
        assert [r["c_code"] for r in some] == sorted(r["c_code"] for r in some)


def test_categories_of_nothing(spark, labeled):
    assert matrix.category_encode(labeled.limit(0).withColumn("c", F.lit("x")), ["c"]).count() == 0
