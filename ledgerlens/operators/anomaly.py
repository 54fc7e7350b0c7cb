"""Isolation forest and local outlier factor as Spark jobs."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .neighbours import nearest_neighbours

# Detector parameters.
TREES = 200
ROWS_PER_TREE = 256
NEIGHBOURS = 20
SEED = 42

_HASH_SPACE = 1 << 40


def feature_array(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns]).alias("x")


def expected_path(rows: int) -> float:
    """Mean depth at which ``rows`` random points are told apart."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + float(np.euler_gamma)) - 2.0 * (rows - 1.0) / rows


def tree_samples(df: DataFrame, key: str, trees: int, rows: int, seed: int) -> DataFrame:
    """``rows`` random rows per tree, drawn without replacement, as ``(tree, key, x)``.

    A hash of (row, tree) decides who is drawn. The cut keeps a few rows more than
    needed for each tree, so only those are repeated and ranked.
    """
    total = df.count()
    share = min(1.0, (rows + 6 * math.sqrt(rows) + 10) / max(total, 1))
    cut = int(share * _HASH_SPACE)

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), tree, F.col(key)), F.lit(_HASH_SPACE))

    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < cut)
    candidates = df.select(key, "x", F.explode(drawn).alias("tree"))
    first = Window.partitionBy("tree").orderBy(draw(F.col("tree")), key)
    return (
        candidates.withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") <= rows)
        .select("tree", key, "x")
    )


@dataclass(frozen=True)
class IsolationForest:
    """At most ``TREES * 2 * ROWS_PER_TREE`` nodes, whatever the data: small enough to ship."""

    nodes: pd.DataFrame
    rows_per_tree: int

    def score(self, df: DataFrame, *keep: str) -> DataFrame:
        """Add ``anomaly_score`` = 2 ** (-mean path / expected path) of the feature array ``x``."""
        trees = [
            (t["feature"].to_numpy(), t["cut"].to_numpy(), t["left"].to_numpy(), t["right"].to_numpy(),
             t["path"].to_numpy())
            for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree")
        ]
        shipped = df.sparkSession.sparkContext.broadcast(trees)
        usual = max(expected_path(self.rows_per_tree), 1e-12)

        @F.pandas_udf("double")
        def anomaly(x: pd.Series) -> pd.Series:
            points = np.stack(x.to_numpy()) if len(x) else np.empty((0, 1))
            everyone = np.arange(len(points))
            total = np.zeros(len(points))
            for feature, cut, left, right, path in shipped.value:
                at = np.zeros(len(points), dtype=np.int64)
                inner = feature[at] >= 0
                while inner.any():
                    goes_left = points[everyone, np.maximum(feature[at], 0)] <= cut[at]
                    at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
                    inner = feature[at] >= 0
                total += path[at]
            return pd.Series(np.exp2(-total / len(shipped.value) / usual))

        return df.select(*keep, anomaly("x").alias("anomaly_score"))


def fit_isolation_forest(
    df: DataFrame,
    key: str,
    trees: int = TREES,
    rows_per_tree: int = ROWS_PER_TREE,
    seed: int = SEED,
) -> IsolationForest:
    """Grow every tree in its own task from its own small sample, drawn from all rows of ``(key, x)``."""
    fit = df.select(key, "x")
    size = min(rows_per_tree, fit.count())
    depth = math.ceil(math.log2(max(size, 2)))

    usual_path = [expected_path(rows) for rows in range(size + 1)]

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        points = np.stack(sample.sort_values(key)["x"].to_numpy())
        chance = np.random.default_rng([seed, tree])
        nodes = []
        waiting = [(points, 0, None, None)]
        while waiting:
            here, level, parent, side = waiting.pop()
            node = len(nodes)
            if parent is not None:
                nodes[parent][side] = node
            low, high = here.min(axis=0), here.max(axis=0)
            spread = np.flatnonzero(high > low)
            if level >= depth or len(here) <= 1 or len(spread) == 0:
                nodes.append([tree, node, -1, 0.0, -1, -1, level + usual_path[len(here)]])
                continue
            feature = int(chance.choice(spread))
            cut = float(chance.uniform(low[feature], high[feature]))
            goes_left = here[:, feature] <= cut
            nodes.append([tree, node, feature, cut, -1, -1, 0.0])
            waiting.append((here[~goes_left], level + 1, node, 5))
            waiting.append((here[goes_left], level + 1, node, 4))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "path"])

    samples = tree_samples(fit, key, trees, rows_per_tree, seed)
    grown = samples.groupBy("tree").applyInPandas(
        grow, "tree int, node int, feature int, cut double, left int, right int, path double"
    )
    return IsolationForest(grown.toPandas(), size)


def local_outlier_factor(df: DataFrame, key: str, k: int = NEIGHBOURS) -> DataFrame:
    """Local outlier factor of every row of ``(key, x)``, from its exact neighbours."""
    near = checkpointed(nearest_neighbours(df, key, k))
    k_distance = near.groupBy(F.col(key).alias("neighbour")).agg(F.max("distance").alias("k_distance"))
    density = (
        near.join(k_distance, "neighbour")
        .groupBy(key)
        .agg((1.0 / (F.avg(F.greatest("distance", "k_distance")) + 1e-10)).alias("density"))
    )
    around = density.select(F.col(key).alias("neighbour"), F.col("density").alias("_around"))
    return (
        near.join(around, "neighbour")
        .groupBy(key)
        .agg(F.avg("_around").alias("_around"))
        .join(density, key)
        .select(key, (F.col("_around") / F.col("density")).alias("anomaly_score"))
    )
