"""Exact nearest neighbours in several blocks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import neighbours


def brute(data, keys, k):
    out = {}
    for i, x in enumerate(data):
        away = np.sqrt(((data - x) ** 2).sum(1))
        out[keys[i]] = [keys[j] for j in sorted((j for j in range(len(data)) if j != i), key=lambda j: (away[j], keys[j]))[:k]]
    return out


def found(df, key, k):
    out = {}
    for r in neighbours.nearest_neighbours(df, key, k).collect():
        out.setdefault(r[key], {})[r["place"]] = r["neighbour"]
    return {i: [near[p] for p in sorted(near)] for i, near in out.items()}


def clusters(chance, n, dimensions, centres):
    return np.round(chance.normal(0, 20, (centres, dimensions))[chance.integers(0, centres, n)] + chance.normal(0, 1, (n, dimensions)), 3)


@pytest.mark.parametrize("dimensions, centres", [(1, 3), (3, 20), (24, 5)])
def test_several_blocks(spark, monkeypatch, dimensions, centres):
    chance = np.random.default_rng(dimensions)
    data = clusters(chance, 700, dimensions, centres)
    data[100:260] = data[50]  # very many equal points, some in other blocks by the hash
    data[300:310] = data[60]
    data[699] = 1e4
    monkeypatch.setattr(neighbours, "block_points", lambda d: 90)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "id long, x array<double>").repartition(5)
    assert found(df, "id", 20) == brute(data, list(range(700)), 20)


def test_text_keys_and_lattice_ties(spark, monkeypatch):
    data = np.array([[a, b] for a in range(20) for b in range(20)], dtype=np.float64)
    keys = [f"k{i * 7919 % 400:03d}" for i in range(400)]
    monkeypatch.setattr(neighbours, "block_points", lambda d: 64)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in zip(keys, data)], "id string, x array<double>")
    assert found(df, "id", 5) == brute(data, keys, 5)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [5.0]), (3, [5.0])], "id long, x array<double>")
    assert found(df, "id", 20) == {1: [2, 3], 2: [3, 1], 3: [2, 1]}
    assert found(df.limit(0), "id", 20) == {} and found(df.limit(1), "id", 20) == {}


def test_far_blocks_do_not_meet(spark, monkeypatch):
    chance = np.random.default_rng(9)
    data = clusters(chance, 4000, 8, 8)
    monkeypatch.setattr(neighbours, "block_points", lambda d: 100)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "id long, x array<double>")
    placed, axes = neighbours._in_blocks(df, "id", 4000, 8)
    assert placed.count() == 4000 and placed.select("id").distinct().count() == 4000
    pack, schema = neighbours._packed("id", "bigint", 10, axes)
    blocks = placed.groupBy("block").applyInArrow(pack, schema).cache()
    sizes = [r["n"] for r in blocks.select(F.size("keys").alias("n")).collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 200
    # most blocks are too far from each other to meet
    assert neighbours._pairs(blocks).count() < 0.4 * len(sizes) * (len(sizes) - 1) / 2


def test_rows_moved_for_each_point(spark, monkeypatch):
    """Where nothing can be pruned every point still meets each block once, and at most one short list comes back from it."""
    chance = np.random.default_rng(3)
    data = chance.normal(0, 1, (2000, 40))
    monkeypatch.setattr(neighbours, "block_points", lambda d: 300)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "id long, x array<double>")
    placed, axes = neighbours._in_blocks(df, "id", 2000, 40)
    pack, schema = neighbours._packed("id", "bigint", 5, axes)
    blocks = placed.groupBy("block").applyInArrow(pack, schema).cache()
    pairs, many = neighbours._pairs(blocks), blocks.count()
    copies = 2 * pairs.count() / many
    assert copies <= many - 1 <= 12
    meet, result = neighbours._meet(5, "bigint", axes)
    assert neighbours._meetings(blocks, pairs).applyInArrow(meet, result).count() <= 2000 * copies
