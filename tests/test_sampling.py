"""Samples have exactly the wanted number of rows, whatever the keys."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.features import amount_z
from ledgerlens.operators.sampling import sample_fixed_n


@pytest.mark.parametrize("n", [0, 1, 5, 400, 950, 999])
def test_missing_and_repeated_keys(spark, n):
    missing = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), (F.col("id") % 7).alias("v"))
    repeated = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    equal = spark.range(1000).select(F.lit(3).alias("k"), F.lit("x").alias("v"))
    for df in (missing, repeated, equal):
        assert sample_fixed_n(df, n, "k").count() == n
    assert sample_fixed_n(missing, 1000, "k").count() == 1000


def test_drawn_by_the_hash_of_the_key(spark):
    df = spark.range(500).withColumn("text", F.concat(F.lit("r"), "id"))
    first = {r["id"] for r in df.orderBy(F.md5("text")).limit(60).collect()}
    assert {r["id"] for r in sample_fixed_n(df, 60, "text").collect()} == first
    assert {r["id"] for r in sample_fixed_n(df.repartition(7), 60, "text").collect()} == first
    assert {r["id"] for r in sample_fixed_n(df, 60, "text", "other").collect()} != first


def test_tiny_spreads_count(spark):
    rows = spark.createDataFrame([(3e-10, 1e-10, 5e-11), (1.0, 1.0, 0.0), (1.0, None, None)], "a double, m double, s double")
    assert [r[0] for r in rows.select(amount_z(F.col("a"), F.col("m"), F.col("s"))).collect()] == [pytest.approx(4.0), None, None]


@pytest.mark.parametrize("n", [1, 20, 51, 99])
def test_first_rows_are_a_filter(spark, n):
    """Equal times are cut by id, rows without a time come last."""
    import datetime

    from ledgerlens.operators.features import first_rows

    start = datetime.datetime(2019, 1, 1)
    rows = [(i * 37 % 100, start + datetime.timedelta(seconds=i % 3, microseconds=i % 2) if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "transaction_id long, ts timestamp_ntz").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or start, r[0]))
    found = first_rows(df, n)
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in ordered[:n])
    assert "Limit" not in found._jdf.queryExecution().executedPlan().toString()
    assert first_rows(df, 100).count() == first_rows(df, 1000).count() == 100 and first_rows(df, 0).count() == 0


@pytest.mark.parametrize("accuracy", [100_000, 12])
def test_exact_quantiles_in_two_passes(spark, monkeypatch, accuracy):
    import numpy as np

    from ledgerlens.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    chance = np.random.default_rng(1)
    groups = {1: np.round(chance.normal(0, 50, 4001), 1), 0: np.full(300, 7.5), None: np.array([3.0]), 5: chance.exponential(10, 2000)}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [(0, None), (9, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    found = {r["g"]: r for r in quantiles.exact_quantiles(df, "v", wanted, ("g",), {"n": F.count("*")}).collect()}
    assert set(found) == {*groups, 9} and found[9]["c"] is None and found[0]["n"] == 301
    for key, values in groups.items():
        assert [found[key][k] for k in wanted] == pytest.approx([float(np.quantile(values, q)) for q in wanted.values()], abs=1e-9)
    whole = quantiles.exact_quantiles(df.filter("g = 5"), "v", {"m": 0.5}).first()
    assert whole["m"] == pytest.approx(float(np.median(groups[5])))
    assert quantiles.exact_quantiles(df.limit(0), "v", {"m": 0.5}, ("g",)).count() == 0
