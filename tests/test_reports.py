import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import reports, sampling, split
from ledgerlens.operators.quantiles import exact_quantiles


def test_region_branches(spark):
    states = spark.createDataFrame([(None,), ("",), ("TX",), ("Italy",)], "s string")
    assert [r[0] for r in states.select(C.region(F.col("s"))).collect()] == [
        "unknown", "international", "US state", "international"
    ]


def test_credit_band_rounds(spark):
    scores = spark.createDataFrame([(300,), (540,), (542,), (850,)], "s int")
    assert [r[0] for r in scores.select(C.credit_band(F.col("s"))).collect()] == [0, 3, 4, 8]


def test_sunday_is_day_zero(spark):
    days = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-07 05:59:59' AS ts")
    row = days.select(
        C.day_of_week(F.col("ts")), C.day_name(C.day_of_week(F.col("ts"))), C.weekend_flag(F.col("ts")),
        C.night_flag(F.col("ts")),
    ).first()
    assert tuple(row) == (0, "Sun", 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_with_a_dominant_value(spark, seed):
    chance = random.Random(seed)
    rows = [(g, 7.5 if chance.random() < 0.4 else chance.uniform(-50, 900)) for g in (0, 1) for _ in range(700 + 31 * g)]
    rows += [(0, None), (1, None)]
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    found = exact_quantiles(spark.createDataFrame(rows, "g int, x double").repartition(6), "x", wanted, ("g",))
    for row in found.collect():
        values = [x for g, x in rows if g == row["g"] and x is not None]
        for name, q in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_histogram_equals_numpy(spark):
    chance = random.Random(3)
    rows = [(i % 2, round(chance.uniform(-10, 2100), 2)) for i in range(3000)]
    df = spark.createDataFrame([*rows, (None, 5.0), (1, None)], "is_fraud int, amount double")
    found = reports.class_histogram(df, "amount", above=0.0, below=2000.0).collect()
    for label, name in ((0, "legitimate"), (1, "fraud")):
        values = [x for g, x in rows if g == label and 0 < x < 2000]
        counts, edges = np.histogram(values, bins=60)
        density, _ = np.histogram(values, bins=60, density=True)
        mine = {r["bin"]: r for r in found if r["class"] == name}
        assert sum(r["n"] for r in mine.values()) == len(values)
        assert [mine[i]["n"] if i in mine else 0 for i in range(60)] == counts.tolist()
        assert [mine[i]["density"] if i in mine else 0 for i in range(60)] == pytest.approx(density.tolist())


def facts(spark):
    rows = [
        (i, f"2019-0{1 + i % 9}-{1 + i % 28:02d} {i % 24:02d}:15:00", ["TX", "Italy", None][i % 3], [0, 1, None][i % 7 % 3])
        for i in range(500)
    ]
    return spark.createDataFrame(rows, "transaction_id long, ts string, merchant_state string, is_fraud int").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


def test_cuts_in_one_pass_equal_single_reports(spark):
    df = facts(spark)
    cuts = reports.rate_cuts(
        df, {"hour": C.hour_of_day(F.col("ts")), "month": C.month_start(F.col("ts")), "region": C.region(F.col("merchant_state"))}
    )
    single = {
        "hour": reports.rate_by_hour(df), "month": reports.rate_by_month(df), "region": reports.rate_by_region(df)
    }
    for key, table in single.items():
        assert sorted(map(str, cuts[key].collect())) == sorted(map(str, table.collect()))


def test_rates_use_labeled_rows_and_summary_all_rows(spark):
    df = facts(spark)
    labeled = df.filter("is_fraud IS NOT NULL").count()
    assert reports.rate_by_region(df).agg(F.sum("n")).first()[0] == labeled
    row = reports.summary(df, spark.range(3), spark.range(4)).first()
    frauds = df.filter("is_fraud = 1").count()
    assert (row["transactions"], row["users"], row["cards"], row["frauds"]) == (500, 3, 4, frauds)
    assert row["fraud_rate"] == pytest.approx(frauds / 500)
    assert row["labeled_fraud_rate"] == pytest.approx(frauds / labeled)
    empty = reports.summary(df.limit(0), spark.range(0), spark.range(0)).first()
    assert empty["fraud_rate"] == 0.0


def by_hash(ids):
    return sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


@pytest.mark.parametrize("n", [1, 100, 4_000])
def test_sample_has_exactly_n_rows_in_hash_order(spark, n):
    df = spark.range(20_000).withColumnRenamed("id", "transaction_id")
    found = sorted(r[0] for r in sampling.sample_fixed_n(df, n, "transaction_id").collect())
    assert found == sorted(by_hash(range(20_000))[:n])


def test_small_tables_are_returned_whole(spark):
    df = spark.range(10).withColumnRenamed("id", "transaction_id")
    assert sampling.sample_fixed_n(df, 10, "transaction_id").count() == 10
    assert sampling.sample_fixed_n(df, 50, "transaction_id").count() == 10


def test_sample_before_filter_loses_rows(spark):
    df = spark.range(10_000).select(F.col("id").alias("transaction_id"), (F.col("id") % 10 == 0).alias("keep"))
    kept = sampling.sample_then_filter(df, 1000, "transaction_id", F.col("keep")).count()
    assert kept == sum(i % 10 == 0 for i in by_hash(range(10_000))[:1000])


def test_stratified_subsample_keeps_all_positives(spark):
    df = spark.range(1000).select(F.col("id").alias("transaction_id"), (F.col("id") % 50 == 0).cast("int").alias("is_fraud"))
    counts = {r["is_fraud"]: r["count"] for r in sampling.stratified_subsample(df, 100, "transaction_id").groupBy("is_fraud").count().collect()}
    assert counts == {1: 20, 0: 100}


def test_time_split_keeps_ties_together(spark):
    chance = random.Random(9)
    days = [chance.randint(1, 28) for _ in range(997)]
    rows = [(i, f"2019-02-{d:02d} 00:00:00", None if i % 5 == 0 else i % 2) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "transaction_id long, ts string, is_fraud int").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    result = split.time_split(df)
    order = sorted(ts for _, ts, y in rows if y is not None)
    n = len(order)
    train_end, valid_end = order[int(n * 0.7)], order[int(n * 0.85)]
    assert (str(result.train_end), str(result.valid_end)) == (train_end, valid_end)
    found = {r["split"]: r["count"] for r in result.rows.groupBy("split").count().collect()}
    assert found["train"] == sum(t <= train_end for t in order)
    assert found["test"] == sum(t > valid_end for t in order)
    assert {name: result.part(name).count() for name in found} == found
    row = split.split_summary(result).first()
    assert row["test_frac"] == 0.15 and row["train"] + row["valid"] + row["test"] == n


def test_time_split_without_labels_raises(spark):
    df = spark.sql("SELECT 1L AS transaction_id, TIMESTAMP_NTZ'2019-01-01' AS ts, CAST(NULL AS INT) AS is_fraud")
    with pytest.raises(ValueError):
        split.time_split(df)
