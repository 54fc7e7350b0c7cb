import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features, history
from ledgerlens.sources.readers import RawTables
from ledgerlens.registry import adapters

SCHEMA = "transaction_id long, ts timestamp_ntz, card_id long, merchant_id long, amount double"
START = datetime(2019, 1, 1)


def rows_of(seed, n=400):
    """Half of the rows on one card, a third at one merchant, many equal times, some NULLs."""
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        card = 1 if chance.random() < 0.5 else chance.choice([None, 2, 3, 4, 5])
        merchant = 9 if chance.random() < 0.34 else chance.randint(1, 6)
        ts = None if chance.random() < 0.05 else START + timedelta(seconds=chance.randint(0, 40) * 3600.5)
        amount = None if chance.random() < 0.05 else float(chance.choice([5, 5, 5, 7.25, -3, 1000.75]))
        rows.append((i, ts, card, merchant, amount))
    return rows


def brute_force(rows):
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[0]))
    cards, merchants, both = {}, {}, {}
    found = {}
    for i, ts, card, merchant, amount in order:
        seen = cards.setdefault(card, [])
        known = [a for _, a in seen if a is not None]
        found[i] = {
            "card_prior_txn_count": len(seen),
            "card_prior_avg_amount": float(np.mean(known)) if known else None,
            "card_prior_std_amount": float(np.std(known)) if known else None,
            "card_prior_max_amount": max(known) if known else None,
            "card_prev_ts": seen[-1][0] if seen else None,
            "merchant_prior_count": merchants.get(merchant, 0),
            "card_merchant_prior_count": both.get((card, merchant), 0),
        }
        seen.append((ts, amount))
        merchants[merchant] = merchants.get(merchant, 0) + 1
        both[card, merchant] = both.get((card, merchant), 0) + 1
    return found


@pytest.mark.parametrize("hot_rows", [None, 30, 5])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_brute_force_whether_split_or_not(spark, hot_rows, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r["transaction_id"]: r for r in history.with_history(df, hot_rows=hot_rows).collect()}
    expected = brute_force(rows)
    assert len(found) == len(rows)
    for key, wanted in expected.items():
        for name, value in wanted.items():
            got = found[key][name]
            if isinstance(value, float):
                assert got == pytest.approx(value, abs=1e-9), (key, name)
            else:
                assert got == value, (key, name)


def test_constant_history_has_no_spread_even_when_split(spark):
    rows = [(i, START + timedelta(minutes=i), 1, 1, 0.1) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    split = features.history_features(history.with_history(df, hot_rows=10))
    assert split.filter(F.col("card_prior_std_amount") != 0).count() == 0
    assert split.filter(F.col("amount_z").isNotNull()).count() == 0


def test_one_instant_holding_all_rows_is_split_by_id(spark):
    rows = [(i, START, 1, 1, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = history.plan_split(df, ["card_id"], "ts", "transaction_id", 10)
    sizes = [r["count"] for r in plan.hot_rows().groupBy("_slot", "_sub").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 150
    found = history.with_history(df, hot_rows=10).orderBy("transaction_id").collect()
    assert [r["card_prior_txn_count"] for r in found] == list(range(500))
    assert [r["card_prior_max_amount"] for r in found][1:] == [float(i) for i in range(499)]


def test_first_rows_have_neutral_features(spark):
    rows = [(1, START, 1, 1, 10.0), (2, START + timedelta(seconds=90), 1, 1, 20.0), (3, START, 2, 1, 30.0)]
    df = features.history_features(history.with_history(spark.createDataFrame(rows, SCHEMA)))
    found = {r["transaction_id"]: r for r in df.collect()}
    first, second = found[1], found[2]
    assert (first["card_prior_avg_amount"], first["card_prior_std_amount"], first["card_prior_max_amount"]) == (0, 0, 10)
    assert first["amount_dev_from_prior_avg"] is None and first["amount_z"] is None
    assert first["is_first_txn"] == 1 and first["sec_since_prev_txn"] is None
    assert second["amount_dev_from_prior_avg"] == 10 and second["amount_z"] is None
    assert second["is_first_txn"] == 0 and second["sec_since_prev_txn"] == 90.0


def test_features_do_not_look_ahead(spark):
    """Removing or changing everything after an instant changes no earlier row."""
    raw = adapters.raw_tables(spark, "/root/testdata/sf0.001")
    instant = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    past = raw.transactions.filter(F.col("date") < instant)
    later = raw.transactions.filter(F.col("date") >= instant).withColumn("amount", F.lit("$99999"))

    def build(transactions):
        table = features.build_features(RawTables(transactions, raw.users, raw.cards, raw.mcc, raw.labels))
        return sorted(map(tuple, table.filter(F.col("ts") < instant).collect()), key=lambda r: r[0])

    whole = build(raw.transactions)
    assert len(whole) > 300
    assert whole == build(past) == build(past.unionByName(later))


@pytest.mark.parametrize("n", [1, 50, 390, 1000])
def test_first_rows_follow_time_and_id(spark, n):
    rows = rows_of(7)
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[0]))
    found = features.first_rows(spark.createDataFrame(rows, SCHEMA).repartition(4), n).collect()
    assert sorted(r[0] for r in found) == sorted(r[0] for r in order[:n])


def test_feature_lists(spark):
    assert not set(features.NUMERIC_FEATURES) & set(features.CATEGORICAL_FEATURES)
    assert len(features.NUMERIC_FEATURES) == 25 and len(features.CATEGORICAL_FEATURES) == 10
    assert set(features.FEATURE_TABLE) == {
        "transaction_id", "ts", "is_fraud", *features.NUMERIC_FEATURES, *features.CATEGORICAL_FEATURES
    }


def test_unsplit_windows_cost_two_shuffles(spark):
    df = spark.createDataFrame(rows_of(3), SCHEMA)
    plan = history.with_history(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in plan


def test_seconds_between_ignores_time_zone_changes(spark):
    from ledgerlens.functions import columns as C

    df = spark.sql(
        """SELECT TIMESTAMP_NTZ'2019-03-30 12:00:00' AS a, TIMESTAMP_NTZ'2019-03-31 12:00:00.5' AS b"""
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert df.select(C.seconds_between(F.col("a"), F.col("b"))).first()[0] == 86400.5
        assert df.select(C.seconds_between(F.col("b"), F.col("a"))).first()[0] == -86400.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
