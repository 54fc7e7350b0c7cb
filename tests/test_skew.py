"""Skewed tables under the default limits, scaled down, and with thin samples."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import history, metrics, ranking, skew


@pytest.fixture()
def small_limits(monkeypatch):
    monkeypatch.setattr(skew, "SMALLEST_HOT_GROUP", 200)
    monkeypatch.setattr(skew, "HOT_FACTOR", 1)


@pytest.fixture()
def thin_samples(monkeypatch):
    monkeypatch.setattr(skew, "SAMPLED_PER_HOT_KEY", 50)
    monkeypatch.setattr(skew, "SAMPLED_PER_SLOT", 20)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on card 1, another third without a card; one merchant holds a third."""
    n = 6000
    key = F.col("id")
    df = spark.range(n).select(
        key.alias("transaction_id"),
        F.timestamp_add("SECOND", (key % 500).cast("int"), F.lit("2019-01-01").cast("timestamp_ntz"))
        .cast("timestamp_ntz")
        .alias("ts"),
        F.when(key % 3 == 0, 1).when(key % 3 == 1, F.lit(None)).otherwise(key % 900).cast("long").alias("card_id"),
        F.when(F.xxhash64("id") % 3 == 0, 9).otherwise(F.pmod(F.xxhash64("id"), F.lit(700))).alias("merchant_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100000)) / 100).alias("amount"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20)) == 0).cast("int").alias("is_fraud"),
        F.when(key % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10**6)) / 1e6).alias("score"),
    )
    return df.repartition(6).persist()


def assert_same(found, expected, columns):
    """Equal rows by id; means may differ in the last bits, everything else may not."""
    mine, theirs = ({r[0]: r for r in df.select(*columns).collect()} for df in (found, expected))
    assert mine.keys() == theirs.keys()
    for name in columns:
        ours, wanted = ([rows[k][name] for k in sorted(rows)] for rows in (mine, theirs))
        if name == "card_prior_avg_amount":
            ours, wanted = ([-1.0 if v is None else v for v in column] for column in (ours, wanted))
            wanted = pytest.approx(wanted, abs=1e-9)
        assert ours == wanted, name


HISTORY = [
    "transaction_id", "card_prior_txn_count", "card_prior_avg_amount", "card_prior_max_amount", "card_prev_ts",
    "merchant_prior_count", "card_merchant_prior_count",
]


def test_hot_keys_are_found_by_default_limits(skewed, small_limits):
    # 6000 rows over 8 tasks: a key of more than 750 rows is hot.
    found = sorted((r[0] is None, r[0]) for r in skew.hot_keys(skewed, ["card_id"]).collect())
    assert found == [(False, 1), (True, None)]
    assert [r[0] for r in skew.hot_keys(skewed, ["merchant_id"]).collect()] == [9]
    assert skew.hot_keys(skewed, ["transaction_id"]) is None


def test_small_tables_have_no_hot_keys(skewed):
    assert skew.hot_row_limit(skewed) == float("inf")
    assert skew.hot_keys(skewed, ["card_id"]) is None


def test_no_slot_of_a_hot_key_is_much_larger_than_a_task(skewed, small_limits):
    split = history.plan_split(skewed, ["card_id"], "ts", "transaction_id")
    sizes = [r["count"] for r in split.hot_rows().groupBy("card_id", "_slot", "_sub").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 4000 / 8 * 1.2


def test_default_limits_split_and_keep_the_result(skewed, small_limits):
    plain = history.with_history(skewed, hot_rows=float("inf"))
    assert_same(history.with_history(skewed), plain, HISTORY)


def test_thin_samples_change_no_result(skewed, small_limits, thin_samples):
    plain = history.with_history(skewed, hot_rows=float("inf"))
    assert_same(history.with_history(skewed), plain, HISTORY)
    ranks = [r["flagged"] for r in ranking.rank_scores(skewed).rows.orderBy(F.desc("score"), "transaction_id").collect()]
    assert ranks == list(range(1, 6001))


def test_metrics_do_not_depend_on_the_cuts(skewed, monkeypatch):
    whole = metrics.evaluate(skewed).first().asDict()
    monkeypatch.setattr(skew, "SAMPLED_PER_SLOT", 5)
    again = metrics.evaluate(skewed).first().asDict()
    for name in ("pr_auc", "roc_auc", "total_cost", "best_threshold", "n", "n_pos"):
        assert again[name] == pytest.approx(whole[name], abs=1e-12)


def test_slots_of_very_many_heavy_scores(spark):
    """300 scores hold a few shares each; 2,000 slots are wanted."""
    rows = spark.range(60_000).select(F.col("id"), (F.col("id") % 300).cast("double").alias("v"), F.concat(F.lit("TX-2019-"), F.lpad(F.col("id"), 9, "0")).alias("t"))
    for tie in ("id", "t"):
        slots = skew.fit_slots(rows, F.col("v"), F.col(tie), pieces=2000)
        placed = slots.assign(rows, F.col("v"), F.col(tie))
        sizes = [r["count"] for r in placed.groupBy("_slot", "_sub").count().collect()]
        assert sum(slots.tied.values()) <= 2000 and 1500 <= len(sizes) <= 2 * 2000 and max(sizes) <= 60_000 / 2000 * 4
        spans = placed.groupBy("_slot", "_sub").agg(F.min(F.struct("v", tie)).alias("lo"), F.max(F.struct("v", tie)).alias("hi")).orderBy("_slot", "_sub").collect()
        assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("head", ["", "TX-", "é/"])
def test_ranks_with_text_ids(skewed, head):
    named = skewed.withColumn("key", F.concat(F.lit(head), F.lpad(F.col("transaction_id"), 7, "0"), F.when(F.col("transaction_id") % 2 == 0, "€").otherwise("")))
    ranked = ranking.rank_scores(named, tie="key").rows.orderBy("flagged").collect()
    expected = sorted(((-r["score"], r["key"].encode()) for r in named.select("score", "key").collect()))
    assert [(-r["score"], r["key"].encode()) for r in ranked] == expected and [r["flagged"] for r in ranked] == list(range(1, 6001))


def test_evaluate_shuffles_rows_once(skewed):
    ranked = ranking.rank_scores(skewed, thresholds=True).rows
    plan = metrics.evaluate(skewed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_slot#") <= 2  # the rows, and the few slot totals
    ends = {r["score"]: (r["pos"], r["end_tp"], r["end_fp"]) for r in ranked.collect()}
    points = {r["score"]: (r["pos"], r["tp"], r["fp"]) for r in ranking.thresholds(skewed).rows.collect()}
    assert ends == points
