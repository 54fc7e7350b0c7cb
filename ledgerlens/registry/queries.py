"""One query per operator: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import (
    anomaly,
    boosting,
    categories,
    enrich,
    features,
    history,
    matrix,
    metrics,
    reports,
    sampling,
    split,
    supervised,
)
from ledgerlens.session import scratch_path
from ledgerlens.sources import readers, schemas, sinks

from . import adapters as A
from . import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Thresholds of the place reports, sized to the driver's tables.
PLACE_MIN_ROWS = 100
# A low limit that makes every larger card and merchant count as hot.
SPLIT_ABOVE_ROWS = 60


# Doubles are rounded, so that engines may differ in the last bits of a sum: to six
# decimals, and to eight where exact values end in a 5 at the seventh.
DIGITS = 6
FINE_DIGITS = 8


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), digits).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def query(digits: int = DIGITS) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return rounded(build(spark, sf_dir), digits)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        return run

    return register


# Sources, parsing, enrichment


@query()
def money_parse(spark, sf_dir):
    text = A.users(spark, sf_dir)
    return text.select("id", C.money(F.col("per_capita_income")).alias("amount"))


@query()
def try_date(spark, sf_dir):
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = (
        F.when(form == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(form == 2, F.date_format(day, "yyyy-MM"))
        .when(form == 3, F.date_format(day, "yyyy"))
        .when(form == 4, F.date_format(day, "MM/yyyy"))
    )
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", "text", C.lenient_date(F.col("text")).alias("parsed"))


@query()
def csv_roundtrip(spark, sf_dir):
    path = files.write_csv(A.event_transactions(spark, sf_dir), scratch_path(spark, "transactions"))
    return readers.read_csv_table(spark, path, schemas.TRANSACTIONS)


@query()
def label_parse(spark, sf_dir):
    folder = scratch_path(spark, "labels")
    path = files.write_label_json(A.dense_labels(spark, sf_dir), f"{folder}/labels.json")
    readers.load_labels(spark, path, f"{folder}/cache")
    cached = readers.load_labels(spark, path, f"{folder}/cache")
    return cached.select("id", F.col("is_fraud").cast("int").alias("is_fraud"))


@query()
def mcc_lookup(spark, sf_dir):
    path = files.write_mcc_json(A.mcc(spark, sf_dir), scratch_path(spark, "mcc"))
    return readers.read_mcc(spark, path)


@query()
def enrich_facts(spark, sf_dir):
    return enrich.enrich(A.raw_tables(spark, sf_dir))


@query()
def enrich_large_dimensions(spark, sf_dir):
    """The same joins when no dimension may be broadcast and large keys are salted."""
    raw = A.raw_tables(spark, sf_dir)
    return enrich.enrich(raw, broadcast_rows=0, hot_rows=SPLIT_ABOVE_ROWS)


@query()
def prepare(spark, sf_dir):
    """Raw files to fact view, through all readers."""
    return enrich.prepare(spark, files.write_raw(spark, A.raw_tables(spark, sf_dir)))


@query()
def label_coverage(spark, sf_dir):
    return reports.label_coverage(_facts(spark, sf_dir, "labels"))


@query()
def summary(spark, sf_dir):
    raw = A.raw_tables(spark, sf_dir)
    return reports.summary(enrich.enrich(raw, ("labels",)), raw.users, raw.cards)


# Features


@query()
def calendar_features(spark, sf_dir):
    facts = A.order_facts(spark, sf_dir).select("transaction_id", "ts")
    events = enrich.transaction_facts(A.event_transactions(spark, sf_dir)).select("transaction_id", "ts")
    both = facts.unionByName(events)
    return both.withColumns(features.calendar_features(F.col("ts")))


@query(FINE_DIGITS)
def card_history(spark, sf_dir):
    facts = enrich.transaction_facts(A.event_transactions(spark, sf_dir))
    rows = features.history_features(history.with_card_history(facts))
    return rows.select(
        "transaction_id", "card_id", "card_prior_txn_count", "card_prior_avg_amount",
        "card_prior_std_amount", "card_prior_max_amount", "card_prev_ts", "sec_since_prev_txn",
        "is_first_txn",
    )


def _order_history(spark, sf_dir, hot_rows=None):
    rows = history.with_card_history(A.order_facts(spark, sf_dir), hot_rows=hot_rows)
    return rows.select(
        "transaction_id", "card_id", "card_prior_txn_count", "card_prior_avg_amount",
        "card_prior_std_amount", "card_prior_max_amount", "card_prev_ts",
    )


@query()
def card_history_ties(spark, sf_dir):
    """Orders carry days, so equal times are ordered by id."""
    return _order_history(spark, sf_dir)


@query()
def card_history_split(spark, sf_dir):
    """The same with every card of more than a few rows cut into time slots."""
    return _order_history(spark, sf_dir, hot_rows=8)


@query()
def merchant_novelty(spark, sf_dir):
    facts = enrich.transaction_facts(A.event_transactions(spark, sf_dir))
    rows = history.with_prior_count(facts, ["merchant_id"], "merchant_prior_count")
    rows = history.with_prior_count(rows, ["card_id", "merchant_id"], "card_merchant_prior_count")
    return rows.select(
        "transaction_id", "card_id", "merchant_id", "merchant_prior_count", "card_merchant_prior_count"
    )


@query(FINE_DIGITS)
def amount_z(spark, sf_dir):
    facts = enrich.transaction_facts(A.event_transactions(spark, sf_dir))
    rows = features.history_features(history.with_card_history(facts))
    return rows.select("transaction_id", "amount", "amount_dev_from_prior_avg", "amount_z")


@query()
def amount_to_limit(spark, sf_dir):
    facts = features.static_features(_facts(spark, sf_dir, "cards"))
    return facts.select("transaction_id", "amount", "credit_limit", "amount_to_limit")


@query()
def card_age(spark, sf_dir):
    facts = features.static_features(_facts(spark, sf_dir, "cards"))
    return facts.select("transaction_id", "acct_open_date", "card_age_years")


@query(FINE_DIGITS)
def causal_features(spark, sf_dir):
    """Flagship: the whole feature table from the raw tables."""
    return features.build_features(A.raw_tables(spark, sf_dir))


@query(FINE_DIGITS)
def causal_features_split(spark, sf_dir):
    """The feature table with hot cards, merchants and pairs cut into time slots."""
    return features.build_features(A.raw_tables(spark, sf_dir), hot_rows=SPLIT_ABOVE_ROWS)


@query(FINE_DIGITS)
def features_sample(spark, sf_dir):
    """Smoke mode: the windows see the first 1,000 transactions only."""
    return features.build_features(A.raw_tables(spark, sf_dir), sample_rows=1000)


@query(FINE_DIGITS)
def features_write(spark, sf_dir):
    """Feature table written as Parquet and read back."""
    table = features.build_features(A.raw_tables(spark, sf_dir))
    return sinks.write_table(table, scratch_path(spark, "features"))


# Reports


def _facts(spark, sf_dir, *dims, dense=False):
    """The fact view with the dimensions a query reads, and no others."""
    return enrich.enrich(A.raw_tables(spark, sf_dir, dense, dims), dims)


def _dense(spark, sf_dir, *dims):
    return _facts(spark, sf_dir, "labels", *dims, dense=True)


@query()
def rate_by_hour(spark, sf_dir):
    return reports.rate_by_hour(_dense(spark, sf_dir))


@query()
def rate_by_dow(spark, sf_dir):
    return reports.rate_by_dow(_dense(spark, sf_dir))


@query()
def rate_by_time_flags(spark, sf_dir):
    return reports.rate_by_time_flags(_dense(spark, sf_dir))


@query()
def rate_by_brand(spark, sf_dir):
    return reports.rate_by_brand(_dense(spark, sf_dir, "cards"))


@query()
def rate_by_card_type(spark, sf_dir):
    return reports.rate_by_card_type(_dense(spark, sf_dir, "cards"))


@query()
def rate_by_state(spark, sf_dir):
    return reports.rate_by_state(_dense(spark, sf_dir), PLACE_MIN_ROWS)


@query()
def rate_by_country(spark, sf_dir):
    return reports.rate_by_country(_dense(spark, sf_dir), PLACE_MIN_ROWS)


@query()
def rate_by_region(spark, sf_dir):
    return reports.rate_by_region(_dense(spark, sf_dir))


@query()
def rate_by_credit_band(spark, sf_dir):
    return reports.rate_by_credit_band(_dense(spark, sf_dir, "users"))


@query()
def rate_by_month(spark, sf_dir):
    return reports.rate_by_month(A.order_facts(spark, sf_dir))


@query()
def rate_by_year(spark, sf_dir):
    return reports.rate_by_year(A.order_facts(spark, sf_dir))


@query()
def rate_by_channel(spark, sf_dir):
    return reports.rate_by_channel(A.order_facts(spark, sf_dir))


@query()
def rate_cuts(spark, sf_dir):
    """Several rate reports counted in one pass over the rows."""
    orders = A.order_facts(spark, sf_dir)
    ts = F.col("ts")
    cuts = reports.rate_cuts(
        orders,
        {"dow": C.day_of_week(ts), "year": F.year(ts).cast("long"), "use_chip": F.col("use_chip")},
    )
    tables = [
        cut.select(F.lit(name).alias("cut"), F.col(name).cast("string").alias("value"), "n", "fraud_rate")
        for name, cut in cuts.items()
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query()
def category_by_volume(spark, sf_dir):
    return reports.category_by_volume(A.item_facts(spark, sf_dir, category=True))


@query()
def category_by_frauds(spark, sf_dir):
    return reports.category_by_frauds(A.item_facts(spark, sf_dir, category=True))


@query()
def top_merchants(spark, sf_dir):
    return reports.top_merchants(A.item_facts(spark, sf_dir, category=True, city=True))


@query()
def amount_stats(spark, sf_dir):
    return reports.amount_stats(A.item_facts(spark, sf_dir))


@query()
def amount_histogram(spark, sf_dir):
    events = _dense(spark, sf_dir)
    return reports.class_histogram(events, "amount", above=0.0, below=reports.EDA_AMOUNT_LIMIT)


@query()
def score_histogram(spark, sf_dir):
    return reports.class_histogram(A.scored(spark, sf_dir), "score")


# Sampling and split


@query()
def sample_fixed_n(spark, sf_dir):
    return sampling.sample_fixed_n(A.order_facts(spark, sf_dir), 1000, "transaction_id")


@query()
def sample_then_filter(spark, sf_dir):
    return sampling.sample_then_filter(
        A.order_facts(spark, sf_dir), 1000, "transaction_id", F.col("is_fraud").isNotNull()
    )


@query()
def stratified_subsample(spark, sf_dir):
    return sampling.stratified_subsample(A.order_facts(spark, sf_dir), 1000, "transaction_id")


@query()
def time_split(spark, sf_dir):
    rows = split.time_split(A.order_facts(spark, sf_dir)).rows
    return rows.select("transaction_id", "ts", "is_fraud", "split")


@query()
def split_summary(spark, sf_dir):
    return split.split_summary(split.time_split(_dense(spark, sf_dir)))


# Ranking


def _ranking(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """One query on nearly distinct scores and one on a dozen of them."""

    def plain(spark, sf_dir):
        return build(A.scored(spark, sf_dir))

    def ties(spark, sf_dir):
        return build(A.scored(spark, sf_dir, ties=True))

    plain.__name__, ties.__name__ = name, f"{name}_ties"
    query(FINE_DIGITS)(plain)
    query(FINE_DIGITS)(ties)


_ranking("average_precision", metrics.average_precision)
_ranking("roc_auc", metrics.roc_auc)
_ranking("recall_at_fpr", metrics.recall_at_fpr)
_ranking("precision_at_k", metrics.precision_at_k)
_ranking("cost_threshold", metrics.cost_threshold)
_ranking("evaluate_ranking", lambda scored: metrics.flat_metrics(metrics.evaluate(scored)))
_ranking("pr_curve", metrics.pr_curve)
_ranking("roc_curve", metrics.roc_curve)
_ranking("cost_curve", metrics.cost_curve)
_ranking("decile_lift", metrics.decile_lift)
_ranking("budget_scan", metrics.budget_scan)
_ranking("confusion_matrix", lambda scored: metrics.confusion_matrix(scored, 0.9))
_ranking("top_risk", metrics.top_risk)


@query(FINE_DIGITS)
def top_risk_view(spark, sf_dir):
    return metrics.top_risk_view(metrics.top_risk(A.scored(spark, sf_dir)))


def _two_models(spark, sf_dir):
    orders = A.scored(spark, sf_dir)
    by_key = (F.col("transaction_id") * 7919 % 10007) / 10007.0
    return {
        "by_price": metrics.evaluate(orders),
        "by_key": metrics.evaluate(orders.withColumn("score", by_key)),
    }


@query(FINE_DIGITS)
def model_comparison(spark, sf_dir):
    return metrics.model_comparison(_two_models(spark, sf_dir), baseline="by_key")


@query(FINE_DIGITS)
def metrics_long(spark, sf_dir):
    table = metrics.model_comparison(_two_models(spark, sf_dir), baseline="by_key")
    return metrics.metrics_long(table)


# Model input and models


def _dense_features(spark, sf_dir):
    return features.build_features(A.raw_tables(spark, sf_dir, dense=True))


@query(FINE_DIGITS)
def model_matrix(spark, sf_dir):
    table = features.build_features(A.raw_tables(spark, sf_dir))
    return matrix.zero_filled(table, keys=("transaction_id",))


@query(FINE_DIGITS)
def detector_matrix(spark, sf_dir):
    """Numbers with NaN and infinities as 0; the credit limit is turned into both on the way."""
    table = features.build_features(A.raw_tables(spark, sf_dir))
    broken = (
        F.when(F.col("credit_limit") < 0, F.lit(float("nan")))
        .when(F.col("credit_limit") > 9000, F.lit(float("inf")))
        .otherwise(F.col("credit_limit"))
    )
    columns = ["amount", "credit_limit", "sec_since_prev_txn", "amount_z", "card_age_years"]
    return matrix.finite_filled(table.withColumn("credit_limit", broken), columns, ("transaction_id",))


@query(FINE_DIGITS)
def tree_matrix(spark, sf_dir):
    """Numbers with a flag for each that was missing."""
    table = features.build_features(A.raw_tables(spark, sf_dir))
    columns = ["amount", "sec_since_prev_txn", "amount_z", "card_age_years"]
    return matrix.with_missing_flags(table, columns, ("transaction_id",))


@query()
def category_encode(spark, sf_dir):
    return matrix.category_encode(features.build_features(A.raw_tables(spark, sf_dir)))


@query()
def standardize(spark, sf_dir):
    table = A.table(spark, sf_dir, "embeddings")
    width = 64
    names = [f"x{i:02d}" for i in range(width)]
    wide = table.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    return matrix.fit_scaler(wide, names).transform(wide)


def _parts(spark, sf_dir):
    table = sinks.write_table(_dense_features(spark, sf_dir), scratch_path(spark, "features"))
    return split.time_split(table)


@query()
def baseline_scores(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return supervised.fit_baseline(parts.part("train")).score(parts.part("test"))


#: The fitted trees by session and tables: two queries read them.
_FITTED: dict[tuple[str, str], tuple] = {}


def _boosted(parts):
    return boosting.fit_boosted(parts.part("train"), parts.part("valid"))


def _fitted(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        parts = _parts(spark, sf_dir)
        _FITTED[key] = parts, _boosted(parts)
    return _FITTED[key]


@query()
def gbt_scores(spark, sf_dir):
    parts, boosted = _fitted(spark, sf_dir)
    return boosted.score(parts.part("test"))


@query()
def feature_importance(spark, sf_dir):
    return supervised.feature_importance(spark, _fitted(spark, sf_dir)[1])


def _given_trees():
    """Three trees by hand: splits on numbers, on missing flags and on a category."""
    first, second, third = boosting.Tree(), boosting.Tree(), boosting.Tree()
    for tree, nodes in (
        (first, [(0, 60.0, None, 1, 2, 0.0, 4.0), (-1, 0.0, None, -1, -1, -0.5, 0.0), (2, 0.5, None, 3, 4, 0.0, 2.5), (-1, 0.0, None, -1, -1, 0.25, 0.0), (-1, 0.0, None, -1, -1, 0.75, 0.0)]),
        (second, [(5, 0.5, None, 1, 2, 0.0, 1.5), (1, 90000.0, None, 3, 4, 0.0, 3.0), (-1, 0.0, None, -1, -1, 0.125, 0.0), (-1, 0.0, None, -1, -1, -0.25, 0.0), (-1, 0.0, None, -1, -1, 0.5, 0.0)]),
        (third, [(8, 0.0, [0, 2], 1, 2, 0.0, 8.0), (-1, 0.0, None, -1, -1, 1.0, 0.0), (-1, 0.0, None, -1, -1, -1.0, 0.0)]),
    ):
        for node in nodes:
            at = tree.add(*node[:3])
            tree.left[at], tree.right[at], tree.value[at], tree.gain[at] = node[3:]
    return [first, second, third]


def _given(spark, sf_dir):
    table = _dense_features(spark, sf_dir)
    codes = categories.fit_categories(table, ["use_chip"])
    return table, boosting.Boosted(_given_trees(), -2.0, ["amount", "sec_since_prev_txn", "amount_z", "card_age_years"], codes, 3)


@query(FINE_DIGITS)
def tree_scores(spark, sf_dir):
    table, boosted = _given(spark, sf_dir)
    return boosted.score(table)


def _vectors(spark, sf_dir):
    table = A.table(spark, sf_dir, "embeddings")
    return table.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


@query()
def isolation_forest(spark, sf_dir):
    points = _vectors(spark, sf_dir)
    return anomaly.fit_isolation_forest(points, "vec_id").score(points, "vec_id")


@query()
def lof(spark, sf_dir):
    return anomaly.local_outlier_factor(_vectors(spark, sf_dir), "vec_id")
