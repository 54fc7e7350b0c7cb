"""End-to-end jobs: reports, feature table, training, anomaly detection, export.

Every job stores what the next one reads, so no job repeats another one's work and
a lost executor repeats one stage at most.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import anomaly, boosting, features, matrix, metrics, reports, supervised
from ..operators.enrich import enrich
from ..operators.split import TRAIN_FRACTION, VALID_FRACTION, TimeSplit, split_summary, time_split
from ..sources.readers import RawPaths, RawTables, read_raw, register_views
from ..sources.sinks import stored_table, write_report, write_table


@dataclass(frozen=True)
class Outputs:
    """Where the jobs keep their tables, below one shared folder."""

    folder: str

    def path(self, name: str, sample_rows: int | None = None) -> str:
        """Named by its parameters, so what a sample gave is never taken for the whole."""
        return f"{self.folder.rstrip('/')}/{name}" + (f"_first_{sample_rows}" if sample_rows else "")

    def features(self, sample_rows: int | None) -> str:
        return self.path("features", sample_rows)


def _stored(spark: SparkSession, path: str, force: bool, build) -> DataFrame:
    """The stored table, built first if it is missing or ``force`` is set."""
    found = None if force else stored_table(spark, path)
    return found if found is not None else write_table(build(), path)


def store_facts(spark: SparkSession, raw: RawTables, out: Outputs, force: bool = False) -> DataFrame:
    """The fact view as Parquet; every later pass reads columns of it instead of text."""
    facts = _stored(spark, out.path("facts"), force, lambda: enrich(raw))
    facts.createOrReplaceTempView("tx_enriched")
    return facts


def eda(spark: SparkSession, paths: RawPaths, out: Outputs, force: bool = False) -> dict[str, DataFrame]:
    """Summary and five reports of the exploratory analysis, all over all rows."""
    raw = read_raw(spark, paths, force)
    register_views(raw)
    facts = store_facts(spark, raw, out, force)
    return {
        "summary": reports.summary(facts, raw.users, raw.cards),
        "by_hour": reports.rate_by_hour(facts),
        "by_dow": reports.rate_by_dow(facts),
        "amounts": reports.class_histogram(facts, "amount", above=0.0, below=reports.EDA_AMOUNT_LIMIT),
        "by_category": reports.category_by_frauds(facts),
        "by_month": reports.rate_by_month(facts),
    }


def build_features(
    spark: SparkSession, paths: RawPaths, out: Outputs, sample_rows: int | None = None, force: bool = False
) -> DataFrame:
    """The feature table, built once per ``sample_rows``.

    Transactions are landed as Parquet first: looking for hot keys and cutting
    their history reads a few columns several times.
    """

    def build() -> DataFrame:
        raw = read_raw(spark, paths, force)
        landed = write_table(raw.transactions, out.path("transactions"))
        return features.build_features(
            RawTables(landed, raw.users, raw.cards, raw.mcc, raw.labels), sample_rows
        )

    return _stored(spark, out.features(sample_rows), force, build)


def _feature_table(spark: SparkSession, out: Outputs, sample_rows: int | None) -> DataFrame:
    table = stored_table(spark, out.features(sample_rows))
    if table is None:
        raise FileNotFoundError(f"no feature table at {out.features(sample_rows)}; build it first")
    return table


def _named(row: DataFrame, model: str, part: str) -> DataFrame:
    return row.select(F.lit(model).alias("model"), F.lit(part).alias("part"), "*")


def _about(settings: metrics.Evaluation, shares: tuple[float, float], **more: object) -> dict[str, str]:
    """Parameters of a run as text, by name."""
    costs = settings.costs
    held = {
        "false_negative": costs.false_negative, "false_positive": costs.false_positive, "fpr_targets": list(settings.fpr_targets),
        "top_fractions": list(settings.top_fractions), "train_share": shares[0], "valid_share": shares[1], **more,
    }
    return {name: json.dumps(value) for name, value in sorted(held.items())}


def write_manifest(spark: SparkSession, out: Outputs, run: str, sample_rows: int | None, about: dict[str, str]) -> None:
    """What a run was given, written when all its outputs are: a run without one did not finish."""
    rows = spark.createDataFrame(sorted(about.items()), "name string, value string")
    write_table(rows.coalesce(1), out.path(f"{run}_manifest", sample_rows))


def read_manifest(spark: SparkSession, out: Outputs, run: str, sample_rows: int | None) -> dict[str, str] | None:
    """The parameters of a finished run, or None."""
    table = stored_table(spark, out.path(f"{run}_manifest", sample_rows))
    return None if table is None else {r["name"]: r["value"] for r in table.collect()}


def check_manifest(spark: SparkSession, out: Outputs, run: str, sample_rows: int | None, about: dict[str, str]) -> None:
    """Fail unless the run finished under the same parameters, of those that both name."""
    held = read_manifest(spark, out, run, sample_rows)
    if held is None or "unfinished" in held:
        raise FileNotFoundError(f"no finished run of {run} below {out.path(run, sample_rows)}")
    other = {k: (held[k], about[k]) for k in sorted(held.keys() & about.keys()) if held[k] != about[k]}
    if other:
        raise ValueError(f"{run} was run with other settings: {other}")


@dataclass(frozen=True)
class TrainingResult:
    split: TimeSplit
    baseline: supervised.Baseline
    boosted: boosting.Boosted
    metrics: DataFrame
    predictions: DataFrame


def train(
    spark: SparkSession,
    out: Outputs,
    sample_rows: int | None = None,
    settings: metrics.Evaluation = metrics.Evaluation(),
    shares: tuple[float, float] = (TRAIN_FRACTION, VALID_FRACTION),
    categories: tuple[str, ...] = (),
    **tree_settings: float,
) -> TrainingResult:
    """Split by time, fit the baseline and the boosted trees, store scores, metrics and models."""
    parts = time_split(_feature_table(spark, out, sample_rows), *shares)

    def path(name: str) -> str:
        return out.path(name, sample_rows)

    # an older manifest would vouch for outputs that are about to be replaced
    write_manifest(spark, out, "train", sample_rows, {"unfinished": "true"})
    training, valid, test = (parts.part(name) for name in ("train", "valid", "test"))

    baseline = supervised.fit_baseline(training)
    boosted = boosting.fit_boosted(training, valid, categories=categories, **tree_settings)
    # Scores are stored before they are ranked: ranking reads them several times.
    baseline_scores = write_table(baseline.score(test), path("baseline_predictions"))
    valid_scores = write_table(boosted.score(valid), path("valid_predictions"))
    predictions = write_table(boosted.score(test), path("predictions"))

    table = (
        _named(metrics.evaluate(baseline_scores, settings), "baseline", "test")
        .unionByName(_named(metrics.evaluate(valid_scores, settings), "boosted", "valid"))
        .unionByName(_named(metrics.evaluate(predictions, settings), "boosted", "test"))
        .withColumn("best_iteration", F.when(F.col("model") == "boosted", boosted.best_rounds))
        .withColumn("n_features", F.lit(len(boosted.importance())))
    )
    stored = write_table(table, path("metrics"))
    boosted.save(spark, path("boosted_model"))
    baseline.save(spark, path("baseline_model"))
    write_table(supervised.feature_importance(spark, boosted), path("feature_importance"))
    write_manifest(spark, out, "train", sample_rows, _about(settings, shares, categories=list(categories), trees=tree_settings))
    return TrainingResult(parts, baseline, boosted, stored, predictions)


def unsupervised(
    spark: SparkSession,
    out: Outputs,
    sample_rows: int | None = None,
    settings: metrics.Evaluation = metrics.Evaluation(),
    legit_only: bool = False,
    shares: tuple[float, float] = (TRAIN_FRACTION, VALID_FRACTION),
) -> DataFrame:
    """Fit both detectors once; store the scores of the test window and the metrics.

    ``legit_only`` keeps frauds out of the fit; by default labels play no part in it.
    """
    parts = time_split(_feature_table(spark, out, sample_rows), *shares)
    columns = features.NUMERIC_FEATURES
    training = parts.part("train")
    if legit_only:
        training = training.filter(F.col("is_fraud") == 0)
    fit = matrix.finite_filled(training, columns)
    scaler = matrix.fit_scaler(fit, columns)

    def points(rows: DataFrame) -> DataFrame:
        return scaler.transform(rows).select(*matrix.KEYS, anomaly.feature_array(columns))

    test = points(matrix.finite_filled(parts.part("test"), columns))
    forest = anomaly.fit_isolation_forest(points(fit), "transaction_id")
    scores = write_table(forest.score(test, *matrix.KEYS), out.path("unsupervised_scores", sample_rows))
    lof = anomaly.local_outlier_factor(test, "transaction_id")
    lof_scores = write_table(
        lof.join(test.select("transaction_id", "is_fraud"), "transaction_id"), out.path("lof_scores", sample_rows)
    )
    table = _named(metrics.evaluate(scores, settings, "anomaly_score"), "isolation_forest", "test").unionByName(
        _named(metrics.evaluate(lof_scores, settings, "anomaly_score"), "lof", "test")
    )
    done = write_table(table, out.path("unsupervised_metrics", sample_rows))
    write_manifest(spark, out, "unsupervised", sample_rows, _about(settings, shares, legit_only=legit_only))
    return done


def export_reports(
    spark: SparkSession,
    paths: RawPaths,
    out: Outputs,
    sample_rows: int | None = None,
    force: bool = False,
    settings: metrics.Evaluation = metrics.Evaluation(),
    shares: tuple[float, float] = (TRAIN_FRACTION, VALID_FRACTION),
) -> str:
    """Write every report of the dashboard below ``<folder>/reports``; needs a finished training under the same ``settings`` and ``shares``."""
    about = _about(settings, shares)
    check_manifest(spark, out, "train", sample_rows, about)
    raw = read_raw(spark, paths, force)
    facts = store_facts(spark, raw, out, force)
    costs, target = settings.costs, out.path("reports", sample_rows)

    def report(name: str, df: DataFrame) -> None:
        write_report(df, f"{target}/{name}")

    overview = reports.summary(facts, raw.users, raw.cards).unionByName(
        reports.label_coverage(facts), allowMissingColumns=True
    )
    report("summary", overview.agg(*[F.any_value(c, True).alias(c) for c in overview.columns]))
    report("split", split_summary(time_split(_feature_table(spark, out, sample_rows), *shares)))
    _export_cuts(facts, report)
    report("eda_by_category", reports.category_by_volume(facts))
    report("eda_by_category_frauds", reports.category_by_frauds(facts))
    report("eda_by_state", reports.rate_by_state(facts))
    report("eda_by_country", reports.rate_by_country(facts))
    report("eda_top_merchants", reports.top_merchants(facts))
    report("eda_by_credit", reports.rate_by_credit_band(facts))
    report("eda_time_flags", reports.rate_by_time_flags(facts))
    report("eda_amount_stats", reports.amount_stats(facts))
    labeled = facts.filter(F.col("is_fraud").isNotNull())
    report(
        "eda_amount_histogram",
        reports.class_histogram(labeled, "amount", above=0.0, below=reports.REPORT_AMOUNT_LIMIT),
    )

    predictions = spark.read.parquet(out.path("predictions", sample_rows))
    trained = spark.read.parquet(out.path("metrics", sample_rows))
    report("metrics", trained)
    supervised_rows = {model: _test_row(trained, model) for model in ("baseline", "boosted")}
    report("model_comparison", metrics.model_comparison(supervised_rows, baseline="baseline", costs=costs))
    report("feature_importance", spark.read.parquet(out.path("feature_importance", sample_rows)).orderBy(F.desc("gain")))
    report("pr_curve", metrics.pr_curve(predictions))
    report("roc_curve", metrics.roc_curve(predictions))
    report("cost_curve", metrics.cost_curve(predictions, costs))
    report("deciles", metrics.decile_lift(predictions))
    report("budget_scan", metrics.budget_scan(predictions))
    threshold = metrics.cost_threshold(predictions, costs).first()["threshold"]
    report("confusion", metrics.confusion_matrix(predictions, threshold))
    top = write_table(metrics.top_risk(predictions), f"{target}/top_risk")
    report("top_risk_view", metrics.top_risk_view(top))

    # detectors are scored again if their run did not finish or had other settings
    held = read_manifest(spark, out, "unsupervised", sample_rows)
    if force or held is None or any(held[k] != v for k, v in about.items()):
        table = unsupervised(spark, out, sample_rows, settings, shares=shares)
    else:
        table = spark.read.parquet(out.path("unsupervised_metrics", sample_rows))
    report("unsupervised_metrics", table)
    approaches = {"boosted": supervised_rows["boosted"]}
    approaches |= {model: _test_row(table, model) for model in ("isolation_forest", "lof")}
    comparison = metrics.model_comparison(approaches, baseline="boosted", costs=costs)
    report("unsupervised_comparison", metrics.metrics_long(comparison).orderBy("model", "metric"))
    scores = spark.read.parquet(out.path("unsupervised_scores", sample_rows))
    report("anomaly_histogram", reports.class_histogram(scores.select("anomaly_score", "is_fraud"), "anomaly_score"))
    return target


def _test_row(table: DataFrame, model: str) -> DataFrame:
    """The stored ``evaluate`` row of one model on the test window."""
    row = table.filter((F.col("model") == model) & (F.col("part") == "test"))
    return row.drop("model", "part", "best_iteration", "n_features")


def _export_cuts(facts: DataFrame, report) -> None:
    """The single-key rate reports, counted together in one pass."""
    ts = F.col("ts")
    cuts = reports.rate_cuts(
        facts,
        {
            "hour": C.hour_of_day(ts),
            "dow": C.day_of_week(ts),
            "month": C.month_start(ts),
            "year": F.year(ts).cast("long"),
            "use_chip": F.col("use_chip"),
            "card_brand": F.col("card_brand"),
            "card_type": F.col("card_type"),
            "region": C.region(F.col("merchant_state")),
        },
    )
    cuts["dow"] = cuts["dow"].withColumn("day", C.day_name(F.col("dow")))
    for name, key in (("by_hour", "hour"), ("by_dow", "dow"), ("monthly", "month"), ("by_year", "year")):
        report(f"eda_{name}", cuts[key].orderBy(key))
    for name, key in (("by_chip", "use_chip"), ("by_region", "region")):
        report(f"eda_{name}", cuts[key].orderBy(F.desc("fraud_rate"), key))
    for name, key in (("by_brand", "card_brand"), ("by_type", "card_type")):
        report(f"eda_{name}", cuts[key].orderBy(F.desc("n"), key))
