"""Metrics of a ranking under extreme class imbalance, and the cost of acting on it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .ranking import Ranked, counted_piece, evenly_spaced, rank_scores, renumber, thresholds, thresholds_by


@dataclass(frozen=True)
class Costs:
    """Dollars lost per missed fraud and spent per false alarm."""

    false_negative: float = 200.0
    false_positive: float = 5.0

    def of(self, flagged: Column, tp: Column, n_pos: int) -> Column:
        return (n_pos - tp) * F.lit(self.false_negative) + (flagged - tp) * F.lit(self.false_positive)


@dataclass(frozen=True)
class Evaluation:
    """Operating points that are reported."""

    costs: Costs = field(default_factory=Costs)
    fpr_targets: tuple[float, ...] = (0.001, 0.005, 0.01, 0.05)
    top_fractions: tuple[float, ...] = (0.001, 0.01)


# Points per thinned curve, risk deciles and review budgets.
CURVE_POINTS = 300
DECILES = 10
BUDGETS = 60
BUDGET_RANGE = (0.0005, 0.1)
TOP_RISK_ROWS = 500


# Fixed formats: the keys of the two metric maps.
def recall_key(target: float) -> str:
    return f"recall@fpr={target:.3f}"


def precision_key(fraction: float) -> str:
    return f"precision@top{fraction * 100:g}%"


def recall_column(target: float) -> str:
    """``recall_key`` as a plain column name."""
    return f"recall_at_fpr_{target:.3f}".replace(".", "_")


def precision_column(fraction: float) -> str:
    """``precision_key`` as a plain column name."""
    return f"precision_at_top_{fraction * 100:g}pct".replace(".", "_")


def _real(column: Column) -> Column:
    return column.cast("double")


def _share(count: Column, total: int) -> Column:
    """``count / total`` as a double, NULL of nothing."""
    return _real(count) / F.lit(float(total)) if total else F.lit(None).cast("double")


def _average_precision(n_pos: int) -> Column:
    """Precision at each threshold, weighted by the recall gained there (no interpolation)."""
    precision = F.col("tp") / _real(F.col("tp") + F.col("fp"))
    return F.sum(_share(F.col("pos"), n_pos) * precision)


def _roc_auc(n_pos: int, n_neg: int) -> Column:
    """P(positive above negative) + half of P(tie)."""
    above = _real(F.col("tp") - F.col("pos")) + _real(F.col("pos")) / 2
    return _share(F.sum(_real(F.col("neg")) * above), n_pos * n_neg)


def _recall_at(target: float, n_pos: int, n_neg: int, tp: Column | None = None, fp: Column | None = None) -> Column:
    """Recall on the ROC polyline at a false-positive rate, interpolated between its points."""
    fpr = _share(F.col("fp") if fp is None else fp, n_neg)
    tpr = _share(F.col("tp") if tp is None else tp, n_pos)
    at = F.lit(float(target))
    low = F.max(F.when(fpr <= at, F.struct(fpr.alias("x"), tpr.alias("y"))))
    high = F.min(F.when(fpr > at, F.struct(fpr.alias("x"), tpr.alias("y"))))
    x0, y0 = F.coalesce(low["x"], F.lit(0.0)), F.coalesce(low["y"], F.lit(0.0))
    return F.when(high.isNull(), y0).otherwise(y0 + (at - x0) * (high["y"] - y0) / (high["x"] - x0))


def average_precision(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    points = thresholds(df, score, label)
    return points.rows.agg(_average_precision(points.n_pos).alias("average_precision"))


def _gained(found: tuple) -> tuple:
    key, _, pos, _, tp, fp = found
    used = pos > 0
    return key, float((pos[used] * (tp[used] / (tp[used] + fp[used]))).sum()), int(pos.sum())


def average_precision_by(pieces: RDD) -> dict[int, float | None]:
    """Average precision by key of several rankings in pieces ``key, scores, labels``, ranked together; None without positives."""
    counted = pieces.map(counted_piece).persist(StorageLevel.MEMORY_AND_DISK)
    sums: dict[int, list] = {}
    for key, gained, pos in sorted(thresholds_by(counted).map(_gained).collect()):
        held = sums.setdefault(key, [0.0, 0])
        held[0], held[1] = held[0] + gained, held[1] + pos
    counted.unpersist()
    return {key: gained / pos if pos else None for key, (gained, pos) in sums.items()}


def roc_auc(df: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    points = thresholds(df, score, label)
    return points.rows.agg(_roc_auc(points.n_pos, points.n_neg).alias("roc_auc"))


def recall_at_fpr(
    df: DataFrame,
    targets: tuple[float, ...] = Evaluation.fpr_targets,
    score: str = "score",
    label: str = "is_fraud",
) -> DataFrame:
    """One column per target."""
    points = thresholds(df, score, label)
    return points.rows.agg(
        *[_recall_at(t, points.n_pos, points.n_neg).alias(recall_column(t)) for t in targets]
    )


def top_k(n: int, fraction: float) -> int:
    return max(1, int(n * fraction))


def _precision_at(fraction: float, n: int) -> Column:
    return F.avg(F.when(F.col("flagged") <= top_k(n, fraction), F.col("label")))


def precision_at_k(
    df: DataFrame,
    fractions: tuple[float, ...] = Evaluation.top_fractions,
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
) -> DataFrame:
    """One column per fraction: share of positives among the top ``max(1, n * fraction)`` rows."""
    ranked = rank_scores(df, score, label, tie)
    return ranked.rows.agg(*[_precision_at(f, ranked.n).alias(precision_column(f)) for f in fractions])


def _cheapest(costs: Costs, n_pos: int) -> Column:
    """The first rank with the lowest cost; flagging nothing is not a choice."""
    cost = costs.of(F.col("flagged"), F.col("tp"), n_pos)
    return F.min(F.struct(cost.alias("cost"), F.col("flagged"), F.col("score")))


def cost_threshold(
    df: DataFrame,
    costs: Costs = Costs(),
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
) -> DataFrame:
    ranked = rank_scores(df, score, label, tie)
    return ranked.rows.agg(_cheapest(costs, ranked.n_pos).alias("best")).select(
        F.col("best.score").alias("threshold"),
        F.col("best.cost").alias("total_cost"),
        "best.flagged",
        _share(F.col("best.cost"), ranked.n).alias("cost_per_txn"),
    )


def _keyed(columns: dict[str, Column]) -> Column:
    return F.create_map(*[part for key, column in columns.items() for part in (F.lit(key), column)])


def evaluate(
    df: DataFrame,
    settings: Evaluation = Evaluation(),
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
) -> DataFrame:
    """The whole metric suite of one score column, in one row.

    Rows are shuffled once: each row carries its rank and the totals at its score, and everything is one aggregation over them.
    """
    ranked = rank_scores(df, score, label, tie, thresholds=True)
    n, n_pos, n_neg = ranked.n, ranked.n_pos, ranked.n_neg
    precision = F.col("end_tp") / _real(F.col("end_tp") + F.col("end_fp"))
    above = _real(F.col("end_tp")) - _real(F.col("pos")) / 2
    points = {"tp": F.col("end_tp"), "fp": F.col("end_fp")}
    one = ranked.rows.agg(
        F.sum(F.when(F.col("label") == 1, _share(F.lit(1), n_pos) * precision)).alias("pr_auc"),
        _share(F.sum(F.when(F.col("label") == 0, above)), n_pos * n_neg).alias("roc_auc"),
        _keyed({recall_key(t): _recall_at(t, n_pos, n_neg, **points) for t in settings.fpr_targets}).alias("recall_at_fpr"),
        _keyed({precision_key(f): _precision_at(f, n) for f in settings.top_fractions}).alias("precision_at_k"),
        _cheapest(settings.costs, n_pos).alias("best"),
    )
    return one.select(
        "pr_auc",
        "roc_auc",
        "recall_at_fpr",
        "precision_at_k",
        F.col("best.score").alias("best_threshold"),
        F.col("best.cost").alias("total_cost"),
        _share(F.col("best.cost"), n).alias("cost_per_txn"),
        F.lit(n).cast("long").alias("n"),
        F.lit(n_pos).cast("long").alias("n_pos"),
    )


def flat_metrics(metrics: DataFrame, settings: Evaluation = Evaluation()) -> DataFrame:
    """Maps opened into one column per key."""
    opened = [F.col("recall_at_fpr")[recall_key(t)].alias(recall_column(t)) for t in settings.fpr_targets]
    opened += [
        F.col("precision_at_k")[precision_key(f)].alias(precision_column(f)) for f in settings.top_fractions
    ]
    rest = [c for c in metrics.columns if c not in ("recall_at_fpr", "precision_at_k")]
    return metrics.select(*rest, *opened)


def pr_curve(
    df: DataFrame, score: str = "score", label: str = "is_fraud", points: int = CURVE_POINTS
) -> DataFrame:
    """Precision and recall by ascending threshold, ending in (recall 0, precision 1)."""
    steps = thresholds(df, score, label)
    index = F.col("places") - F.col("place")
    kept = steps.rows.filter(evenly_spaced(index, F.col("places") + 1, points))
    curve = kept.select(
        F.col("score").alias("threshold"),
        _share(F.col("tp"), steps.n_pos).alias("recall"),
        (F.col("tp") / _real(F.col("tp") + F.col("fp"))).alias("precision"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")
    )
    return curve.unionByName(end).orderBy(F.col("threshold").asc_nulls_last())


def roc_curve(
    df: DataFrame, score: str = "score", label: str = "is_fraud", points: int = CURVE_POINTS
) -> DataFrame:
    """ROC points from (0, 0), without those on a straight line between their neighbours."""
    steps = thresholds(df, score, label)
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    corners = steps.rows.filter((F.col("place") == 1) | (F.col("place") == F.col("places")) | bends)
    kept = renumber(corners).filter(evenly_spaced(F.col("place"), F.col("places") + 1, points))
    curve = kept.select(
        F.col("score").alias("threshold"),
        _share(F.col("fp"), steps.n_neg).alias("fpr"),
        _share(F.col("tp"), steps.n_pos).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve).orderBy(F.col("threshold").desc_nulls_first())


def cost_curve(
    df: DataFrame,
    costs: Costs = Costs(),
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
    points: int = CURVE_POINTS,
) -> DataFrame:
    """Cost per transaction against the flagged share, and the cheapest point (``optimal``)."""
    ranked = rank_scores(df, score, label, tie)

    def shaped(rows: DataFrame, point: str, cost: Column) -> DataFrame:
        return rows.select(
            F.lit(point).alias("point"),
            "flagged",
            _share(F.col("flagged"), ranked.n).alias("flagged_frac"),
            F.col("score").alias("threshold"),
            _share(cost, ranked.n).alias("cost_per_txn"),
        )

    thinned = ranked.rows.filter(evenly_spaced(F.col("flagged") - 1, F.lit(ranked.n), points))
    curve = shaped(thinned, "curve", costs.of(F.col("flagged"), F.col("tp"), ranked.n_pos))
    best = ranked.rows.agg(_cheapest(costs, ranked.n_pos).alias("best")).select("best.*")
    return curve.unionByName(shaped(best, "optimal", F.col("cost"))).orderBy("point", "flagged")


def decile_lift(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
    parts: int = DECILES,
) -> DataFrame:
    """Fraud rate, lift and cumulative recall per risk decile (1 = riskiest).

    The first ``n % parts`` deciles hold one row more than the others.
    """
    ranked = rank_scores(df, score, label, tie)
    size, rest = divmod(ranked.n, parts)
    at, long_rows = F.col("flagged"), rest * (size + 1)
    decile = F.when(at <= long_rows, F.ceil(at / (size + 1))).otherwise(
        rest + F.ceil((at - long_rows) / max(size, 1))
    )
    counts = ranked.rows.groupBy(decile.cast("int").alias("decile")).agg(
        F.count("*").alias("n"), F.sum("label").alias("frauds")
    )
    so_far = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # ten rows
    rate = F.col("frauds") / F.col("n")
    return counts.select(
        "decile",
        "n",
        "frauds",
        rate.alias("fraud_rate"),
        _lift(rate, ranked).alias("lift"),
        _share(F.sum("frauds").over(so_far), ranked.n_pos).alias("cumulative_recall"),
    ).orderBy("decile")


def _lift(rate: Column, ranked: Ranked) -> Column:
    """How many times the base rate."""
    return C.safe_ratio(rate, F.lit(ranked.n_pos / max(ranked.n, 1)))


def confusion_matrix(
    df: DataFrame, threshold: float | Column, score: str = "score", label: str = "is_fraud"
) -> DataFrame:
    """Counts and rates of flagging every row scored at or above ``threshold``."""
    at = F.lit(threshold) if isinstance(threshold, float) else threshold
    # a row without a score is not flagged, as in the rankings, where it comes last
    hit, bad = F.coalesce(F.col(score) >= at, F.lit(False)), F.col(label) == 1
    counts = df.agg(
        F.count_if(hit & bad).alias("tp"),
        F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & bad).alias("fn"),
        F.count_if(~hit & ~bad).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        C.ratio_or_zero(tp, tp + fp).alias("precision"),
        C.ratio_or_zero(tp, tp + fn).alias("recall"),
        C.ratio_or_zero(fp, fp + tn).alias("fpr"),
        C.ratio_or_zero(tp + fp, tp + fp + fn + tn).alias("flagged_frac"),
    )


def budget_scan(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    tie: str = "transaction_id",
    budgets: int = BUDGETS,
    span: tuple[float, float] = BUDGET_RANGE,
) -> DataFrame:
    """Recall, precision and lift for evenly spaced review budgets.

    Only the rows at the budget ranks are kept; they know how many frauds lie above.
    """
    ranked = rank_scores(df, score, label, tie)
    low, high = span
    gap = (high - low) / (budgets - 1)
    fractions = [low + i * gap for i in range(budgets - 1)] + [high]
    sizes = [top_k(ranked.n, f) for f in fractions]
    steps = df.sparkSession.createDataFrame(
        [(i + 1, k) for i, k in enumerate(sizes)], "step int, flagged long"
    )
    hits = ranked.rows.filter(F.col("flagged").isin(sizes)).select("flagged", "tp")
    precision = F.col("tp") / F.col("flagged")
    return (
        steps.join(hits, "flagged")
        .select(
            "step",
            _share(F.col("flagged"), ranked.n).alias("budget"),
            _share(F.col("tp"), ranked.n_pos).alias("recall"),
            precision.alias("precision"),
            _lift(precision, ranked).alias("lift"),
        )
        .orderBy("step")
    )


def top_risk(
    df: DataFrame,
    n: int = TOP_RISK_ROWS,
    score: str = "score",
    tie: str = "transaction_id",
) -> DataFrame:
    """The ``n`` riskiest rows with the time as text."""
    return (
        df.orderBy(F.desc(score), tie)
        .limit(n)
        .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )


def top_risk_view(top: DataFrame, rows: int = 25) -> DataFrame:
    """The head of ``top_risk`` under the names shown to reviewers."""
    named = top.orderBy(F.desc("score"), "transaction_id").limit(rows)
    return named.select(
        F.col("transaction_id").alias("Transaction ID"),
        F.col("ts").alias("Timestamp"),
        C.yes_no(F.col("is_fraud")).alias("Actually fraud"),
        F.col("score").alias("Risk score"),
    )


def model_comparison(metrics: dict[str, DataFrame], baseline: str, costs: Costs = Costs()) -> DataFrame:
    """One row per model: headline metrics, lift over the base rate and savings against ``baseline``.

    ``metrics`` holds one ``evaluate`` row per model, so the whole table has a
    handful of rows.
    """
    table = None
    for name, row in metrics.items():
        named = row.withColumn("model", F.lit(name))
        table = named if table is None else table.unionByName(named)
    everyone = Window.partitionBy()
    baseline_cost = F.max(F.when(F.col("model") == baseline, F.col("total_cost"))).over(everyone)
    top = F.col("precision_at_k")[precision_key(0.001)]
    return table.select(
        "model",
        "pr_auc",
        "roc_auc",
        *[
            F.col("recall_at_fpr")[recall_key(t)].alias(f"recall_at_fpr_{i}")
            for i, t in (("0_1pct", 0.001), ("1pct", 0.01), ("5pct", 0.05))
        ],
        top.alias("precision_at_top_0_1pct"),
        C.safe_ratio(top, F.col("n_pos") / F.col("n")).alias("lift_at_top_0_1pct"),
        "total_cost",
        "cost_per_txn",
        (baseline_cost - F.col("total_cost")).alias("savings"),
        (F.col("n_pos") * F.lit(costs.false_negative)).alias("do_nothing_cost"),
    ).orderBy("model")


def metrics_long(table: DataFrame, metrics: tuple[str, ...] = ("roc_auc", "pr_auc")) -> DataFrame:
    """Wide model table to ``(model, metric, value)``."""
    return table.unpivot("model", list(metrics), "metric", "value")
