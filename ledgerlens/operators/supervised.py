"""Logistic baseline, and what the trees of ``boosting`` gained."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed
from .boosting import PREDICTION, Boosted
from .features import NUMERIC_FEATURES, TARGET
from .matrix import Scaler, fit_scaler, zero_filled
from .sampling import BASELINE_NEGATIVES, stratified_subsample

# Training parameters.
LOGISTIC_ITERATIONS = 300
TOP_FEATURES = 20


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


@dataclass(frozen=True)
class Baseline:
    scaler: Scaler
    model: LogisticRegressionModel
    columns: list[str]

    def score(self, df: DataFrame) -> DataFrame:
        """Prediction rows with P(fraud) as ``score``."""
        ready = _vectors(self.scaler.transform(zero_filled(df, self.columns)), self.columns)
        probability = vector_to_array("probability").getItem(1)
        return self.model.transform(ready).select(*PREDICTION, probability.alias("score"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Model, columns and scaler together: what scoring new rows needs."""
        self.model.write().overwrite().save(f"{path}/model")
        rows = [(i, c, self.scaler.means[c], self.scaler.deviations[c]) for i, c in enumerate(self.columns)]
        table = spark.createDataFrame(rows, "place int, column string, mean double, deviation double")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Baseline:
        rows = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
        scaler = Scaler({r["column"]: r["mean"] for r in rows}, {r["column"]: r["deviation"] for r in rows})
        return Baseline(scaler, LogisticRegressionModel.load(f"{path}/model"), [r["column"] for r in rows])


def fit_baseline(
    train: DataFrame,
    max_negatives: int = BASELINE_NEGATIVES,
    iterations: int = LOGISTIC_ITERATIONS,
    columns: list[str] = NUMERIC_FEATURES,
) -> Baseline:
    """L2 logistic regression on all frauds and a sample of the rest, classes weighted evenly."""
    # The sample decides the fit, so it is drawn once and stored.
    rows = checkpointed(
        zero_filled(stratified_subsample(train, max_negatives, "transaction_id", TARGET), columns)
    )
    scaler = fit_scaler(rows, columns)
    n_pos, n = rows.agg(F.count_if(F.col(TARGET) == 1), F.count("*")).first()
    weight = F.when(F.col(TARGET) == 1, n / (2 * max(n_pos, 1))).otherwise(n / (2 * max(n - n_pos, 1)))
    ready = _vectors(scaler.transform(rows), columns).withColumn("weight", weight)
    # Weights add up to n, and the penalty counts against the mean loss: C = 1 is 1 / n.
    logistic = LogisticRegression(
        labelCol=TARGET,
        weightCol="weight",
        maxIter=iterations,
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
    )
    return Baseline(scaler, logistic.fit(ready), columns)


def feature_importance(spark: SparkSession, boosted: Boosted, top: int = TOP_FEATURES) -> DataFrame:
    """The columns that gained most, shares adding up to 1 over all columns."""
    table = spark.createDataFrame(list(boosted.importance().items()), "feature string, gain double")
    return table.orderBy(F.desc("gain"), "feature").limit(top)
