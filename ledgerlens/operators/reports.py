"""Aggregate reports over the fact view.

Every report is one partial-then-final aggregation on pruned columns, so a hot
value is reduced in the tasks that read it. Row order is presentation only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import checkpointed
from .quantiles import exact_quantiles

# Report sizes and thresholds.
TOP_ROWS = 15
STATE_MIN_ROWS = 2000
COUNTRY_MIN_ROWS = 200
HISTOGRAM_BINS = 60
EDA_AMOUNT_LIMIT = 2000.0
REPORT_AMOUNT_LIMIT = 1500.0


def labeled(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def rate_by(df: DataFrame, label: str = "is_fraud", **keys: Column) -> DataFrame:
    """Labeled rows and their fraud rate per combination of ``keys``."""
    rows = labeled(df, label).select(*[c.alias(name) for name, c in keys.items()], label)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(label).alias("fraud_rate"))


def rate_cuts(df: DataFrame, cuts: dict[str, Column]) -> dict[str, DataFrame]:
    """``rate_by`` for many single keys in one pass over the rows.

    The grouping sets are aggregated together; the result has one row per value of
    each key and is stored, so the reports read nothing else.
    """
    rows = labeled(df).select(*[c.alias(name) for name, c in cuts.items()], "is_fraud")
    sets = [[F.col(name)] for name in cuts]
    together = checkpointed(
        rows.groupingSets(sets, *[F.col(name) for name in cuts]).agg(
            F.count("*").alias("n"), F.avg("is_fraud").alias("fraud_rate"), F.grouping_id().alias("_set")
        )
    )
    # A key's bit in the grouping id is 0 where the set groups by it.
    everything = (1 << len(cuts)) - 1
    return {
        name: together.filter(F.col("_set") == everything - (1 << (len(cuts) - 1 - i))).select(
            name, "n", "fraud_rate"
        )
        for i, name in enumerate(cuts)
    }


def rate_by_hour(df: DataFrame) -> DataFrame:
    return rate_by(df, hour=C.hour_of_day(F.col("ts"))).orderBy("hour")


def rate_by_dow(df: DataFrame) -> DataFrame:
    rates = rate_by(df, dow=C.day_of_week(F.col("ts"))).orderBy("dow")
    return rates.withColumn("day", C.day_name(F.col("dow")))


def rate_by_month(df: DataFrame) -> DataFrame:
    return rate_by(df, month=C.month_start(F.col("ts"))).orderBy("month")


def rate_by_year(df: DataFrame) -> DataFrame:
    return rate_by(df, year=F.year("ts").cast("long")).orderBy("year")


def rate_by_channel(df: DataFrame) -> DataFrame:
    return rate_by(df, use_chip=F.col("use_chip")).orderBy(F.desc("fraud_rate"), "use_chip")


def rate_by_brand(df: DataFrame) -> DataFrame:
    return rate_by(df, card_brand=F.col("card_brand")).orderBy(F.desc("n"), "card_brand")


def rate_by_card_type(df: DataFrame) -> DataFrame:
    return rate_by(df, card_type=F.col("card_type")).orderBy(F.desc("n"), "card_type")


def rate_by_region(df: DataFrame) -> DataFrame:
    return rate_by(df, region=C.region(F.col("merchant_state"))).orderBy(F.desc("fraud_rate"), "region")


def _riskiest_places(df: DataFrame, name: str, condition: Column, min_rows: int, top: int) -> DataFrame:
    rates = rate_by(df.filter(condition), **{name: F.col("merchant_state")})
    return rates.filter(F.col("n") > min_rows).orderBy(F.desc("fraud_rate"), F.desc("n"), name).limit(top)


def rate_by_state(df: DataFrame, min_rows: int = STATE_MIN_ROWS, top: int = TOP_ROWS) -> DataFrame:
    return _riskiest_places(df, "state", F.length("merchant_state") == 2, min_rows, top)


def rate_by_country(df: DataFrame, min_rows: int = COUNTRY_MIN_ROWS, top: int = TOP_ROWS) -> DataFrame:
    return _riskiest_places(df, "country", F.length("merchant_state") > 2, min_rows, top)


def rate_by_credit_band(df: DataFrame) -> DataFrame:
    rows = labeled(df).filter(F.col("credit_score").isNotNull())
    bands = rows.groupBy(C.credit_band(F.col("credit_score")).alias("bucket")).agg(
        F.min("credit_score").alias("lo"),
        F.max("credit_score").alias("hi"),
        F.count("*").alias("n"),
        F.avg("is_fraud").alias("fraud_rate"),
    )
    return bands.withColumn("range", C.band_label(F.col("lo"), F.col("hi"))).orderBy("bucket")


def rate_by_time_flags(df: DataFrame) -> DataFrame:
    ts = F.col("ts")
    rates = rate_by(df, is_night=C.night_flag(ts), is_weekend=C.weekend_flag(ts))
    return rates.withColumn(
        "label", C.time_flags_label(F.col("is_night"), F.col("is_weekend"))
    ).orderBy("is_night", "is_weekend")


def category_by_volume(df: DataFrame, top: int = TOP_ROWS) -> DataFrame:
    """Categories with most labeled rows (not most frauds)."""
    rates = rate_by(df, mcc_desc=F.col("mcc_desc"))
    return rates.orderBy(F.desc("n"), F.col("mcc_desc").asc_nulls_last()).limit(top)


def category_by_frauds(df: DataFrame, top: int = TOP_ROWS) -> DataFrame:
    counts = df.filter(F.col("is_fraud") == 1).groupBy("mcc_desc").agg(F.count("*").alias("frauds"))
    return counts.orderBy(F.desc("frauds"), F.col("mcc_desc").asc_nulls_last()).limit(top)


def top_merchants(df: DataFrame, top: int = TOP_ROWS) -> DataFrame:
    """Merchants with most frauds; of several cities or categories the first by name is shown."""
    merchants = (
        df.filter(F.col("is_fraud") == 1)
        .groupBy("merchant_id")
        .agg(
            F.min("merchant_city").alias("city"),
            F.min("mcc_desc").alias("category"),
            F.count("*").alias("frauds"),
        )
        .orderBy(F.desc("frauds"), F.col("merchant_id").asc_nulls_last())
        .limit(top)
    )
    return merchants.withColumn("label", C.merchant_label(F.col("city"), F.col("category")))


def label_coverage(df: DataFrame) -> DataFrame:
    """Labeled and unlabeled rows and the period, over all rows."""
    return df.agg(
        F.count_if(F.col("is_fraud").isNotNull()).alias("labeled"),
        F.count_if(F.col("is_fraud").isNull()).alias("unlabeled"),
        F.min("ts").alias("date_min"),
        F.max("ts").alias("date_max"),
    )


def summary(facts: DataFrame, users: DataFrame, cards: DataFrame) -> DataFrame:
    """Row counts, frauds, the fraud rate over all rows and the one over labeled rows."""
    counts = (
        facts.agg(
            F.count("*").alias("transactions"),
            F.count_if(F.col("is_fraud") == 1).alias("frauds"),
            F.count_if(F.col("is_fraud").isNotNull()).alias("_labeled"),
        )
        .unionByName(users.agg(F.count("*").alias("users")), allowMissingColumns=True)
        .unionByName(cards.agg(F.count("*").alias("cards")), allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in ("transactions", "users", "cards", "frauds", "_labeled")])
    )
    return counts.select(
        "transactions",
        "users",
        "cards",
        "frauds",
        C.ratio_or_zero(F.col("frauds"), F.col("transactions")).alias("fraud_rate"),
        C.ratio_or_zero(F.col("frauds"), F.col("_labeled")).alias("labeled_fraud_rate"),
    )


def amount_stats(df: DataFrame) -> DataFrame:
    """Count, mean and exact quantiles of the amount per class."""
    rows = labeled(df).select("is_fraud", "amount")
    # The reported quantiles.
    quantiles = {"median": 0.5, "q25": 0.25, "q75": 0.75, "q95": 0.95}
    counts = {"n": F.count("*"), "mean": F.avg("amount")}
    found = exact_quantiles(rows, "amount", quantiles, ("is_fraud",), counts).orderBy("is_fraud")
    return found.withColumn("class", C.class_label(F.col("is_fraud")))


def class_histogram(
    df: DataFrame,
    value: str,
    label: str = "is_fraud",
    above: float | None = None,
    below: float | None = None,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Density histogram per class: equal bins over the class's own range, last bin closed.

    ``above`` and ``below`` leave out values outside the open interval first.
    """
    classes = df.filter(F.col(label).isin(0, 1))
    rows = classes.select(F.col(label).alias("label"), F.col(value).cast("double").alias("x"))
    if above is not None:
        rows = rows.filter(F.col("x") > above)
    if below is not None:
        rows = rows.filter(F.col("x") < below)
    rows = rows.filter(F.col("x").isNotNull())
    ranges = rows.groupBy("label").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("total")
    )
    # The filter leaves two classes, so the ranges are two rows at most.
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.floor((F.col("x") - F.col("lo")) / width))
    counts = (
        rows.join(F.broadcast(ranges), "label")
        .groupBy("label", F.least(place, F.lit(bins - 1)).cast("long").alias("bin"))
        .agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("lo", "hi", "total")])
    )
    return counts.select(
        C.class_label(F.col("label")).alias("class"),
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        "n",
        C.safe_ratio(F.col("n").cast("double"), F.col("total") * width).alias("density"),
    ).orderBy("class", "bin")
