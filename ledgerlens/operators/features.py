"""The modelling table: static, calendar and strictly-prior features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.readers import RawTables
from .enrich import attach_dimensions, transaction_facts
from .history import with_history
from .quantiles import kth_values

# Model columns; the order is the order of the feature vector.
NUMERIC_FEATURES = [
    "amount", "txn_hour", "txn_dow", "txn_month", "is_weekend", "is_night", "current_age",
    "credit_score", "num_credit_cards", "per_capita_income", "yearly_income", "total_debt",
    "credit_limit", "amount_to_limit", "card_prior_txn_count", "card_merchant_prior_count",
    "card_prior_avg_amount", "card_prior_std_amount", "card_prior_max_amount",
    "sec_since_prev_txn", "amount_dev_from_prior_avg", "amount_z", "is_first_txn",
    "card_age_years", "merchant_prior_count",
]

CATEGORICAL_FEATURES = [
    "use_chip", "errors", "merchant_state", "mcc", "mcc_desc", "card_brand", "card_type",
    "has_chip", "card_on_dark_web", "gender",
]

TARGET = "is_fraud"

# The columns of the feature table, in order.
FEATURE_TABLE = [
    "transaction_id", "ts", "is_fraud", "amount", "txn_hour", "txn_dow", "txn_month",
    "is_weekend", "is_night", "use_chip", "errors", "merchant_state", "mcc", "mcc_desc",
    "card_brand", "card_type", "has_chip", "card_on_dark_web", "current_age", "gender",
    "credit_score", "num_credit_cards", "per_capita_income", "yearly_income", "total_debt",
    "credit_limit", "amount_to_limit", "card_prior_txn_count", "card_merchant_prior_count",
    "merchant_prior_count", "card_prior_avg_amount", "card_prior_std_amount",
    "card_prior_max_amount", "sec_since_prev_txn", "amount_dev_from_prior_avg", "amount_z",
    "is_first_txn", "card_age_years",
]


def calendar_features(ts: Column) -> dict[str, Column]:
    return {
        "txn_hour": C.hour_of_day(ts),
        "txn_dow": C.day_of_week(ts),
        "txn_month": C.month_of_year(ts),
        "is_weekend": C.weekend_flag(ts),
        "is_night": C.night_flag(ts),
    }


def amount_z(amount: Column, prior_avg: Column, prior_std: Column) -> Column:
    """NULL without spread: first row, second row and constant history."""
    return F.when(prior_std > 0, (amount - prior_avg) / prior_std)


def history_features(df: DataFrame) -> DataFrame:
    """Model columns from the raw window columns of ``with_history``.

    Deviations use the raw prior mean (NULL on the first row), the published mean
    and deviation are 0 there, and the published maximum is the row's own amount.
    """
    amount, ts, prev = F.col("amount"), F.col("ts"), F.col("card_prev_ts")
    avg, std, highest = (F.col(f"card_prior_{s}_amount") for s in ("avg", "std", "max"))
    return df.withColumns(
        {
            "amount_dev_from_prior_avg": amount - avg,
            "amount_z": amount_z(amount, avg, std),
            "sec_since_prev_txn": C.seconds_between(prev, ts),
            "is_first_txn": prev.isNull().cast("int"),
            "card_prior_avg_amount": F.coalesce(avg, F.lit(0.0)),
            "card_prior_std_amount": F.coalesce(std, F.lit(0.0)),
            "card_prior_max_amount": F.coalesce(highest, amount),
        }
    )


def static_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **calendar_features(F.col("ts")),
            "amount_to_limit": C.safe_ratio(F.col("amount"), F.col("credit_limit")),
            "card_age_years": (F.year("ts") - F.year("acct_open_date")).cast("long"),
        }
    )


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The earliest ``n`` transactions by ``(ts, transaction_id)``, rows without a time last; ids are unique.

    The instant of the last one is looked up, then its id among the rows of that instant. The result is a filter: no task holds ``n`` rows.
    """
    if n <= 0:
        return df.limit(0)
    last = kth_values(df, "ts", lambda total: {"last": F.lit(n - 1)}).first()
    if last is None:
        before, tied = F.col("ts").isNotNull(), F.col("ts").isNull()
    else:
        instant = C.naive_instant(last["value"])
        before, tied = F.col("ts") < instant, F.col("ts") == instant
    counts = df.agg(F.count_if(before).alias("before"), F.count_if(tied).alias("tied")).first()
    wanted = n - counts["before"]
    if wanted >= counts["tied"]:
        return df.filter(before | tied)
    edge = kth_values(df.filter(tied), "transaction_id", lambda total: {"last": F.lit(wanted - 1)}).first()["value"]
    return df.filter(before | (tied & (F.col("transaction_id") <= F.lit(edge))))


def build_features(
    raw: RawTables, sample_rows: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Feature table from the raw tables.

    History needs five columns only, all from the transactions, so labels are
    joined and the windows run while rows are narrow; cards, cardholders and
    categories come last. Every joined side has one row per key, so the result is
    the same as joining first.
    """
    facts = transaction_facts(raw.transactions).drop("merchant_city", "zip")
    if sample_rows:
        facts = first_rows(facts, sample_rows)
    rows = with_history(attach_dimensions(facts, raw, ("labels",)), hot_rows=hot_rows)
    rows = attach_dimensions(rows, raw, ("mcc", "users", "cards"))
    return static_features(history_features(rows)).select(*FEATURE_TABLE)


def build_features_from_facts(facts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Feature table from an already materialised fact view."""
    return static_features(history_features(with_history(facts, hot_rows=hot_rows))).select(*FEATURE_TABLE)
