"""One row per transaction with its card, cardholder, category and label."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import task_count
from ..sources.readers import RawPaths, RawTables, read_raw, register_views
from .skew import BROADCAST_ROWS, fits_broadcast, flag_hot, hot_keys

# Labels are as long as the transactions and are joined by shuffle: first, while rows are narrow.
ALL_DIMENSIONS = ("labels", "mcc", "users", "cards")

# The columns of the fact view, in order.
FACT_COLUMNS = [
    "transaction_id", "ts", "amount", "use_chip", "merchant_id", "merchant_city",
    "merchant_state", "zip", "mcc", "errors", "mcc_desc", "client_id", "card_id",
    "current_age", "gender", "latitude", "longitude", "per_capita_income",
    "yearly_income", "total_debt", "credit_score", "num_credit_cards", "card_brand",
    "card_type", "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
    "year_pin_last_changed", "card_on_dark_web", "is_fraud",
]


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Guard against fan-out: of repeated keys the smallest row is kept.

    Being an aggregate on the key, it also lets Catalyst drop the left join
    altogether from queries that use none of the columns.
    """
    rest = [name for name in df.columns if name != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join on ``key``, of which ``dimension`` contributes one row per value.

    A dimension counted to be short is broadcast. Otherwise the rows of hot keys
    are dealt to salts, and only the few matching dimension rows are repeated.
    """
    short = fits_broadcast(dimension.select(key), broadcast_rows)
    dimension = one_row_per_key(dimension, key)
    if short:
        return fact.join(F.broadcast(dimension), key, "left")
    hot = hot_keys(fact, [key], hot_rows)
    if hot is None:
        return fact.join(dimension, key, "left")
    salts = task_count(fact.sparkSession)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    salted_fact = flag_hot(fact, [key], hot).withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dimension = flag_hot(dimension, [key], hot).withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_fact.join(salted_dimension, [key, "_salt"], "left").drop("_hot", "_salt")


def transaction_facts(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        F.col("id").alias("transaction_id"),
        F.col("date").alias("ts"),
        C.money(F.col("amount")).alias("amount"),
        "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors",
        "client_id", "card_id",
    )


def card_facts(cards: DataFrame) -> DataFrame:
    """Card attributes; card number, expiry and CVV never leave the raw table."""
    return cards.select(
        F.col("id").alias("card_id"), "card_brand", "card_type", "has_chip", "num_cards_issued",
        C.money(F.col("credit_limit")).alias("credit_limit"),
        C.lenient_date(F.col("acct_open_date")).alias("acct_open_date"),
        "year_pin_last_changed", "card_on_dark_web",
    )


def user_facts(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("client_id"), "current_age", "gender", "latitude", "longitude",
        C.money(F.col("per_capita_income")).alias("per_capita_income"),
        C.money(F.col("yearly_income")).alias("yearly_income"),
        C.money(F.col("total_debt")).alias("total_debt"),
        "credit_score", "num_credit_cards",
    )


def label_facts(labels: DataFrame) -> DataFrame:
    """One label per transaction; a transaction marked fraud once is fraud."""
    return labels.groupBy(F.col("id").alias("transaction_id")).agg(
        F.max(F.col("is_fraud").cast("int")).alias("is_fraud")
    )


def attach_dimensions(facts: DataFrame, raw: RawTables, dims: Collection[str], **sizes: int) -> DataFrame:
    """Left-join the named dimensions; unlabeled transactions keep a NULL label."""
    for name in (d for d in ALL_DIMENSIONS if d in dims):
        if name == "labels":
            # Transaction ids are unique, so this key cannot be hot.
            facts = facts.join(label_facts(raw.labels), "transaction_id", "left")
            continue
        if name == "cards":
            dimension, key = card_facts(raw.cards), "card_id"
        elif name == "users":
            dimension, key = user_facts(raw.users), "client_id"
        else:
            dimension, key = raw.mcc, "mcc"
        facts = join_dimension(facts, dimension, key, "transaction_id", **sizes)
    return facts


def enrich(raw: RawTables, dims: Collection[str] = ALL_DIMENSIONS, **sizes: int) -> DataFrame:
    """The fact view. Leave out of ``dims`` what a report does not read."""
    facts = attach_dimensions(transaction_facts(raw.transactions), raw, dims, **sizes)
    return facts.select(*[name for name in FACT_COLUMNS if name in facts.columns])


def prepare(spark: SparkSession, paths: RawPaths) -> DataFrame:
    """Read the raw files, register all views and return the fact view."""
    raw = read_raw(spark, paths)
    register_views(raw)
    facts = enrich(raw)
    facts.createOrReplaceTempView("tx_enriched")
    return facts
