"""The driver's tables reshaped as the raw tables of a card data set.

Only column expressions and key joins; every row of the source is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.enrich import ALL_DIMENSIONS
from ledgerlens.sources.readers import RawTables


# Declared, so that opening a table does not start a job to read its footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING""",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _dollars(amount) -> F.Column:
    """Exact text of a double with a currency sign: 12.5 -> '$12.5'."""
    return F.concat(F.lit("$"), amount.cast("string"))


def _dollars_grouped(amount) -> F.Column:
    """Two decimals and thousands separators: 1863.84 -> '$1,863.84'."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        (key % 70 + 18).cast("int").alias("current_age"),
        (key % 10 + 60).cast("int").alias("retirement_age"),
        (key % 70 + 1930).cast("int").alias("birth_year"),
        (key % 12 + 1).cast("int").alias("birth_month"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.col("c_name").alias("address"),
        (F.col("c_nationkey") * 1.5).alias("latitude"),
        (F.col("c_nationkey") * -2.5).alias("longitude"),
        _dollars_grouped(F.col("c_acctbal")).alias("per_capita_income"),
        _dollars(key * 10).alias("yearly_income"),
        _dollars(key % 5000).alias("total_debt"),
        (key % 551 + 300).cast("int").alias("credit_score"),
        (key % 5 + 1).cast("int").alias("num_credit_cards"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    opened = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("acct_open_date"))
    )
    regions = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    )
    customers = table(spark, sf_dir, "customer").join(opened, "c_custkey", "left")
    return customers.join(regions, "c_nationkey", "left").select(
        key.alias("id"),
        key.alias("client_id"),
        F.col("c_mktsegment").alias("card_brand"),
        F.col("r_name").alias("card_type"),
        F.lpad(key.cast("string"), 16, "4").alias("card_number"),
        F.lit("12/2030").alias("expires"),
        F.lpad((key % 1000).cast("string"), 3, "0").alias("cvv"),
        F.when(key % 3 == 0, "NO").otherwise("YES").alias("has_chip"),
        (key % 3 + 1).cast("int").alias("num_cards_issued"),
        _dollars_grouped(F.col("c_acctbal")).alias("credit_limit"),
        "acct_open_date",
        (key % 20 + 2000).cast("int").alias("year_pin_last_changed"),
        F.when(key % 50 == 0, "Yes").otherwise("No").alias("card_on_dark_web"),
    )


def mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 5000).cast("long").alias("mcc"),
        F.concat(F.lit("Trade "), F.col("n_name")).alias("mcc_desc"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: the user is the card, ``props.k`` the merchant."""
    merchant = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events").withColumn("merchant_id", merchant)
    nation, region = F.col("n_name"), F.col("n_regionkey")
    state = (
        F.when(region == 0, F.lit(None))
        .when(region <= 2, F.concat(F.lit("N"), (F.col("n_nationkey") % 10).cast("string")))
        .otherwise(nation)
    )
    # Merchants sit in one of the 25 nations.
    places = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("_nation"),
        nation.alias("merchant_city"),
        state.alias("merchant_state"),
    )
    return (
        events.withColumn("_nation", F.col("merchant_id") % 25)
        .join(places, "_nation", "left")
        .select(
            F.col("event_id").alias("id"),
            F.col("ts").cast("timestamp_ntz").alias("date"),
            F.col("user_id").alias("client_id"),
            F.col("user_id").alias("card_id"),
            _dollars(F.col("value")).alias("amount"),
            F.col("event_type").alias("use_chip"),
            "merchant_id",
            "merchant_city",
            "merchant_state",
            (F.col("merchant_id") * 100.0).alias("zip"),
            # Codes above 5024 have no description.
            (F.col("merchant_id") % 30 + 5000).alias("mcc"),
            F.when(F.col("user_id") % 7 == 0, "Bad PIN").alias("errors"),
        )
    )


def sparse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a few percent of the events, all in the first days."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("tinyint").alias("is_fraud")
    )


def dense_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error is a fraud; sign-ups carry no label."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") != "signup")
        .select(
            F.col("event_id").alias("id"),
            (F.col("event_type") == "error").cast("tinyint").alias("is_fraud"),
        )
    )


def raw_tables(
    spark: SparkSession, sf_dir: str, dense: bool = False, dims: tuple[str, ...] = ALL_DIMENSIONS
) -> RawTables:
    """The raw tables; those not in ``dims`` are not opened."""
    build = {"users": users, "cards": cards, "mcc": mcc, "labels": dense_labels if dense else sparse_labels}
    tables = {name: make(spark, sf_dir) if name in dims else None for name, make in build.items()}
    return RawTables(transactions=event_transactions(spark, sf_dir), **tables)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as labeled transactions: P is a fraud, F is none, O is still open."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("use_chip"),
        F.when(status == "P", 1).when(status == "F", 0).alias("is_fraud"),
    )


def item_facts(spark: SparkSession, sf_dir: str, category: bool = False, city: bool = False) -> DataFrame:
    """Line items as labeled transactions: returned is a fraud, accepted is none.

    The supplier is the merchant; ``category`` adds the type of the part and
    ``city`` the nation of the supplier.
    """
    flag = F.col("l_returnflag")
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("amount"),
        F.col("l_suppkey").alias("merchant_id"),
        "l_partkey",
        F.when(flag == "R", 1).when(flag == "A", 0).alias("is_fraud"),
    )
    if category:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("mcc_desc")
        )
        items = items.join(parts, "l_partkey", "left")
    if city:
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("merchant_city")
        )
        suppliers = table(spark, sf_dir, "supplier").join(nation, "s_nationkey", "left")
        places = suppliers.select(F.col("s_suppkey").alias("merchant_id"), "merchant_city")
        items = items.join(places, "merchant_id", "left")
    return items.drop("l_partkey")


def scored(spark: SparkSession, sf_dir: str, ties: bool = False) -> DataFrame:
    """Orders with a score and a 0/1 outcome; ``ties`` leaves a dozen distinct scores."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_fraud"),
        (F.round(price / 50000) if ties else price / 500000).alias("score"),
    )
