"""Readers for the five raw files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas
from .sinks import finished


@dataclass(frozen=True)
class RawPaths:
    transactions: str
    users: str
    cards: str
    mcc: str
    labels: str
    labels_cache: str


@dataclass(frozen=True)
class RawTables:
    """The raw tables, whatever they were read from; None where a query needs no such table."""

    transactions: DataFrame
    users: DataFrame | None = None
    cards: DataFrame | None = None
    mcc: DataFrame | None = None
    labels: DataFrame | None = None


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema; empty fields are NULL, junk fails."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path)
    )


def read_mcc(spark: SparkSession, path: str) -> DataFrame:
    """Flat JSON object ``{code: description}`` as ``(mcc, mcc_desc)``.

    Category codes have four digits, so the file is small whatever the volume.
    """
    document = spark.read.text(path, wholetext=True)
    codes = document.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("code", "mcc_desc")
    )
    return codes.select(F.col("code").cast("long").alias("mcc"), "mcc_desc")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``{"target": {id: "Yes" | "No"}}`` as ``(id, is_fraud)``; only "Yes" is 1, other sections are left out.

    One JSON document has no line breaks to split at, but it has commas: reading
    it with the comma as record separator gives every task its own byte range of
    the file. Records that open or close a section are few; their depths, in file
    order, tell where the section ``target`` of the document begins and ends.
    Pairs repeated in the file stay repeated; a file without the section fails.
    """
    records = spark.read.option("lineSep", ",").text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("at"),
    )
    opens, closes = F.regexp_count("value", F.lit("\\{")), F.regexp_count("value", F.lit("\\}"))
    brackets = records.filter(F.col("value").rlike("[{}]")).select("value", "at", (opens - closes).alias("change"))
    in_order = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    depths = brackets.withColumn("depth", F.sum("change").over(in_order))
    ahead = F.regexp_extract("value", _TARGET, 1)
    before = F.col("depth") - F.col("change") + F.regexp_count(ahead, F.lit("\\{")) - F.regexp_count(ahead, F.lit("\\}"))
    begin = depths.filter(F.col("value").rlike(_TARGET) & (before == 1)).agg(F.min("at")).first()[0]
    if begin is None:
        raise ValueError(f"no section target in {path}")
    first = F.struct(*[F.lit(v).alias(k) for k, v in begin.asDict().items()])
    last = depths.filter((F.col("at") >= first) & (F.col("depth") <= 1) & F.col("value").contains("}"))
    end = last.agg(F.min("at")).first()[0]
    inside = records.filter(F.col("at") >= first)
    if end is not None:
        inside = inside.filter(F.col("at") <= F.struct(*[F.lit(v).alias(k) for k, v in end.asDict().items()]))
    opened = F.when(F.col("at") == first, F.regexp_replace("value", _TARGET, "")).otherwise(F.col("value"))
    pair = F.regexp_extract(opened, r"^([^}]*)", 1)
    key = F.regexp_extract(pair, r'"(-?\d+)"\s*:', 1)
    return inside.filter(key != "").select(
        key.cast("long").alias("id"),
        pair.rlike(r'"-?\d+"\s*:\s*"Yes"').cast("tinyint").alias("is_fraud"),
    )


#: What stands before the section of labels, and its opening.
_TARGET = r'(?s)^(.*?)"target"\s*:\s*\{'


def load_labels(spark: SparkSession, path: str, cache_path: str, force: bool = False) -> DataFrame:
    """Labels from the Parquet cache; parsed and cached on a miss, after an unfinished write or on ``force``."""
    if force or not finished(spark, cache_path):
        read_labels(spark, path).write.mode("overwrite").option("compression", "zstd").parquet(cache_path)
    return spark.read.parquet(cache_path).select("id", "is_fraud")


def read_raw(spark: SparkSession, paths: RawPaths, force: bool = False) -> RawTables:
    return RawTables(
        transactions=read_csv_table(spark, paths.transactions, schemas.TRANSACTIONS),
        users=read_csv_table(spark, paths.users, schemas.USERS),
        cards=read_csv_table(spark, paths.cards, schemas.CARDS),
        mcc=read_mcc(spark, paths.mcc),
        labels=load_labels(spark, paths.labels, paths.labels_cache, force),
    )


def register_views(raw: RawTables) -> None:
    """A temporary view of each table that was read, under the name of its field."""
    for name, table in vars(raw).items():
        if table is not None:
            table.createOrReplaceTempView(name)
