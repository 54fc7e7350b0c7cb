"""Writes the adapted tables in the raw file formats, for the readers to read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path
from ledgerlens.sources.readers import RawPaths, RawTables


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; times keep their microseconds."""
    text = [
        F.col(name).cast("string").alias(name) if kind.startswith("timestamp") else F.col(name)
        for name, kind in df.dtypes
    ]
    df.select(*text).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_label_json(labels: DataFrame, path: str) -> str:
    """``{"target": {id: "Yes" | "No", ...}}`` between two other sections, one document over the sorted part files.

    The pieces are range-partitioned, so no task writes more than its share.
    """
    first = labels.agg(F.min("id")).first()[0]
    pair = F.concat(
        F.when(F.col("id") == F.lit(first), "").otherwise(","),
        F.lit('"'),
        F.col("id").cast("string"),
        F.when(F.col("is_fraud") == 1, '": "Yes"').otherwise('": "No"'),
    )
    body = labels.select(F.lit(1).alias("section"), "id", pair.alias("line"))
    spark = labels.sparkSession
    brackets = spark.createDataFrame(
        [(0, 0, '{"meta": {"7": "Yes", "note": {"target": {"9": "Yes"}}}, "target": {'), (2, 0, '}, "more": {"8": "Yes"}}')], "section int, id long, line string"
    )
    ordered = body.unionByName(brackets).orderBy("section", "id")
    ordered.select("line").write.mode("overwrite").text(path)
    return path


def write_mcc_json(mcc: DataFrame, path: str) -> str:
    """``{code: description}``; the lookup has 25 rows (one per nation)."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col("mcc").cast("string"), F.col("mcc_desc"))))
    document = mcc.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))
    document.write.mode("overwrite").text(path)
    return path


def write_raw(spark: SparkSession, raw: RawTables) -> RawPaths:
    folder = scratch_path(spark, "raw")
    return RawPaths(
        transactions=write_csv(raw.transactions, f"{folder}/transactions.csv"),
        users=write_csv(raw.users, f"{folder}/users.csv"),
        cards=write_csv(raw.cards, f"{folder}/cards.csv"),
        mcc=write_mcc_json(raw.mcc, f"{folder}/mcc.json"),
        labels=write_label_json(raw.labels, f"{folder}/labels.json"),
        labels_cache=f"{folder}/labels.parquet",
    )
