"""Helpers the corpus operators share: inputs, scratch tables, native word arrays."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path, ship, task_count

#: Columns of the documents table; a filtering stage of the pipeline returns exactly these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside send Python workers batches of at most ``size`` bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, held) if held is not None else spark.conf.unset(key)


def buckets(spark: SparkSession, per_task: int = 16) -> int:
    """How many groups to cut a table into so that every shuffle task gets several of them."""
    return per_task * task_count(spark)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def row_key() -> Column:
    """A key for each row of a file scan, so that repeated document ids stay apart."""
    return F.monotonically_increasing_id()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crowded_keys(rows: DataFrame, key: str) -> list:
    """Keys that hold more than a task's fair share of the stored ``rows``: fewer than 4 * tasks of them, whatever the data."""
    share = max(100, rows.count() // (4 * task_count(rows.sparkSession)))
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > share)
    return [r[0] for r in counts.filter(F.col(key).isNotNull()).select(key).collect()]


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, crowded: list | None = None) -> DataFrame:
    """Inner join of the stored ``rows`` with ``lookup``, which has one row for each ``key``.

    Rows of crowded keys stay where they are and get their lookup rows, fewer than 4 * tasks, by broadcast; the others are joined by shuffle.
    """
    crowded = crowded_keys(rows, key) if crowded is None else crowded
    if not crowded:
        return rows.join(lookup, key)
    keys = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in crowded], rows.select(key).schema))
    few = F.broadcast(lookup.join(keys, key, "left_semi"))
    return rows.join(keys, key, "left_semi").join(few, key).union(rows.join(keys, key, "left_anti").join(lookup, key))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name = f"_{name}"
    return name
