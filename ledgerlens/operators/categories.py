"""Category codes without a limit on the number of categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import checkpointed, task_count
from .enrich import join_dimension
from .skew import BROADCAST_ROWS

_VOCABULARY = "place int, value string, code long"


@dataclass(frozen=True)
class Categories:
    """``vocabulary`` holds ``(place, value, code)`` for each value of the column at that place; ``sizes`` how many a column has."""

    columns: list[str]
    vocabulary: DataFrame
    sizes: list[int]

    def transform(self, df: DataFrame, spread_by: str = "transaction_id") -> DataFrame:
        """Add ``<column>_code``; a value that was not fitted gets the number of categories.

        Short lists of values are broadcast, all together at most ``BROADCAST_ROWS`` of them; beyond that rows are joined by shuffle, those of hot values salted.
        """
        room = BROADCAST_ROWS
        for place in sorted(range(len(self.columns)), key=lambda i: self.sizes[i]):
            column, size = self.columns[place], self.sizes[place]
            room -= size
            codes = self.vocabulary.filter(F.col("place") == place).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            named = df.withColumn("_value", C.category_or_missing(F.col(column)))
            if room >= 0:
                joined = named.join(F.broadcast(codes), "_value", "left")
            else:
                joined = join_dimension(named, codes, "_value", spread_by, broadcast_rows=0)
            df = joined.withColumn(f"{column}_code", F.coalesce("_code", F.lit(size).cast("long"))).drop("_value", "_code")
        return df

    def save(self, path: str) -> None:
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/values")
        rows = [(i, c, n) for i, (c, n) in enumerate(zip(self.columns, self.sizes, strict=True))]
        table = self.vocabulary.sparkSession.createDataFrame(rows, "place int, column string, size long")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Categories:
        rows = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
        return Categories([r["column"] for r in rows], spark.read.parquet(f"{path}/values"), [r["size"] for r in rows])


def fit_categories(df: DataFrame, columns: list[str]) -> Categories:
    """Number the distinct values of each column 0, 1, ... in alphabetical order, a missing one being a value too.

    All columns are numbered together: distinct (column, value) pairs are cut into ranges, each range counts and numbers its own,
    and prefix sums of the counts, one row for each range and column, are added. Only the number of values of each column reaches the driver.
    """
    spark, tasks = df.sparkSession, task_count(df.sparkSession)
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), C.category_or_missing(F.col(c)).alias("value")) for i, c in enumerate(columns)])
    distinct = df.select(F.inline(pairs)).distinct()
    # the range a value falls into depends on a sample, so it is stored with the value
    ranged = distinct.repartitionByRange(tasks, "place", "value").withColumn("part", F.spark_partition_id())
    stored = checkpointed(ranged)
    counts = stored.groupBy("place", "part").agg(F.count("*").alias("n")).collect()
    sizes, before = [0] * len(columns), []
    for place, part, n in sorted((r["place"], r["part"], r["n"]) for r in counts):
        before.append((place, part, sizes[place]))
        sizes[place] += n
    carried = F.broadcast(spark.createDataFrame(before, "place int, part int, base long"))
    order = Window.partitionBy("place", "part").orderBy("value")
    numbered = stored.withColumn("at", F.row_number().over(order)).join(carried, ["place", "part"])
    codes = numbered.select(F.col("place").cast("int").alias("place"), "value", (F.col("base") + F.col("at") - 1).alias("code"))
    return Categories(list(columns), checkpointed(codes) if before else spark.createDataFrame([], _VOCABULARY), sizes)
