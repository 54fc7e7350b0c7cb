"""Parquet and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table as ZSTD Parquet and return it read back."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet or its last write did not finish."""
    return spark.read.parquet(path) if finished(spark, path) else None


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def json_ready(df: DataFrame) -> DataFrame:
    """Doubles rounded to ten decimals, timestamps and dates as ISO text."""
    shaped = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 10)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        shaped.append(column.alias(field.name))
    return df.select(*shaped)


def write_report(df: DataFrame, path: str) -> None:
    """One report (at most a few hundred rows) as a single JSON part."""
    json_ready(df).coalesce(1).write.mode("overwrite").json(path)
