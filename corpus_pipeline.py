"""A corpus pipeline over the ``documents`` table: toxic texts go, one of each group of near duplicates stays, leaked test items go,
personal data get surrogates, and what is left is packed into training sequences.

Every stage takes (spark, docs, sf_dir), where ``docs`` are the documents its predecessor kept, and returns a DataFrame; all but the last return the
columns of ``documents``. Between stages the rows are written as Parquet to the shared scratch folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import DOCUMENT_COLUMNS, stored, table
from ledgerlens.llm.decontam import decontaminate
from ledgerlens.llm.packing import pack
from ledgerlens.llm.pii import replace_pii
from ledgerlens.llm.setsketch import keep_first
from ledgerlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score stays below the threshold. The fit uses the labelled rows of the given documents."""
    return drop_toxic(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return keep_first(docs.select(*DOCUMENT_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark."""
    return decontaminate(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates for personal data and the length of the new text."""
    replaced = replace_pii(docs.select(*DOCUMENT_COLUMNS))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and place in it."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: SQL expresses neither a trained classifier nor a tokenizer; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
