import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture()
def frame(spark):
    """A documents table from (doc_id, text) rows, with further columns under names that operators use themselves."""

    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return df.select("doc_id", "text", F.lit("x").alias("row"), F.lit(1).alias("score"), F.lit(2).alias("n"))

    return make


ODD = [(5, None), (3, ""), (4, "a"), (None, "b c"), (4, "a"), (9, " \n\t "), (7, "word " * 30000), (8, None)]
