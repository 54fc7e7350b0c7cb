"""Contiguous shards of near-equal bytes from global prefix sums.

Documents lie in one order: by a hash of the text, equal texts by ``doc_id``. The order is cut into buckets by the leading hash
bits, which are uniform; a text that very many rows share gets buckets of its own, dealt by a hash of ``doc_id``. Every bucket sums
its own rows; prefix sums of the bucket totals (one small row each) carry the sums over. Shard k takes the rows whose middle byte
lies in the k-th of equal parts of all bytes, so shards are contiguous and differ from the mean by less than one of the largest
rows. Equal texts stay together where a group of them is no larger than the largest row; a longer one may be cut.

Defined results: the size of a null text is the overhead; repeated or null ``doc_id`` are rows of their own (nulls first, then by
row); an empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import buckets, row_key, stored, table
from ledgerlens.session import task_count

SHARDS, OVERHEAD = 40, 16


def utf8_size(text: Column) -> Column:
    """Bytes of the text in UTF-8; none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _narrow(docs: DataFrame, overhead: int) -> DataFrame:
    """One short row for each document: what order and size depend on. The text itself is never shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        row_key().alias("row"), F.col("doc_id").cast("long"), (utf8_size(F.col("text")) + overhead).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("hash"), F.col("text").isNull().alias("void"),
    )


def _bucketed(rows: DataFrame) -> DataFrame:
    """A bucket for each row, ascending in the order of the corpus; equal texts share one unless they are very many."""
    spark = rows.sparkSession
    n, tasks = buckets(spark), task_count(spark)
    total = rows.count()
    share = max(1, total // (4 * tasks))  # at most 4 * tasks texts have more rows than this
    group = ["hash", "text_crc32", "void"]
    hot = rows.groupBy(*group).agg(F.count("*").alias("copies")).filter(F.col("copies") > share)
    parts = F.ceil(F.col("copies") / share).cast("long")
    numbered = hot.select(*group, parts.alias("parts"), (F.sum(parts).over(Window.orderBy(*group)) - parts).alias("base"))
    leading = F.shiftrightunsigned("hash", 32) * n
    common = F.shiftrightunsigned(leading, 32)
    own = F.lit(n) + F.col("base") + F.pmod(F.xxhash64("doc_id", "row"), F.col("parts"))
    joined = rows.join(F.broadcast(numbered), group, "left")
    return joined.withColumn("bucket", F.coalesce(own, common)).withColumn("hot", F.col("parts").isNotNull()).drop("parts", "base")


def assign_shards(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """``row, doc_id, size, text_crc32, shard, slot`` of each document."""
    rows = stored(_bucketed(stored(_narrow(docs, overhead), "sizes")), "buckets")
    totals = rows.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("largest"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = totals.select(
        "bucket", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"), F.max("largest").over(everything).alias("largest"),
    )
    group = Window.partitionBy("bucket", "hash", "text_crc32", "void")
    order = Window.partitionBy("bucket").orderBy("hash", "text_crc32", "void", "doc_id", "row")
    summed = rows.select(
        "*", F.sum("size").over(order).alias("upto"), F.row_number().over(order).alias("k"),
        F.sum("size").over(group).alias("group_bytes"),
    )
    # a group that stays whole lies where its middle byte does; equal texts have equal sizes
    rank = F.row_number().over(Window.partitionBy("bucket", "hash", "text_crc32", "void").orderBy("doc_id", "row"))
    placed = summed.withColumn("rank", rank).join(F.broadcast(carried), "bucket")
    start = F.col("bytes_before") + F.col("upto") - F.col("size")
    group_start = start - F.col("size") * (F.col("rank") - 1)
    whole = ~F.col("hot") & (F.col("group_bytes") <= F.col("largest"))
    middle = F.when(whole, 2 * group_start + F.col("group_bytes")).otherwise(2 * start + F.col("size"))
    shard = F.least(F.floor(middle.cast("decimal(38,0)") * shards / (2 * F.col("all_bytes"))).cast("int"), F.lit(shards - 1))
    dealt = placed.select("row", "doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("k") - 1).alias("place"))
    dealt = stored(dealt, "shards")
    firsts = dealt.groupBy("shard").agg(F.min("place").alias("first"))
    return dealt.join(F.broadcast(firsts), "shard").select("row", "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op5_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assign_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
