"""Benchmark decontamination by spaced-seed hashing.

Each mask names some of a few consecutive token positions and ignores the others. Hashes of the named tokens are taken at
every position of the test items and of the training texts and joined; a hit fixes a diagonal (training position less item
position). Around the hit the two token sequences are compared position by position along the diagonal, so substituted tokens
cost one match each. A document is contaminated where, in some window of ``WINDOW`` positions of an item (or the whole item, if
shorter), at least ``PERCENT`` percent of the tokens agree and at least as many distinct tokens as ``LEAST_DISTINCT``; an item that is
shorter than a window and has fewer distinct tokens must agree in all of them. So items of up to five different tokens are found word for word.

The training table is never shuffled. Test items are broadcast: at most ``BLOCK_TOKENS`` tokens at once, counted beforehand;
a larger benchmark is cut into blocks by a hash of the item, each of which is held against all documents.

Defined results: null or empty texts, on either side, match nothing; test items with equal text are one, reported by the smallest
``item_id``; different texts are different items, also where they share an ``item_id`` or have none; rows with the same ``doc_id`` are judged one by one; empty tables give no contamination; a null ``doc_id`` stays null;
other columns are ignored by ``overlaps`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, row_key, table
from ledgerlens.llm.words import hashed_places, places, words

#: Positions named by each mask: of 5 and of 7 consecutive tokens.
MASKS = [(0, 1, 3, 4), (0, 2, 5, 6)]
#: Further masks, for items of these lengths alone and hashed only where a benchmark has some: with the first, every placement of the
#: substitutions that an item of 3 to 12 tokens may have leaves some mask whole (all placements were enumerated; tests repeat it).
SHORT_MASKS = [((0, 1, 2), 3, 12), ((0, 1), 2, 2), ((0,), 1, 1)]
#: A window of an item is leaked if so many percent of its tokens agree.
WINDOW, PERCENT, LEAST_DISTINCT = 13, 75, 5
#: Tokens of test items that are broadcast at once (some 30 bytes each and mask).
BLOCK_TOKENS = 400_000


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def test_items(benchmark: DataFrame) -> DataFrame:
    """``item_key, item_id, item`` (token hashes) of the distinct non-empty test texts; the key is a hash of the whole text's tokens."""
    read = benchmark.select("item_id", _hashes(F.col("text")).alias("item")).filter(F.size("item") > 0)
    return read.groupBy("item").agg(F.min("item_id").alias("item_id")).select(F.xxhash64("item").alias("item_key"), "item_id", "item")


def _agreement(doc: str, item: str, shift: str) -> Column:
    """Place by place of the item: does the document hold the same token there?"""
    def same(i: Column) -> Column:
        at = i + F.col(shift)
        return (at >= 0) & (F.get(F.col(doc), F.greatest(at, F.lit(0))) == F.get(F.col(item), i))

    return F.transform(places(F.size(item)), lambda i: F.coalesce(same(i), F.lit(False)).cast("int"))


def _best_window(agreed: str, item: str) -> Column:
    """(agreeing tokens, start) of the window of the item that agrees most, where enough distinct tokens agree."""
    size = F.size(agreed)
    width = F.least(size, F.lit(WINDOW))
    least = F.when(size < WINDOW, F.least(F.lit(LEAST_DISTINCT), F.size(F.array_distinct(F.col(item))))).otherwise(LEAST_DISTINCT)

    def window(i: Column) -> Column:
        part = F.slice(F.col(agreed), i + 1, width)
        total = F.aggregate(part, F.lit(0), lambda x, y: x + y)
        tokens = F.zip_with(part, F.slice(F.col(item), i + 1, width), lambda x, t: F.when(x == 1, t))
        distinct = F.size(F.array_compact(F.array_distinct(tokens)))
        enough = (total * 100 >= width * PERCENT) & (distinct >= least)
        return F.struct(F.when(enough, total).otherwise(0).alias("n"), (-i).alias("at"))

    return F.array_max(F.transform(F.sequence(F.lit(0), size - width), window))


def _masks(items: DataFrame) -> tuple[int, list[tuple[tuple[int, ...], int, int]]]:
    """How many tokens the items have, and the masks their lengths need with the least and greatest length each is for."""
    size = F.size("item")
    any_of = [F.max(size.between(low, high)).alias(f"m{k}") for k, (_, low, high) in enumerate(SHORT_MASKS)]
    held = items.agg(F.sum(size).alias("total"), *any_of).first()
    short = [m for k, m in enumerate(SHORT_MASKS) if held[f"m{k}"]]
    return held["total"] or 0, [(m, 1, 2**31 - 1) for m in MASKS] + short


def _in_block(docs: DataFrame, items: DataFrame, masks: list[tuple[tuple[int, ...], int, int]]) -> DataFrame:
    shapes = [m for m, _, _ in masks]
    mask, item_pos, size = F.col("p") % len(masks), F.floor(F.col("p") / len(masks)).cast("int"), F.size("item")
    # a mask serves items of its lengths, where it does not reach beyond their end
    fits = [(mask == k) & size.between(low, high) & (item_pos + shape[-1] < size) for k, (shape, low, high) in enumerate(masks)]
    seeds = items.select("item_key", "item", F.posexplode(hashed_places(items, "item", shapes)).alias("p", "seed"))
    seeds = seeds.filter(reduce(or_, fits)).select("item_key", "seed", item_pos.alias("item_pos"))
    # hashes in a step of their own: the explode and both joins then run as one generated loop, which holds the tokens by reference
    hashed = docs.select("row", "doc_id", "tokens", hashed_places(docs, "tokens", shapes).alias("seeds"))
    hits = hashed.select("row", "doc_id", "tokens", F.posexplode_outer("seeds").alias("p", "seed"))
    shift = F.floor(F.col("p") / len(masks)).cast("int") - F.col("item_pos")
    found = hits.join(F.broadcast(seeds), "seed").select("row", "doc_id", "tokens", "item_key", shift.alias("shift"))
    # only the stretch that the item may cover goes on
    near = found.join(F.broadcast(items), "item_key").select(
        "row", "doc_id", "item_key", "item_id", "item", "shift",
        F.slice("tokens", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item") + F.least(F.col("shift"), F.lit(0))).alias("part"),
        F.least(F.col("shift"), F.lit(0)).alias("lead"),
    )
    # once for each diagonal; the aggregate also keeps the optimizer from repeating what follows inside the joins
    once = near.groupBy("row", "doc_id", "item_key", "item_id", "shift").agg(F.first("item").alias("item"), F.first("part").alias("part"), F.first("lead").alias("lead"))
    judged = once.select("row", "doc_id", "item_key", "item_id", "shift", "item", _agreement("part", "item", "lead").alias("agreed"))
    total = F.aggregate("agreed", F.lit(0), lambda x, y: x + y)
    return judged.select("row", "doc_id", "item_key", "item_id", "shift", F.size("item").alias("n_item"), total.alias("matched"), _best_window("agreed", "item").alias("best"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps, one row for each document row and distinct item text: its best diagonal.

    ``shift``: where in the document (token) the item would begin; ``matched``: agreeing tokens along the diagonal;
    ``window_start``: first token in the document of the best window.
    """
    items = test_items(benchmark)
    total, masks = _masks(items)
    blocks = -(-total // (BLOCK_TOKENS // 2)) or 1
    tokens = docs.select(row_key().alias("row"), F.col("doc_id"), _hashes(F.col("text")).alias("tokens"))
    found = None
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        one = _in_block(tokens, part, masks)
        found = one if found is None else found.union(one)
    window = F.struct(F.col("best.n").alias("n"), "matched", (F.col("shift") - F.col("best.at")).alias("window_start"), "shift")
    best = found.groupBy("row", "doc_id", "item_key", "item_id", "n_item").agg(F.max(window).alias("m")).filter("m.n > 0")
    return best.select("row", "doc_id", "item_id", "n_item", "m.matched", "m.shift", "m.window_start")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per contaminated document row: how many items leak and the share of the best one that agrees."""
    share = F.struct((F.col("matched") / F.col("n_item")).alias("share"), (-F.col("item_id")).alias("item"))
    return overlaps(docs, benchmark).groupBy("row", "doc_id").agg(F.count("*").alias("n_items"), F.max(share).alias("m")).select(
        "row", "doc_id", "n_items", (-F.col("m.item")).alias("item_id"), F.col("m.share").alias("overlap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without contaminated ones, columns as they came."""
    key = fresh(docs, "row")
    found = contaminated(docs, benchmark).select(F.col("row").alias(key))
    return docs.withColumn(key, row_key()).join(found, key, "left_anti").drop(key)


def op2_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: ``contaminated``, ``n_items`` (leaked items), ``item_id`` and ``overlap`` of the fullest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).drop("doc_id")
    rows = docs.select("doc_id", row_key().alias("row"))
    joined = rows.join(found, "row", "left")
    return joined.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", F.coalesce("overlap", F.lit(0.0)).alias("overlap"))
