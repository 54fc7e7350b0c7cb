"""Document fingerprints by I-Match.

The lexicon holds the terms (words, A-Z in lower case) whose share of documents lies in a chosen band, so neither the commonest nor
the rare ones. A document's terms in the lexicon are made distinct, sorted, and hashed once for each of several random lexicon
subsets. Subsets thin out with the length of the document: at level j a subset keeps one of 2**j of its terms, and a document
uses the three levels at which about one to four of its terms are left in each. Two fingerprints are alike in the share of subsets,
at the finest level both have, whose hashes agree.

The lexicon is counted: up to ``LEXICON_AT_ONCE`` terms are broadcast, more are joined by shuffle. Only terms that some subset of the
document may keep are looked up. Whole texts are shuffled once, dealt by ranges of ``doc_id``, where each finds the next document's beside it.

Defined results: a null text is an empty one; a text without lexicon terms is fingerprinted by all its terms; the document after the
last is the first; rows with the same ``doc_id`` follow each other in row order, nulls first; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import row_key, spread_join, stored, table, text_or_empty
from ledgerlens.llm.words import words
from ledgerlens.session import task_count

#: Band of the lexicon: least and greatest share of documents that hold a term.
LOW, HIGH = 0.002, 0.2
#: Random subsets, levels of each that a document uses, hexadecimal digits of a hash.
SUBSETS, LEVELS, DIGITS = 12, 3, 6

#: Terms of a lexicon that are broadcast (8 bytes each, some 40 in the table that is built of them).
LEXICON_AT_ONCE = 2_000_000

_END = -1  # stands for "no more terms", in every document and in the lexicon


def terms(text: Column) -> Column:
    """Sorted distinct 64-bit hashes of the words."""
    return F.array_sort(F.array_distinct(F.transform(words(text), lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``term`` hashes whose document frequency lies in the band, counted over all documents."""
    total = docs.count()
    spread = docs.select(terms(F.col("text")).alias("terms")).select(F.explode_outer("terms").alias("term")).filter("term is not null")
    counted = spread.groupBy("term").agg(F.count("*").alias("n"))
    return counted.filter((F.col("n") >= low * total) & (F.col("n") <= max(1.0, high * total))).select("term")


def first_level(n_terms: Column) -> Column:
    """The least thinned level a document of so many distinct terms uses."""
    return F.greatest(F.ceil(F.log2(F.greatest(n_terms, F.lit(1)) / SUBSETS)).cast("int") - 1, F.lit(0))


def _at_level(term: Column, level: Column) -> Column:
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1
    return F.shiftrightunsigned(term, 24).bitwiseAND(mask) == 0


def _selected(array: str, level: str) -> Column:
    return F.concat(F.filter(F.col(array), lambda t: _at_level(t, F.col(level))), F.array(F.lit(_END).cast("long")))


def subset_hashes(found: Column, level: Column) -> Column:
    """Hash of the sorted terms of each subset at each level, empty for a subset without terms; level by level."""
    def kept(j: int, k: int) -> Column:
        return F.filter(found, lambda t: (F.pmod(t, F.lit(SUBSETS)) == k) & _at_level(t, level + j))

    hashes = []
    for j in range(LEVELS):
        for k in range(SUBSETS):
            part = kept(j, k)
            hashes.append(F.when(F.size(part) > 0, F.right(F.lower(F.lpad(F.hex(F.xxhash64(part)), 16, "0")), F.lit(DIGITS))).otherwise(""))
    return F.array(*hashes)


def likeness(a: str, b: str) -> Column:
    """Share of agreeing subsets of two fingerprints, structs of ``level``, ``hashes`` and ``whole`` (used without lexicon terms)."""
    x, y = F.col(f"{a}.level"), F.col(f"{b}.level")
    level = F.greatest(x, y)
    places = F.sequence(F.lit(0), F.lit(SUBSETS - 1))

    def of(name: str, own: Column, k: Column) -> Column:
        return F.get(F.col(f"{name}.hashes"), (level - own) * SUBSETS + k)

    agree = F.size(F.filter(places, lambda k: (of(a, x, k) == of(b, y, k)) & (of(a, x, k) != "")))
    there = F.size(F.filter(places, lambda k: (of(a, x, k) != "") | (of(b, y, k) != "")))
    common = (F.abs(x - y) < LEVELS) & (there > 0)
    empty = F.col(f"{a}.bare") | F.col(f"{b}.bare")
    same = F.col(f"{a}.text") == F.col(f"{b}.text")
    return F.when(same, 1.0).when(empty | ~common, 0.0).otherwise(agree / there)


def _first_keys(docs: DataFrame) -> list[tuple[int | None, int]]:
    """``(doc_id, row)`` of the first row of each range, ascending: two ranges a task, so the list does not grow with the table."""
    dealt = docs.select("doc_id", "row").repartitionByRange(2 * task_count(docs.sparkSession), "doc_id", "row").withColumn("part", F.spark_partition_id())
    first = [r["first"] for r in dealt.groupBy("part").agg(F.min(F.struct("doc_id", "row")).alias("first")).collect()]
    return sorted(((r["doc_id"], r["row"]) for r in first), key=lambda k: (k[0] is not None, k[0] or 0, k[1]))


def _range_of(keys: list[tuple[int | None, int]]) -> Column:
    """Number of the range a row of ``doc_id, row`` is in: how many of the later ranges begin at or before it, by bisection."""
    later = F.array(*[F.struct(F.lit(d).cast("long").alias("doc_id"), F.lit(r).cast("long").alias("row")) for d, r in keys[1:]]).cast("array<struct<doc_id:bigint,row:bigint>>")
    own = F.struct(F.col("doc_id"), F.col("row"))
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(keys[1:]).bit_length()))]).cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda part, step: F.when(F.get(later, part + step - 1) <= own, part + step).otherwise(part))


def neighbours(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text, next_row, next_text``: each row and the next in ascending ``doc_id``, the last followed by the first.

    The first row of each range goes, once more, behind the last of the range before.
    """
    keys = _first_keys(docs)
    follows = [(k, keys[(k + 1) % len(keys)][1]) for k in range(len(keys))]
    edges = F.broadcast(docs.sparkSession.createDataFrame(follows, "part int, row long"))
    own = docs.select(_range_of(keys).alias("part"), F.lit(0).alias("edge"), "doc_id", "row", "text")
    more = docs.join(edges, "row").select("part", F.lit(1).alias("edge"), "doc_id", "row", "text")
    order = Window.partitionBy("part").orderBy("edge", "doc_id", "row")
    beside = own.union(more).withColumns({"next_row": F.lead("row").over(order), "next_text": F.lead("text").over(order)})
    return beside.filter("edge = 0").select("row", "doc_id", "text", "next_row", "next_text")


def edited_terms(docs: DataFrame) -> DataFrame:
    """Per document: lengths, its successor, the checksum of the edited text, and of both texts the terms any subset may keep."""
    n_chars = F.length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - quarter), F.substring("next_text", F.lit(1), quarter))
    both = neighbours(docs).select("row", "doc_id", "next_row", "text", n_chars.alias("n_chars"), edited.alias("edited"))
    read = both.select("row", "doc_id", "next_row", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), terms(F.col("text")).alias("t0"), terms(F.col("edited")).alias("t1"))
    levels = read.select("*", first_level(F.size("t0")).alias("level0"), first_level(F.size("t1")).alias("level1"))
    return levels.select("row", "doc_id", "next_row", "n_chars", "edited_sha256", "level0", "level1", F.xxhash64("t0").alias("whole0"), F.xxhash64("t1").alias("whole1"), _selected("t0", "level0").alias("some0"), _selected("t1", "level1").alias("some1"))


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row of ``doc_id, text`` its fingerprint, that of the edited text, and the likeness of both and of the next document's."""
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("long"), text_or_empty(F.col("text")).alias("text"))
    kept = stored(lexicon(rows, low, high), "lexicon")
    base = stored(edited_terms(rows), "terms")
    end = docs.sparkSession.range(1).select(F.lit(_END).cast("long").alias("term"))
    spread = [base.select("row", F.lit(v).alias("v"), F.explode_outer(f"some{v}").alias("term")) for v in (0, 1)]
    terms_of, known = spread[0].union(spread[1]), kept.filter(F.col("term") != _END).union(end)
    small = kept.count() <= LEXICON_AT_ONCE
    found = terms_of.join(F.broadcast(known), "term") if small else spread_join(stored(terms_of, "wanted"), known, "term")
    listed = found.groupBy("row", "v").agg(F.array_sort(F.array_remove(F.collect_list("term"), F.lit(_END).cast("long"))).alias("terms"))
    sides = listed.join(base.select("row", "level0", "level1", "whole0", "whole1"), "row").select(
        "row", "v", F.when(F.col("v") == 0, F.col("level0")).otherwise(F.col("level1")).alias("level"),
        F.when(F.col("v") == 0, F.col("whole0")).otherwise(F.col("whole1")).alias("whole"), "terms",
    )
    hashed = sides.select("row", "v", "level", "whole", (F.size("terms") == 0).alias("bare"), subset_hashes(F.col("terms"), F.col("level")).alias("hashes"))
    text = F.when(F.col("bare"), F.concat(F.lit("all:"), F.lower(F.hex("whole")))).otherwise(F.concat_ws(":", F.col("level").cast("string"), F.concat_ws(",", "hashes")))
    prints = stored(hashed.select("row", "v", F.struct("level", "hashes", "bare", text.alias("text")).alias("p")), "fingerprints")
    own = prints.filter("v = 0").select("row", F.col("p").alias("own"))
    edited = prints.filter("v = 1").select("row", F.col("p").alias("edited"))
    after = prints.filter("v = 0").select(F.col("row").alias("next_row"), F.col("p").alias("after"))
    joined = base.select("row", "doc_id", "next_row", "n_chars", "edited_sha256").join(own, "row").join(edited, "row").join(after, "next_row")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", F.col("own.text").alias("fingerprint"), F.col("edited.text").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"), likeness("own", "after").alias("near_next"), "row",
    )


def op9_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents")).drop("row")
