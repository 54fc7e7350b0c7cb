"""How filters interact: what each one removes alone, in any order, and what it is worth on average.

For every part of the table (a language) and every filter the ids of the rows that fail it are kept as sorted posting lists, cut by ranges of ids, with lists of the rows
labelled good or toxic beside them. In each range the lists are merged k ways by galloping: the entries of the shorter list are looked up in the longer one. This gives the
sizes of the unions of all sets of filters and of their differences, over all rows, over the good and over the toxic ones. Sizes add up over ranges, and everything asked about an
order of filters is a difference of such sums: after the steps S, the rows removed are the union of the lists of S.

Ranges hold at most ``RANGE`` ids, so no part, however large, is one task; sums of sizes are combined before they are shuffled. The number of rows a part takes in the sums does not depend on its size.

Defined results: a null text is an empty one, equal to it; a null ``lang`` is the empty string; a null ``doc_id`` is larger than any and fails on copies if any other has its text; rows with the same ``doc_id``
are rows of their own and no copies of each other by themselves; a row counts as good or toxic if any label of its ``doc_id`` says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import row_key, spread_join, stored, table, text_or_empty
from ledgerlens.session import task_count

#: The filters by letter.
LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 200, 50, 3
#: Ids of one range.
RANGE = 1 << 16
#: What sizes are counted over.
ALL, GOOD, TOXIC = 0, 1, 2

_SIZES = "part string, over int, members int, size long"
_AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: Column, copy: Column) -> dict[str, Column]:
    """Whether a text fails each filter; ``copy`` says it of the last."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper > MOST_UPPER_PERCENT * F.length(text),
        "D": text.rlike("[#$%&*|]"),
        "E": copy,
    }


def failing_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, part`` of every row, the letters it fails, and whether it is labelled good and toxic."""
    text, copy = text_or_empty(F.col("text").cast("string")), F.lit(False)
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    each = docs.select(row_key().alias("id"), F.col("doc_id").cast("long"), part.alias("part"), F.sha2(text, 256).alias("digest"), *[f.alias(k) for k, f in failures(text, copy).items()])
    rows = stored(each.drop("E"), "filters")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    both = spread_join(rows, first, "digest").join(marks, F.col("doc_id") == F.col("labelled"), "left")
    later = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id")))
    flags = [F.coalesce(c, F.lit(False)).alias(k) for k, c in [*[(k, F.col(k)) for k in "ABCD"], ("E", later), ("good", F.col("good")), ("toxic", F.col("toxic"))]]
    return both.select("id", "part", *flags)


def posting_lists(rows: DataFrame) -> DataFrame:
    """``part, range, list, ids``: the sorted ids of each list in each range. The lists are the letters, ``good``, ``toxic`` and ``all``, of which only the number is kept."""
    names = [*LETTERS, "good", "toxic"]
    held = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in names], F.lit("all")))
    spread = rows.select("part", F.shiftright("id", 16).alias("range"), "id", F.explode(held).alias("list"))
    grouped = spread.groupBy("part", "range", "list").agg(F.sort_array(F.collect_list(F.when(F.col("list") != "all", F.col("id")))).alias("ids"), F.count("*").alias("n"))
    return stored(grouped, "postings")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each id of the shorter sorted list, whether the longer one holds it."""
    if not len(long):
        return np.zeros(len(short), dtype=bool)
    at = np.searchsorted(long, short)
    return long[np.minimum(at, len(long) - 1)] == short


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many ids two sorted lists have in common."""
    return int(gallop(a, b).sum() if len(a) <= len(b) else gallop(b, a).sum())


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted lists merged: what only the shorter has is put into the longer at its place."""
    if len(a) > len(b):
        a, b = b, a
    new = a[~gallop(a, b)]
    return np.insert(b, np.searchsorted(b, new), new)


def union_sizes(lists: list[np.ndarray], over: list[np.ndarray | None]) -> list[tuple[int, int, int]]:
    """(index in ``over``, bit set of lists, size) of the unions of all sets of lists, within each list of ``over`` (None: all ids)."""
    merged = {0: np.empty(0, dtype=np.int64)}
    out = []
    for members in range(1, 1 << len(lists)):
        low = members & -members
        merged[members] = union(merged[members ^ low], lists[low.bit_length() - 1])
        out += [(k, members, len(merged[members]) if one is None else shared(one, merged[members])) for k, one in enumerate(over)]
    return out


def _range_sizes(lists: pa.Table) -> pa.Table:
    """Sizes in one range of one part, from its few posting lists."""
    held = dict(zip(lists.column("list").to_pylist(), (c.values.to_numpy() for c in lists.column("ids")), strict=True))
    n = sum(k for name, k in zip(lists.column("list").to_pylist(), lists.column("n").to_pylist(), strict=True) if name == "all")
    empty = np.empty(0, dtype=np.int64)
    sizes = union_sizes([held.get(k, empty) for k in LETTERS], [None, held.get("good", empty), held.get("toxic", empty)])
    over, members, size = zip(*[(ALL, 0, n), *sizes], strict=True)
    part = lists.column("part")[0].as_py()
    return pa.table({"part": pa.array([part] * len(over)), "over": pa.array(over, pa.int32()), "members": pa.array(members, pa.int32()), "size": pa.array(size, pa.int64())})


def _orders(sizes: pa.Table) -> pa.Table:
    """All orders and steps of one part from the sizes of its unions; under ``members`` 0 stands the number of rows."""
    held = {(o, m): s for o, m, s in zip(*[sizes.column(k).to_pylist() for k in ("over", "members", "size")], strict=True)}
    n, part, everything = held.pop((ALL, 0)), sizes.column("part")[0].as_py(), (1 << len(LETTERS)) - 1

    def gone(over: int, members: int) -> int:
        return held[over, members] if members else 0

    rows, worth = [], dict.fromkeys(LETTERS, 0)
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            after = before | bit
            removed, good, toxic = (gone(over, after) - gone(over, before) for over in (ALL, GOOD, TOXIC))
            rows.append([part, "".join(order), step, n - gone(ALL, after), removed, gone(ALL, bit) - removed, gone(ALL, everything) - gone(ALL, everything ^ bit), good, toxic])
            worth[letter] += removed
            before = after
    rows = [[*r, worth[r[1][r[2] - 1]]] for r in rows]
    names = [c.split()[0] for c in _AUDIT.split(", ")]
    kinds = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32()}
    return pa.table({name: pa.array(column, kinds.get(name, pa.int64())) for name, column in zip(names, zip(*rows, strict=True), strict=True)})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step of it."""
    lists = posting_lists(failing_rows(docs, labels))
    tasks = task_count(docs.sparkSession)
    sizes = lists.repartition(tasks, "part", "range").groupBy("part", "range").applyInArrow(_range_sizes, _SIZES)
    sums = stored(sizes.groupBy("part", "over", "members").agg(F.sum("size").alias("size")), "union-sizes")
    return sums.groupBy("part").applyInArrow(_orders, _AUDIT)


def op13_galloping_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The query in DuckDB's SQL: rows counted by the set of filters they fail, orders from the sets of their first letters.
ORACLE = r"""
WITH RECURSIVE flags AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
firsts AS (SELECT t, min(doc_id) AS first FROM flags GROUP BY t),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(ws) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(first < doc_id OR (doc_id IS NULL AND first IS NOT NULL), false) AS INT) AS mask
  FROM flags JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT letter AS filter_order, 1 AS step, bit AS done, bit, 0 AS before FROM letters
  UNION ALL
  SELECT o.filter_order || l.letter, o.step + 1, o.done + l.bit, l.bit, o.done FROM orders o JOIN letters l ON (o.done & l.bit) = 0 WHERE o.step < 5),
steps AS (
  SELECT f.filter_order, p.step, p.bit, p.before, p.done FROM orders f JOIN orders p ON starts_with(f.filter_order, p.filter_order) WHERE f.step = 5),
told AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN (mask & done) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & bit) > 0 AND (mask & before) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & bit) > 0 AND (mask & before) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""
