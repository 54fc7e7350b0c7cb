"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct five-word shingles. Register i of its sketch is floor(C - log_b of the smallest
exponential variate) that hash function i gives a shingle, truncated to one byte: registers of a union are register-wise
maxima, and equal registers mean similar sets. Bands of registers propose pairs; a joint likelihood of (greater, smaller, equal)
counts and the two set sizes estimates their Jaccard similarity; pairs not far below the threshold are verified on full sets.

No bucket is expanded into all its pairs. Equal sets are one class first. In each bucket every class is paired with the
one that meets most others; of these pairs each class verifies its best, and links give components. Only buckets that then still hold several
components give further pairs, between different components. An exact bound keeps these few: a pair can share no more shingles than either has in common with classes of other
components, a count that takes one shuffle of shingle hashes, and a link has to share three sevenths of both sizes together. Copies that were edited too much for a link have too many shingles
of their own and leave before anything is paired; a bit signature of each set bounds what a single pair can share. Connected components of all verified links are the result.

Defined results: texts that are null, empty or without words are linked with nothing; rows with the same ``doc_id`` are rows of
their own, of which the first is kept; a null ``doc_id`` comes last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import batches_of, fresh, row_key, spread_join, stored, table
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.wordhash import chunks, mix, shingles, word_hashes

#: Similarity of a link in percent, words of a shingle.
THRESHOLD, SHINGLE = 75, 5
#: Bands and registers of each: a pair at the threshold shares no band with a probability of 4e-5.
BANDS, ROWS = 36, 5
#: Base and offset of the registers: one byte covers sets of up to 3e7 shingles.
BASE, OFFSET = 1.08, 28.0
#: Estimates below this leave a pair out: over four standard errors under the threshold.
LEAST_ESTIMATE = 0.58
#: Bytes of a batch that goes to a Python worker: pairs of whole sets are long.
BATCH_BYTES = 8 << 20
#: Registers of unequal parity that leave a pair possible: at the threshold 22 are expected, with a deviation of 4.4.
MOST_ODD = 46
_PARITY = ["bits0", "bits1", "bits2"]
#: A bit for each of 1024 values of a shingle's hash, 64 to a long.
_SIGNATURE = [f"sig{k}" for k in range(16)]

_SETS = "row long, doc_id long, n long, s1 long, s2 long, sketch binary"


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of byte registers for each (non-empty) set of 64-bit hashes."""
    factors = _multipliers()
    least = np.empty((len(sets), len(factors)), dtype=np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(sets):  # stretches whose hashes stay in the processor's cache
            last, size = first, 0
            while last < len(sets) and (last == first or size + len(sets[last]) <= 1 << 14):
                size += len(sets[last])
                last += 1
            joined = np.concatenate(sets[first:last])
            starts = np.cumsum([0, *[len(s) for s in sets[first : last - 1]]])
            for i, factor in enumerate(factors):
                least[first:last, i] = np.minimum.reduceat(joined * factor, starts)
            first = last
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(OFFSET - np.log(np.maximum(variate, 1e-300)) / np.log(BASE)), 0, 255).astype(np.uint8)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each row of registers."""
    with np.errstate(over="ignore"):
        banded = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), banded.shape[:2]).copy()
        for j in range(ROWS):
            key = key << np.uint64(8) | banded[:, :, j]
        return mix(key).view(np.int64)


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of register rows, given the set sizes, on a grid of 1/200."""
    grid = np.arange(1, 200) / 200
    greater, smaller = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - greater - smaller
    u = (n_a / (n_a + n_b))[:, None]
    possible = np.minimum(u / (1 - u), (1 - u) / u)
    j = np.minimum(grid[None, :], possible)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - (1 - u) * j), p(1 - u - u * j)
    tiny = 1e-9
    with np.errstate(divide="ignore"):
        likelihood = greater * np.log(up + tiny) + smaller * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, tiny))
    return np.take_along_axis(j, likelihood.argmax(1)[:, None], 1)[:, 0]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys = batch.column(0), batch.column(1)
        for first, raw in chunks(batch.column(2).to_pylist()):
            sets = shingles(*word_hashes(raw), SHINGLE)
            full = [s for s in sets if len(s)]
            drawn = iter(sketch(full) if full else [])
            sums = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64) for s in sets])
            columns = [rows.slice(first, len(raw)), keys.slice(first, len(raw)), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(sums[:, k], pa.int64()) for k in (0, 1)]
            columns.append(pa.array([next(drawn).tobytes() if len(s) else b"" for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n", "s1", "s2", "sketch"])


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), BANDS * ROWS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_registers(batch.column(1)))
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["cls", "keys"])


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest bit of every register, 64 to a long: unequal bits bound the similarity cheaply inside a join."""
    for batch in batches:
        if batch.num_rows:
            bits = np.zeros((batch.num_rows, 64 * len(_PARITY)), dtype=np.uint8)
            bits[:, : BANDS * ROWS] = _registers(batch.column(2)) & 1
            packed = np.packbits(bits, axis=1).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(packed[:, k]) for k in range(len(_PARITY))]], ["cls", "n", *_PARITY])


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            found = estimates(_registers(part.column(2)), _registers(part.column(3)), part.column(4).to_numpy(), part.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found)], ["a", "b", "estimate"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw in chunks(batch.column(1).to_pylist()):
            sets = shingles(*word_hashes(raw), SHINGLE)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raw)), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "hashes"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            joined = np.sort(np.concatenate([x, y]), kind="stable")
            shared = int((joined[1:] == joined[:-1]).sum())
            keep.append(100 * shared >= THRESHOLD * (len(joined) - shared))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _estimate(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose estimate does not rule them out."""
    left = sketches.select(F.col("cls").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx"))
    right = sketches.select(F.col("cls").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny"))
    possible = F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * THRESHOLD
    both = pairs.join(left, "a").join(right, "b").filter(possible).select("a", "b", "x", "y", "nx", "ny")
    return both.mapInArrow(_estimated, "a long, b long, estimate double").filter(F.col("estimate") >= LEAST_ESTIMATE)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full shingle sets of the classes that share a bucket with another. Always one shuffle of the texts, whatever the size."""
    ids = wanted.select(F.col("cls").alias("w")).distinct().hint("merge")
    texts = docs.join(ids, F.col("row") == F.col("w"), "left_semi").select("row", "text")
    return stored(texts.mapInArrow(_full_sets, "cls long, hashes binary"), "shingle-sets")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the pairs, by full sets."""
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(cls, c, h)``, one row for each shingle hash."""
    for batch in batches:
        for at in range(batch.num_rows):
            hashes = np.frombuffer(batch.column(2)[at].as_buffer(), dtype=np.int64)
            for first in range(0, len(hashes), 1 << 16):
                part = hashes[first : first + (1 << 16)]
                columns = [pa.array(np.full(len(part), batch.column(k)[at].as_py()), pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(part, pa.int64())], ["cls", "c", "h"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of 1024 hash values the shingles of a class take. A bit that only one of two classes has is a shingle that the other lacks."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, 64 * len(_SIGNATURE)), dtype=np.uint8)
        for at in range(batch.num_rows):
            hashes = np.frombuffer(batch.column(1)[at].as_buffer(), dtype=np.uint64)
            bits[at, (hashes >> np.uint64(54)).astype(np.int64)] = 1
        packed = np.packbits(bits, axis=1).view(">i8").astype(np.int64).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(packed[:, k]) for k in range(len(_SIGNATURE))]], ["cls", *_SIGNATURE])


def _met_elsewhere(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """``(cls, met)``: how many shingles of each class of ``mixed`` some class of another component there has, if any."""
    members = mixed.select("cls", "c").distinct()
    hashes = stored(members.join(sets, "cls").select("cls", "c", "hashes").mapInArrow(_exploded, "cls long, c long, h long"), "shingle-hashes")
    shared = hashes.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("h")
    return stored(hashes.join(shared, "h", "left_semi").groupBy("cls").agg(F.count("*").alias("met")), "met-elsewhere")


def _across(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components that share a bucket and that sizes, shared shingles, register parities and signatures leave possible.

    A pair is given by the smallest key it shares only.
    """
    # at most met shingles are shared, and 100 * shared >= THRESHOLD * (n + m - shared): how large the other set may be
    most = (100 + THRESHOLD) * F.col("met") - THRESHOLD * F.col("n")
    able = mixed.filter(most * 100 >= THRESHOLD * THRESHOLD * F.col("n")).withColumn("most", most)
    least = able.groupBy("key").agg(F.min(F.struct("n", "cls")).alias("one"), F.min("n").alias("least"), F.count("*").alias("size")).filter("size > 1")
    able = stored(able.join(least.select("key", "least"), "key").filter(F.col("most") >= THRESHOLD * F.col("least")).drop("least"), "able")
    keys = able.groupBy("cls").agg(F.collect_list("key").alias("own"))
    signatures = sets.join(keys.select("cls"), "cls", "left_semi").select("cls", "hashes").mapInArrow(_signatures, "cls long, " + ", ".join(f"{k} long" for k in _SIGNATURE))
    # stored, one row for each class: both sides of the join below read it, and its steps do not start together with those of the join
    able = able.join(stored(keys.join(signatures, "cls"), "signatures"), "cls")
    columns = ["cls", "c", "n", "most", *_PARITY, *_SIGNATURE, "own"]
    x = able.select("key", *[F.col(k).alias(f"{k}_x") for k in columns])
    y = able.select("key", *[F.col(k).alias(f"{k}_y") for k in columns])
    sizes = (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * THRESHOLD) & (F.col("most_x") >= THRESHOLD * F.col("n_y")) & (F.col("most_y") >= THRESHOLD * F.col("n_x"))
    unequal = sum((F.bit_count(F.col(f"{k}_x").bitwiseXOR(F.col(f"{k}_y"))) for k in _PARITY), F.lit(0))
    # at most n less its bits that the other lacks are shared
    ends = [(a, b, sum((F.bit_count(F.col(f"{k}_{a}").bitwiseAND(F.bitwise_not(F.col(f"{k}_{b}")))) for k in _SIGNATURE), F.lit(0))) for a, b in ("xy", "yx")]
    shared = [(100 + THRESHOLD) * (F.col(f"n_{a}") - own) >= THRESHOLD * (F.col(f"n_{a}") + F.col(f"n_{b}")) for a, b, own in ends]
    once = F.array_min(F.array_intersect("own_x", "own_y")) == F.col("key")
    pairs = x.join(y, "key").filter((F.col("c_x") < F.col("c_y")) & sizes & (unequal <= MOST_ODD) & shared[0] & shared[1] & once)
    return pairs.select(F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``doc_id, text``: ``n_shingles``, ``component_id`` (smallest ``doc_id`` reachable), ``kept`` (the row with it, the first of several) and ``row``."""
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return _near_duplicates(docs)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = stored(rows.mapInArrow(_summaries, _SETS), "sketches")
    classes = sets.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("row").alias("cls"))
    ids = classes.select("cls")
    sketches = stored(sets.join(ids, sets.row == ids.cls, "left_semi").select(F.col("row").alias("cls"), "n", "sketch"), "classes")
    keys = sketches.select("cls", "sketch").mapInArrow(_banded, "cls long, keys array<long>")
    bands = keys.select("cls", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    crowded = stored(bands.join(shared, "key"), "buckets")
    sets_of = _sets(rows, crowded)

    # the class that meets most others is likeliest to be what they were copied from
    degrees = crowded.groupBy("cls").agg(F.sum("size").alias("degree"))
    ranked = crowded.join(degrees, "cls").select("key", "cls", F.struct("degree", -F.col("cls")).alias("rank"))
    heads = ranked.groupBy("key").agg(F.max("rank").alias("top")).select("key", (-F.col("top.col2")).alias("head"))
    first = crowded.join(heads, "key").filter("head <> cls").select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    likely = _estimate(first, sketches)
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("estimate", -F.col("a"))).alias("a")).select("a", "b")
    # a query of few joins at a time: the driver holds a table for each broadcast and blocks for each stage and scan that it starts at once
    links = stored(_verify(stored(best, "best"), sets_of), "verified")
    found = connected_components(links)

    labelled = crowded.join(found, crowded.cls == found.v, "left").select("key", "cls", F.coalesce("c", "cls").alias("c"))
    parts = labelled.select("key", "c").distinct()
    several = parts.groupBy("key").agg(F.count("*").alias("components")).filter("components > 1").select("key")
    traits = sketches.select("cls", "n", "sketch").mapInArrow(_parities, "cls long, n long, " + ", ".join(f"{k} long" for k in _PARITY))
    mixed = stored(labelled.join(several, "key").join(traits, "cls"), "mixed")
    further = stored(_across(mixed.join(_met_elsewhere(mixed, sets_of), "cls"), sets_of), "further")
    more = _verify(stored(_estimate(further, sketches).select("a", "b"), "estimated"), sets_of)
    whole = connected_components(stored(links.union(more), "verified"))

    named = classes.join(whole, classes.cls == whole.v, "left").select("s1", "s2", "n", F.coalesce("c", "cls").alias("c"))
    # rows of one set may be very many
    of_set = named.select(F.struct("s1", "s2", "n").alias("set"), "c")
    joined = spread_join(sets.filter("n > 0").select("row", "doc_id", F.struct("s1", "s2", "n").alias("set")), of_set, "set")
    members = joined.select("row", "doc_id", F.col("set.n").alias("n"), "c").union(sets.filter("n = 0").select("row", "doc_id", "n", F.col("row").alias("c")))
    members = stored(members, "members")
    least = members.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
    ends = least.select("c", F.col("m.doc_id").alias("component_id"), F.col("m.row").alias("first_row"))
    return spread_join(members, ends, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("first_row")).alias("kept"), "row")


def op7_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: The query in DuckDB's SQL: all pairs that share a shingle, and labels spread along links.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT both_ways.b, reach.c FROM reach JOIN both_ways ON both_ways.a = reach.v WHERE reach.c < both_ways.b),
least AS (SELECT v, min(c) AS c FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least.c AS component_id, d.doc_id = least.c AS kept
FROM d JOIN least ON least.v = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest ``doc_id``; columns as they came."""
    key = fresh(docs, "row")
    kept = near_duplicates(docs.select("doc_id", "text")).filter("kept").select(F.col("row").alias(key))
    return docs.withColumn(key, row_key()).join(kept, key, "left_semi").drop(key)
