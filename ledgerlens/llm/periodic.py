"""Periodic runs in the word sequence of a text, found by multi-scale minimizers.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS``
periods. Scale j serves periods in (k[j-1], k[j]], its k growing by a factor of about the root of 2. It hashes every k[j] words and selects the
places whose hash is the least of some window of places. A window that lies inside a run repeats q places later with the same hashes, so
its least place does as well; as k[j] >= q, the same k[j] words recur inside a run at multiples of q only, so neighbouring selected places with equal hashes lie exactly q
apart. Such a pair seeds an extension to both sides, word by word in growing steps; a stretch is extended once for each period. Every run has at least one seed, as the window
is short enough to fit, with the words it covers and their copy q later, into three periods. Periods up to ``DIRECT`` words are found by comparing the whole sequence with itself that many
places later. A multiple of a run's period gives the same stretch; the smallest period is kept.

Texts are handled in stretches of about 1 MB, those of similar length together, a word of its own between two. Memory is a fixed multiple of the stretch or of one text.
Words are compared by 64-bit hashes of their bytes, upper and lower case apart.

Defined results: a null, empty or wordless text has no runs and collapses to an empty text (null stays null); rows with equal or null ``doc_id`` are rows of their own; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are ignored, ``collapse`` hands them on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, table, text_or_empty
from ledgerlens.llm.wordhash import EXACT, R, R_INVERSE, SPACE, chunks, mix, powers, word_hashes

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods up to this many words are found by direct comparison.
DIRECT = 8
#: The words of a text are joined again in pieces of this many.
PIECE_WORDS = 1 << 16

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RUNS_SQL = "array<struct<start: long, length: long, period: long>>"


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(largest period of the scale before, words hashed, places of a window) for texts of at most ``longest`` words."""
    below = DIRECT
    while below + 1 <= longest // LEAST_PERIODS:
        k = math.floor(below * math.sqrt(2))
        yield below, k, 2 * (below + 1) - k + 1
        below = k


def _sliding(x: np.ndarray, w: int, of: np.ufunc) -> np.ndarray:
    """``of`` over every ``w`` neighbouring entries, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = of(x[: len(x) - step], x[step:])
        have += step
    return x


def _selected(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places whose hash is the least of some window of ``w`` places."""
    least = _sliding(hashes, w, np.minimum)
    edge = np.zeros(w - 1, dtype=hashes.dtype)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), w, np.maximum) == hashes)


def _seeds(x: np.ndarray, prefix: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, distances) of neighbouring selected places with equal hashes, by scale."""
    inverse = powers(R_INVERSE, len(x) + 1)
    for below, k, w in scales(longest):
        if len(x) - k + 1 < w:
            return
        hashes = mix((prefix[k:] - prefix[:-k]) * inverse[: len(x) - k + 1])
        at = _selected(hashes, w)
        at = at[np.argsort(hashes[at], kind="stable")]
        apart = np.diff(at)
        pair = np.flatnonzero((apart > below) & (apart <= k) & (hashes[at[1:]] == hashes[at[:-1]]))
        yield at[pair], apart[pair]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of two sequences are equal."""
    done, step, most = 0, 64, min(len(a), len(b))
    while done < most:
        other = np.flatnonzero(a[done : min(done + step, most)] != b[done : min(done + step, most)])
        if len(other):
            return done + int(other[0])
        done, step = min(done + step, most), 2 * step
    return most


def _least_length(period):
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def periodic_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period), by start, then period, of all runs of a word sequence in which no run is longer than ``longest``."""
    found = []
    for q in range(1, min(DIRECT, longest // LEAST_PERIODS) + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], x[q:] == x[:-q], [False]])))
        start, length = edges[::2], edges[1::2] - edges[::2] + q
        long = length >= _least_length(q)
        found.append(np.stack([start[long], length[long], np.full(long.sum(), q)], 1))
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x * powers(R, len(x)), out=prefix[1:])
        seeds = [np.stack(s, 1) for s in _seeds(x, prefix, longest)]
    seeds = np.concatenate(seeds) if seeds else np.empty((0, 2), dtype=np.int64)
    last, covered = 0, 0
    for at, d in seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].tolist():
        if d == last and at < covered:
            continue
        end = at + _reach(x[at:], x[at + d :])
        start = at - _reach(x[:at][::-1], x[: at + d][::-1])
        last, covered = d, end
        if end - start + d >= _least_length(d):
            found.append(np.array([[start, end - start + d, d]]))
    runs = np.concatenate(found).astype(np.int64) if found else np.empty((0, 3), dtype=np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.concatenate([[False], (runs[1:, :2] == runs[:-1, :2]).all(1)]) if len(runs) else np.empty(0, dtype=bool)
    runs = runs[~again]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(texts: list[bytes]) -> list[np.ndarray]:
    """The runs of each text."""
    hashes, counts = word_hashes(texts, values=EXACT)
    starts = np.cumsum(counts) - counts
    out = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    sizes = np.array([int(c).bit_length() for c in counts])
    for size in np.unique(sizes[counts >= LEAST_WORDS]):
        group = np.flatnonzero((sizes == size) & (counts >= LEAST_WORDS))
        with np.errstate(over="ignore"):
            between = mix(np.arange(len(group), dtype=np.uint64) * np.uint64(R) + np.uint64(1))
        x = np.concatenate([part for g, b in zip(group, between, strict=True) for part in (hashes[starts[g] : starts[g] + counts[g]], [b])])
        first = np.cumsum(counts[group] + 1) - counts[group] - 1
        runs = periodic_runs(x, int(counts[group].max()))
        edges = np.searchsorted(runs[:, 0], [*first, len(x)])
        for k, g in enumerate(group):
            out[g] = runs[edges[k] : edges[k + 1]] - [first[k], 0, 0]
    return out


def collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs) and len(text) < PIECE_WORDS:
        return b" ".join(text.split())
    gap = np.concatenate([[True], SPACE[np.frombuffer(text, dtype=np.uint8)], [True]])
    edges = np.flatnonzero(np.diff(gap))
    starts, ends = edges[::2], edges[1::2]
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    bounds = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]])))
    pieces = []
    for a, b in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True):
        for i in range(a, b, PIECE_WORDS):
            pieces.append(b" ".join(text[starts[i] : ends[min(i + PIECE_WORDS, b) - 1]].split()))
    return b" ".join(pieces)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw in chunks(batch.column(1).to_pylist()):
            runs = runs_of_texts(raw)
            every = np.concatenate(runs)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *[len(r) for r in runs]]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(every[:, j], pa.int64()) for j in range(3)], fields=list(_RUNS.value_type)),
            )
            texts = pa.array([collapsed(t, r) for t, r in zip(raw, runs, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raw)), lists, texts], ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` of each row: its runs by start, then period (places are word numbers), and the text without their repeats."""
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).cast("binary").alias("text"))
    found = rows.mapInArrow(_found, f"doc_id long, runs {_RUNS_SQL}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _collapsed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *others, column = batch.columns
        for first, raw in chunks(column.to_pylist()):
            texts = [collapsed(t, r) for t, r in zip(raw, runs_of_texts(raw), strict=True)]
            yield pa.RecordBatch.from_arrays([*[c.slice(first, len(raw)) for c in others], pa.array(texts, pa.binary())], batch.schema.names)


def collapse(docs: DataFrame) -> DataFrame:
    """All rows and columns, the texts with the first period of each run only."""
    new = fresh(docs, "new_text")
    rows = docs.withColumn(new, text_or_empty(F.col("text").cast("string")).cast("binary"))
    done = rows.mapInArrow(_collapsed_texts, rows.schema)
    return done.withColumn("text", F.when(F.col("text").isNotNull(), F.col(new).cast("string"))).drop(new)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth, by a hash of ``doc_id``, repeat a stretch of their words to the end; a null ``doc_id`` changes nothing."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split(text_or_empty(F.col("text")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    held = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    planted = held.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(n > 0, F.col("g") % n))
    planted = planted.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    edited = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", place(i))), " ")
    return planted.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), edited).otherwise(F.col("text")).alias("text"))


def _best(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: the smallest start, then period."""
    def better(a: Column, b: Column) -> Column:
        left, right = b["length"] * a["period"], a["length"] * b["period"]
        return a.isNull() | (left > right) | ((left == right) & (F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"])))

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda a, b: F.when(better(a, b), b).otherwise(a))


def op11_minimizer_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(_with_planted_runs(docs)).withColumn("best", _best(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
