"""Best-fit packing by a configuration linear program over the histogram of piece lengths.

1. Every document becomes pieces of at most ``capacity`` tokens; only longer documents are cut, their first piece takes the
   remainder. One row per piece leaves the tokenizer: its place in the document, its length and a checksum.
2. The histogram of lengths (at most ``capacity`` rows, whatever the corpus) goes to the driver. Sequences of more than ``UNITS``
   tokens have their lengths rounded up to classes. A covering program is solved over configurations (multisets of classes
   that fit a sequence): multiplicative weights price the classes, a knapsack dynamic program finds the best configurations for
   these prices, each is used for a share of its scarcest class, and covered classes lose weight. Prices under which no
   configuration is worth more than one sequence bound the program from below; the gap to that bound ends the phases.
3. Rounding keeps the configurations: whole numbers by largest remainders, each place takes the longest piece left of its class.
   Pieces that find no place fill the room that is left, longest first where it fits best, again on the histogram.
4. Pieces of one length are interchangeable: each is numbered among its length, and the number decides sequence and place.

Defined results: a null or empty text is a document with only the end id; repeated or null ``doc_id`` rows are packed as
documents of their own; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import encoder, stretches, tokenizer_file
from ledgerlens.llm.common import buckets, stored, table
from ledgerlens.llm.tokenfile import END_ID, ids_crc32

CAPACITY = 2048
#: Units of room that a sequence has in the program: lengths themselves for sequences no longer than that, else rounded up.
UNITS = 2048
#: Configurations taken at one set of prices, share of a length covered at once, fall of a price with the share covered, preference for long pieces.
PER_ROUND, STEP, RATE, TILT = 64, 0.5, 0.3, 0.05
#: Phases at most, gain of weight from one to the next, and the gap between value and bound that ends them.
PHASES, PHASE_RATE, GAP = 8, 3.0, 0.001

_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _cut(path: str, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u2")
        for batch in batches:
            rows, keys, texts = (batch.column(k).to_pylist() for k in range(3))
            for first, to in stretches(texts):
                out: list[tuple] = []
                for row, key, ids in zip(rows[first:to], keys[first:to], encoder(path).encode(texts[first:to]), strict=True):
                    whole = np.concatenate([ids, end])
                    for k, (start, length) in enumerate(piece_bounds(len(whole), capacity)):
                        out.append((row, key, k, start, length, ids_crc32(whole[start : start + length])))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def classes(histogram: np.ndarray, capacity: int) -> tuple[int, np.ndarray]:
    """Width of a length class and the pieces in each: class ``c`` holds the lengths above ``(c - 1) * width`` up to ``c * width``.

    A sequence has ``capacity // width`` units of room; pieces longer than that are a class of their own that fills it.
    """
    width = -(-capacity // UNITS)
    units = capacity // width
    of = np.minimum(-(-np.arange(capacity + 1) // width), units)
    return width, np.bincount(of, histogram, units + 1).astype(np.int64)


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price of lengths fitting each capacity, and the length taken last (0: none). ``prices[l]`` is that of length l."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    offered = np.flatnonzero(prices > 0)
    value = prices[offered]
    fitting = np.searchsorted(offered, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fitting[c]:
            total = best[c - offered[:n]] + value[:n]
            k = total.argmax()
            if total[k] > best[c]:
                best[c], last[c] = total[k], offered[k]
    return best, last


def _configuration(last: np.ndarray, room: int) -> list[int]:
    lengths = []
    while room > 0:
        if last[room]:
            lengths.append(int(last[room]))
            room -= lengths[-1]
        else:
            room -= 1
    return lengths


class Solution(NamedTuple):
    """Configurations of classes and how often each is used, their sum, and a lower bound of any solution's sum."""

    used: list[tuple[tuple[int, ...], float]]
    value: float
    bound: float


def _cover(need: np.ndarray, capacity: int, worth: np.ndarray) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Cover all lengths exactly. A covered share lowers the price of a length, so those that are behind are preferred.

    Also returns, for each length, the mean share of the price of 1 that its configurations lack at the prices ``worth``.
    """
    left, used, lack = need.astype(float), {}, np.zeros(len(need))
    while (open_ := left > 0).any():
        covered = np.divide(need - left, need, out=np.zeros_like(left), where=need > 0)
        prices = np.where(open_, worth * np.exp(-RATE * covered), 0.0)
        best, last = knapsack(prices, capacity)
        lengths = np.flatnonzero(open_)
        through = prices[lengths] + best[capacity - lengths]
        for k in lengths[np.argsort(-through, kind="stable")[:PER_ROUND]]:
            config = tuple(sorted([int(k), *_configuration(last, capacity - int(k))], reverse=True))
            kinds, times = np.unique(config, return_counts=True)
            step = float((np.minimum(left[kinds], np.maximum(STEP * need[kinds], times)) / times).min())
            if step <= 0:
                continue
            step = np.floor(step) if step >= 1 else step
            used[config] = used.get(config, 0.0) + step
            left[kinds] -= step * times
            lack[kinds] += step * times * max(0.0, 1.0 - float((worth[kinds] * times).sum()))
        left[left < 1e-9 * need] = 0.0
    return used, np.divide(lack, need, out=np.zeros_like(lack), where=need > 0)


def solve(histogram: np.ndarray, capacity: int, phases: int = PHASES, gap: float = GAP) -> Solution:
    """Fractional solution of the program ``min sum(x): every length is covered``. ``histogram[l]`` counts pieces of length l.

    Prices scaled so that no configuration is worth more than 1 bound the sum from below. Lengths whose configurations are
    worth less than 1 gain weight from phase to phase, until value and bound are within ``gap`` or the phases are over.
    """
    need = histogram.astype(np.int64)
    worth = np.arange(len(need)) / capacity * (need > 0)
    found, value, bound = {}, np.inf, 0.0
    for _ in range(phases if need.any() else 0):
        worth = worth / knapsack(worth, capacity)[0][capacity]
        bound = max(bound, float((need * worth).sum()))
        used, lack = _cover(need, capacity, worth * (1 + TILT * np.arange(len(need)) / capacity))
        if sum(used.values()) < value:
            found, value = used, sum(used.values())
        if value - bound <= gap * bound:
            break
        worth = worth * np.exp(PHASE_RATE * lack)
    return Solution(sorted(found.items(), key=lambda x: (-x[1], x[0])), value if found else 0.0, bound)


def whole_numbers(used: list[tuple[tuple[int, ...], float]]) -> list[tuple[tuple[int, ...], int]]:
    """Whole numbers of configurations by largest remainders; their sum is that of the shares, rounded up."""
    shares = np.array([x for _, x in used])
    whole = np.floor(shares + 1e-9).astype(np.int64)
    more = int(np.ceil(shares.sum() - 1e-6)) - int(whole.sum())
    whole[np.argsort(whole - shares, kind="stable")[: max(0, more)]] += 1
    return [(config, int(n)) for (config, _), n in zip(used, whole, strict=True) if n]


def _longest(left: np.ndarray, low: int, high: int) -> int:
    """The longest length above ``low`` and up to ``high`` that is left, or 0."""
    at = np.flatnonzero(left[low + 1 : high + 1])
    return int(at[-1]) + low + 1 if at.size else 0


def rounded(histogram: np.ndarray, capacity: int, used: list[tuple[tuple[int, ...], float]], width: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """Sequences, as lengths and how often, that use up the histogram exactly.

    A place of a configuration takes the longest piece left of its class, the last place the longest that fits in what is left
    of its class and the next. Pieces without a place go, longest first, where least room is left, else into new sequences.
    """
    left = histogram.astype(np.int64).copy()
    gaps: dict[int, list[list]] = {}  # room left: [lengths, how often]

    def take(lengths: list[int], most: int) -> int:
        kinds, times = np.unique(lengths, return_counts=True)
        n = min(most, int((left[kinds] // times).min()))
        left[kinds] -= n * times
        gaps.setdefault(capacity - sum(lengths), []).append([lengths, n])
        return n

    for config, n in whole_numbers(used):
        while n:
            lengths: list[int] = []
            spare = left.copy()
            for k, place in enumerate(config):
                room = capacity - sum(lengths)
                final = k == len(config) - 1 and place * width < capacity
                top = place * width if place * width + width <= capacity else capacity
                if got := _longest(spare, (place - 1) * width, min(room, (place + 1) * width if final else top)):
                    lengths.append(got)
                    spare[got] -= 1
            if not lengths:
                break
            n -= take(lengths, n)
    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length]:
            room = min((r for r in gaps if r >= length), default=None)
            if room is None:
                alike = capacity // length
                n, rest = divmod(int(left[length]), alike)
                for count, each in ((n, alike), (1, rest)):
                    if count and each:
                        take([length] * each, count)
                continue
            held = gaps[room][-1]
            alike = min(room // length, int(left[length]))
            n = min(held[1], int(left[length]) // alike)
            left[length] -= n * alike
            gaps.setdefault(room - alike * length, []).append([held[0] + [length] * alike, n])
            held[1] -= n
            if not held[1]:
                gaps[room].remove(held)
                if not gaps[room]:
                    del gaps[room]
    return [(tuple(lengths), n) for room in sorted(gaps) for lengths, n in gaps[room]]


def plan_sequences(histogram: np.ndarray, capacity: int, phases: int = PHASES) -> tuple[list[tuple[tuple[int, ...], int]], Solution]:
    """The sequences for a histogram of exact lengths, and the solution over its classes that they come from."""
    width, need = classes(histogram, capacity)
    solution = solve(need, capacity // width, phases)
    return rounded(histogram, capacity, solution.used, width), solution


def assignment(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length: from number ``lo`` among its length on, a piece lies in sequence ``first + number - lo`` at ``offset``."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for config, n in plan:
        offset = 0
        for length in config:
            rows.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + n
            offset += length
        sequence += n
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("length", "lo", "first", "offset"), columns, strict=True))


def _place(plan: dict[str, np.ndarray], capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = np.searchsorted(plan["length"], np.arange(capacity + 2))
        wide = 1 << 45
        keys = plan["length"] * wide + plan["lo"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(keys, length * wide + number, side="right") - 1
            if at.size and (at < begin[length]).any():
                raise ValueError("a piece has no place in the plan")
            sequence = plan["first"][at] + number - plan["lo"][at] if at.size else at
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column(c) for c in kept] + [pa.array(x, pa.int64()) for x in (sequence, plan["offset"][at] if at.size else at)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    return run


def numbered(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0. A common length is counted by cells, hash buckets of it, so no task holds it whole.

    Pieces are dealt by the cell alone: dealt by two columns, they could share a shuffle by length with the totals.
    """
    n = buckets(pieces.sparkSession, 4)
    cell = F.col("length") * n + F.pmod(F.xxhash64("row", "piece"), F.lit(n))
    dealt = pieces.withColumn("_cell", cell)
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_cell").agg(F.first("length").alias("length"), F.count("*").alias("_n"))
    bases = totals.select("_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_cell").orderBy("row", "piece")
    placed = dealt.withColumn("_k", F.row_number().over(within)).join(bases, "_cell")
    return placed.withColumn("number", F.col("_base") + F.col("_k") - 1).drop("_base", "_k", "_cell")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``; see the module for the method and defined results."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stored(rows.mapInArrow(_cut(tokenizer or tokenizer_file(), capacity, end_id), _PIECES), "pieces")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    plan = assignment(plan_sequences(histogram, capacity)[0])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered(pieces).mapInArrow(_place(plan, capacity), schema)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
