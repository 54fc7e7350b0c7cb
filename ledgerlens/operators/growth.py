"""Regression trees grown level by level on rows that are coded once and kept in blocks.

A block holds the codes of up to ``BLOCK_ROWS`` rows, one array for each input that can be split. A level is one pass: tasks add up counts and gradients
by node and bin, the driver adds these and picks the splits. Of two children the smaller is added up and the other is what remains of their node, so nothing a
task returns or the driver holds grows with the rows. Splits are those of an exact regression tree over the cuts of the round.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 16
#: Up to so many training rows the cuts of a round are made from all rows drawn for it; beyond, from a sample of CUT_ROWS rows taken once.
EXACT_ROWS = 1 << 14
CUT_ROWS = 100_000
#: Results of more tasks than this are added up in the cluster first.
DIRECT_TASKS = 64
#: Gains of a node that differ by less than this share of its spread are equal: the first input, then the lowest cut is taken.
TIE = 1e-12

_ONE_BY_ONE = BatchedSerializer(CPickleSerializer(), 1)
_MASK = (1 << 64) - 1
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _turned(h, bits: int):
    return ((h << bits) | (h >> (64 - bits))) & _MASK


def _hash_int(value: int, seed: int) -> int:
    """``xxhash64`` of an integer as Spark computes it."""
    h = (seed + _P5 + 4) & _MASK
    h = (_turned(h ^ ((value & 0xFFFFFFFF) * _P1 & _MASK), 23) * _P2 + _P3) & _MASK
    h = (h ^ (h >> 33)) * _P2 & _MASK
    h = (h ^ (h >> 29)) * _P3 & _MASK
    return h ^ (h >> 32)


def drawn_rows(ids: np.ndarray, unknown: np.ndarray | None, seed: int, round_: int, share: float) -> np.ndarray:
    """Which rows a round draws: ``pmod(xxhash64(seed, round, id), 2**30) < share * 2**30``; a NULL id leaves the hash of the two before."""
    start = _hash_int(round_, _hash_int(seed, 42))
    u = np.uint64
    k = ids.view(u) * u(_P2)
    k = ((k << u(31)) | (k >> u(33))) * u(_P1)
    h = u((start + _P5 + 8) & _MASK) ^ k
    h = ((h << u(27)) | (h >> u(37))) * u(_P1) + u(_P4)
    h = (h ^ (h >> u(33))) * u(_P2)
    h = (h ^ (h >> u(29))) * u(_P3)
    h ^= h >> u(32)
    if unknown is not None:
        h = np.where(unknown, u(start), h)
    return (h & u((1 << 30) - 1)) < u(int(share * (1 << 30)))


def cuts_between(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between distinct sorted ``values``: all where they are few, else those nearest to equal shares of the rows."""
    bins = min(bins, int(counts.sum()))
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2.0
    stride, reached = counts.sum() / bins, np.cumsum(counts)
    both = reached[:-1] + reached[1:]
    past = lambda i: abs(reached[i - 1] - target) < abs(reached[i] - target)
    found, target, first = [], stride, 1
    while True:
        i = max(first, 1 + int(np.searchsorted(both, 2 * target, "right")))
        while i - 1 >= first and past(i - 1):
            i -= 1
        while i < len(values) and not past(i):
            i += 1
        if i >= len(values):
            return (values[found] + values[np.array(found, dtype=np.int64) - 1]) / 2.0
        found.append(i)
        target, first = target + stride, i + 1


@dataclass(frozen=True)
class Round:
    """What a round splits on: places in the codes, inputs, cuts (None: a category), bins, and tables from code to bin (None: equal)."""

    places: list[int]
    inputs: list[int]
    cuts: list[np.ndarray | None]
    widths: list[int]
    bins_of: list[np.ndarray] | None


@dataclass(frozen=True)
class Coder:
    """Inputs that can be split and their codes. With a sample ``known`` (all rows) a code is the place of a value among all, else of its bin."""

    inputs: list[int]
    values: list[np.ndarray | None]
    sizes: list[int]
    bins: int
    known: tuple | None

    def codes(self, x: np.ndarray) -> np.ndarray:
        wide = max(self.sizes, default=1) > 256
        found = np.empty((len(self.inputs), x.shape[1]), dtype=np.uint16 if wide else np.uint8)
        for at, (i, values, size) in enumerate(zip(self.inputs, self.values, self.sizes, strict=True)):
            code = x[i].astype(np.int64) if values is None else np.searchsorted(values, x[i], "left")
            found[at] = np.minimum(code, size - 1)
        return found

    def round(self, chosen: list[int], seed: int, round_: int, share: float) -> Round:
        at = [p for p, i in enumerate(self.inputs) if i in set(chosen)]
        if self.known is None:
            return Round(at, [self.inputs[p] for p in at], [self.values[p] for p in at], [self.sizes[p] for p in at], None)
        ids, unknown, codes = self.known
        drawn = np.flatnonzero(drawn_rows(ids, unknown, seed, round_, share))
        found = Round([], [], [], [], [])
        for p in at if len(drawn) else []:
            values, cuts, bins_of = self.values[p], None, np.arange(self.sizes[p])
            if values is not None:
                counts = np.bincount(codes[p].take(drawn), minlength=len(values))
                cuts = cuts_between(values[counts > 0], counts[counts > 0], self.bins)
                bins_of = np.searchsorted(cuts, values, "left")
                if not len(cuts):
                    continue
            for held, item in zip((found.places, found.inputs, found.cuts, found.widths, found.bins_of), (p, self.inputs[p], cuts, int(bins_of.max()) + 1, bins_of.astype(np.uint16)), strict=True):
                held.append(item)
        return found


def fit_coder(table: DataFrame, rows: int, inputs: list[str], nominal: dict[str, int], bins: int, seed: int) -> Coder:
    """Values and cuts of each input, from all of ``rows`` where these are few, else from a sample."""
    exact = rows <= EXACT_ROWS
    part = table if exact else table.sample(min(1.0, CUT_ROWS / rows), seed)
    found = part.select("_id", "x").toArrow().combine_chunks()
    x = _inputs_of(found)
    kept, values, sizes = [], [], []
    for i, name in enumerate(inputs):
        if name in nominal:
            held, size = None, nominal[name] + 1
        else:
            held, counts = np.unique(x[i] + 0.0, return_counts=True)  # -0.0 is 0.0
            if not exact:
                held = cuts_between(held, counts, bins)
            size = len(held) + (not exact)
        if size > 1:
            for items, item in zip((kept, values, sizes), (i, held, size), strict=True):
                items.append(item)
    coder = Coder(kept, values, sizes, bins, None)
    if not exact:
        return coder
    ids, unknown = _ids(found.column("_id"))
    return Coder(kept, values, sizes, bins, (ids, unknown, coder.codes(x)))


def _checked(found: np.ndarray) -> np.ndarray:
    if np.isnan(found).any():
        raise ValueError("inputs and labels of the trees must be numbers, none missing and none NaN")
    return found


def _inputs_of(chunk: pa.Table) -> np.ndarray:
    """One array for each input, from the column of arrays ``x``."""
    flat = pc.list_flatten(chunk.column("x")).to_numpy()
    return np.ascontiguousarray(_checked(flat).reshape(chunk.num_rows, -1).T)


def _ids(column) -> tuple[np.ndarray, np.ndarray | None]:
    unknown = column.is_null().to_numpy() if column.null_count else None
    return column.fill_null(0).to_numpy().astype(np.int64), unknown


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def blocks(table: DataFrame, rows: int, shape) -> RDD:
    """``shape`` of each chunk of rows of ``table``, stored, on as many partitions as there are cores at least."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = min(BLOCK_ROWS, max(1, -(-rows // cores)))

    def packed(batches):
        for chunk in _chunks(batches, size):
            yield pa.record_batch({"block": pa.array([pickle.dumps(shape(chunk), protocol=5)], pa.binary())})

    found = table.mapInArrow(packed, "block binary")
    parts, wanted = found.rdd.getNumPartitions(), max(cores, -(-rows // size))
    if parts < cores:
        found = found.repartition(cores)
    elif parts > 2 * wanted:
        found = found.coalesce(wanted)
    return stored(found.rdd.map(_unpacked))


def _unpacked(row):
    return pickle.loads(row["block"])


def one_by_one(rdd: RDD) -> RDD:
    """Blocks written one by one, so that two tables of them can be zipped as they are."""
    return rdd._reserialize(_ONE_BY_ONE)


def kept(rdd: RDD) -> RDD:
    return one_by_one(rdd).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def stored(rdd: RDD) -> RDD:
    """``rdd`` kept, and its lineage cut by a copy in the shared folder."""
    held = kept(rdd)
    held.checkpoint()
    held.count()
    return held


@dataclass(frozen=True)
class Nodes:
    """Nodes in the order they were found; ``feature`` is a place in the codes, rows of at most ``limit`` (or of ``held`` categories) go to the first child."""

    feature: np.ndarray
    limit: np.ndarray
    child: np.ndarray
    nominal: np.ndarray | None
    held: np.ndarray | None
    depth: int

    def reached(self, codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        flat, n, at = codes.ravel(), codes.shape[1], np.zeros(len(rows), dtype=np.int64)
        for _ in range(self.depth):
            code = flat.take(self.feature.take(at) * n + rows)
            right = code > self.limit.take(at)
            if self.nominal is not None:
                right = np.where(self.nominal.take(at), ~self.held[at, np.minimum(code, self.held.shape[1] - 1)], right)
            at = self.child.take(2 * at + right)
        return at


@dataclass
class Growth:
    """A tree as it grows. ``split`` holds input, cut and left categories of an inner node."""

    feature: list[int] = field(default_factory=lambda: [0])
    limit: list[int] = field(default_factory=lambda: [1 << 30])
    child: list[int] = field(default_factory=lambda: [0, 0])
    split: dict[int, tuple] = field(default_factory=dict)
    depth: int = 0

    def divide(self, node: int, place: int, limit: int, split: tuple) -> tuple[int, int]:
        left = len(self.feature)
        for new in (left, left + 1):
            self.feature.append(0)
            self.limit.append(1 << 30)
            self.child += [new, new]
        self.feature[node], self.limit[node], self.split[node] = place, limit, split
        self.child[2 * node : 2 * node + 2] = [left, left + 1]
        return left, left + 1

    def nodes(self) -> Nodes:
        nominal = held = None
        named = {n: s[2] for n, s in self.split.items() if s[2] is not None}
        if named:
            nominal = np.isin(np.arange(len(self.feature)), list(named))
            held = np.zeros((len(self.feature), max(max(c) for c in named.values()) + 2), dtype=bool)
            for node, codes in named.items():
                held[node, codes] = True
        return Nodes(np.array(self.feature), np.array(self.limit, dtype=np.int32), np.array(self.child), nominal, held, self.depth)


def chance_of(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin))


def _level(pairs, nodes: Nodes, slot: np.ndarray, slots: int, places: list[int], width: int, bins_of: list[np.ndarray] | None):
    """Squares of the gradient by node; counts and gradients by slot of a node, input and bin."""
    squares = np.zeros(len(slot))
    counts = np.zeros((slots, len(places), width), dtype=np.int64)
    sums = np.zeros((slots, len(places), width))
    for (codes, y, *_), (margin, drawn) in pairs:
        rows = np.flatnonzero(drawn)
        at = nodes.reached(codes, rows)
        gradient = y[rows] - chance_of(margin[rows])
        squares += np.bincount(at, gradient * gradient, minlength=len(slot))
        base = slot.take(at)
        if (slot < 0).any():
            here = np.flatnonzero(base >= 0)
            rows, base, gradient = rows.take(here), base.take(here), gradient.take(here)
        base = base * width
        for i, place in enumerate(places):
            bins = codes[place].take(rows)
            if bins_of is not None:
                bins = bins_of[i].take(bins)
            bins = base + bins
            counts[:, i] += np.bincount(bins, minlength=slots * width).reshape(slots, width)
            sums[:, i] += np.bincount(bins, gradient, minlength=slots * width).reshape(slots, width)
    yield squares, counts, sums


def _leaves(pairs, nodes: Nodes):
    """Gradients and weights of the rows drawn, by node."""
    n = len(nodes.feature)
    gradients, weights = np.zeros(n), np.zeros(n)
    for (codes, y, *_), (margin, drawn) in pairs:
        rows = np.flatnonzero(drawn)
        at = nodes.reached(codes, rows)
        p = chance_of(margin[rows])
        gradients += np.bincount(at, y[rows] - p, minlength=n)
        weights += np.bincount(at, p * (1 - p), minlength=n)
    yield gradients, weights


def _added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def _total(pairs: RDD, measure, **given) -> tuple:
    found = pairs.mapPartitions(partial(measure, **given))
    return reduce(_added, found.collect()) if pairs.getNumPartitions() <= DIRECT_TASKS else found.treeReduce(_added)


def _best(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, found: Round, least: int) -> list[tuple | None]:
    """For each node its best split: input of the round, bins on the left (None: up to the last of them), last bin, rows on either side."""
    nodes, width = counts.shape[0], counts.shape[2]
    order = np.broadcast_to(np.arange(width), counts.shape).copy()
    for i, cuts in enumerate(found.cuts):
        if cuts is None:
            mean = np.where(counts[:, i] > 0, sums[:, i] / np.maximum(counts[:, i], 1), np.inf)
            order[:, i] = np.argsort(mean, axis=1, kind="stable")
    n, s = np.cumsum(np.take_along_axis(counts, order, 2), 2), np.cumsum(np.take_along_axis(sums, order, 2), 2)
    all_n, all_s = n[:, :, -1:], s[:, :, -1:]
    right = all_n - n
    usable = (n >= least) & (right >= least) & (np.arange(width) < np.array(found.widths)[:, None] - 1)
    whole = np.maximum(all_n, 1)
    gain = (s**2 / np.maximum(n, 1) + (all_s - s) ** 2 / np.maximum(right, 1) - all_s**2 / whole) / whole
    gain = np.where(usable, gain, -np.inf).reshape(nodes, -1)
    best = []
    for node in range(nodes):
        spread, top = squares[node] / max(int(all_n[node, 0, 0]), 1), gain[node].max()
        if not top > TIE * spread / 100:
            best.append(None)
            continue
        i, last = divmod(int(np.argmax(gain[node] >= top - TIE * spread)), width)
        held = None if found.cuts[i] is not None else sorted(order[node, i, : last + 1].tolist())
        best.append((i, held, last, int(n[node, i, last]), int(right[node, i, last])))
    return best


def grow(pairs: RDD, found: Round, max_depth: int, min_rows: int) -> Growth:
    """A tree over the drawn rows of ``pairs``: of equally good splits the first input, then the lowest cut."""
    tree, least = Growth(), max(1, min_rows)
    width = max(found.widths, default=1)
    sums_of: dict[int, tuple] = {}
    #: open nodes, and of pairs of children: the node, the child to add up, the child that is the rest
    level, families = [0], []
    while level and found.places and tree.depth < max_depth:
        built = [small for _, small, _ in families] or [0]
        slot = np.full(len(tree.feature), -1)
        slot[built] = np.arange(len(built))
        squares, counts, sums = _total(pairs, _level, nodes=tree.nodes(), slot=slot, slots=len(built), places=found.places, width=width, bins_of=found.bins_of)
        above, sums_of = sums_of, {node: (counts[i], sums[i]) for i, node in enumerate(built)}
        for node, small, large in families:
            rest = above[node][0] - sums_of[small][0]
            sums_of[large] = rest, np.where(rest > 0, above[node][1] - sums_of[small][1], 0.0)
        best = _best(*(np.stack([sums_of[node][k] for node in level]) for k in (0, 1)), squares[level], found, least)
        level_of_children, families = [], []
        for node, split in zip(level, best, strict=True):
            n, s = sums_of[node][0][0].sum(), sums_of[node][1][0].sum()
            # a child whose gradients are all the same is a leaf
            if split is None or (node and abs(squares[node] / n - (s / n) ** 2) < np.finfo(float).eps):
                continue
            i, held, last, n_left, n_right = split
            limit = last if found.bins_of is None or held else int(np.searchsorted(found.bins_of[i], last, "right")) - 1
            cut = 0.0 if held else float(found.cuts[i][last])
            left, right = tree.divide(node, found.places[i], limit, (found.inputs[i], cut, held))
            open_ = [child for child, rows in ((left, n_left), (right, n_right)) if rows >= 2 * least]
            if open_:
                families.append((node, left, right) if n_left <= n_right else (node, right, left))
                level_of_children += open_
        tree.depth += any(node in tree.split for node in level)
        level = level_of_children
    return tree


def leaf_sums(pairs: RDD, nodes: Nodes) -> tuple[np.ndarray, np.ndarray]:
    return _total(pairs, _leaves, nodes=nodes)


def coded_block(chunk: pa.Table, coder: Coder, margin) -> tuple:
    """Codes, labels, ids and margins of a chunk of rows."""
    x, y = _inputs_of(chunk), _checked(chunk.column("y").to_numpy())
    small = y.astype(np.int8)
    return coder.codes(x), small if np.array_equal(small, y) else y, *_ids(chunk.column("_id")), margin(x)


def plain_block(chunk: pa.Table, used: list[int], margin) -> tuple:
    """The inputs ``used``, labels and margins of a chunk of rows; a missing label counts as none."""
    x = _inputs_of(chunk)
    return x[used], chunk.column("y").to_numpy(), margin(x)


def with_id(df: DataFrame, name: str) -> DataFrame:
    """``_id``, a number: the hash of an id that is none."""
    kind = dict(df.dtypes)[name]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return df.withColumn("_id", F.col(name).cast("long") if whole else F.when(F.col(name).isNotNull(), F.xxhash64(name)))
