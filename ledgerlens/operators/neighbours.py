"""Exact nearest neighbours of every row, block against block.

Rows are cut into blocks of bounded size: a tree of median splits along the principal axes of a bounded sample, so that a block is a region of space, and large regions by a hash.
A block is one packed row. Inside its block every point finds an upper bound of the distance it has to look. Two blocks meet, each pair once, only where the box of one, in the
rotated axes, is no farther from the box of the other than the largest bound of either; inside a meeting, points whose bound does not reach the other box stay out. The distances of a meeting are first taken
as one matrix product, whose rounding error is bounded, and only what lies within bound and error is measured exactly. A point is therefore copied once for each block its own block meets, and at most ``n / points of a block`` times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

#: Bytes of the vectors of one block, and points of one at most.
BLOCK_BYTES, BLOCK_POINTS = 1 << 23, 1 << 14
#: Regions of space, and rows sampled to find them.
REGIONS, SAMPLE_ROWS = 1024, 50_000
#: Bytes of a stretch of the distance matrix.
TILE_BYTES = 1 << 25
#: Relative error of a squared distance from a matrix product, far above what rounding gives.
ERROR = 1e-10


class Splits:
    """Median splits of a sample along its principal axes; at most ``REGIONS`` leaves."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.axes = np.linalg.eigh(np.cov(sample.T).reshape(sample.shape[1], -1))[1] if len(sample) > 1 else np.eye(sample.shape[1])
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, cut, left, right; a leaf has axis -1 and its number as left
        self.leaves = 0
        self._grow(sample @ self.axes, leaves)

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, self.leaves, 0))
        spread = points.std(axis=0) if len(points) else np.zeros(1)
        axis = int(spread.argmax())
        cut = float(np.median(points[:, axis])) if len(points) else 0.0
        low = points[:, axis] <= cut if len(points) else np.empty(0, dtype=bool)
        if leaves < 2 or len(points) < 4 or low.all() or not low.any():
            self.leaves += 1
            return at
        left = self._grow(points[low], leaves // 2)
        right = self._grow(points[~low], leaves - leaves // 2)
        self.nodes[at] = (axis, cut, left, right)
        return at

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        turned = points @ self.axes
        found = np.empty(len(points), dtype=np.int64)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            axis, cut, left, right = self.nodes[node]
            if axis < 0:
                found[rows] = left
            else:
                low = turned[rows, axis] <= cut
                waiting += [(left, rows[low]), (right, rows[~low])]
        return found


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact distances of corresponding rows, axis by axis."""
    total = np.zeros(len(a))
    for axis in range(a.shape[1]):
        total += (a[:, axis] - b[:, axis]) ** 2
    return np.sqrt(total)


def _reached(queries: np.ndarray, bounds: np.ndarray, points: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of all points within a query's bound, and at least its ``few`` nearest where the bound lets more through."""
    found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
    lengths = (points**2).sum(1)
    step = max(1, TILE_BYTES // (8 * max(1, len(points))))
    for at in range(0, len(queries), step):
        part, own = queries[at : at + step], (queries[at : at + step] ** 2).sum(1)
        squares = own[:, None] + lengths[None, :] - 2.0 * (part @ points.T)
        slack = ERROR * (own + lengths.max()) + 1e-300
        limit = bounds[at : at + step] ** 2 * (1 + ERROR) + slack
        wide = np.flatnonzero((squares <= limit[:, None]).sum(1) > 2 * few)
        if len(wide):
            nth = np.partition(squares[wide], few - 1, axis=1)[:, few - 1]
            limit[wide] = np.minimum(limit[wide], nth + 2 * slack[wide])
        q, p = np.nonzero(squares <= limit[:, None])
        found.append((q + at, p, _distance(part[q], points[p])))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Block:
    """The distinct points of a block with the rows that share each; keys ascending."""

    def __init__(self, keys: pa.Array, vectors: np.ndarray, k: int) -> None:
        order = np.argsort(keys.to_numpy(zero_copy_only=False), kind="stable")
        self.keys = keys.take(pa.array(order))
        vectors = vectors[order]
        _, first, self.point = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        self.point = self.point.reshape(-1)
        self.x = vectors[first]
        # the first k + 1 rows of each point
        by_point = np.argsort(self.point, kind="stable")
        starts = np.searchsorted(self.point[by_point], np.arange(len(self.x)))
        place = np.arange(len(by_point)) - starts[self.point[by_point]]
        self.held = by_point[place <= k]
        self.counts = np.bincount(self.point[self.held], minlength=len(self.x))
        self.offsets = np.cumsum(self.counts) - self.counts

    def rows_of(self, q: np.ndarray, p: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs with points as pairs with the rows each point carries."""
        n = self.counts[p]
        at = np.repeat(self.offsets[p] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(q, n), self.held[at], np.repeat(distance, n)


def _first(q: np.ndarray, row: np.ndarray, distance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` nearest rows of each query; ties by key, which is the order of the rows."""
    order = np.lexsort((row, distance, q))
    q, row, distance = q[order], row[order], distance[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    near = place < most
    return q[near], row[near], distance[near]


def _lists(q: np.ndarray, values: pa.Array, many: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(q, [*many, np.inf]), pa.int32()), values)


def _packed(key: str, kind: str, k: int, axes: np.ndarray | None):
    """One row for a block: its rows, the box of its points, their bounds, and each point's nearest rows inside the block."""
    schema = f"block long, keys array<{kind}>, point array<int>, x array<double>, lo array<double>, hi array<double>, bounds array<double>, ids array<array<{kind}>>, distances array<array<double>>"

    def pack(table: pa.Table) -> pa.Table:
        block = Block(table.column(key).combine_chunks(), _vectors(table.column("x")), k)
        everywhere = np.full(len(block.x), np.inf)
        q, row, distance = _first(*block.rows_of(*_reached(block.x, everywhere, block.x, k + 1)), k + 1)
        full = np.bincount(q, minlength=len(block.x)) > k
        bounds = np.where(full, distance[np.searchsorted(q, np.arange(len(block.x)), side="right") - 1], np.inf)
        turned = block.x @ axes if axes is not None else block.x
        points = np.arange(len(block.x))
        one = [
            table.column("block")[0].as_py(), block.keys, pa.array(block.point, pa.int32()), pa.array(block.x.ravel()), pa.array(turned.min(0)), pa.array(turned.max(0)),
            pa.array(bounds), _lists(q, block.keys.take(pa.array(row)), points), _lists(q, pa.array(distance), points),
        ]
        names = [c.split()[0] for c in schema.split(", ")]
        arrays = [pa.array(one[:1], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in one[1:]]]
        return pa.table(dict(zip(names, arrays, strict=True)))

    return pack, schema


def _gap(lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance of boxes (or points, with lo = hi) from boxes, a little less for rounding."""
    between = np.maximum(0.0, np.maximum(low - hi, lo - high))
    return np.sqrt((between**2).sum(-1)) * (1 - 1e-9)


def _value(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name)[0].values.to_numpy(zero_copy_only=False)


def _meet(k: int, kind: str, axes: np.ndarray):
    """What the points of each of two blocks find in the other."""
    schema = f"block long, point int, ids array<{kind}>, distances array<double>"

    def read(side: pa.Table) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
        point, x, keys = _value(side, "point"), _value(side, "x"), side.column("keys")[0].values
        x = x.reshape(int(point.max()) + 1, -1)
        block = Block(keys, x[point], k)
        # distinct points are sorted, so the block is the same as when it was packed
        return block, _value(side, "bounds"), _value(side, "lo"), _value(side, "hi")

    def meet(mine: pa.Table, other: pa.Table) -> pa.Table:
        out = []
        if mine.num_rows and other.num_rows:
            sides = [read(mine), read(other)]
            names = [t.column("block")[0].as_py() for t in (mine, other)]
            for a, b, name in ((0, 1, names[0]), (1, 0, names[1])):
                (block, bounds, _, _), (there, _, lo, hi) = sides[a], sides[b]
                turned = block.x @ axes
                asking = np.flatnonzero(_gap(turned, turned, lo, hi) <= bounds * (1 + 1e-9) + 1e-12)
                q, row, distance = _first(*there.rows_of(*_reached(block.x[asking], bounds[asking], there.x, k + 1)), k + 1)
                some = np.unique(q)
                columns = [pa.array(np.full(len(some), name), pa.int64()), pa.array(asking[some], pa.int32()), _lists(q, there.keys.take(pa.array(row)), some), _lists(q, pa.array(distance), some)]
                out.append(pa.table(columns, names=["block", "point", "ids", "distances"]))
        value = pa.list_(mine.schema.field("keys").type.value_type)
        empty = pa.table({"block": pa.array([], pa.int64()), "point": pa.array([], pa.int32()), "ids": pa.array([], value), "distances": pa.array([], pa.list_(pa.float64()))})
        return pa.concat_tables(out) if out else empty

    return meet, schema


def block_points(dimensions: int) -> int:
    return max(64, min(BLOCK_POINTS, BLOCK_BYTES // (8 * max(1, dimensions))))


def _in_blocks(rows: DataFrame, key: str, n: int, dimensions: int) -> tuple[DataFrame, np.ndarray | None]:
    """``rows`` with their block, and the axes that boxes are taken in."""
    size = block_points(dimensions)
    if n <= size:
        return rows.withColumn("block", F.lit(0).cast("long")), None
    share = min(1.0, SAMPLE_ROWS / n)
    drawn = rows if share == 1.0 else rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < int(share * (1 << 20)))
    splits = Splits(np.array([r["x"] for r in drawn.select("x").collect()], dtype=np.float64).reshape(-1, dimensions), min(REGIONS, -(-n // size)))
    shipped = rows.sparkSession.sparkContext.broadcast(splits)
    kind = rows.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shipped.value.leaf_of(_vectors(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], [key, "x", "leaf"])

    placed = checkpointed(rows.mapInArrow(place, f"`{key}` {kind}, x array<double>, leaf long"))
    parts = {r["leaf"]: -(-r["n"] // size) for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    bases, total = {}, 0
    for leaf in sorted(parts):
        bases[leaf], total = total, total + parts[leaf]
    of = [F.array(*[F.lit(d.get(leaf, 0)).cast("long") for leaf in range(splits.leaves)]) for d in (parts, bases)]
    at = F.col("leaf").cast("int")
    block = F.get(of[1], at) + F.pmod(F.xxhash64(F.lit("part"), key), F.get(of[0], at))
    return placed.select(key, "x", block.alias("block")), splits.axes


def _pairs(blocks: DataFrame) -> DataFrame:
    """``(i, j)``, i < j, of the blocks that have to meet. One short row for each block passes the driver; the list is 16 bytes a pair, a block's worth for half a million."""
    spark = blocks.sparkSession
    reach = F.array_max("bounds")
    held = blocks.select("block", "lo", "hi", reach.alias("reach")).orderBy("block").collect()
    names = np.array([r["block"] for r in held])
    lo, hi, reach = (np.array([r[c] for r in held], dtype=np.float64) for c in ("lo", "hi", "reach"))
    shipped = spark.sparkContext.broadcast((names, lo, hi, reach))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lo, hi, reach = shipped.value
        for batch in batches:
            for at in batch.column(0).to_numpy():
                far = _gap(lo[at], hi[at], lo[at + 1 :], hi[at + 1 :])
                met = names[at + 1 :][far <= np.maximum(reach[at], reach[at + 1 :]) * (1 + 1e-9) + 1e-12]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), names[at]), pa.int64()), pa.array(met, pa.int64())], ["i", "j"])

    return spark.range(len(names)).mapInArrow(near, "i long, j long")


def _meetings(blocks: DataFrame, pairs: DataFrame):
    """The two blocks of each pair, cogrouped."""
    names = ["block", "keys", "point", "x", "lo", "hi", "bounds"]

    def side(own: str):
        held = blocks.select(*[F.col(c).alias(c) for c in names])
        met = F.broadcast(pairs.select(F.col("i").alias("i"), F.col("j").alias("j")))
        return held.join(met, F.col("block") == F.col(own)).groupBy("i", "j")

    return side("i").cogroup(side("j"))


def nearest_neighbours(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` nearest other rows of each row of ``(key, x)``, ties by key: ``(key, place, neighbour, distance)``.

    Exact, for every row. Keys are distinct. Equal points of a block are searched once and carry their first ``k + 1`` keys.
    """
    rows = df.select(key, F.col("x").cast("array<double>").alias("x"))
    held = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dimensions")).first()
    n, k = held["n"], max(1, min(k, held["n"] - 1))
    kind = rows.schema[key].dataType.simpleString()
    if not n:
        return rows.select(key, F.lit(0).alias("place"), F.lit(None).cast(kind).alias("neighbour"), F.lit(0.0).alias("distance"))
    placed, axes = _in_blocks(rows, key, n, held["dimensions"])
    pack, schema = _packed(key, kind, k, axes)
    blocks = checkpointed(placed.groupBy("block").applyInArrow(pack, schema))
    own = blocks.select("block", F.posexplode(F.arrays_zip("ids", "distances")).alias("point", "t")).select("block", "point", "t.ids", "t.distances")
    near = F.arrays_zip(F.col("distances").alias("distance"), F.col("ids").alias("neighbour"))
    if axes is None:
        merged = own.select("block", "point", near.alias("near"))
    else:
        meet, result = _meet(k, kind, axes)
        found = _meetings(blocks, checkpointed(_pairs(blocks))).applyInArrow(meet, result).union(own)
        merged = found.groupBy("block", "point").agg(F.slice(F.array_sort(F.flatten(F.collect_list(near))), 1, k + 1).alias("near"))
    members = blocks.select("block", F.explode(F.arrays_zip("keys", "point")).alias("m")).select("block", F.col("m.point").alias("point"), F.col("m.keys").alias(key))
    others = F.slice(F.filter("near", lambda t: t["neighbour"] != F.col(key)), 1, k)
    listed = members.join(merged, ["block", "point"]).select(key, F.posexplode(others).alias("place", "t"))
    return listed.select(key, (F.col("place") + 1).alias("place"), "t.neighbour", "t.distance")
