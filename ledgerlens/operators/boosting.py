"""Gradient boosting of regression trees, grown until the validation metric stops rising.

Rows are coded once by the cuts of their inputs and kept in blocks (``growth``). Each round grows one tree on the gradient of the log loss over a share of rows and
columns, one pass for each of its levels; the leaves get the Newton step with an L2 penalty. Margins are kept apart from the codes: each round's are kept until the next
round has its own, so no pass repeats earlier rounds, and stored every few rounds, so the lineage stays short, a lost executor costs one stretch, and a fit can be continued. All
prefixes of a stretch are ranked on the validation rows together. The trees, bounded by the parameters, are kept as a plain table of nodes; all of them are scored in one Arrow call.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field, replace
from functools import partial

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, ship
from . import growth
from .categories import Categories, fit_categories
from .features import NUMERIC_FEATURES, TARGET
from .matrix import KEYS, with_missing_flags
from .metrics import average_precision_by

PREDICTION = ("transaction_id", "ts", "is_fraud")
_NODES = "round int, node int, feature int, cut double, left_codes array<int>, left int, right int, value double, gain double"


@dataclass(frozen=True)
class Boosting:
    """The training parameters. ``patience`` rounds without gain on the validation rows end the fit."""

    rounds: int = 1500
    learning_rate: float = 0.05
    max_depth: int = 6  # 2**6 leaves, next to the 63 leaves asked for
    min_rows_per_leaf: int = 200
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 1.0
    patience: int = 100
    seed: int = 42
    #: Rounds between two storings of the margins, and ranked together.
    stretch: int = 20
    #: Bins of a numeric column; a category of more values than this is split by its code.
    bins: int = 64


@dataclass
class Tree:
    """Nodes in depth-first order, node 0 the root; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left_codes: list[list[int] | None] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, feature: int = -1, cut: float = 0.0, codes: list[int] | None = None) -> int:
        for column, item in zip(asdict(self), (feature, cut, codes, -1, -1, 0.0, 0.0), strict=True):
            getattr(self, column).append(item)
        return len(self.feature) - 1

    @property
    def leaves(self) -> list[int]:
        return [i for i, f in enumerate(self.feature) if f < 0]

    def arrays(self) -> tuple:
        """Input, cut, categories and children by node, and the steps down to the lowest leaf. A leaf is its own child."""
        here = np.arange(len(self.feature))
        inner = np.array(self.feature) >= 0
        child = np.where(inner, [self.left, self.right], here).T.ravel()
        feature, cut = np.where(inner, self.feature, 0), np.where(inner, self.cut, np.inf)
        nominal = codes = None
        if any(c is not None for c in self.left_codes):
            nominal = np.array([c is not None for c in self.left_codes])
            # the last column stands for larger codes
            codes = np.zeros((len(self.feature), max([1, *[max(c) + 1 for c in self.left_codes if c]]) + 1), dtype=bool)
            for node, held in enumerate(self.left_codes):
                codes[node, held or []] = True
        steps = np.zeros(len(here), dtype=int)
        for node in reversed(here[inner]):
            steps[node] = 1 + max(steps[self.left[node]], steps[self.right[node]])
        return feature, cut, nominal, codes, child, np.array(self.value), int(steps[0])


def _outputs(trees: list[tuple], x: np.ndarray):
    """What each tree gives the rows; ``x`` has one array for each input."""
    flat, n = x.ravel(), x.shape[1]
    everyone = np.arange(n)
    for feature, cut, nominal, codes, child, value, steps in trees:
        at = np.zeros(n, dtype=np.int64)
        for _ in range(steps):
            v = flat.take(feature.take(at) * n + everyone)
            right = ~(v <= cut.take(at))
            if nominal is not None:
                code = np.clip(v, 0, codes.shape[1] - 1).astype(np.int64)
                right = np.where(nominal.take(at), ~codes[at, code], right)
            at = child.take(2 * at + right)
        yield value.take(at)


def _margins_of(trees: list[Tree]):
    """UDF from the inputs to the sum of the trees' outputs."""
    spark = SparkSession.active()
    ship(spark)
    held = spark.sparkContext.broadcast([t.arrays() for t in trees])

    @F.pandas_udf("double")
    def margins(*x: pd.Series) -> pd.Series:
        return pd.Series(sum(_outputs(held.value, np.stack([c.to_numpy(dtype=np.float64) for c in x])), np.zeros(len(x[0]))))

    return margins


def probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


@dataclass(frozen=True)
class Boosted:
    """Trees over ``columns``, their missing flags and the codes of ``categories``; the first ``best_rounds`` are used."""

    trees: list[Tree]
    base: float
    columns: list[str]
    categories: Categories | None
    best_rounds: int
    history: tuple[float, ...] = ()

    @property
    def inputs(self) -> list[str]:
        return _inputs(self.columns, self.categories)

    def score(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        """Prediction columns and the probability as ``score``."""
        x = [F.col(c).cast("double") for c in self.inputs]
        used = self.trees[: self.best_rounds if rounds is None else rounds]
        margin = F.lit(self.base) + (_margins_of(used)(*x) if used else F.lit(0.0))
        return _table(df, self.columns, self.categories).select(*PREDICTION, probability(margin).alias("score"))

    def importance(self) -> dict[str, float]:
        """What each column gained over the trees in use, shares of the whole; a missing flag counts towards its column."""
        total = dict.fromkeys([*self.columns, *(self.categories.columns if self.categories else [])], 0.0)
        owner = [*self.columns, *self.columns, *(self.categories.columns if self.categories else [])]
        for tree in self.trees[: self.best_rounds]:
            for feature, gain in zip(tree.feature, tree.gain, strict=True):
                if feature >= 0:
                    total[owner[feature]] += gain
        whole = sum(total.values()) or 1.0
        return {c: g / whole for c, g in total.items()}

    def nodes(self, spark: SparkSession) -> DataFrame:
        rows = [(r, i, *items) for r, t in enumerate(self.trees) for i, items in enumerate(zip(*asdict(t).values(), strict=True))]
        return spark.createDataFrame(rows, _NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes, inputs and category codes together: what scoring new rows needs."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = [(self.columns, self.base, self.best_rounds, list(self.history), bool(self.categories))]
        kinds = "columns array<string>, base double, best_rounds int, history array<double>, has_categories boolean"
        spark.createDataFrame(about, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
        if self.categories:
            self.categories.save(f"{path}/categories")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        about = spark.read.parquet(f"{path}/about").first()
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "node").collect():
            if r["node"] == 0:
                trees.append(Tree())
            for name in asdict(trees[-1]):
                getattr(trees[-1], name).append(r[name])
        categories = Categories.load(spark, f"{path}/categories") if about["has_categories"] else None
        return Boosted(trees, about["base"], about["columns"], categories, about["best_rounds"], tuple(about["history"]))


def _inputs(columns: list[str], categories: Categories | None) -> list[str]:
    return [*columns, *[f"{c}_missing" for c in columns], *[f"{c}_code" for c in (categories.columns if categories else [])]]


def _table(df: DataFrame, columns: list[str], categories: Categories | None) -> DataFrame:
    """Keys and inputs of the trees."""
    keys = (*KEYS, *(categories.columns if categories else ()))
    rows = with_missing_flags(df, columns, keys)
    return categories.transform(rows) if categories else rows


def _nominal(categories: Categories | None, bins: int) -> dict[str, int]:
    """Sizes of the categories of few values."""
    sizes = zip(categories.columns, categories.sizes, strict=True) if categories else ()
    return {f"{c}_code": size for c, size in sizes if size < bins}


@dataclass(frozen=True)
class _Rows:
    """Blocks of coded rows and, in the same order, their margins and whether they are drawn; ``step`` is the tree whose outputs the margins still lack."""

    blocks: RDD
    rdd: RDD
    coder: growth.Coder
    step: tuple | None = None

    @property
    def storageLevel(self) -> StorageLevel:  # noqa: N802  as a DataFrame names it
        return self.rdd.getStorageLevel()

    @property
    def pairs(self) -> RDD:
        return self.blocks.zip(self.rdd)


def _advanced(pair: tuple, step: tuple | None, draw: tuple | None = None) -> tuple:
    """Margin of a block with the outputs of ``step``, and whether its rows are drawn."""
    (codes, _, ids, unknown, _), (margin, _) = pair
    if step:
        nodes, values = step
        margin = margin + values.take(nodes.reached(codes, np.arange(len(margin))))
    return margin, growth.drawn_rows(ids, unknown, *draw) if draw else None


def _drawn(rows: _Rows, settings: Boosting, round_: int) -> _Rows:
    """``rows`` as round ``round_`` needs them: their margin and whether they are drawn. Kept until the next round has its own."""
    draw = (settings.seed, round_, settings.row_share)
    return _Rows(rows.blocks, growth.kept(rows.pairs.map(partial(_advanced, step=rows.step, draw=draw))), rows.coder)


def _stored(rows: _Rows) -> _Rows:
    return _Rows(rows.blocks, growth.stored(rows.pairs.map(partial(_advanced, step=rows.step))), rows.coder)


def _grow(rows: _Rows, settings: Boosting, round_: int, inputs: int) -> tuple[Tree, _Rows]:
    """One tree fitted to the rows ``_drawn`` for its round, and all of them with the margin it leads to."""
    chance = np.random.default_rng([settings.seed, round_])
    chosen = sorted(chance.choice(inputs, max(1, round(inputs * settings.column_share)), replace=False).tolist())
    held = rows.coder.round(chosen, settings.seed, round_, settings.row_share)
    grown = growth.grow(rows.pairs, held, settings.max_depth, settings.min_rows_per_leaf)
    nodes = grown.nodes()
    gradients, weights = growth.leaf_sums(rows.pairs, nodes)
    tree, values = Tree(), np.zeros(len(nodes.feature))
    part = lambda gradient, weight: gradient**2 / (weight + settings.l2) if weight + settings.l2 else 0.0

    def place(found: int) -> tuple[int, float, float]:
        """Put a node and those below it into the tree; its place, gradient and weight."""
        split = grown.split.get(found)
        if split is None:
            at, gradient, weight = tree.add(), gradients[found], weights[found]
            values[found] = tree.value[at] = settings.learning_rate * float(gradient / (weight + settings.l2)) if weight + settings.l2 else 0.0
            return at, gradient, weight
        at = tree.add(*split)
        (tree.left[at], *left), (tree.right[at], *right) = [place(int(c)) for c in nodes.child[2 * found : 2 * found + 2]]
        gradient, weight = left[0] + right[0], left[1] + right[1]
        tree.gain[at] = float(part(*left) + part(*right) - part(gradient, weight))
        return at, gradient, weight

    place(0)
    return tree, replace(rows, step=(nodes, values))


def _first_margin(block: tuple) -> np.ndarray:
    return block[-1] + np.zeros(len(block[1]))


def _first_state(block: tuple) -> tuple:
    return _first_margin(block), None


def _later(pair: tuple, trees: list[tuple]) -> tuple:
    """Labels of a block and its margins after each of ``trees``."""
    (x, y, _), margin = pair
    return y, margin + np.cumsum(list(_outputs(trees, x)), axis=0)


def _placed(tree: Tree, used: list[int]) -> tuple:
    """Arrays of a tree over the inputs ``used`` alone."""
    feature, *rest = tree.arrays()
    return np.searchsorted(used, feature), *rest


def _rankings(block: tuple):
    y, margins = block
    return [(i, margin, y) for i, margin in enumerate(margins)]


def _last(block: tuple) -> np.ndarray:
    return block[1][-1]


def fit_boosted(
    train: DataFrame, valid: DataFrame, columns: list[str] = NUMERIC_FEATURES, categories: list[str] | tuple[str, ...] = (),
    start: Boosted | None = None, **settings: float,
) -> Boosted:
    """Boosted trees without class weights, stopped where average precision on ``valid`` has not risen for ``patience`` rounds, at whichever round that is.

    ``start`` continues an earlier fit over the same columns. Category codes are fitted on ``train``, which is read for the cuts and again for the codes.
    """
    held = replace(Boosting(), **settings)
    shared_folder(train.sparkSession)
    ship(train.sparkSession)
    codes = start.categories if start else fit_categories(train, list(categories)) if categories else None
    columns = start.columns if start else list(columns)
    inputs = _inputs(columns, codes)
    x = F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")
    tables = [growth.with_id(_table(df, columns, codes), "transaction_id").select("_id", F.col(TARGET).cast("double").alias("y"), x) for df in (train, valid)]
    about = train.agg(F.count("*").alias("n"), F.avg(F.col(TARGET).cast("double")).alias("mean")).first()
    if not about["n"]:
        raise ValueError("no rows to fit trees to")
    mean = min(max(about["mean"] or 0.0, 1e-9), 1 - 1e-9)
    base = start.base if start else math.log(mean / (1 - mean))
    trees, history = list(start.trees) if start else [], list(start.history) if start else []
    coder = growth.fit_coder(tables[0], about["n"], inputs, _nominal(codes, held.bins), held.bins, held.seed)
    before = partial(_margin_before, base=base, trees=[t.arrays() for t in trees])
    blocks = growth.blocks(tables[0], about["n"], partial(growth.coded_block, coder=coder, margin=before))
    ranked = growth.blocks(tables[1], valid.count(), partial(growth.plain_block, used=coder.inputs, margin=before))
    rows, margins = _Rows(blocks, growth.kept(blocks.map(_first_state)), coder), growth.kept(ranked.map(_first_margin))
    while len(trees) < held.rounds:
        first, opened = len(trees), rows
        kept = []
        for round_ in range(first, min(first + held.stretch, held.rounds)):
            kept.append(_drawn(rows, held, round_))
            tree, rows = _grow(kept[-1], held, round_, len(inputs))
            trees.append(tree)
            for old in kept[:-1]:
                old.rdd.unpersist()
            del kept[:-1]
        rows = _stored(rows)
        for old in (opened, *kept):
            old.rdd.unpersist()
        after = growth.kept(ranked.zip(margins).map(partial(_later, trees=[_placed(t, coder.inputs) for t in trees[first:]])))
        found = average_precision_by(after.flatMap(_rankings))
        history += [found.get(i) or 0.0 for i in range(len(trees) - first)]
        earlier, margins = margins, growth.stored(after.map(_last))
        for old in (earlier, after):
            old.unpersist()
        stop = _stop(history, held.patience)
        if stop is not None:
            trees, history = trees[:stop], history[:stop]
            break
    for old in (rows.rdd, blocks, ranked, margins):
        old.unpersist()
    best = 1 + max(range(len(history)), key=lambda i: (history[i], -i)) if history else 0
    return Boosted(trees, base, columns, codes, best, tuple(history))


def _margin_before(x: np.ndarray, base: float, trees: list[tuple]) -> np.ndarray | float:
    """Margins by an earlier fit; one number where there is none."""
    return base + sum(_outputs(trees, x), np.zeros(x.shape[1])) if trees else base


def _stop(history: list[float], patience: int) -> int | None:
    """After how many rounds a fit ends: the first that is ``patience`` rounds behind the best so far."""
    best, at = -1.0, 0
    for i, found in enumerate(history):
        if found > best:
            best, at = found, i
        elif i - at >= patience:
            return i + 1
    return None
