"""Gradient boosted trees that stop in time: two classes, or one-vs-rest for several.

Features are cut into bins once and the binned rows are staged. A tree grows level by level from the histograms of the rows' gradients. Rows
that fit one task stay there for a chunk of rounds; of more rows every task adds up its own histograms, one job per level, and Spark sums
the cells. A chunk begins from the trees grown so far, which are all the state there is, so a lost executor costs one chunk.
The loss of the held-out rows is known after every round; growth ends ``patience`` rounds after the best one and the ensemble is
cut there. No round is fitted twice.

Gradients are rounded to whole numbers of a small unit before they are added, so sums do not depend on their order: a model is
the same for any number of tasks and any order of its rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tidemark.session import staged

# what runs in tasks travels with them, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: bins of a feature at most; rounds of a chunk; rows that one task holds; rounds after which the margins of more rows are staged anew
BINS = 64
CHUNK_ROUNDS = 50
TASK_ROWS = 1_000_000
STAGED_ROUNDS = 10
#: gradients are whole numbers of this unit; penalty on leaf values; least gain of a split
UNIT = 2.0**-24
PENALTY = 1.0
LEAST_GAIN = 1e-6


#: a tree as a row
TREE = {
    "feature": "array<int>", "bin": "array<int>", "cut": "array<double>", "left": "array<int>", "right": "array<int>", "value": "array<double>",
    "gain": "array<double>", "depth": "int",
}
GROWN = ", ".join(f"`{c}` {kind}" for c, kind in {"place": "int", "loss": "double", **TREE}.items())
_ARROW = {"array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "int": pa.int32(), "double": pa.float64()}
GROWN_TYPE = pa.schema([(c, _ARROW[kind]) for c, kind in {"place": "int", "loss": "double", **TREE}.items()])


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays: rows go left where feature <= cut; a leaf leads to itself and has feature -1."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int

    def leaves(self, columns: np.ndarray, at: np.ndarray, begun: tuple[int, np.ndarray] | None = None) -> np.ndarray:
        """Leaf of every row; ``columns`` holds bins or values, ``at`` the bin or cut of each node to compare with.

        ``begun`` has the depth of the tree when it was smaller and the leaves of that time, from which the rows go on.
        """
        depth, node = begun or (0, np.zeros(len(columns), np.intp))
        flat = np.ascontiguousarray(columns).ravel()
        first, feature = np.arange(len(columns)) * columns.shape[1], np.maximum(self.feature, 0)
        child = np.column_stack([self.left, self.right]).ravel()
        for _ in range(depth, self.depth):
            goes_right = ~(flat.take(first + feature.take(node)) <= at.take(node))
            node = child.take(2 * node + goes_right)
        return node

    def masks(self, widths: Sequence[int]) -> LeafMasks | None:
        """The tree as bits, for features with so many bins; None for one of more than 64 leaves."""
        order, under, stack = [], {}, [(0, False)]
        while stack:
            node, seen = stack.pop()
            if self.feature[node] < 0:
                under[node] = 1 << len(order)
                order.append(node)
            elif seen:
                under[node] = under[self.left[node]] | under[self.right[node]]
            else:
                stack += [(node, True), (self.right[node], False), (self.left[node], False)]
        if len(order) > 64:
            return None
        tables = {f: np.full(widths[f], 2**64 - 1, np.uint64) for f in sorted({int(f) for f in self.feature if f >= 0})}
        for node in np.flatnonzero(self.feature >= 0):
            tables[int(self.feature[node])][self.bin[node] + 1 :] &= np.uint64(2**64 - 1 - under[self.left[node]])
        values = np.zeros(64)
        for place, node in enumerate(order):
            values[(SPREAD_BITS << place) % 2**64 >> 58] = self.value[node]
        return LeafMasks(tuple(tables.items()), values)


#: a de Bruijn number: its product with a single bit has another value in the top six bits for every bit
SPREAD_BITS = 0x03F79D71B4CB0A89


@dataclass(frozen=True)
class LeafMasks:
    """Of each feature, by bin, the leaves (from the left, as bits) that its splits leave open. A row's leaf is the lowest bit open in all of them."""

    tables: tuple[tuple[int, np.ndarray], ...]
    values: np.ndarray

    def of(self, bins: Sequence[np.ndarray]) -> np.ndarray | float:
        """Value of every row, from one array of bins per feature."""
        if not self.tables:
            return self.values[SPREAD_BITS >> 58]
        (f, table), *more = self.tables
        open_ = table.take(bins[f])
        for f, table in more:
            open_ &= table.take(bins[f])
        open_ &= -open_
        open_ *= np.uint64(SPREAD_BITS)
        open_ >>= np.uint64(58)
        return self.values.take(open_.view(np.int64))


@dataclass(frozen=True)
class BoostedTrees:
    """Rounds of trees, one tree per class in a round (one for two classes)."""

    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]
    classes: int
    priors: tuple[float, ...]
    rounds: tuple[tuple[Tree, ...], ...] = ()
    losses: tuple[float, ...] = ()
    fitted_rounds: int = 0
    has_held: bool = False
    settings: Mapping = field(default_factory=dict)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.features))
        for tree in (t for trees in self.rounds for t in trees):
            np.add.at(total, tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        """(rows, classes) for a matrix of feature values."""
        bins = [np.searchsorted(at, values[:, f], "left") for f, at in enumerate(self.cuts)]
        margins = np.tile(np.array(self.priors), (len(values), 1))
        for k, trees in enumerate(zip(*self.rounds)):
            # a column of its own lies closer together than one of the matrix
            sums = margins[:, k].copy()
            for number, tree in enumerate(trees):
                masks = self._masks[number][k]
                sums += masks.of(bins) if masks else tree.value.take(tree.leaves(values, tree.cut))
            margins[:, k] = sums
        return class_shares(margins)

    @cached_property
    def _masks(self) -> list[list[LeafMasks | None]]:
        """Made once in a task, whatever its batches."""
        widths = [len(at) + 1 for at in self.cuts]
        return [[tree.masks(widths) for tree in trees] for trees in self.rounds]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (vector) and ``prediction``, from its vector column ``features``."""
        model = self

        @F.pandas_udf("array<double>")
        def shares(columns: pd.Series) -> pd.Series:
            values = np.stack(columns.to_list()).astype(float) if len(columns) else np.zeros((0, len(model.features)))
            return pd.Series(list(model.probabilities(values)))

        scored = df.withColumn("probability", shares(vector_to_array("features")))
        most = F.array_position("probability", F.array_max("probability")) - 1
        said = F.when(F.col("probability")[1] > 0.5, 1).otherwise(0) if self.classes == 2 else most
        return scored.withColumn("prediction", said.cast("double")).withColumn("probability", array_to_vector("probability"))

    def trees(self, spark: SparkSession) -> DataFrame:
        """The model as a table, one row per node."""
        rows = [
            (r, k, node, self.features[t.feature[node]] if t.feature[node] >= 0 else None, float(t.cut[node]) if t.feature[node] >= 0 else None,
             int(t.left[node]), int(t.right[node]), float(t.value[node]), float(t.gain[node]))
            for r, trees in enumerate(self.rounds) for k, t in enumerate(trees) for node in range(len(t.feature))
        ]
        return spark.createDataFrame(rows, "round int, class int, node int, feature string, cut double, left int, right int, value double, gain double")


def class_shares(margins: np.ndarray) -> np.ndarray:
    """Probabilities of all classes: the logistic of one margin, or of each margin, brought to a sum of 1."""
    said = 1 / (1 + np.exp(-margins))
    return np.column_stack([1 - said[:, 0], said[:, 0]]) if margins.shape[1] == 1 else said / said.sum(1, keepdims=True)


def _spread(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes, anew for every salt."""
    h = key.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in (*salt, 0x51):
            h = (h ^ np.uint64(s & 0xFFFFFFFF) ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
    return (h >> np.uint64(11)).astype(float) * 2.0**-53


def _whole(values: np.ndarray) -> np.ndarray:
    return np.rint(values / UNIT)


def _best_splits(sums: np.ndarray, features: np.ndarray, least_weight: float) -> list[tuple[float, int, int, np.ndarray]]:
    """Per node (gain, feature, bin, [[g, h] left, [g, h] right]) from its histograms (2, nodes, features, bins)."""
    g, h = sums * UNIT
    gl, hl = g.cumsum(2), h.cumsum(2)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    gr, hr = gt - gl, ht - hl
    gain = gl**2 / (hl + PENALTY) + gr**2 / (hr + PENALTY) - gt**2 / (ht + PENALTY)
    gain = np.where((hl >= least_weight) & (hr >= least_weight), gain, -np.inf)
    best = gain.reshape(len(gain), -1).argmax(1)
    out = []
    for node, place in enumerate(best):
        f, b = divmod(int(place), gain.shape[2])
        sides = np.array([[gl[node, f, b], hl[node, f, b]], [gr[node, f, b], hr[node, f, b]]])
        out.append((float(gain[node, f, b]), int(features[f]), b, sides))
    return out


def _table(nodes: list[list], depth: int) -> Tree:
    kinds = (np.int32, np.int32, float, np.int32, np.int32, float, float)
    return Tree(*[np.array(column, kind) for column, kind in zip(zip(*nodes), kinds)], depth)


class HeldRows:
    """Binned rows in memory, with their margins under a model."""

    def __init__(self, model: BoostedTrees, bins: np.ndarray, label: np.ndarray, held: np.ndarray, key: np.ndarray, margins: np.ndarray | None = None):
        self.model, self.bins, self.label, self.held, self.key = model, bins, label, held, key
        self.margins = np.tile(np.array(model.priors), (len(label), 1)) if margins is None else margins
        self.width = max((len(c) for c in model.cuts), default=0) + 1
        self.drawn: tuple = (None, None)
        self.walked: tuple = (None, None)

    def add(self, trees: Sequence[Tree]) -> None:
        for k, tree in enumerate(trees):
            self.margins[:, k] += tree.value[tree.leaves(self.bins, tree.bin)]

    def _gradients(self, number: int, k: int) -> tuple[np.ndarray, ...]:
        if self.drawn[0] != (number, k):
            settings = self.model.settings
            used = ~self.held & (_spread(self.key, settings["seed"], number) < settings["subsample"])
            said = 1 / (1 + np.exp(-self.margins[:, k]))
            hit = self.label == (1 if len(self.model.priors) == 1 else k)
            self.drawn = ((number, k), (used, _whole(said - hit), _whole(said * (1 - said))))
        return self.drawn[1]

    def histograms(self, tree: Tree, open_: Sequence[int], features: np.ndarray, number: int, k: int) -> np.ndarray:
        """(2, open nodes, features, bins): sums of the gradients of round ``number`` and output ``k``."""
        used, g, h = self._gradients(number, k)
        node = tree.leaves(self.bins, tree.bin, self.walked[1] if self.walked[0] == (number, k) else None)
        self.walked = ((number, k), (tree.depth, node))
        at = np.full(len(tree.feature), -1)
        at[list(open_)] = range(len(open_))
        place = np.where(used, at[node], -1)
        rows = np.flatnonzero(place >= 0)
        first, values = place[rows] * self.width, (g[rows], h[rows])
        sums = np.empty((2, len(open_), len(features), self.width))
        for i, f in enumerate(features):
            cell = first + self.bins[rows, f]
            for side, value in enumerate(values):
                sums[side, :, i] = np.bincount(cell, value, len(open_) * self.width).reshape(len(open_), self.width)
        return sums

    def loss(self) -> tuple[float, int]:
        """Sum of the held rows' losses in units, and their number."""
        shares = class_shares(self.margins[self.held])[np.arange(self.held.sum()), self.label[self.held]]
        return float(_whole(-np.log(np.maximum(shares, 1e-15))).sum()), int(self.held.sum())


class SpreadRows:
    """Binned rows of a table, over as many tasks as it needs; margins are staged every few rounds."""

    def __init__(self, model: BoostedTrees, binned: DataFrame):
        self.model, self.binned, self.since, self.margins = model, binned, [], False
        self.width = max((len(c) for c in model.cuts), default=0) + 1

    def _each(self, work, schema: str, at_end=None) -> DataFrame:
        """What ``work`` makes of every batch; with ``at_end`` its results are added up in the task and one batch is made of the sum."""
        model, since, margins = self.model, list(self.since), self.margins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                rows = _held_rows(model, [batch], margins)
                for trees in since:
                    rows.add(trees)
                made = work(rows, batch)
                if at_end is None:
                    yield made
                else:
                    total = made if total is None else total + made
            if total is not None:
                yield at_end(total)

        return self.binned.mapInArrow(run, schema)

    def add(self, trees: Sequence[Tree]) -> None:
        self.since.append(tuple(trees))
        if len(self.since) >= STAGED_ROUNDS:
            def with_margins(rows: HeldRows, batch: pa.RecordBatch) -> pa.RecordBatch:
                flat = pa.array([m.tobytes() for m in rows.margins], pa.binary())
                return pa.RecordBatch.from_arrays([*batch.columns[:4], flat], names=[*BINNED, "margins"])

            self.binned, self.since, self.margins = staged(self._each(with_margins, f"{BINNED_TYPE}, margins binary"), "margins"), [], True

    def histograms(self, tree: Tree, open_: Sequence[int], features: np.ndarray, number: int, k: int) -> np.ndarray:
        shape = (2, len(open_), len(features), self.width)

        def sums(rows: HeldRows, batch: pa.RecordBatch) -> np.ndarray:
            return rows.histograms(tree, open_, features, number, k).reshape(2, -1)

        def cells(total: np.ndarray) -> pa.RecordBatch:
            total = total.astype(np.int64)
            filled = np.flatnonzero(total.any(0))
            return pa.RecordBatch.from_arrays([pa.array(filled), *[pa.array(side[filled]) for side in total]], names=["cell", "g", "h"])

        # as many rows as the tree level has cells, whatever the table
        out = np.zeros((2, math.prod(shape[1:])))
        for r in self._each(sums, "cell long, g long, h long", cells).groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            out[:, r["cell"]] = r["g"], r["h"]
        return out.reshape(shape)

    def loss(self) -> tuple[float, int]:
        def both(rows: HeldRows, batch: pa.RecordBatch) -> np.ndarray:
            return np.array(rows.loss())

        def one(total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in total], names=["loss", "n"])

        said = self._each(both, "loss long, n long", one)
        r = said.agg(F.coalesce(F.sum("loss"), F.lit(0)).alias("loss"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        return float(r["loss"]), int(r["n"])


def grow_tree(rows: HeldRows | SpreadRows, features: np.ndarray, number: int, k: int) -> Tree:
    """The tree of round ``number`` and output ``k``, level by level; the smallest feature and bin win ties.

    Of two children the lighter one is summed; the other has what it leaves of their parent, to the last unit.
    """
    settings, cuts = rows.model.settings, rows.model.cuts
    nodes = [[-1, 0, math.nan, 0, 0, 0.0, 0.0]]  # feature, bin, cut, left, right, value, gain
    open_, depth, rate, lighter = [0], 0, settings["learning_rate"], np.zeros(1, np.intp)
    sums = parents = None
    while open_ and depth < settings["max_depth"]:
        counted = rows.histograms(_table(nodes, depth), [open_[i] for i in lighter], features, number, k)
        if depth == 0:
            sums = counted
            total = sums[:, 0, 0].sum(1) * UNIT
            nodes[0][5] = -rate * total[0] / (total[1] + PENALTY)
        else:
            whole = sums[:, parents]
            sums = np.empty((2, len(open_), *counted.shape[2:]))
            sums[:, lighter], sums[:, lighter ^ 1] = counted, whole - counted
        ahead, parents, lighter = [], [], []
        for place, (here, (gain, f, b, sides)) in enumerate(zip(open_, _best_splits(sums, features, settings["min_child_weight"]))):
            if gain > LEAST_GAIN:
                parents.append(place)
                lighter.append(len(ahead) + int(sides[1, 1] < sides[0, 1]))
                for gs, hs in sides:
                    ahead.append(len(nodes))
                    nodes.append([-1, 0, math.nan, len(nodes), len(nodes), -rate * gs / (hs + PENALTY), 0.0])
                nodes[here] = [f, b, float(cuts[f][b]), ahead[-2], ahead[-1], nodes[here][5], gain]
        open_, depth, lighter = ahead, depth + bool(ahead), np.array(lighter, np.intp)
    return _table(nodes, depth)


def grow_rounds(model: BoostedTrees, rows: HeldRows | SpreadRows, rounds: int, patience: int | None) -> BoostedTrees:
    """``model`` with up to ``rounds`` more rounds from rows that know its margins; growth ends ``patience`` rounds after the best loss."""
    settings, names = model.settings, len(model.features)
    grown, losses = list(model.rounds), list(model.losses)
    for number in range(len(grown), len(grown) + rounds):
        trees = []
        for k in range(len(model.priors)):
            draw = np.random.default_rng([settings["seed"], number, k])
            features = np.sort(draw.choice(names, max(1, round(names * settings["colsample"])), replace=False))
            trees.append(grow_tree(rows, features, number, k))
        rows.add(trees)
        grown.append(tuple(trees))
        total, n = rows.loss() if model.has_held else (0.0, 0)
        if n:
            losses.append(total * UNIT / n)
            if patience is not None and len(losses) - 1 - int(np.argmin(losses)) >= patience:
                break
    return replace(model, rounds=tuple(grown), losses=tuple(losses))


BINNED = ("bins", "label", "held", "key")
BINNED_TYPE = "bins binary, label long, held boolean, key long"


def _held_rows(model: BoostedTrees, batches: list[pa.RecordBatch], margins: bool = False) -> HeldRows:
    def matrix(column: int, kind: type, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(x for b in batches for x in b.column(column).to_pylist()), kind).reshape(-1, width).copy()

    label, held, key = (
        np.concatenate([np.zeros(0, kind), *[b.column(i).to_numpy(zero_copy_only=False).astype(kind) for b in batches]])
        for i, kind in ((1, np.int64), (2, bool), (3, np.int64))
    )
    said = matrix(4, float, len(model.priors)) if margins else None
    return HeldRows(model, matrix(0, np.uint8, len(model.features)), label, held, key, said)


def _chunk(model: BoostedTrees, rounds: int, patience: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _held_rows(model, list(batches))
        for trees in model.rounds:
            rows.add(trees)
        grown = grow_rounds(model, rows, rounds, patience)
        trees = [t for group in grown.rounds[len(model.rounds) :] for t in group]
        new = list(grown.losses[len(model.losses) :])
        losses = [new[i // len(model.priors)] if new else None for i in range(len(trees))]
        yield pa.RecordBatch.from_pydict(
            {"place": range(len(trees)), "loss": losses, **{c: [getattr(t, c) for t in trees] for c in TREE}}, schema=GROWN_TYPE
        )

    return run


def _read_chunk(rows: list, outputs: int) -> tuple[tuple[tuple[Tree, ...], ...], tuple[float, ...]]:
    """Rounds and losses of the rows that a chunk returns."""
    rows = sorted(rows, key=lambda r: r["place"])
    trees = [Tree(*[np.array(r[c]) if kind.startswith("array") else r[c] for c, kind in TREE.items()]) for r in rows]
    rounds = tuple(tuple(trees[i : i + outputs]) for i in range(0, len(trees), outputs))
    return rounds, tuple(r["loss"] for r in rows[::outputs] if r["loss"] is not None)


def _bin_rows(features: Sequence[str], cuts: Sequence[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = np.empty((batch.num_rows, len(features)), np.uint8)
            for i, at in enumerate(cuts):
                binned[:, i] = np.searchsorted(at, batch.column(i).to_numpy(zero_copy_only=False), "left")
            flat = pa.array([row.tobytes() for row in binned], pa.binary())
            yield pa.RecordBatch.from_arrays([flat, *batch.columns[len(features) :]], names=list(BINNED))

    return run


DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 4, "subsample": 1.0, "colsample": 1.0, "min_child_weight": 1.0, "seed": 42}


@dataclass(frozen=True)
class BinnedRows:
    """Staged rows in bins, which any number of fits may read, and the model without rounds."""

    table: DataFrame
    rows: int
    empty: BoostedTrees


def _cuts(train: DataFrame, size: int) -> tuple[np.ndarray, ...]:
    """Quantiles of the rows and of the distinct values of every feature; all values where there are fewer than ``BINS``."""
    shares = [(i + 1) / BINS for i in range(BINS - 1)]
    each = train.select(F.posexplode(F.array(*[f"f{i}" for i in range(size)])).alias("f", "v"))
    counted = each.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    of_values = {r["f"]: r["q"] for r in counted.groupBy("f").agg(F.percentile_approx("v", shares, 10_000).alias("q")).collect()}
    of_rows = train.agg(*[F.percentile_approx(f"f{i}", shares, 10_000).alias(f"f{i}") for i in range(size)]).first()
    return tuple(np.unique(np.array([*(of_rows[i] or []), *of_values.get(i, [])], float)) for i in range(size))


def bin_rows(
    rows: DataFrame, features: Sequence[str], label: str = "label", validation: Column | None = None, classes: int = 2, fill: float = 0.0,
    key: Sequence[str] = (),
) -> BinnedRows:
    """Rows with a label from 0 to ``classes`` - 1, cut into bins and staged for ``grow``.

    Rows for which ``validation`` holds are not trained on, they measure the loss. ``key`` (by default features and label) is hashed to
    draw a round's rows. A null or NaN feature counts as ``fill``; rows without a label take no part.
    """
    features = tuple(features)
    values = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(fill))).alias(f"f{i}") for i, c in enumerate(features)]
    held = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    hashed = F.xxhash64(*[F.col(c) for c in key or (*features, label)])
    plain = staged(
        rows.where(F.col(label).isNotNull()).select(*values, F.col(label).cast("long").alias("label"), held.alias("held"), hashed.alias("key")), "fit"
    )
    told = plain.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("held")).alias("n_train"),
        *[F.count_if((F.col("label") == k) & ~F.col("held")).alias(f"n{k}") for k in range(classes)],
    ).first()
    cuts = _cuts(plain.where(~F.col("held")), len(features))
    counts = [told[f"n{k}"] for k in ([1] if classes == 2 else range(classes))]
    priors = tuple(math.log((n + 0.5) / (told["n_train"] - n + 0.5)) for n in counts)
    model = BoostedTrees(features, cuts, classes, priors, has_held=told["n"] > told["n_train"] > 0)
    return BinnedRows(staged(plain.mapInArrow(_bin_rows(features, cuts), BINNED_TYPE), "bins"), told["n"] if told["n_train"] else 0, model)


def _ended(model: BoostedTrees, patience: int | None) -> bool:
    return patience is not None and bool(model.losses) and len(model.losses) - 1 - int(np.argmin(model.losses)) >= patience


def grow(binned: BinnedRows, patience: int | None = None, **settings) -> BoostedTrees:
    """Boosted trees with the ``settings`` n_estimators, learning_rate, max_depth, subsample, colsample, min_child_weight and seed.

    With held-out rows the ensemble is cut at the round of their lowest loss; ``patience`` ends its growth so many rounds after that one.
    Without rows to train on the model is its priors.
    """
    model = replace(binned.empty, settings={**DEFAULTS, **settings})
    wanted = int(model.settings["n_estimators"]) if binned.rows else 0
    if binned.rows > TASK_ROWS:
        model = grow_rounds(model, SpreadRows(model, binned.table), wanted, patience)
    while binned.rows <= TASK_ROWS and len(model.rounds) < wanted and not _ended(model, patience):
        ask = min(CHUNK_ROUNDS, wanted - len(model.rounds))
        told = binned.table.coalesce(1).mapInArrow(_chunk(model, ask, patience), GROWN).collect()
        grown, losses = _read_chunk(told, len(model.priors))
        model = replace(model, rounds=model.rounds + grown, losses=model.losses + losses)
    best = int(np.argmin(model.losses)) + 1 if model.losses else len(model.rounds)
    return replace(model, rounds=model.rounds[:best], fitted_rounds=len(model.rounds))


def fit(
    rows: DataFrame, features: Sequence[str], label: str = "label", validation: Column | None = None, classes: int = 2, fill: float = 0.0,
    patience: int | None = None, key: Sequence[str] = (), **settings,
) -> BoostedTrees:
    """``bin_rows`` and ``grow`` in one."""
    return grow(bin_rows(rows, features, label, validation, classes, fill, key), patience, **settings)


def score_many(
    trained: Sequence[BoostedTrees], df: DataFrame, keep: Sequence[str], fill: float = 0.0, features: Sequence[str] | None = None
) -> DataFrame:
    """(model, scores, *keep): every row under every model, read once; ``model`` is its place in ``trained``, ``scores`` an array with all classes.

    ``features`` are the columns in the models' order, where they have other names than in the fit.
    """
    features = list(features or trained[0].features)
    values = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(fill))).alias(f"_f{i}") for i, c in enumerate(features)]
    models, rows = list(trained), df.select(*values, *keep)
    kept = rows.schema.fields[len(features) :]
    schema = StructType([StructField("model", IntegerType()), StructField("scores", ArrayType(DoubleType())), *kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            matrix = np.empty((n, len(features)))
            for i in range(len(features)):
                matrix[:, i] = batch.column(i).to_numpy(zero_copy_only=False)
            for place, model in enumerate(models):
                said = model.probabilities(matrix)
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * said.shape[1], pa.int32())
                scores = pa.ListArray.from_arrays(ends, pa.array(said.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, place, np.int32)), scores, *batch.columns[len(features) :]], names=["model", "scores", *[f.name for f in kept]]
                )

    return rows.mapInArrow(run, schema)
