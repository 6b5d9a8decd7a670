"""Boosted regression trees grown leaf by leaf from per-leaf gradient histograms.

Columns are cut into at most 255 bins once and stored, a byte a cell, with a running prediction. Each level
of a tree is one Spark aggregate: tasks add up gradients and rows by (leaf, column, bin), the parts are
merged by (leaf, block of columns), and only the best cut of each block reaches the driver. A leaf's cut
does not depend on the other leaves, so all leaves of a level are measured together, and afterwards cuts
are taken best gain first until the tree has its number of leaves: the same tree as growing it leaf by leaf.

Squared error takes regularised means as leaf values; absolute error takes the exact median of the
residuals of each leaf.

A level costs a few Spark jobs' fixed time whatever the rows are, so a table of up to ONE_TASK_CELLS cells is
fitted by one task (``Held``): the same cuts, with the histogram of the larger child taken as that of its parent
less its sibling's.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.labels import hash_uniform
from basketry.functions.numeric import finite_or_zero
from basketry.operators.gram import finite_matrix
from basketry.operators.quantile import quantiles
from basketry.session import cut_lineage, ship_package

BINS = 255
# Columns whose cuts are searched together, and tasks whose histograms are merged in the first step.
COLUMNS_AT_ONCE = 16
FAN_IN = 64
# Trees after which predictions are stored anew.
TREES_PER_COPY = 25
# Cells (rows times columns, a byte each) up to which one task grows boosted trees by itself.
ONE_TASK_CELLS = 512 * 2 ** 20
# Rows whose cells a task gathers at once, and rows up to which all columns go into one count.
GATHERED, FEW = 2 ** 15, 2 ** 11
_GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    leaves: int = 31
    least_rows: int = 20
    l1: float = 0.0
    l2: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    loss: str = "squared"
    seed: int = 42

    def __post_init__(self):
        if self.loss not in ("squared", "absolute"):
            raise ValueError(f"no loss named {self.loss}")


# Trees

@dataclass
class Tree:
    """Nodes as arrays; a leaf has column -1. Rows with value <= threshold go left."""

    column: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, value: float, rows: float) -> int:
        for name, x in (("column", -1), ("bin", 0), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", value), ("rows", rows)):
            getattr(self, name).append(x)
        return len(self.column) - 1

    def leaf_of(self, cells: np.ndarray, binned: bool) -> np.ndarray:
        """The leaf of each row of a matrix of bins or values."""
        column, left, right = (np.asarray(x) for x in (self.column, self.left, self.right))
        limit = np.asarray(self.bin if binned else self.threshold)
        at, rows = np.zeros(len(cells), dtype=np.int64), np.arange(len(cells))
        while True:
            inner = column[at] >= 0
            if not inner.any():
                return at
            here = at[inner]
            low = cells[rows[inner], column[here]] <= limit[here]
            at[inner] = np.where(low, left[here], right[here])

    def expect(self) -> None:
        """Set the value of inner nodes to the mean of their leaves, weighted by rows."""
        for i in range(len(self.column) - 1, -1, -1):  # children come after their parent
            if self.column[i] >= 0:
                a, b = self.left[i], self.right[i]
                total = self.rows[a] + self.rows[b]
                self.value[i] = (self.value[a] * self.rows[a] + self.value[b] * self.rows[b]) / total if total else 0.0

    def contributions(self, cells: np.ndarray, into: np.ndarray) -> None:
        """Add to ``into`` (rows x columns) what each column changes along the row's path."""
        column, left, right, value = (np.asarray(x) for x in (self.column, self.left, self.right, self.value))
        limit = np.asarray(self.threshold)
        at, rows = np.zeros(len(cells), dtype=np.int64), np.arange(len(cells))
        while True:
            inner = column[at] >= 0
            if not inner.any():
                return
            here, who = at[inner], rows[inner]
            below = np.where(cells[who, column[here]] <= limit[here], left[here], right[here])
            into[who, column[here]] += value[below] - value[here]
            at[inner] = below


@dataclass
class Ensemble:
    """Trees over named columns; the prediction is base plus the trees' leaf values."""

    columns: list[str]
    base: float
    trees: list[Tree]

    def predict(self, cells: np.ndarray) -> np.ndarray:
        found = np.full(len(cells), self.base)
        for tree in self.trees:
            found += np.asarray(tree.value)[tree.leaf_of(cells, False)]
        return found

    @property
    def expected(self) -> float:
        """The mean prediction: base plus the trees' values at their roots."""
        return self.base + sum(tree.value[0] for tree in self.trees)

    def _matrix(self) -> Column:
        return F.array(*[finite_or_zero(c) for c in self.columns])

    def prediction(self) -> Column:
        """The model as a column; null, NaN and infinities count as 0."""
        width = len(self.columns)

        @F.arrow_udf("double")
        def predicted(cells: pa.Array) -> pa.Array:
            return pa.array(self.predict(_rows_of(cells, width)))

        return predicted(self._matrix())

    def contributions(self) -> Column:
        """An array with a contribution for each column; with ``expected`` they add up to the prediction."""
        width = len(self.columns)

        @F.arrow_udf("array<double>")
        def contributed(cells: pa.Array) -> pa.Array:
            values = _rows_of(cells, width)
            found = np.zeros_like(values)
            for tree in self.trees:
                tree.contributions(values, found)
            return pa.ListArray.from_arrays(np.arange(0, (len(values) + 1) * width, width, dtype=np.int32), found.ravel())

        return contributed(self._matrix())

    def importance(self) -> dict[str, float]:
        """Share of all cuts' rows that each column decides."""
        found = dict.fromkeys(self.columns, 0.0)
        for tree in self.trees:
            for column, rows in zip(tree.column, tree.rows):
                if column >= 0:
                    found[self.columns[column]] += rows
        total = sum(found.values())
        return {c: x / total if total else 0.0 for c, x in found.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, column, threshold, left, right, value, rows); node -1 of tree -1 holds the base."""
        rows = [(-1, -1, None, None, -1, -1, float(self.base), 0.0)]
        rows += [(-2 - i, -1, c, None, -1, -1, 0.0, 0.0) for i, c in enumerate(self.columns)]
        for t, tree in enumerate(self.trees):
            rows += [(t, i, self.columns[c] if c >= 0 else None, float(x), int(a), int(b), float(v), float(n)) for i, (c, x, a, b, v, n) in
                     enumerate(zip(tree.column, tree.threshold, tree.left, tree.right, tree.value, tree.rows))]
        return spark.createDataFrame(rows, "tree int, node int, column string, threshold double, left int, right int, "
                                           "value double, rows double")

    @classmethod
    def of_table(cls, nodes: DataFrame) -> Ensemble:
        rows = nodes.orderBy("tree", "node").collect()  # as many as the model has nodes
        names = [r["column"] for r in sorted((r for r in rows if r.tree < -1), key=lambda r: -r.tree)]
        at = {c: i for i, c in enumerate(names)}
        trees: dict[int, Tree] = {}
        for r in rows:
            if r.tree >= 0:
                tree = trees.setdefault(r.tree, Tree())
                i = tree.add(r["value"], r["rows"])
                tree.column[i] = at[r["column"]] if r["column"] is not None else -1
                tree.threshold[i], tree.left[i], tree.right[i] = r.threshold, r["left"], r["right"]
        return cls(names, next(r["value"] for r in rows if r.tree == -1), list(trees.values()))


def _rows_of(cells: pa.Array, width: int) -> np.ndarray:
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# Bins

def bin_edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of each column's bins, the last one open. Runs two Spark jobs.

    A column with no more distinct values than bins has one for each value; others are cut at quantiles.
    """
    values = df.select(*[finite_or_zero(c).alias(f"c{i}") for i, c in enumerate(columns)])
    names = values.columns
    few = values.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    exact = [n for n in names if few[n] <= 2 * bins]  # a bounded set, whatever the estimate's error
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cells = values.agg(*[F.collect_set(n).alias(n) if n in exact else
                         F.percentile_approx(n, shares, F.lit(20 * bins)).alias(n) for n in names]).first()
    edges = []
    for n in names:
        found = np.unique(np.array(cells[n] if cells[n] is not None else [], dtype=float))
        if n in exact and len(found) > bins:
            found = found[np.linspace(0, len(found) - 1, bins).astype(int)]
        edges.append(found[:-1] if n in exact and len(found) else found)
    return edges


_STATE = "draw double, label double, bins binary, prediction double"


def binned(df: DataFrame, columns: Sequence[str], label: str, key: str, edges: list[np.ndarray], base: float) -> DataFrame:
    """The labelled rows as (draw, label, packed bins, prediction), all with the same prediction."""
    draw = hash_uniform(F.col(key).cast("string"))
    rows = df.select(F.coalesce(draw, F.lit(0.0)).alias("draw"), F.col(label).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).where("label IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = finite_matrix(batch.columns[2:])
            cells = np.column_stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
            packed = pa.array([r.tobytes() for r in cells], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), packed, pa.array(np.full(len(cells), base))],
                names=["draw", "label", "bins", "prediction"])

    return rows.mapInArrow(run, _STATE)


# Growing

class _Rows:
    """What a task needs to read a batch: bins, gradient and leaf of the rows sampled for this tree."""

    def __init__(self, width: int, recent: list[Tree], settings: Settings, number: int, tasks: int):
        self.width, self.recent, self.settings, self.number, self.tasks = width, recent, settings, number, tasks

    def read(self, batch: pa.RecordBatch, sampled: bool = True):
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(-1, self.width)
        draw, label, now = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("draw", "label", "prediction"))
        if sampled and self.settings.row_share < 1:
            mine = (draw + self.number * _GOLDEN) % 1.0 < self.settings.row_share
            bins, label, now = bins[mine], label[mine], now[mine]
        now = now.copy()
        for tree in self.recent:
            now += np.array(tree.value)[tree.leaf_of(bins, True)]
        return bins, label, now


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g, n, s: Settings):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n + s.l2 > 0, _shrunk(g, s.l1) ** 2 / (n + s.l2), 0.0)


def _value(g: float, n: float, s: Settings) -> float:
    return float(-_shrunk(g, s.l1) / (n + s.l2)) * s.rate if n + s.l2 > 0 else 0.0


def _best_first(full: Tree, gains: dict[int, float], leaves: int) -> Tree:
    """The cuts of a full tree taken by gain up to the number of leaves; of equal gains the upper, then the left node."""
    tree, queue = Tree(), []

    def take(node: int, place: int) -> int:
        copy = tree.add(full.value[node], full.rows[node])
        if node in gains:
            heapq.heappush(queue, (-gains[node], place, node, copy))
        return copy

    take(0, 1)
    for _ in range(leaves - 1):
        if not queue:
            break
        _, place, node, copy = heapq.heappop(queue)
        tree.column[copy], tree.bin[copy], tree.threshold[copy] = full.column[node], full.bin[node], full.threshold[node]
        tree.left[copy], tree.right[copy] = take(full.left[node], 2 * place), take(full.right[node], 2 * place + 1)
    return tree


def _cuts(rows: DataFrame, reader: _Rows, tree: Tree, frontier: list[int], columns: list[int]) -> dict[int, tuple]:
    """{leaf: (gain, column, bin, left gradient, left rows, gradient, rows)} for the leaves of the frontier. One Spark job."""
    s, cells = reader.settings, BINS + 1
    blocks = [columns[i:i + COLUMNS_AT_ONCE] for i in range(0, len(columns), COLUMNS_AT_ONCE)]
    place = np.full(len(tree.column), -1)
    place[frontier] = np.arange(len(frontier))
    parts_schema = "leaf int, block int, part int, gradient array<double>, rows array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(columns), len(frontier) * cells)
        gradients, counts = np.zeros(shape), np.zeros(shape)
        for batch in batches:
            bins, label, now = reader.read(batch)
            g = now - label if s.loss == "squared" else np.sign(now - label)
            leaf = place[tree.leaf_of(bins, True)]
            bins, g, leaf = bins[leaf >= 0], g[leaf >= 0], leaf[leaf >= 0] * cells
            for i, c in enumerate(columns):
                at = leaf + bins[:, c]
                gradients[i] += np.bincount(at, g, shape[1])
                counts[i] += np.bincount(at, minlength=shape[1])
        group = TaskContext.get().partitionId() // FAN_IN
        out, first = [], 0
        for b, block in enumerate(blocks):
            for i, node in enumerate(frontier):
                cut = (slice(first, first + len(block)), slice(i * cells, (i + 1) * cells))
                if counts[cut].any():
                    out.append((node, b, group, gradients[cut].ravel(), counts[cut].ravel()))
            first += len(block)
        if out:
            leaf, block, part, *arrays = zip(*out)
            ends = np.cumsum([0, *(len(a) for a in arrays[0])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in (leaf, block, part)),
                 *(pa.ListArray.from_arrays(ends, np.concatenate(a)) for a in arrays)],
                names=["leaf", "block", "part", "gradient", "rows"])

    def added(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_rows_of(group.column(c).combine_chunks(), len(blocks[group.column("block")[0].as_py()]) * cells).sum(axis=0)
                     for c in ("gradient", "rows"))

    def merge(group: pa.Table) -> pa.Table:
        gradient, counts = added(group)
        return pa.table([group.column("leaf")[:1], group.column("block")[:1], pa.array([0], pa.int32()),
                         pa.array([gradient], pa.list_(pa.float64())), pa.array([counts], pa.list_(pa.float64()))],
                        names=["leaf", "block", "part", "gradient", "rows"])

    def best(group: pa.Table) -> pa.Table:
        leaf, block = group.column("leaf")[0].as_py(), group.column("block")[0].as_py()
        gradient, counts = (x.reshape(-1, cells) for x in added(group))
        g, n = gradient[0].sum(), counts[0].sum()
        left_g, left_n = gradient.cumsum(axis=1), counts.cumsum(axis=1)
        gain = _score(left_g, left_n, s) + _score(g - left_g, n - left_n, s) - _score(g, n, s)
        gain[(left_n < max(s.least_rows, 1)) | (n - left_n < max(s.least_rows, 1))] = -np.inf
        at = int(np.argmax(np.round(gain, 9)))  # of equal gains the first column and bin
        i, b = divmod(at, cells)
        return pa.table({"leaf": [leaf], "gain": [float(gain[i, b])], "column": [blocks[block][i]], "bin": [b],
                         "left_g": [left_g[i, b]], "left_n": [left_n[i, b]], "g": [g], "n": [n]})

    parts = rows.mapInArrow(run, parts_schema)
    if reader.tasks > FAN_IN:
        parts = parts.groupBy("leaf", "block", "part").applyInArrow(merge, parts_schema)
    found = parts.groupBy("leaf", "block").applyInArrow(
        best, "leaf long, gain double, column long, bin long, left_g double, left_n double, g double, n double").collect()
    cuts: dict[int, tuple] = {}
    for r in sorted(found, key=lambda r: (r["leaf"], -round(r["gain"], 9), r["column"])):
        cuts.setdefault(r["leaf"], tuple(r)[1:])
    return cuts


def _grow(rows: DataFrame, reader: _Rows, columns: list[int], edges: list[np.ndarray]) -> Tree:
    """One tree: all levels are measured, then cuts are taken by gain. Runs a Spark job for each level."""
    s = reader.settings

    full = Tree()
    full.add(0.0, 0.0)
    gains: dict[int, float] = {}
    frontier = [0]
    for level in range(s.depth):
        cuts = _cuts(rows, reader, full, frontier, columns)
        if level == 0 and 0 in cuts:
            full.value[0], full.rows[0] = _value(*cuts[0][5:], s), cuts[0][6]
        below = []
        for node in frontier:
            gain, column, b, left_g, left_n, g, n = cuts.get(node, (-np.inf,) * 7)
            if not gain > 1e-9:
                continue
            gains[node] = gain
            full.column[node], full.bin[node], full.threshold[node] = int(column), int(b), float(edges[int(column)][int(b)])
            full.left[node] = full.add(_value(left_g, left_n, s), left_n)
            full.right[node] = full.add(_value(g - left_g, n - left_n, s), n - left_n)
            below += [full.left[node], full.right[node]]
        if not below:
            break
        frontier = below

    return _best_first(full, gains, s.leaves)


def _with_medians(rows: DataFrame, reader: _Rows, tree: Tree) -> None:
    """Leaf values by the exact median of the residuals of each leaf's sampled rows. Runs Spark jobs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, label, now = reader.read(batch)
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaf_of(bins, True), pa.int64()), pa.array(label - now)],
                                             names=["leaf", "residual"])

    residuals = rows.mapInArrow(run, "leaf long, residual double")
    for r in quantiles(residuals, ["leaf"], "residual", [0.5], ["median"]).collect():  # a row for each leaf
        tree.value[r["leaf"]] = r["median"] * reader.settings.rate


def _chosen(width: int, s: Settings) -> Iterator[list[int]]:
    """The columns of each tree."""
    rng = np.random.default_rng(s.seed)
    wanted = max(1, round(s.column_share * width))
    for _ in range(s.rounds):
        yield sorted(rng.choice(width, wanted, replace=False).tolist())


def boost(df: DataFrame, columns: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> Ensemble:
    """Fit an ensemble. Runs Spark jobs: one for each level of each tree, and the medians for absolute error; for a
    table of few cells one for all trees.

    ``key`` decides by its hash which rows a tree samples. Rows without a label are left out; null, NaN
    and infinite features count as 0. A table without rows cannot be fitted.
    """
    columns = list(columns)
    ship_package(df.sparkSession)
    middle = df.agg(F.avg(label)).first()[0] if settings.loss == "squared" else \
        quantiles(df, [], label, [0.5], ["m"]).first()["m"]
    if middle is None:
        raise ValueError("there are no labelled rows")
    edges = bin_edges(df.where(F.col(label).isNotNull()), columns)
    rows = cut_lineage(binned(df, columns, label, key, edges, float(middle)))
    total = rows.count()
    if total * len(columns) <= ONE_TASK_CELLS:
        return Ensemble(columns, float(middle), _boosted_in_one_task(rows, total, edges, settings))
    tasks = rows.rdd.getNumPartitions()
    trees: list[Tree] = []
    stored = 0
    for number, chosen in enumerate(_chosen(len(columns), settings)):
        reader = _Rows(len(columns), trees[stored:], settings, number, tasks)
        tree = _grow(rows, reader, chosen, edges)
        if settings.loss == "absolute":
            _with_medians(rows, reader, tree)
        tree.expect()
        trees.append(tree)
        if len(trees) - stored == TREES_PER_COPY:
            rows = cut_lineage(_advanced(rows, _Rows(len(columns), trees[stored:], settings, number, tasks)))
            tasks = rows.rdd.getNumPartitions()
            stored = len(trees)
    return Ensemble(columns, float(middle), trees)


def _advanced(rows: DataFrame, reader: _Rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(3, "prediction", pa.array(reader.read(batch, sampled=False)[2]))

    return rows.mapInArrow(run, _STATE)


# Growing in one task

class Held:
    """The bins of all rows in one task, a column after the other, and trees over them.

    The wide columns come first, then those with at most two bins: of these only the rows of the upper bin are
    added up.
    """

    def __init__(self, edges: list[np.ndarray], rows: int, cells: np.ndarray | None = None):
        self.edges = edges
        few = np.array([len(e) < 2 for e in edges], dtype=bool)
        self.order = np.concatenate([np.flatnonzero(~few), np.flatnonzero(few)])
        self.place = np.argsort(self.order)
        self.wide = int((~few).sum())
        self.cells = np.empty((len(edges), rows), dtype=np.uint8) if cells is None else cells
        self.rows = 0

    def add(self, columns: np.ndarray) -> slice:
        """Take the bins of more rows in, a column after the other; the rows' places."""
        at = slice(self.rows, self.rows + columns.shape[1])
        self.cells[:, at] = columns[self.order]
        self.rows = at.stop
        return at

    def grow(self, columns: Sequence[int], at: np.ndarray, g: np.ndarray, n: np.ndarray | None, s: Settings) -> Tree:
        """The tree of the rows ``at`` with gradients ``g`` and weights ``n`` (1 each by default)."""
        return _Growth(self, columns, g, n, s).tree(at)

    def leaf_of(self, tree: Tree) -> np.ndarray:
        """The leaf of every row."""
        found = np.zeros(self.rows, dtype=np.int32)
        parts = [(0, np.arange(self.rows))]
        while parts:
            node, at = parts.pop()
            if tree.column[node] < 0:
                found[at] = node
            elif len(at):
                low = self.cells[self.place[tree.column[node]]][at] <= tree.bin[node]
                parts += [(tree.left[node], at[low]), (tree.right[node], at[~low])]
        return found


class _Growth:
    """One tree over held rows: depth first, so only the histograms of a path are kept."""

    def __init__(self, held: Held, columns: Sequence[int], g: np.ndarray, n: np.ndarray | None, s: Settings):
        self.held, self.g, self.n, self.s = held, g, n, s
        places = np.sort(held.place[list(columns)])
        self.many, self.two = places[places < held.wide], places[places >= held.wide]
        self.named = held.order[np.concatenate([self.many, self.two])]
        self.full, self.gains, self.least = Tree(), {}, max(s.least_rows, 1)

    def tree(self, at: np.ndarray) -> Tree:
        g = float(self.g[at].sum())
        n = float(len(at) if self.n is None else self.n[at].sum())
        self.full.add(_value(g, n, self.s), n)
        if self._may_split(n, 0):
            self._visit(0, 0, at, g, n, self._sums(at))
        return _best_first(self.full, self.gains, self.s.leaves)

    def _may_split(self, n: float, level: int) -> bool:
        return level < self.s.depth and n >= 2 * self.least

    def _sums(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gradients and rows by (wide column, bin), and of the upper bins of the others."""
        cells, bins, k = self.held.cells, BINS + 1, len(self.many)
        g_of, n_of = np.zeros((k, bins)), np.zeros((k, bins))
        upper = np.zeros((len(self.two), 2))
        for first in range(0, len(at), GATHERED):
            rows = at[first:first + GATHERED]
            g = self.g[rows]
            n = None if self.n is None else self.n[rows]
            if len(rows) <= FEW and k:
                flat = (cells[self.many[:, None], rows] + np.arange(k, dtype=np.int64)[:, None] * bins).ravel()
                g_of += np.bincount(flat, np.tile(g, k), k * bins).reshape(k, bins)
                n_of += np.bincount(flat, None if n is None else np.tile(n, k), k * bins).reshape(k, bins)
            else:
                for i, c in enumerate(self.many):
                    found = cells[c][rows].astype(np.int64)
                    g_of[i] += np.bincount(found, g, bins)
                    n_of[i] += np.bincount(found, n, bins)
            if len(self.two):
                both = np.column_stack([g, np.ones(len(rows)) if n is None else n])
                upper += (cells[self.two[:, None], rows] > 0).astype(np.float64) @ both
        return g_of, n_of, upper

    def _best(self, g: float, n: float, sums: tuple[np.ndarray, ...]) -> tuple[float, int, int, float, float] | None:
        """(gain, column, bin, left gradient, left rows) of the best cut; of equal gains the first column and bin."""
        g_of, n_of, upper = sums
        left = n_of.cumsum(axis=1)
        wide = np.flatnonzero((left >= self.least) & (left <= n - self.least) & (n_of > 0))  # an empty bin cuts as the one before
        two = np.flatnonzero((upper[:, 1] >= self.least) & (upper[:, 1] <= n - self.least))
        if not len(wide) + len(two):
            return None
        row, b = np.divmod(wide, left.shape[1])
        left_g = np.concatenate([g_of.cumsum(axis=1).ravel()[wide], g - upper[two, 0]])
        left_n = np.concatenate([left.ravel()[wide], n - upper[two, 1]])
        column = self.named[np.concatenate([row, two + len(self.many)])]
        b = np.concatenate([b, np.zeros(len(two), dtype=np.int64)])
        gain = _score(left_g, left_n, self.s) + _score(g - left_g, n - left_n, self.s) - _score(g, n, self.s)
        near = np.flatnonzero(gain >= gain.max() - 1e-9)
        i = min(near.tolist(), key=lambda i: (-round(float(gain[i]), 9), column[i], b[i]))
        return float(gain[i]), int(column[i]), int(b[i]), float(left_g[i]), float(left_n[i])

    def _visit(self, node: int, level: int, at: np.ndarray, g: float, n: float, sums: tuple[np.ndarray, ...]) -> None:
        found = self._best(g, n, sums)
        if found is None or not found[0] > 1e-9:
            return
        full, s = self.full, self.s
        self.gains[node], c, b, left_g, left_n = found
        full.column[node], full.bin[node], full.threshold[node] = c, b, float(self.held.edges[c][b])
        full.left[node] = full.add(_value(left_g, left_n, s), left_n)
        full.right[node] = full.add(_value(g - left_g, n - left_n, s), n - left_n)
        low = self.held.cells[self.held.place[c]][at] <= b
        small, large = sorted(((full.left[node], at[low], left_g, left_n), (full.right[node], at[~low], g - left_g, n - left_n)),
                              key=lambda half: len(half[1]))
        wanted = [self._may_split(half[3], level + 1) for half in (small, large)]
        if not any(wanted):
            return
        part = self._sums(small[1])
        if wanted[1]:
            for whole, less in zip(sums, part):
                whole -= less
        for (child, rows, child_g, child_n), own, split in zip((small, large), (part, sums), wanted):
            if split:
                self._visit(child, level + 1, rows, child_g, child_n, own)


def _boosted_in_one_task(rows: DataFrame, total: int, edges: list[np.ndarray], s: Settings) -> list[Tree]:
    """All trees, grown one after the other by a task that holds the rows. One Spark job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(edges, total)
        draw, label, now = np.empty(total), np.empty(total), np.empty(total)
        for batch in batches:
            at = held.add(np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(-1, len(edges)).T)
            for into, name in ((draw, "draw"), (label, "label"), (now, "prediction")):
                into[at] = batch.column(name).to_numpy(zero_copy_only=False)
        for number, chosen in enumerate(_chosen(len(edges), s)):
            mine = np.flatnonzero((draw + number * _GOLDEN) % 1.0 < s.row_share) if s.row_share < 1 else np.arange(total)
            tree = held.grow(chosen, mine, now - label if s.loss == "squared" else np.sign(now - label), None, s)
            leaf = held.leaf_of(tree)
            if s.loss == "absolute":
                sampled, residual = leaf[mine], (label - now)[mine]
                for node in np.unique(sampled).tolist():
                    tree.value[node] = float(np.median(residual[sampled == node])) * s.rate
            tree.expect()
            now += np.array(tree.value)[leaf]
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([pickle.dumps(tree)], pa.binary())], names=["number", "tree"])

    found = rows.coalesce(1).mapInArrow(run, "number long, tree binary").collect()  # the model's nodes
    return [pickle.loads(r.tree) for r in sorted(found, key=lambda r: r.number)]
