"""Means and cross products of many columns, for each fold, from one scan.

Least squares, ridge, lasso, their cross-validation and variance inflation all need nothing else of the
rows. Each task keeps one centred matrix for every fold (as many cells as columns squared, whatever the
rows are); tasks' matrices are cut into blocks of rows and merged in two steps of Spark groups. Parts are
centred on their own means and merged by the exact formula for means that differ, so nothing cancels.
A training set without one fold is the whole less that fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import finite_or_zero
from basketry.session import ship_package

# Rows of a matrix that travel together, and tasks whose matrices are merged in the first step.
BLOCK = 32
FAN_IN = 64
_PART = "fold int, block int, part int, n double, mean array<double>, cells array<double>"


@dataclass(frozen=True)
class Moments:
    """Rows, column means and centred cross products."""

    columns: tuple[str, ...]
    n: float
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        return Moments(self.columns, n, self.mean + apart * (other.n / n),
                       self.cross + other.cross + np.outer(apart, apart) * (self.n * other.n / n))

    def __sub__(self, part: Moments) -> Moments:
        """The rows that are not in ``part``, which must be among these."""
        n = self.n - part.n
        if not part.n or n <= 0:
            return self if not part.n else Moments(self.columns, 0.0, np.zeros_like(self.mean), np.zeros_like(self.cross))
        mean = (self.n * self.mean - part.n * part.mean) / n
        apart = part.mean - mean
        return Moments(self.columns, n, mean, self.cross - part.cross - np.outer(apart, apart) * (n * part.n / self.n))

    def of(self, columns: Sequence[str]) -> Moments:
        at = [self.columns.index(c) for c in columns]
        return Moments(tuple(columns), self.n, self.mean[at], self.cross[np.ix_(at, at)])

    def correlations(self) -> np.ndarray:
        """Correlation matrix; columns that do not vary correlate with nothing but themselves."""
        spread = np.sqrt(np.diag(self.cross).clip(min=0))
        with np.errstate(divide="ignore", invalid="ignore"):
            found = np.nan_to_num(self.cross / np.outer(spread, spread), nan=0.0, posinf=0.0, neginf=0.0)
        np.fill_diagonal(found, 1.0)
        return found.clip(-1.0, 1.0)


def _merged(n: np.ndarray, means: np.ndarray, cells: np.ndarray, first: int) -> tuple[float, np.ndarray, np.ndarray]:
    """One block of rows (from row ``first``) of the matrices of several parts, as that of all their rows."""
    total = n.sum()
    mean = n @ means / total
    apart = means - mean
    rows = slice(first, first + cells.shape[1])
    return total, mean, cells.sum(axis=0) + np.einsum("k,ki,kj->ij", n, apart[:, rows], apart)


def _numbers(columns: Sequence[str]) -> list[Column]:
    """The bare numbers: ``finite_matrix`` clears them, as a check for each column makes a row's code too long to compile."""
    return [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]


def finite_matrix(columns: Sequence[pa.Array]) -> np.ndarray:
    """The columns of a batch side by side; null, NaN and infinities count as 0."""
    values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
    return np.nan_to_num(values, copy=False, nan=0.0, posinf=0.0, neginf=0.0)


def moments(df: DataFrame, columns: Sequence[str], fold: Column | None = None) -> dict[int, Moments]:
    """Moments of the columns for each fold number; without folds all rows are fold 0. Runs a Spark job.

    Null, NaN and infinities count as 0; rows without a fold are left out. What reaches the driver is a
    matrix for each fold. No rows give no folds.
    """
    columns = list(columns)
    ship_package(df.sparkSession)
    width = len(columns)
    rows = df.select((F.lit(0) if fold is None else fold).cast("int").alias("__fold"),
                     *_numbers(columns)).where("__fold IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            values = finite_matrix(batch.columns[1:])
            for f in np.unique(folds).tolist():
                part = values[folds == f]
                mean = part.mean(axis=0)
                centred = part - mean
                found = Moments((), float(len(part)), mean, centred.T @ centred)
                held[f] = held[f] + found if f in held else found
        group = TaskContext.get().partitionId() // FAN_IN
        out = [(f, first // BLOCK, group, m.n, m.mean, m.cross[first:first + BLOCK].ravel())
               for f, m in held.items() for first in range(0, width, BLOCK)]
        if out:
            yield _table(out).to_batches()[0]

    def _table(out: list[tuple]) -> pa.Table:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        names=["fold", "block", "part", "n", "mean", "cells"])

    def merge(group: pa.Table) -> pa.Table:
        first = group.column("block")[0].as_py() * BLOCK
        means = np.array(group.column("mean").to_pylist())
        cells = np.array(group.column("cells").to_pylist()).reshape(len(means), -1, width)
        n, mean, block = _merged(group.column("n").to_numpy(), means, cells, first)
        return _table([(group.column("fold")[0].as_py(), first // BLOCK, 0, n, mean, block.ravel())])

    parts = rows.mapInArrow(run, _PART)
    for keys in (["fold", "block", "part"], ["fold", "block"]):
        parts = parts.groupBy(*keys).applyInArrow(merge, _PART)
    blocks: dict[int, list] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["fold"], r["block"])):  # a matrix for each fold
        blocks.setdefault(r["fold"], []).append(r)
    return {f: Moments(tuple(columns), bs[0]["n"], np.array(bs[0]["mean"]),
                       np.vstack([np.array(b["cells"]).reshape(-1, width) for b in bs]))
            for f, bs in blocks.items()}


def total(parts: dict[int, Moments]) -> Moments:
    """All folds together."""
    found = None
    for part in parts.values():
        found = part if found is None else found + part
    if found is None:
        raise ValueError("there are no rows")
    return found


# Linear models

@dataclass(frozen=True)
class Line:
    """A fitted linear model."""

    columns: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        """The model as a column expression; features as in ``moments``. A sum of halves keeps it shallow."""
        terms = [finite_or_zero(c) * F.lit(float(w)) for c, w in zip(self.columns, self.coefficients) if w]
        terms.append(F.lit(float(self.intercept)))
        while len(terms) > 1:
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        return terms[0]


def _parts(m: Moments, label: str) -> tuple[tuple[str, ...], np.ndarray, np.ndarray]:
    names = tuple(c for c in m.columns if c != label)
    both = m.of([*names, label])
    return names, both.cross[:-1, :-1], both.cross[:-1, -1]


def _line(m: Moments, label: str, names: tuple[str, ...], weights: np.ndarray) -> Line:
    means = m.of([*names, label]).mean
    return Line(names, weights, float(means[-1] - means[:-1] @ weights))


def least_squares(m: Moments, label: str) -> Line:
    """Ordinary least squares; of the solutions for dependent columns the shortest."""
    names, xx, xy = _parts(m, label)
    scale = np.sqrt(np.diag(xx).clip(min=0))
    scale[scale == 0] = 1.0  # a column that does not vary gets the weight 0
    weights = np.linalg.pinv(xx / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (xy / scale) / scale
    return _line(m, label, names, weights)


def ridge(m: Moments, label: str, alpha: float = 1.0) -> Line:
    """Squared penalty alpha on the summed loss, by Cholesky; the intercept is free."""
    if alpha <= 0:
        raise ValueError("alpha must be positive")
    names, xx, xy = _parts(m, label)
    lower = np.linalg.cholesky(xx + alpha * np.eye(len(names)))
    return _line(m, label, names, np.linalg.solve(lower.T, np.linalg.solve(lower, xy)))


def lasso(m: Moments, label: str, alpha: float = 0.1, tolerance: float = 1e-10, rounds: int = 100_000) -> Line:
    """Absolute penalty alpha on half the mean squared loss, by coordinate descent on the moments."""
    names, xx, xy = _parts(m, label)
    if not m.n:
        raise ValueError("there are no rows")
    xx, xy = xx / m.n, xy / m.n
    weights, slope = np.zeros(len(names)), xy.copy()  # slope: the loss falls by it along each weight
    for _ in range(rounds):
        most = 0.0
        for j in np.flatnonzero(np.diag(xx) > 0):
            pull = slope[j] + xx[j, j] * weights[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / xx[j, j]
            if new != weights[j]:
                slope -= xx[:, j] * (new - weights[j])
                most = max(most, abs(new - weights[j]) * np.sqrt(xx[j, j]))
                weights[j] = new
        if most <= tolerance:
            return _line(m, label, names, weights)
    raise ArithmeticError(f"no convergence to {tolerance} in {rounds} rounds")


SOLVERS = {"linear": least_squares, "ridge": ridge, "lasso": lasso}


def fold_errors(df: DataFrame, label: str, fold: Column, lines: dict[tuple[str, int], Line]) -> DataFrame:
    """(model, fold, n, mae): mean absolute error of each fold's rows under the models kept for that fold.

    One scan: a task multiplies its rows with the weights of all models of their fold. A null label is
    left out.
    """
    names = list(next(iter(lines.values())).columns)
    weights = {key: (np.array(line.coefficients), line.intercept) for key, line in lines.items()}
    ship_package(df.sparkSession)
    rows = df.select(fold.cast("int").alias("__fold"), F.col(label).cast("double").alias("__label"),
                     *_numbers(names)).where(
        "__fold IS NOT NULL AND __label IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors: dict[tuple[str, int], list[float]] = {}
        for batch in batches:
            folds, truth = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            values = finite_matrix(batch.columns[2:])
            for (model, f), (w, intercept) in weights.items():
                mine = folds == f
                if mine.any():
                    cell = errors.setdefault((model, f), [0, 0.0])
                    cell[0] += int(mine.sum())
                    cell[1] += float(np.abs(truth[mine] - values[mine] @ w - intercept).sum())
        if errors:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m for m, _ in errors]), pa.array([f for _, f in errors], pa.int32()),
                 pa.array([n for n, _ in errors.values()], pa.int64()), pa.array([e for _, e in errors.values()])],
                names=["model", "fold", "n", "error"])

    parts = rows.mapInArrow(run, "model string, fold int, n long, error double")
    return parts.groupBy("model", "fold").agg(F.sum("n").alias("n"), (F.sum("error") / F.sum("n")).alias("mae"))


def cross_validated(df: DataFrame, columns: Sequence[str], label: str, fold: Column,
                    solvers: dict | None = None) -> DataFrame:
    """(model, folds, mae_mean, mae_std): error of each model over the folds, population deviation. Runs a Spark job.

    One scan for the moments of all folds, one for the errors of all models. Every model of a fold is
    fitted on the whole less that fold. Rows without a label are left out.
    """
    df = df.where(F.col(label).isNotNull())
    parts = moments(df, [*columns, label], fold)
    whole = total(parts)
    if len(parts) < 2:
        raise ValueError("there is only one fold with rows")
    lines = {(name, f): solve(whole - part, label) for f, part in parts.items()
             for name, solve in (solvers or SOLVERS).items()}
    return fold_errors(df, label, fold, lines).groupBy("model").agg(
        F.count("*").cast("int").alias("folds"), F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"))
