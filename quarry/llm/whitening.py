"""Embedding whitening by an incrementally updated eigendecomposition.

Vectors are scaled and rounded down to integers; each distinct one counts once
(the fit list).  A task goes through its part of the list and holds the
eigenvalues and eigenvectors of the scatter around the mean so far.  A vector
adds a rank-one term, centred on that mean: the new eigenvalues are the roots
of the secular equation, found after deflation (components that the term
hardly touches, and equal eigenvalues turned into one), and the eigenvectors
follow from Loewner's formula.  Spectra of tasks are combined in a tree, the
second one's eigenpairs and the difference of the means being added as rank-one
terms one after another.  At last a Rayleigh-Ritz step over the whole list, in
the basis so found and with the exact mean, gives the components to double
precision.

Scale: the list is made by a map-side combined distinct, so a vector that a
third of the rows repeat is one row a task; tasks give back one spectrum each
(dim x dim numbers); what reaches the driver are dim x dim sums, whatever the
number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, as are vectors of another size than the commonest (the smaller of
equally common ones); null ids and repeated rows stay, each with its rows; an
entry beyond the range of a long takes the nearest long; fewer components are
given if the vectors are shorter; along a component without variance
``whitened`` is null, ``explained`` is null if there is no variance at all, and
``identity_error`` is of the components that have variance (null without any);
``deviation`` is null where it does not fit a long; an empty table, or one
without a usable vector, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.grouped import each_group
from quarry.session import store

SCALE = 256
COMPONENTS = 4
#: Vectors of the fit list that a task takes, and spectra that one combines.
TASK_ROWS, FAN_IN = 8192, 8
#: Most tasks of a pass; beyond it they take more vectors each.
MOST_TASKS = 1 << 16
EPS = np.finfo(float).eps
#: Steps of a root stop at this relative change, or at this number.
STOP, MOST_STEPS = 1e-13, 60
#: An eigenvalue below this share of the trace is rounding, not variance.
NO_VARIANCE = 1e-13


# ---------------------------------------------------------------- spectra

def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """Row j: ``d - root_j`` for the roots of 1 + sum(z2 / (d - x)) = 0, with
    ``d`` ascending and ``z2`` positive.  Each root is sought as its distance
    from the nearer of the two poles around it.  A step replaces the terms of
    the poles on each side by one term at the nearest pole with the same value
    and slope, and solves that; a step that leaves the bracket halves it."""
    m = len(d)
    gap = np.append(np.diff(d), z2.sum())
    rows = np.arange(m)
    differences = d[None, :] - d[:, None]
    middle = 1 + (z2 / (differences - gap[:, None] / 2)).sum(1)
    near = rows + ((middle < 0) & (rows < m - 1))
    delta = differences[near]
    left = near == rows
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, np.where(rows == m - 1, gap, gap / 2), 0.0)
    at_left = delta[rows, rows]
    at_right = np.append(delta[rows[:-1], rows[1:]], np.inf)
    lower = np.tri(m)
    x = (low + high) / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(MOST_STEPS):
            away = delta - x[:, None]
            part = z2 / away
            f = 1 + part.sum(1)
            part /= away
            slope, slope_left = part.sum(1), (part * lower).sum(1)
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            one, two = at_left - x, at_right - x
            c = f - one * slope_left - np.where(rows < m - 1, two, 0) * (slope - slope_left)
            a = (one + two) * f - one * two * slope
            b = one * two * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = one[-1] * f[-1] / c[-1]
            to = x + step
            to = np.where((to >= low) & (to <= high) & (to != 0), to, (low + high) / 2)
            moved, x = np.abs(to - x), to
            if (moved <= STOP * np.abs(x)).all():
                break
    return delta - x[:, None]


def add_rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of
    ``basis diag(values) basis' + weight v v'``."""
    z = basis.T @ v
    size = weight * float(z @ z)
    if not size > 0:
        return values, basis
    tolerance = 8 * EPS * max(abs(values[0]), abs(values[-1]), size)
    w = z * math.sqrt(weight)
    keep = np.abs(w) * math.sqrt(size) > tolerance
    values, basis = values.copy(), basis.copy()
    at = np.flatnonzero(keep)
    if len(at) > 1:
        a, b = w[at[:-1]], w[at[1:]]
        if (np.diff(values[at]) * np.abs(a * b) <= tolerance * (a * a + b * b)).any():
            i = at[0]
            for j in at[1:]:
                r2 = w[i] ** 2 + w[j] ** 2
                if (values[j] - values[i]) * abs(w[i] * w[j]) <= tolerance * r2:  # equal: turn the pair
                    r = math.sqrt(r2)
                    c, s = w[j] / r, w[i] / r
                    basis[:, [i, j]] = np.stack([c * basis[:, i] - s * basis[:, j], s * basis[:, i] + c * basis[:, j]], 1)
                    values[i], values[j] = c * c * values[i] + s * s * values[j], s * s * values[i] + c * c * values[j]
                    w[i], w[j], keep[i] = 0.0, r, False
                i = j
    at = np.flatnonzero(keep)
    if len(at):
        d, part = values[at], w[at]
        order = np.argsort(d, kind="stable")
        at, d, part = at[order], d[order], part[order]
        away = secular_roots(d, part * part)  # [root, pole]
        poles = d[None, :] - d[:, None]
        np.fill_diagonal(poles, 1.0)
        # the vector whose roots these are exactly, so that eigenvectors stay orthogonal
        exact = np.sqrt(np.abs(np.prod(-away / poles.T, axis=0))) * np.sign(part)
        vectors = exact[:, None] / away.T
        vectors /= np.linalg.norm(vectors, axis=0)
        basis[:, at] = basis[:, at] @ vectors
        values[at] = d - np.diag(away)
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, mean, and eigenpairs of the scatter around the mean."""
    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.n += 1
        if self.n > 1:
            self.values, self.basis = add_rank_one(self.values, self.basis, away, (self.n - 1) / self.n)
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.basis = other.n, other.mean, other.values, other.basis
            return
        n = self.n + other.n
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = add_rank_one(self.values, self.basis, vector, float(value))
        away = other.mean - self.mean
        self.values, self.basis = add_rank_one(self.values, self.basis, away, self.n * other.n / n)
        self.mean, self.n = self.mean + away * (other.n / n), n

    def batch(self, part: int) -> pa.RecordBatch:
        held = [np.ascontiguousarray(a, "<f8").tobytes() for a in (self.mean, self.values, self.basis)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), *[pa.array([h], pa.binary()) for h in held]],
                                          ["part", "n", "mean", "eigenvalues", "basis"])


SPECTRUM = "part long, n long, mean binary, eigenvalues binary, basis binary"


def _spectra(rows, dim: int) -> Iterator[Spectrum]:
    for r in rows:
        mean, values, basis = (np.frombuffer(r[k], "<f8") for k in ("mean", "eigenvalues", "basis"))
        yield Spectrum(r["n"], mean, values, basis.reshape(dim, dim))


def spectrum(fit: DataFrame, dim: int) -> Spectrum:
    """The spectrum of all vectors ``x`` of the stored ``fit``."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = Spectrum.empty(dim)
        for batch in batches:
            for x in matrix(batch.column("x"), dim).astype(float):
                held.add(x)
        yield held.batch(TaskContext.get().partitionId())

    def combine(table: pa.Table) -> Iterator[pa.RecordBatch]:
        held = Spectrum.empty(dim)
        for other in _spectra(sorted(table.to_pylist(), key=lambda r: r["part"]), dim):
            held.merge(other)
        yield held.batch(table["up"][0].as_py())

    held = store(fit.select("x").mapInArrow(fold, SPECTRUM), "spectra")
    last = held.agg(F.max("part").alias("part")).first()["part"]
    while last:
        up = held.withColumn("up", F.floor(F.col("part") / FAN_IN))
        held, last = store(each_group(up, ["up"], SPECTRUM, combine), "spectra"), last // FAN_IN
    return next(_spectra(held.collect(), dim))  # one row


# ---------------------------------------------------------------- passes over rows

def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``x - S/n`` in double precision and the exact sums of (n*x - S)^2, by
    64-bit integers where they hold them, else by whole ones."""
    most = max(abs(int(x.min())), abs(int(x.max())), 1) if x.size else 1
    span = n * most + max(map(abs, sums))
    if span * span * len(sums) < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return away / n, (away * away).sum(1).tolist()
    rows = [[n * int(c) - s for c, s in zip(row, sums)] for row in x]
    squares = [sum(a * a for a in row) for row in rows]
    return np.array([[a / n for a in row] for row in rows]).reshape(x.shape), [q if q < 1 << 63 else None for q in squares]


def _sums(df: DataFrame, dim: int, width: int, of) -> np.ndarray:
    """Sum over all rows of ``of(x matrix)``, a vector of ``width`` numbers a
    task, by a combined aggregation on the place in the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of(matrix(batch.column("x"), dim))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], ["place", "value"])
    rows = df.select("x").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(width)
    for r in rows:  # width rows
        out[r["place"]] = r["value"]
    return out


@dataclass
class Whitening:
    n: int
    sums: list[int]            # exact, per dimension
    components: np.ndarray     # rows, by falling eigenvalue
    values: np.ndarray         # their eigenvalues
    trace: float
    identity_error: float | None


def usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))) & (F.size(vector) > 0), F.lit(False))


def scaled(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """``(id, x)`` of the rows that take part, and the size of their vectors."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dim = common[0]["size"] if common else 0
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))
    return rows.where(F.size("v") == dim).select("id", x.alias("x")), dim


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct ``x`` of ``rows``; None without rows."""
    listed = store(rows.select("x").distinct(), "whitening-list")
    total = listed.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(dim)]).first()
    n = total["n"]
    if not n:
        return None
    sums = [int(total[f"s{k}"]) for k in range(dim)]
    parts = min(-(-n // TASK_ROWS), MOST_TASKS)
    dealt = store(listed.repartition(parts), "whitening-dealt")
    basis, _ = np.linalg.qr(spectrum(dealt, dim).basis)
    upper = np.triu_indices(dim)

    def products(x):
        turned = centred(x, n, sums)[0] @ basis
        return (turned.T @ turned)[upper]
    ritz = np.zeros((dim, dim))
    ritz[upper] = _sums(dealt, dim, len(upper[0]), products) / n
    ritz = ritz + np.triu(ritz, 1).T
    values, turn = np.linalg.eigh(ritz)
    order = np.argsort(-values, kind="stable")[:components]
    found = (basis @ turn[:, order]).T
    found *= np.sign(found[np.arange(len(found)), np.abs(found).argmax(1)])[:, None]
    out = Whitening(n, sums, found, values[order], float(np.trace(ritz)), None)
    live = out.values > NO_VARIANCE * out.trace
    if live.any():
        m = int(live.sum())

        def moments(x):
            w = white(out, centred(x, n, sums)[0])[:, live]
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])
        got = _sums(dealt, dim, m + m * m, moments) / n
        mean, second = got[:m], got[m:].reshape(m, m)
        out.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(m)).max())
    return out


def white(model: Whitening, away: np.ndarray) -> np.ndarray:
    """Centred rows along the components, NaN where there is no variance."""
    live = model.values > NO_VARIANCE * model.trace
    return (away @ model.components.T) / np.sqrt(np.where(live, model.values, np.nan))


def apply(rows: DataFrame, model: Whitening, dim: int) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``:
    a row for each row of ``rows`` and component."""
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    k = len(model.values)
    share = [float(Fraction(float(max(v, 0.0))) / Fraction(model.trace)) if model.trace > 0 else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            away, squares = centred(matrix(batch.column("x"), dim), model.n, model.sums)
            w = white(model, away).ravel()
            place = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(place), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, model.n), pa.int64()), pa.array(squares, pa.int64()).take(place),
                pa.array(w, mask=np.isnan(w)), pa.array(share * m, pa.float64()),
                pa.array([model.identity_error] * (m * k), pa.float64())],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The rows of ``apply`` for a table of vectors fitted on itself."""
    rows, dim = scaled(df, id_col, vec_col)
    model = fit(rows, dim, components) if dim else None
    if model is None:
        model = Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, None)
        rows = rows.limit(0)
    return apply(rows, model, dim).withColumnRenamed("id", id_col)
