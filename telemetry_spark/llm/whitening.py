"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Spark computes the sums and the centred scatter of the distinct vectors (partial matrices in tasks,
added by key); what reaches the driver is one matrix of width x width.  There the scatter is
factored as G G^T with G = P L (pivoted Cholesky), and one-sided Jacobi rotates the columns of the
factor itself until they are orthogonal: the scatter is never squared, the columns' norms are the
square roots of the eigenvalues and the normalised columns the components.  A second pass over the
distinct vectors measures the covariance of what was whitened; a last one projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import materialise, quoted, ship_package, table
from telemetry_spark.llm.vectors import finite, matrix

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40     # a batch of entries from here on could not be added in 64 bits
EPS = np.finfo(float).eps


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """G with G G^T = scatter (positive semidefinite), one column for each pivot above rounding."""
    rest = scatter.astype(float).copy()
    n = len(rest)
    least = n * EPS * max(rest.diagonal().max(initial=0.0), 0.0)
    columns = []
    for _ in range(n):
        at = int(rest.diagonal().argmax())
        if rest[at, at] <= least:
            break
        column = rest[:, at] / np.sqrt(rest[at, at])
        columns.append(column)
        rest -= np.outer(column, column)
        rest[at, :] = rest[:, at] = 0.0      # done with this pivot
    return np.array(columns).T if columns else np.zeros((n, 0))


def jacobi_columns(factor: np.ndarray, rounds: int = 60) -> np.ndarray:
    """The factor's columns rotated until all pairs are orthogonal to rounding, largest first."""
    g = factor.astype(float).copy()
    k = g.shape[1]
    for _ in range(rounds):
        turned = False
        for i in range(k - 1):
            for j in range(i + 1, k):
                a, b, c = g[:, i] @ g[:, i], g[:, j] @ g[:, j], g[:, i] @ g[:, j]
                if abs(c) <= EPS * np.sqrt(a * b):
                    continue
                turned = True
                tau = (b - a) / (2 * c)
                t = (1.0 if tau >= 0 else -1.0) / (abs(tau) + np.hypot(1.0, tau))
                cos = 1 / np.hypot(1.0, t)
                g[:, i], g[:, j] = cos * (g[:, i] - t * g[:, j]), cos * (t * g[:, i] + g[:, j])
        if not turned:
            break
    return g[:, np.argsort(-(g * g).sum(axis=0), kind="stable")]


class Whitening:
    """``mean`` as whole part and remainder, ``axes`` (components by width) and their eigenvalues."""

    def __init__(self, n: int, sums: list[int], scatter: np.ndarray, components: int):
        self.n, self.sums = n, sums
        self.whole = [round(Fraction(s, n)) for s in sums]
        self.rest = np.array([float(Fraction(s, n) - w) for s, w in zip(sums, self.whole)])
        columns = jacobi_columns(pivoted_cholesky(scatter / n))
        values = (columns * columns).sum(axis=0)
        kept = min(components, int((values > len(sums) * EPS * values.max(initial=0.0)).sum()))     # above rounding
        self.eigenvalues = values[:kept]
        self.axes = (columns[:, :kept] / np.sqrt(self.eigenvalues)).T
        self.trace = float(np.trace(scatter / n))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole numbers first, so that nothing is lost to the size of x."""
        return (x - np.array(self.whole, np.int64)).astype(float) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.axes / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null where a long cannot hold one."""
        from_whole = x - np.array(self.whole, np.int64)
        most = x.shape[1] * (self.n * (int(np.abs(from_whole).max(initial=0)) + 1)) ** 2
        kind = np.int64 if most < 2 ** 62 else object
        left = np.array([s - self.n * w for s, w in zip(self.sums, self.whole)], kind)
        apart = from_whole.astype(kind) * self.n - left
        return [int(v) if v < 2 ** 63 else None for v in (apart * apart).sum(axis=1)]


def _summed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = matrix(batch.column(0), width, np.int64).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["i", "s"])

    return run


def _products(points, size: int):
    """Per task: the sum of the points' products with themselves (upper half) and, at j = -1, of the points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            p = points(batch)
            total += p.T @ p
            plain += p.sum(axis=0)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([i, np.arange(size)]), pa.int32()), pa.array(np.concatenate([j, np.full(size, -1)]), pa.int32()),
            pa.array(np.concatenate([total[i, j], plain]))], names=["i", "j", "v"])

    return run


def _added(frame: DataFrame, points, size: int) -> tuple[np.ndarray, np.ndarray]:
    rows = frame.mapInArrow(_products(points, size), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    products, plain = np.zeros((size, size)), np.zeros(size)
    for r in rows:
        if r["j"] < 0:
            plain[r["i"]] = r["v"]
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = r["v"]
    return products, plain


def _rows_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.expr(finite("v", LARGEST))).select(
        "id", F.expr(f"transform(v, c -> cast(floor({SCALE} * c) as bigint) + {SHIFT})").alias("x"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), up to ``components`` rows a vector.

    Dropped are rows whose vector is null or holds a null or non-finite entry.  The fit is over
    each distinct vector of whole numbers once, so copies do not weigh.  Defined results: a null id
    gives its rows with that null id; repeated rows are repeated; vectors of another length than the
    commonest (ties: the longest) have no common space with it and give no rows, like those without
    entries; there are as many components as the covariance has rank (equal vectors only: none, no
    rows); an entry of 2^40 or more cannot be scaled and added in longs and counts as non-finite; a deviation
    that no long holds is null; an empty table gives no rows; columns but the two are not read.

    The driver holds a matrix of width x width.  Deviations and sums are exact; the scatter is
    added in double precision after centring."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows, _ = materialise(_rows_of(vectors, id_col, vector_col), "whole-vectors")
    common = rows.groupBy(F.size("x").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    out = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = common["w"] if common else 0
    if not width:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("x") == width)
    fit, seen = materialise(rows.select("x").distinct(), "fit-vectors", {"n": F.count(F.lit(1))})
    n = seen["n"]
    sums = {r["i"]: int(r["s"]) for r in fit.mapInArrow(_summed(width), "i int, s long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    sums = [sums[i] for i in range(width)]
    whole = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = np.array([float(Fraction(s, n) - int(w)) for s, w in zip(sums, whole)])
    scatter, _ = _added(fit, lambda b: (matrix(b.column(0), width, np.int64) - whole).astype(float) - rest, width)
    model = Whitening(n, sums, scatter, components)
    kept = len(model.eigenvalues)
    if not kept:
        return spark.createDataFrame([], out)
    products, plain = _added(fit, lambda b: model.whitened(matrix(b.column(0), width, np.int64)), kept)
    error = float(np.abs(products / n - np.outer(plain / n, plain / n) - np.eye(kept)).max())
    explained = model.eigenvalues / model.trace

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width, np.int64)
            m = len(x)
            deviation = pa.array(model.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(m), kept))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, kept + 1), m), pa.int32()),
                pa.array(np.full(m * kept, n), pa.int64()), deviation.take(each), pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(projected, out)


def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
