"""Whitening of embeddings from an exact covariance.

Every entry c of a vector becomes the whole number x = floor(64 * c) + 1000000.
The fit list is each distinct x vector once. Its sums, then its scatter centred at
the whole part of the mean, are added up as whole numbers by task and by Spark
(two parts per number, so nothing overflows); the remaining fraction of the mean
is taken off exactly at the end. So the covariance does not depend on the order
of rows or tasks. The driver sees dim * (dim + 1) / 2 numbers, however many rows
there are.

The factor L of the covariance V = L L' comes from a Cholesky decomposition with
diagonal pivots, and one-sided Jacobi rotations make the columns of L orthogonal:
their squared norms are the eigenvalues, the normalised columns the components.
V's own eigenvectors are never sought, so small eigenvalues keep their digits.

Rows whose vector is null or holds a null, NaN or infinite entry are dropped.
Vectors of different lengths do not share a space: each length is fitted on its
own. Repeated rows, ids and null ids are kept, each with its own result. A
direction without variance is no component: a fit list of one vector, or an empty
vector, gives no rows; an empty table gives an empty result. x stays within a long
(a larger entry counts as the end of its range); a deviation that does not fit its
type is null. Columns besides vec_id and embedding are ignored.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm.common import importable, materialise, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
ROWS = 4096  # rows multiplied at a time
_PART = 1 << 60  # a whole number travels as high * _PART + low
_SWEEPS = 60
_SUMS = "dim int, i int, j int, high decimal(28,0), low decimal(28,0)"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, x (array of longs) of the rows that take part."""
    finite = ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform("embedding", lambda c: F.least(F.floor(c.cast("double") * SCALE).cast("long"), F.lit((1 << 63) - 1 - SHIFT)) + F.lit(SHIFT))
    return embeddings.filter(F.col("embedding").isNotNull()).filter(finite).select("vec_id", whole.alias("x"))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of at most ``ROWS`` vectors of one length each."""
    if not len(column):
        return
    ends = np.asarray(column.offsets, np.int64)
    flat, sizes = np.asarray(column.values, np.int64), np.diff(ends)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        for a in range(0, len(rows), ROWS):
            part = rows[a:a + ROWS]
            yield part, flat[ends[part][:, None] + np.arange(dim)]


def _fits(largest: int, terms: int) -> bool:
    """Whether sums of ``terms`` products of numbers up to ``largest`` are exact in doubles."""
    return largest * largest * max(1, terms) < 1 << 53


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x minus ``middle``: longs where they cannot overflow, else Python integers."""
    if x.size and max(abs(int(x.max())), abs(int(x.min())), *map(abs, middle)) >= 1 << 61:
        return x.astype(object) - np.array(middle, object)
    return x - np.array(middle, np.int64)


def _largest(y: np.ndarray) -> int:
    return max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0


def products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers."""
    if _fits(_largest(y), len(y)):
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def _emit(sums: dict[int, np.ndarray], of_pairs: bool) -> Iterator[pa.RecordBatch]:
    for dim, total in sums.items():
        i, j = np.triu_indices(dim) if of_pairs else (np.arange(len(total)), np.zeros(len(total), int))
        values = [int(v) for v in (total[i, j] if of_pairs else total)]
        high = pa.array([decimal.Decimal(v // _PART) for v in values], pa.decimal128(28, 0))
        low = pa.array([decimal.Decimal(v % _PART) for v in values], pa.decimal128(28, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), dim), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), high, low], names=["dim", "i", "j", "high", "low"])


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length the sum of each entry; the number of vectors comes last."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in matrices(batch.column("x")):
            dim = x.shape[1]
            wide = _largest(x) * len(x) >= 1 << 63
            own = np.append((x.astype(object) if wide else x).sum(axis=0).astype(object), len(x))
            sums[dim] = sums.get(dim, 0) + own
    yield from _emit(sums, False)


def _scatter(middles: dict[int, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch.column("x")):
                dim = x.shape[1]
                sums[dim] = sums.get(dim, 0) + products(centred(x, middles[dim]))
        yield from _emit(sums, True)
    return run


def _added(parts: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """The whole numbers of all tasks added up, by length and place."""
    rows = parts.groupBy("dim", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    out: dict[int, dict[tuple[int, int], int]] = {}
    for r in rows:
        out.setdefault(r["dim"], {})[r["i"], r["j"]] = int(r["high"]) * _PART + int(r["low"])
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with L L' = v, a column for every direction that has variance. The
    pivot is the largest remaining diagonal; what rounding alone can have left
    of an entry's own variance counts as none."""
    n = len(v)
    rest = v.astype(np.float64).copy()
    left = np.diag(rest).copy()
    noise = n * np.finfo(np.float64).eps * left
    columns = []
    while n and (live := left > noise).any():
        p = int(np.argmax(np.where(live, left, -1)))
        column = rest[:, p] / np.sqrt(left[p])
        columns.append(column)
        rest -= np.outer(column, column)
        left = np.diag(rest).copy()
        rest[p], rest[:, p], left[p] = 0.0, 0.0, 0.0
    return np.array(columns).T if columns else np.zeros((n, 0))


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor factor', largest first.

    Rotations in the plane of two columns, all disjoint pairs of a round at once,
    until every two columns are orthogonal to working precision. The largest
    entry of a component is positive."""
    u = factor.copy()
    n = u.shape[1]
    order = list(range(n)) + [-1] * (n % 2)
    half = len(order) // 2
    for _ in range(_SWEEPS):
        worst = 0.0
        for _ in range(len(order) - 1):
            pairs = [(a, b) for a, b in zip(order[:half], reversed(order[half:])) if a >= 0 and b >= 0]
            order = [order[0], order[-1], *order[1:-1]]
            if not pairs:
                continue
            p, q = np.array(pairs).T
            x, y = u[:, p], u[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(a) * np.sqrt(b)
            apart = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            worst = max(worst, float(apart.max()))
            turn = apart > 1e-16
            zeta = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turn)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            sin = np.where(turn, cos * t, 0.0)
            u[:, p], u[:, q] = cos * x - sin * y, sin * x + cos * y
        if worst < 4e-16 * max(1, n):
            break
    norms = np.sqrt((u * u).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    by_size = by_size[norms[by_size] > 0]
    vectors = u[:, by_size] / norms[by_size]
    if vectors.shape[1]:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return norms[by_size] ** 2, vectors


@dataclass
class Whitening:
    """The fit of one vector length: ``n`` fit vectors with sums ``sums``; the
    kept components as columns, their variances, and each one's share of all."""

    n: int
    sums: list[int]
    middle: list[int]
    rest: list[int]  # sums - n * middle
    variances: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows."""
        y = centred(x, self.middle)
        deviations = (y.astype(np.float64) * self.n - np.array([float(r) for r in self.rest])) / self.n
        return deviations @ self.vectors / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sums) squared, exact."""
        y = centred(x, self.middle)
        if (_largest(y) * self.n + max(map(abs, self.rest), default=0)) ** 2 * max(1, len(self.rest)) < 1 << 63:
            z = y.astype(np.int64) * self.n - np.array(self.rest, np.int64)
        else:
            z = y.astype(object) * self.n - np.array(self.rest, object)
        return [int(s) for s in (z * z).sum(axis=1)] if z.size else [0] * len(x)


def decompose(n: int, sums: list[int], scatter: np.ndarray, components: int) -> Whitening:
    """A fit from n, the sums and the scatter about the whole part of the mean."""
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    offset = np.array(rest, object)
    exact = scatter * n - np.outer(offset, offset)  # n * n * V, whole numbers
    v = np.array([[float(decimal.Decimal(int(e)) / n / n) for e in row] for row in exact], np.float64).reshape(len(sums), len(sums))
    variances, vectors = one_sided_jacobi(pivoted_cholesky(v))
    trace = float(decimal.Decimal(int(sum(np.diag(exact)))) / n / n) if len(sums) else 0.0
    keep = slice(0, components)
    return Whitening(n, sums, middle, rest, variances[keep], vectors[:, keep], variances[keep] / trace if trace else variances[keep])


def _moments(models: dict[int, Whitening]):
    """Sums and products of whitened rows, per length (j = -1: the sums)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch.column("x")):
                w = models[x.shape[1]].scores(x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + np.vstack([w.T @ w, w.sum(0)])
        for dim, total in sums.items():
            k = total.shape[1]
            i, j = np.divmod(np.arange((k + 1) * k), max(1, k))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel(), pa.float64())], names=["dim", "i", "j", "v"])
    return run


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A ``Whitening`` for each vector length of ``rows`` (see ``usable``)."""
    importable(rows.sparkSession)
    listed = materialise(rows.select("x").distinct(), "fit-vectors")
    counted = _added(listed.mapInArrow(_column_sums, _SUMS))
    totals = {dim: [s for _, s in sorted(found.items())] for dim, found in counted.items()}
    middles = {dim: [s // t[-1] for s in t[:-1]] for dim, t in totals.items()}
    pairs = _added(listed.mapInArrow(_scatter(middles), _SUMS))
    models = {}
    for dim, (*sums, n) in totals.items():
        scatter = np.zeros((dim, dim), object)
        for (i, j), s in pairs.get(dim, {}).items():
            scatter[i, j] = scatter[j, i] = s
        models[dim] = decompose(n, sums, scatter, components)
    seen = listed.mapInArrow(_moments(models), "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    found = {dim: np.zeros((len(m.variances) + 1, len(m.variances))) for dim, m in models.items()}
    for r in seen:
        found[r["dim"]][r["i"], r["j"]] = r["v"]
    for dim, m in models.items():
        k = len(m.variances)
        means = found[dim][k] / m.n
        error = np.abs(found[dim][:k] / m.n - np.outer(means, means) - np.eye(k))
        m.identity_error = float(error.max(initial=0.0))
    return models


def _whitened(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch.column("x")):
                m = models[x.shape[1]]
                w = m.scores(x)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel(), pa.float64()))
                deviations = pa.array([decimal.Decimal(d) if d < 10 ** 38 else None for d in m.deviations(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(np.full(len(w), x.shape[1]), pa.int32()), deviations, flat], names=["vec_id", "dim", "deviation", "whitened"])
    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, models: dict[int, Whitening] | None = None) -> DataFrame:
    """vec_id, n (vectors of the fit list), deviation (decimal), whitened
    (array: the row's value for each component), explained (array), identity_error.

    ``models``: an earlier ``fit`` to apply; by default these rows' own. A length
    that the models lack fails the job."""
    importable(embeddings.sparkSession)
    rows = usable(embeddings)
    models = fit(rows, components) if models is None else models
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    out = rows.mapInArrow(_whitened(models), f"vec_id {kind}, dim int, deviation decimal(38,0), whitened array<double>")
    # one small row per vector length
    facts = [(dim, m.n, [float(e) for e in m.explained], m.identity_error) for dim, m in models.items()]
    known = embeddings.sparkSession.createDataFrame(facts, "dim int, n long, explained array<double>, identity_error double")
    return out.join(F.broadcast(known), "dim").select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")


def op11_whiten_embeddings(spark, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"))
    each = rows.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("k", "whitened"))
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
                       "whitened", F.get("explained", F.col("k")).alias("explained"), "identity_error")
