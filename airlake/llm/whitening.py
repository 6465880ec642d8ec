"""Embedding whitening by QDWH spectral divide-and-conquer.

Entries become integers (``units``), equal vectors count once, and sums over that fit list are exact.
Spark centres the vectors and adds up the d x d covariance; the driver holds only that
matrix and turns it into components: the polar factor of the shifted covariance (QR-based
dynamically weighted Halley iteration) gives the projector on the eigenvalues above the shift, its range
and complement split the space in two invariant subspaces, and each is split again until it is one
dimension wide or a multiple of the identity. The d x 16 components travel with the closure of the whitening
pass: their size depends on the vectors' length (at most ``WIDEST``), not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airlake.llm.common import prepare, written

COMPONENTS = 16
UNIT = 64
OFFSET = 1_000_000
# Units from which a double no longer holds every integer; such rows count as not finite.
LARGEST = float(2**53)
# Longest vectors: the driver holds a few matrices of this width.
WIDEST = 4096
EPS = float(np.finfo(np.float64).eps)
# Variance below this share of the total is rounding, not a component.
NOTHING = 1e-13


# QDWH ---------------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix (its matrix sign), by inverse-free QDWH."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low = max(EPS, float(np.linalg.norm(x, -2)) / np.sqrt(n)) if n < 3 else _least(x)
    for _ in range(60):
        # Weights of the rational step that lifts singular values in [low, 1] best.
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved <= 10 * EPS * np.sqrt(n) or (1 - low <= 10 * EPS and moved <= EPS ** (1 / 3)):
            return x
    return x


def _least(x: np.ndarray) -> float:
    """A lower bound of the smallest singular value, from the triangle of a QR factorisation."""
    triangle = np.linalg.qr(x, mode="r")
    diagonal = np.abs(np.diag(triangle)).min()
    if diagonal <= EPS:
        return EPS
    inverse = np.linalg.norm(np.linalg.inv(triangle))
    return float(min(1.0, max(EPS, 0.9 / inverse))) if np.isfinite(inverse) else EPS


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if it is too near an eigenvalue."""
    n = len(a)
    shifted = a - shift * np.eye(n)
    if not shifted.any():
        return None
    projector = (polar_factor(shifted) + np.eye(n)) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < n or np.linalg.norm(projector @ projector - projector) > 1e-10 * n:
        return None
    start = np.random.default_rng(n).standard_normal((n, n))
    # Range of the projector, then of its complement; a second round removes what rounding left of the other.
    up = np.linalg.qr(projector @ start[:, :above])[0]
    up = np.linalg.qr(projector @ up)[0]
    down = start[:, above:]
    for _ in range(2):
        down = np.linalg.qr(down - projector @ down)[0]
        down = np.linalg.qr(down - up @ (up.T @ down))[0]
    return up, down


def _divide(a: np.ndarray, basis: np.ndarray, total: float) -> list[tuple[float, np.ndarray]]:
    """(eigenvalue, vector) of ``a``, whose coordinates are the columns of ``basis``."""
    n = len(a)
    mean = float(np.trace(a)) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if n == 1 or spread <= 4 * EPS * total:
        return [(float(a[i, i]), basis[:, i]) for i in range(n)]
    # The mean has eigenvalues on both sides; nearby shifts step aside from one that it meets.
    for step in (0.0, 0.05, -0.05, 0.11, -0.11, 0.23, -0.23, 0.31, -0.31):
        halves = _halves(a, mean + step * spread / np.sqrt(n))
        if halves:
            break
    else:
        return [(float(a[i, i]), basis[:, i]) for i in range(n)]
    found = []
    for part in halves:
        inner = part.T @ a @ part
        found += _divide((inner + inner.T) / 2, basis @ part, total)
    return found


def spectrum(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors in columns) of a covariance, largest first.

    The sign of a vector is free; the largest entry by magnitude is made positive. A second division, of the
    matrix in the first one's basis, removes the rounding that the splits add up.
    """
    d = len(covariance)
    scale = float(np.abs(covariance).max())
    if not d or scale == 0:
        return np.zeros(d), np.eye(d)
    a, basis = covariance / scale, np.eye(d)
    for _ in range(2):
        inner = basis.T @ a @ basis
        found = _divide((inner + inner.T) / 2, basis, float(np.linalg.norm(a)))
        basis = np.linalg.qr(np.column_stack([vector for _, vector in found]))[0]
    values = np.einsum("ij,ij->j", basis, a @ basis)
    order = np.argsort(-values, kind="stable")
    values, basis = values[order] * scale, basis[:, order]
    return values, basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)


# Passes over the rows -----------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every entry a finite number that becomes an exact integer."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c) * UNIT < LARGEST, F.lit(False)) & ~F.isnan(c))
    return vector.isNotNull() & (F.size(vector) > 0) & inside


def units(vector: Column) -> Column:
    """floor(64 c) of every entry. The offset of 1,000,000 is left out: it changes no difference."""
    return F.transform(vector, lambda c: F.floor(c * UNIT).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length, as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        yield int(length), batch if (lengths == length).all() else batch.filter(pa.array(lengths == length))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, total, n): exact sums of each task; Python integers, so nothing wraps around."""
    held: dict[int, tuple[np.ndarray, int]] = {}
    for batch in batches:
        for d, part in _by_length(batch, 0):
            # Both halves of an entry are below 2**28, so their sums over a batch fit.
            x = _matrix(part.column(0))
            high, low = x >> 26, x & ((1 << 26) - 1)
            total = high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)
            before, n = held.get(d, (np.zeros(d, object), 0))
            held[d] = before + total, n + len(x)
    for d, (total, n) in held.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                pa.array([str(t) for t in total]), pa.array([n] * d, pa.int64()),
            ],
            ["d", "i", "total", "n"],
        )


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S/n in doubles, from the exact nearest integer of S/n and the exact rest."""
    near = [(2 * s + n) // (2 * n) for s in sums]
    rest = np.array([(s - k * n) / n for s, k in zip(sums, near)])
    return (x - np.array(near, np.int64)) - rest


def _products(fits: dict[int, tuple[int, list[int]]], components: dict[int, np.ndarray] | None = None):
    """(d, i, j, total): products of the centred entries, or of their projections, added up in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, part in _by_length(batch, 0):
                n, sums = fits[d]
                x = centred(_matrix(part.column(0)), sums, n)
                if components:
                    x = x @ components[d]
                held[d] = held.get(d, 0) + x.T @ x
        for d, total in held.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                    pa.array(total[i, j]),
                ],
                ["d", "i", "j", "total"],
            )

    return run


def _covariances(fit: DataFrame, fits: dict, components: dict | None = None) -> dict[int, np.ndarray]:
    """The covariance per length, in entries or in components: d x d numbers reach the driver."""
    rows = fit.mapInArrow(_products(fits, components), "d int, i int, j int, total double")
    found: dict[int, np.ndarray] = {}
    for r in rows.groupBy("d", "i", "j").agg(F.sum("total").alias("total")).collect():
        width = components[r["d"]].shape[1] if components else r["d"]
        matrix = found.setdefault(r["d"], np.zeros((width, width)))
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["total"] / fits[r["d"]][0]
    return found


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int]:
    """The exact sum of (n x - S)^2 of each row."""
    reach = max((max(abs(int(c.max()) * n - s), abs(int(c.min()) * n - s)) for c, s in zip(x.T, sums)), default=0)
    if len(sums) * reach * reach < 2**62:
        apart = x * n - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def _whiten(models: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _by_length(batch, 1):
                n, sums, scaled, explained, error = models[d]
                x = _matrix(part.column(1))
                apart = [v if v < 2**63 else None for v in deviations(x, sums, n)]
                white = centred(x, sums, n) @ scaled
                k = len(explained)
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(rows), n), pa.int64()),
                        pa.array(apart, pa.int64()).take(pa.array(rows)),
                        pa.array(white.reshape(-1), from_pandas=True),  # NaN: no variance to divide by
                        pa.array(np.tile(explained, len(x)), from_pandas=True),
                        pa.array(np.full(len(rows), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def fit_whitening(vectors: Column, rows: DataFrame, components: int = COMPONENTS) -> dict[int, tuple]:
    """Models by length of vector: (n, S, scaled components, explained shares, identity error).

    Equal vectors count once: they are reduced in each task before the shuffle, so copies of one vector
    never meet in one task. What reaches the driver are d sums and d x d products per length.
    """
    fit = written(rows.select(vectors.alias("x")).distinct(), "whitening-fit")
    sums = fit.mapInArrow(_sums, "d int, i int, total string, n long").groupBy("d", "i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    fits: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("d", "i").collect():
        fits.setdefault(r["d"], (r["n"], []))[1].append(int(r["total"]))
    if fits and max(fits) > WIDEST:
        raise ValueError(f"vectors of {max(fits)} entries; covariances are held up to {WIDEST}")
    scaled, shares, kept = {}, {}, {}
    for d, covariance in _covariances(fit, fits).items():
        values, basis = spectrum(covariance)
        trace = float(np.trace(covariance))
        values, basis = values[:components], basis[:, :components]
        varied = values > NOTHING * max(trace, 0.0)
        kept[d] = varied
        root = np.where(varied, np.sqrt(np.where(varied, values, 1.0)), np.nan)
        scaled[d] = basis / root
        shares[d] = np.where(varied, values, 0.0) / trace if trace > 0 else np.full(len(values), np.nan)
    # Without its NaN columns a projection is finite; the error is of the components that exist.
    present = {d: s[:, kept[d]] for d, s in scaled.items()}
    errors = {d: 0.0 for d in fits}
    for d, matrix in (_covariances(fit, fits, present) if fits else {}).items():
        errors[d] = float(np.abs(matrix - np.eye(len(matrix))).max(initial=0.0))
    return {d: (n, s, scaled[d], shares[d], errors[d]) for d, (n, s) in fits.items()}


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Rows whose vector is null or empty or holds a null, an entry that is not finite, or one beyond 2**53 / 64
    are left out. Vectors of each length are a table of their own, with their own fit. Repeated rows are
    whitened each, and count once in the fit. A component without variance (fewer distinct vectors than entries)
    has a null ``whitened`` and explains 0; with no variance at all ``explained`` is null too. ``deviation`` is exact, and
    null where it needs more than 63 bits. A null id is kept. Other columns are not read; an empty table
    gives no rows.
    """
    prepare(embeddings.sparkSession)
    wide = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), wide.alias("vector"))
    rows = rows.where(usable(F.col("vector"))).select("vec_id", units(F.col("vector")).alias("x"))
    models = fit_whitening(F.col("x"), rows, components)
    return rows.mapInArrow(
        _whiten(models),
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
