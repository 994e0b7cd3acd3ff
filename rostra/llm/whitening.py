"""Embedding whitening by spectral divide and conquer.

Sums and centred products of the vectors are added up on Spark. The covariance, a matrix
of the vectors' width, is then taken apart: the polar factor of the covariance minus a
shift tells the components above the shift from those below, so its projectors split the
space into two invariant subspaces, and each is split further until one direction is
left. Polar factors come from QDWH, a dynamically weighted Halley iteration. The
directions are broadcast, and every vector is projected on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import append_columns, schema_with
from rostra.llm.vectors import floored, matrices, usual_width
from rostra.sources.tables import materialize

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
# A vector with an entry beyond it has no exact integer form and takes no part.
MOST = float(1 << 40)
# Components of so small a part of the largest variance are rounding errors of it.
NO_VARIANCE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What a fit list has taught: its size, integer sums, and directions with their variances."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray
    total: float

    def count(self, most: int = COMPONENTS) -> int:
        """Number of components with a variance, up to ``most``."""
        return min(most, int((self.values > NO_VARIANCE * max(self.values[0], 0)).sum()))


def polar(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a nonsingular square matrix, by QDWH."""
    n = len(a)
    eye = np.eye(n)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, np.finfo(float).eps / n))
    for _ in range(rounds):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = (1 + d) ** 0.5
        wa = root + 0.5 * (8 - 4 * d + 8 * (2 - square) / (square * root)) ** 0.5
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            # Far from orthogonal the inverse is formed by a QR factorisation.
            q, _ = np.linalg.qr(np.vstack([wc**0.5 * x, eye]))
            y = wb / wc * x + (wa - wb / wc) / wc**0.5 * (q[:n] @ q[n:].T)
        else:
            y = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        change = np.linalg.norm(y - x)
        x = y
        if change < 1e-10 * n**0.5 and 1 - low < 1e-12:
            break
    return x


def _split(a: np.ndarray, shift: float, random: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the directions above the shift, and their number."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    projector = (projector + projector.T) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-8 * n:
        return None
    start = random.standard_normal((n, rank))
    # Once for the subspace, once more against rounding errors; the rest is its complement.
    for _ in range(2):
        start = np.linalg.qr(projector @ start)[0]
    basis = np.linalg.qr(np.hstack([start, random.standard_normal((n, n - rank))]))[0]
    off = basis[:, rank:].T @ a @ basis[:, :rank]
    return (basis, rank) if np.linalg.norm(off) <= 1e-10 * np.linalg.norm(a) else None


def _divided(a: np.ndarray, floor: float, random: np.random.Generator) -> np.ndarray:
    n = len(a)
    middle = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - middle * np.eye(n)) <= floor:
        return np.eye(n)
    # The mean of the variances lies between two of them; a shift that hits one moves on.
    spread = np.linalg.norm(a - middle * np.eye(n)) / n**0.5
    for shift in [float(np.median(np.diag(a))), *(middle + spread * t for t in (0, 1e-3, -1e-3, 0.03, -0.03, 0.3, -0.3))]:
        found = _split(a, shift, random)
        if found:
            break
    else:
        raise ArithmeticError("no shift splits the spectrum")
    basis, rank = found
    upper, lower = basis[:, :rank], basis[:, rank:]
    out = np.empty_like(a)
    for part, columns in ((upper, slice(0, rank)), (lower, slice(rank, n))):
        inner = part.T @ a @ part
        out[:, columns] = part @ _divided((inner + inner.T) / 2, floor, random)
    return out


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variances, falling, and unit directions (columns) of a symmetric matrix.

    A direction's entry of largest size is positive. Directions of equal variances are
    any orthogonal ones of their space.
    """
    size = max(float(np.linalg.norm(covariance)), np.finfo(float).tiny)
    found = _divided(covariance, 4 * np.finfo(float).eps * size, np.random.default_rng(7))
    found = np.linalg.qr(found)[0]
    values = np.einsum("ij,ik,kj->j", found, covariance, found)
    order = np.argsort(-values, kind="stable")
    values, found = values[order], found[:, order]
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return values, found * np.where(signs == 0, 1, signs)


def fit(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Components of all vectors of the rows; None if there is no vector.

    Entries become integers first: ``scale`` times the entry, rounded down, plus ``shift``.
    Vectors that are null or empty, hold a null, non-finite or far too large entry, or have
    another length than most (of several lengths as frequent, the shortest) take no part.
    What reaches the driver is a matrix of that length, whatever the number of rows.
    """
    given = rows.select(F.col(vector).cast("array<double>").alias("v"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for width, _, matrix in matrices(batch.column("v")):
                x, _ = floored(matrix, scale, MOST)
                new = [len(x), *(x.sum(axis=0) + len(x) * shift).tolist()]
                # Whole numbers of Python, which do not overflow.
                sums[width] = [a + b for a, b in zip(sums.get(width, [0] * (width + 1)), new)]
        for width, found in sums.items():
            yield pa.RecordBatch.from_pydict({
                "width": pa.array([width] * len(found), pa.int32()),
                "at": pa.array(range(len(found)), pa.int32()),
                "n": pa.array(found, pa.decimal128(38, 0)),
            })

    parts = given.mapInArrow(add_up, "width int, at int, n decimal(38,0)")
    sums = materialize(parts.groupBy("width", "at").agg(F.sum("n").cast("decimal(38,0)").alias("n")))
    usual = usual_width(sums.where("at = 0 AND n > 0"))
    if usual is None:
        return None
    width, n = usual
    totals = {r["at"]: int(r["n"]) for r in sums.where((F.col("width") == width) & (F.col("at") > 0)).collect()}
    totals = tuple(totals[i + 1] for i in range(width))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for batch in batches:
            for size, _, matrix in matrices(batch.column("v")):
                if size == width:
                    y = _centred(floored(matrix, scale, MOST)[0] + shift, n, totals)
                    gram += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": gram[i, j]})

    added = given.mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    i, j = added["i"].to_numpy(), added["j"].to_numpy()
    covariance = np.zeros((width, width))
    covariance[i, j] = covariance[j, i] = added["s"].to_numpy() / n
    values, directions = components(covariance)
    return Whitening(n, totals, values, directions, float(np.trace(covariance)))


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Entries minus their means: the whole part of the mean exactly, then the rest."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([s % n / n for s in sums])


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over the entries of (n x - S)^2, exact."""
    most = max([1, *(abs(n * int(v) - s) for v, s in zip(x.max(axis=0), sums)),
                *(abs(n * int(v) - s) for v, s in zip(x.min(axis=0), sums))])
    if most * most * len(sums) < 1 << 62:
        # Both terms may be too large for a long where their difference is not: it is taken
        # from the whole part of the mean.
        y = (x - np.array([s // n for s in sums], np.int64)) * n - np.array([s % n for s in sums], np.int64)
        return (y * y).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def whiten(
    rows: DataFrame,
    model: Whitening,
    count: int = COMPONENTS,
    vector: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """The rows whose vector takes part, with ``whitened array<double>`` and ``deviation decimal(38,0)``.

    ``whitened`` has the projections on the first ``count`` components over the roots of
    their variances; components without variance are left out, so that vectors that are
    all equal give an empty array. ``deviation`` is the exact sum of (n x - S)^2; beyond 38
    digits it is null. Columns of these names are replaced, repeated rows give repeated
    results, and an id may be null.
    """
    rows = rows.drop("whitened", "deviation")
    width = len(model.sums)
    kept = model.count(count)
    # Bounded by the width of the vectors.
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.n, model.sums, model.directions[:, :kept] / np.sqrt(model.values[:kept]))
    )
    doubles = rows.withColumn("whitened", F.col(f"`{vector}`").cast("array<double>"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, directions = shared.value
        for batch in batches:
            own = batch.drop_columns(["whitened"])
            for size, at, matrix in matrices(batch.column("whitened")):
                if size != width:
                    continue
                x, fits = floored(matrix, scale, MOST)
                if not len(x):
                    continue
                x += shift
                white = _centred(x, n, sums) @ directions
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * kept, pa.int32())
                far = [d if d < 10**38 else None for d in _deviations(x, n, sums)]
                yield append_columns(
                    own.take(pa.array(at[fits])),
                    whitened=pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
                    deviation=pa.array(far, pa.decimal128(38, 0)),
                )

    return doubles.mapInArrow(project, schema_with(rows, "whitened array<double>", "deviation decimal(38,0)"))


def identity_error(whitened: DataFrame, count: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity.

    ``whitened`` has a column of that name with ``count`` entries; 0 without entries.
    """
    if not count:
        return 0.0
    w = [F.get("whitened", F.lit(i)) for i in range(count)]
    means = whitened.agg(*[F.avg(c) for c in w]).first()
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = whitened.agg(*[F.avg((w[i] - F.lit(means[i])) * (w[j] - F.lit(means[j]))) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found))
