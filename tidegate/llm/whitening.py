"""Operator 11: whitening components of integer embeddings by shifted CholeskyQR.

Every entry c becomes x = floor(64 * c) + 1000000. The fit uses each distinct x vector once; its rows are centred exactly,
(n * x - S) / n with the integer sums S, before anything is multiplied. A pass over the rows solves them against the
triangular factors found so far, sums the Gram matrix of the solved rows, and its Cholesky factor is the next one. The
first Gram matrix, and any that is not safely positive definite, is shifted by a small multiple of the unit matrix. Passes end
when the solved rows are orthonormal. The product R of the factors has the singular values and right singular vectors of the
centred rows, so the small SVD of R gives the components to double precision.

What a task returns is a Gram matrix in slabs of rows, added up by two shuffles of slabs; the driver sees one matrix of
width x width, and factors of that size go back to the tasks. Both are bounded by the width of the vectors, whatever their number.

Defined results: rows with a null vector or a null or non-finite entry go; a null vec_id stays null; repeated rows each give
their rows but count once in the fit; x is limited to +-2^40; vectors of another length are fitted and whitened among themselves; a
component whose eigenvalue is at most 1e-20 of the greatest does not exist (equal vectors, one row and empty vectors have none, and
give no rows); `deviation` is null beyond 64 bits; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import shuffle_partitions, stage

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 40
COMPONENTS = 16
SLAB_ROWS = 64
FAN = 64
PASSES, ORTHONORMAL = 8, 1e-13
RANK = 1e-10  # of the greatest singular value

WHITENED = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
SLABS = "width int, slab int, branch int, part binary"
Factors = dict[int, list[np.ndarray]]


def whole_vectors(embedding: Column) -> Column:
    """The integers of a vector, or null where it is null or has a null or non-finite entry."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    limit = F.lit(float(LIMIT))
    return F.when(finite, F.transform(embedding, lambda c: (
        F.greatest(F.least(F.floor(c.cast("double") * SCALE).cast("double"), limit), -limit).cast("bigint") + OFFSET)))


class Centre:
    """Number and sums of the fit list of one width; rows minus the mean without rounding before the last division."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as 64-bit integers where they fit and as Python's otherwise."""
        away = x - self.base
        most = int(np.abs(away).max(initial=0)) + 1
        if self.n * most < 1 << 62:
            return self.n * away - np.array(self.rest, np.int64)
        return self.n * away.astype(object) - np.array(self.rest, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        scaled = self.scaled(x)
        most = max((abs(int(v)) for v in (scaled.max(initial=0), scaled.min(initial=0))))
        if most * most * max(x.shape[1], 1) >= 1 << 62:
            scaled = scaled.astype(object)
        return [int(d) if d < 1 << 63 else None for d in (scaled * scaled).sum(1)]


def solve_right(rows: np.ndarray, factor: np.ndarray, block: int = 32) -> np.ndarray:
    """rows @ inverse(factor) for an upper triangular factor, by substitution from the first column on."""
    out = rows.copy()
    for a in range(0, len(factor), block):
        b = min(a + block, len(factor))
        out[:, a:b] -= out[:, :a] @ factor[:a, a:b]
        for j in range(a, b):
            out[:, j] = (out[:, j] - out[:, a:j] @ factor[a:j, j]) / factor[j, j]
    return out


def _by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each width in a batch."""
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    widths = np.diff(offsets)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, flat[offsets[rows][:, None] + np.arange(width)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial numbers and sums per width and dimension; a batch holds far fewer than 2**22 rows."""
    for batch in batches:
        for _, x in _by_width(batch.column(0)):
            width = x.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(width, width, np.int32)), pa.array(np.arange(width, dtype=np.int32)), pa.array(x.sum(0)),
                pa.array(np.full(width, len(x)))], ["width", "dimension", "total", "n"])


def fit_centres(fit: DataFrame) -> dict[int, Centre]:
    """One row per width and dimension comes to the driver."""
    parts = fit.mapInArrow(_sums, "width int, dimension int, total bigint, n bigint")
    rows = parts.groupBy("width", "dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r.width, r.dimension)):
        out.setdefault(row.width, [row.n, []])[1].append(int(row.total))
    return {width: Centre(n, sums) for width, (n, sums) in out.items()}


def _add_slabs(branch_of_next: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for width, slab, branch, part in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(part)
                key = width, slab, branch // branch_of_next
                held[key] = held[key] + own if key in held else own
        yield from _slab_batches(held)

    return run


def _slab_batches(held: dict[tuple, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (width, slab, branch), part in held.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([width], pa.int32()), pa.array([slab], pa.int32()), pa.array([branch], pa.int32()),
            pa.array([part.tobytes()], pa.binary())], ["width", "slab", "branch", "part"])


def gram(fit: DataFrame, rows_of: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """The Gram matrix of `rows_of(width, x)` over all rows, per width of x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_width(batch.column(0)):
                rows = rows_of(x.shape[1], x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + rows.T @ rows
        branch = TaskContext.get().partitionId()
        yield from _slab_batches({(width, a // SLAB_ROWS, branch): matrix[a:a + SLAB_ROWS].ravel()
                                  for width, matrix in sums.items() for a in range(0, len(matrix), SLAB_ROWS)})

    slabs, n = fit.mapInArrow(run, SLABS), shuffle_partitions(fit.sparkSession)
    # Tasks in sets of FAN first, then the sets, so that no task adds the slabs of all tasks.
    near = slabs.repartition(n, "width", "slab", F.floor(F.col("branch") / FAN)).mapInArrow(_add_slabs(FAN), SLABS)
    whole = near.repartition(n, "width", "slab").mapInArrow(_add_slabs(1 << 31), SLABS)
    out: dict[int, list] = {}
    for row in sorted(whole.collect(), key=lambda r: (r.width, r.slab)):
        out.setdefault(row.width, []).append(np.frombuffer(row.part))
    return {width: (m := np.concatenate(parts)).reshape(int(len(m) ** 0.5), -1) for width, parts in out.items()}


def shifted_factor(matrix: np.ndarray, n: int, first: bool) -> np.ndarray:
    """The upper triangular factor of a Gram matrix, shifted where it is the first or not safely positive definite."""
    d, most = len(matrix), max(float(np.trace(matrix)), np.finfo(float).tiny)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * most if first else 0.0
    shift = min(shift, most / d * 1e-2)
    while True:
        try:
            lower = np.linalg.cholesky(matrix + shift * np.eye(d))
            if np.diag(lower).min() ** 2 > 1e-15 * most / d:
                return lower.T
        except np.linalg.LinAlgError:
            pass
        shift = max(shift * 10, most / d * 1e-14)


def _settled(matrix: np.ndarray) -> bool:
    """Whether the solved rows are orthonormal, but for directions that the data do not have."""
    values = np.linalg.eigvalsh(matrix)
    return bool(np.all((np.abs(values - 1) < ORTHONORMAL * len(matrix)) | (values < 1e-6)))


def orthogonal_factors(fit: DataFrame, centres: dict[int, Centre]) -> Factors:
    """Triangular factors whose product is the R of the centred rows, per width."""
    factors: Factors = {w: [] for w in centres}

    def solved(width: int, x: np.ndarray) -> np.ndarray:
        rows = centres[width].centred(x)
        for factor in factors[width]:
            rows = solve_right(rows, factor)
        return rows

    for turn in range(PASSES):
        matrices = {w: m for w, m in gram(fit, solved).items() if np.any(m)}
        open_ = {w: m for w, m in matrices.items() if not turn or not _settled(m)}
        if not open_:
            break
        for width, matrix in open_.items():
            factors[width] = [*factors[width], shifted_factor(matrix, centres[width].n, not turn)]
    return factors


class Whitener:
    """Components of one width: unit vectors by falling eigenvalue, and what they explain."""

    def __init__(self, centre: Centre, factors: list[np.ndarray], most: int):
        product = np.eye(len(centre.base))
        for factor in factors:
            product = factor @ product
        _, values, vectors = np.linalg.svd(product)
        found = values > RANK * max(values.max(initial=0), np.finfo(float).tiny) if factors else np.zeros(len(values), bool)
        kept = int(min(found.sum(), most))
        eigen = values ** 2 / centre.n
        vectors = vectors[:kept]
        vectors = vectors * np.sign(vectors[np.arange(kept), np.abs(vectors).argmax(1)])[:, None] if kept else vectors
        self.centre, self.scaled = centre, vectors.T / np.sqrt(eigen[:kept])
        self.explained = eigen[:kept] / eigen.sum() if kept else eigen[:0]
        self.error = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.scaled


def fit_whiteners(x: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """The whitener of each width of the vectors in column x, with the measured error of its covariance."""
    fit = stage(x.select("x").distinct(), "whitening-fit")
    centres = fit_centres(fit)
    factors = orthogonal_factors(fit, centres)
    models = {w: Whitener(centres[w], factors[w], components) for w in centres}
    spread = gram(fit, lambda width, rows: models[width].whiten(rows))
    for width, model in models.items():
        covariance = spread.get(width, np.zeros((0, 0))) / model.centre.n
        model.error = float(np.abs(covariance - np.eye(len(covariance))).max(initial=0.0))
    return models


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector of `vectors` (vec_id, embedding) and component."""
    x = vectors.select(whole_vectors(F.col("embedding")).alias("x"), F.col("vec_id").cast("bigint").alias("vec_id")).filter("size(x) > 0")
    models = fit_whiteners(x, components)
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WHITENED.split(", ")]
        for batch in batches:
            for rows, x in _by_width(batch.column(0)):
                model = shared.value[x.shape[1]]
                kept = len(model.explained)
                again = np.repeat(np.arange(len(rows)), kept)
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).take(pa.array(rows[again])), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(again), model.centre.n)),
                    pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(again)), pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(model.explained, len(rows))), pa.array(np.full(len(again), model.error))], names)

    return x.mapInArrow(run, WHITENED)
