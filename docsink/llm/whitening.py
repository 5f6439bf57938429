"""Whitening of embeddings by shifted CholeskyQR.

The centred rows X are never factored directly. A pass sums the Gram matrix of Q (at first X), its Cholesky factor R
orthogonalises Q by triangular solves, and the next pass does so again; the first factor is of the Gram matrix
plus a shift, which makes it exist however ill-conditioned X is. The product of the factors is the R of X = QR, whose
singular values and right singular vectors give the components: no covariance matrix is decomposed, so small
eigenvalues keep their digits.

Rows stay where they are: a pass sends one row for each dimension from each task, and only matrices of
dimension x dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Components that a row is projected on.
COMPONENTS = 8
#: Entries c become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Passes after which the rows must be orthogonal.
PASSES = 8
#: A component has more than so much of the variance, else it is rounding.
LEAST_SHARE = 1e-13
#: Rows of a matrix in work at a time.
ROWS = 4096


def integer_vectors(spark: SparkSession, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Written (vec_id, x array<long>) of the rows whose vector has finite entries alone, and the dimension: the commonest length (of equally common ones the longer)."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    kept = rows.where(F.col(vector_col).isNotNull() & whole & (F.size(vector) > 0)).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(OFFSET)).cast("array<long>").alias("x"))
    kept = written(spark, kept, "vectors")
    first = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return (kept, 0) if first is None else (kept.where(F.size("x") == first["d"]), first["d"])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.column("x").slice(i, ROWS), d)


def _sums(rows: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of a matrix of a few rows, summed in tasks, then by matrix row. of: from a block of x, its matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(map(of, _blocks(batches, d)), start=np.zeros((1, 1), kind))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array([row.tobytes() for row in total], pa.binary())], names=["i", "row"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist(), strict=True):
                own = np.frombuffer(row, kind)
                found[i] = found[i] + own if i in found else own  # the zero of a task without rows is one wide, and is added to all
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([r.tobytes() for r in found.values()], pa.binary())], names=["i", "row"])

    schema = "i long, row binary"
    summed = rows.select("x").mapInArrow(partial, schema).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "i").mapInArrow(merged, schema)
    found = {r["i"]: np.frombuffer(r["row"], kind) for r in summed.collect()}
    wide = max(map(len, found.values()), default=0)
    return np.array([np.broadcast_to(found[i], wide) for i in sorted(found)])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows times the inverse of each of the upper triangular factors, one after the other."""
    for r in factors:
        out = np.empty_like(rows)
        for k in range(len(r)):
            out[:, k] = (rows[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
        rows = out
    return rows


def factored(gram: Callable[[list[np.ndarray]], np.ndarray], n: int, d: int) -> np.ndarray:
    """The R of X = QR. gram(factors): Q'Q of the rows solved by the factors so far.

    Each pass takes the Cholesky factor of Q'Q; the first adds a shift, and so do later ones while Q'Q has none. Where
    X lacks rank the shift alone remains in the directions that it lacks, and shrinks from pass to pass.
    """
    u, factors = np.finfo(float).eps / 2, []
    for k in range(PASSES):
        g = gram(factors)
        if k and np.abs(g - np.eye(d)).max() < 1e-12:
            break
        if not np.trace(g):
            return np.zeros((d, d))  # equal rows
        shift = min(11 * (n * d + d * (d + 1)) * u, 1e-6) * np.trace(g)
        try:
            lower = np.linalg.cholesky(g + shift * np.eye(d) if not k else g)
        except np.linalg.LinAlgError:
            lower = np.linalg.cholesky(g + shift * np.eye(d))
        factors.append(lower.T)
    out = np.eye(d)
    for r in factors:
        out = r @ out
    return out


def whiten(spark: SparkSession, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, holds null or non-finite entries, or is not of the table's dimension (the commonest length) are
    dropped. Rows that repeat a vec_id, or have none, each count. Components are the directions in which the rows differ: equal rows, or one row,
    have none, and so no result; nor has an empty table. Entries so large that sums over the table, or deviations, leave a long raise. Other columns stay out.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, d = integer_vectors(spark, rows, id_col, vector_col)
    empty = spark.createDataFrame([], schema)
    if not d:
        return empty

    def counted(x: np.ndarray) -> np.ndarray:
        return np.append(x.sum(axis=0), len(x))[None, :]

    first = _sums(rows, d, counted, "int64")[0]
    sums, n = first[:d], int(first[d])

    def off(x: np.ndarray) -> np.ndarray:
        """n times the centred rows, in whole numbers."""
        if float(np.abs(x).max(initial=0)) * n >= 2**62:
            raise OverflowError("an entry is too large")
        return n * x - sums

    def centred(x: np.ndarray) -> np.ndarray:
        return off(x) / n

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            q = _solved(centred(x), factors)
            return q.T @ q

        return _sums(rows, d, of, "float64")

    _, sigma, axes = np.linalg.svd(factored(gram, n, d))
    variances = sigma**2 / n
    share = variances / (variances.sum() or 1.0)
    axes = axes[: min(most, int((share > LEAST_SHARE).sum()))]
    if not len(axes):
        return empty
    scaled = (axes / np.sqrt(variances[: len(axes)])[:, None]).T
    means = _sums(rows, d, lambda x: (centred(x) @ scaled).sum(axis=0)[None, :], "float64")[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ scaled - means
        return w.T @ w

    error = float(np.abs(_sums(rows, d, spread, "float64") / n - np.eye(len(axes))).max())
    def deviation(own: np.ndarray) -> np.ndarray:
        if (own.astype(float) ** 2).sum(axis=1).max(initial=0) < 2**62:
            return (own**2).sum(axis=1)
        exact = [sum(v * v for v in row) for row in own.tolist()]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation is beyond a long")
        return np.array(exact, np.int64)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(axes)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                own = off(_matrix(batch.column("x").slice(i, ROWS), d))
                m = len(own)
                ids = batch.column("vec_id").slice(i, ROWS).take(pa.array(np.repeat(np.arange(m), k)))
                values = [np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), np.repeat(deviation(own), k), ((own / n) @ scaled).ravel(), np.tile(share[:k], m), np.full(m * k, error)]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, values)], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, table(spark, sf_dir, "embeddings"))
