"""Whitening of embeddings by a covariance weighted with multiplicities.

Vectors are put on a grid of 1/64, which makes their sums exact. Rows with the
same grid vector are one group: the fit works on distinct vectors with their
counts (or with one each) as weights, each distinct vector is whitened once, and
rows get the result by a join. Groups are combined in the map tasks, and the few
vectors that many rows share are joined by broadcast (at most ``HOT_SHARE`` of
them can exist), so a vector that holds a third of all rows is never gathered.

The covariance is a sum of products of centred matrices, one a task; tasks write
their cells, Spark adds them up, and the driver holds one matrix (``d * d``) for
each vector length there is. Its eigenvectors come from that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslake.llm.components import _written

GRID = 64
SHIFT = 1_000_000
COMPONENTS = 32
HOT_SHARE = 256
BATCH_VALUES = 1 << 18  # vector entries that one matrix product reads
_LIMIT = float(1 << 62)  # a grid value beyond this is no long; such an entry counts as not finite


@dataclass
class Whitener:
    """The fit for vectors of one length, in plain arrays.

    ``n`` is the sum of weights; ``floor`` and ``rest`` give the mean exactly: ``floor + rest / n``.
    ``axes`` holds one unit eigenvector a row, ``variances`` their eigenvalues.
    """

    n: int
    floor: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    trace: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.variances > 0, 1 / np.sqrt(self.variances), np.nan)
        return (self.centred(x) @ self.axes.T) * scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """``sum((n * x - S) ** 2)`` of each row, exactly."""
        near = x - self.floor
        reach = (int(np.abs(near).max(initial=0)) + 1) * self.n
        exact = np.int64 if reach**2 * max(x.shape[1], 1) < 1 << 62 else object
        off = near.astype(exact) * self.n - self.rest.astype(exact)
        return [int(v) for v in (off * off).sum(axis=1)]


def _grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vectors are whole, with the vector as the bytes of its grid values."""
    for batch in batches:
        vectors = batch.column("vector")
        ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = vectors.flatten()
        values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(values * GRID)
            bad = ~(np.abs(scaled) < _LIMIT)
        wrong = np.concatenate([[0], np.cumsum(bad)])
        whole = (wrong[ends[1:]] == wrong[ends[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(whole)
        x = np.where(bad, 0, scaled).astype(np.int64) + SHIFT
        sizes = np.diff(ends)[rows]
        kept = x[np.repeat(whole, np.diff(ends))]
        cells = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(rows),
            [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int64)), pa.py_buffer(kept)],
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(rows)), cells.cast(pa.binary())], names=["vec_id", "x"]
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Matrices of grid vectors of one length, with the rows of the batch they stand for."""
    for batch in batches:
        column = batch.column("x").cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(BATCH_VALUES // max(size // 8, 1), 1)
            for begin in range(0, len(rows), step):
                part = pa.RecordBatch.from_arrays(
                    [c.take(pa.array(rows[begin : begin + step])) for c in batch.columns], names=batch.schema.names
                )
                data = b"".join(part.column("x").to_pylist())
                yield size // 8, np.frombuffer(data, np.int64).reshape(part.num_rows, size // 8), part


def _weights(part: pa.RecordBatch, counted: bool) -> np.ndarray:
    n = part.column("n").to_numpy(zero_copy_only=False)
    return n if counted else np.ones(len(n), np.int64)


def _totals(counted: bool):
    """Exact weighted sums of a task, for each length and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for length, x, part in _matrices(batches):
            w = _weights(part, counted)
            safe = int(np.abs(x).max(initial=0)) * int(w.sum()) < 1 << 62
            kind = np.int64 if safe else object
            sums = (x.astype(kind) * w.astype(kind)[:, None]).sum(axis=0).astype(object)
            total, before = held.get(length, (0, 0))
            held[length] = total + int(w.sum()), before + sums
        for length, (total, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * length, pa.int32()),
                    pa.array(range(length), pa.int32()),
                    pa.array([total] * length, pa.int64()),
                    pa.array(map(str, sums), pa.string()),
                ],
                names=["length", "dim", "n", "s"],
            )

    return run


def _cells(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Upper triangles as rows ``length, i, j, value``."""
    for length, matrix in held.items():
        i, j = np.triu_indices(matrix.shape[0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(i), length), pa.int32()),
                pa.array(i, pa.int32()),
                pa.array(j, pa.int32()),
                pa.array(matrix[i, j]),
            ],
            names=["length", "i", "j", "value"],
        )


def _products(fits, counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for length, x, part in _matrices(batches):
            c = Whitener(**fits.value[length]).centred(x)
            held[length] = held.get(length, 0) + (c * _weights(part, counted).astype(np.float64)[:, None]).T @ c
        yield from _cells(held)

    return run


def _whitened(fits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, x, part in _matrices(batches):
            fit = Whitener(**fits.value[length])
            z = fit.whiten(x)
            width = z.shape[1]
            flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
            ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("x"),
                    part.column("n"),
                    pa.array(np.full(len(z), length), pa.int32()),
                    pa.array([str(v) for v in fit.deviations(x)], pa.string()),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=["x", "n", "length", "deviation", "whitened"],
            )

    return run


def _identity(counted: bool):
    """Weighted sums of ``z`` (row 0) and of its products, of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            w = _weights(batch, counted).astype(np.float64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                z = batch.column("whitened").take(pa.array(rows))
                z = z.flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(rows), -1)
                one = np.concatenate([np.ones((len(rows), 1)), z], axis=1)
                held[length] = held.get(length, 0) + (one * w[rows][:, None]).T @ one
        yield from _cells(held)

    return run


def _square(rows: pa.Table, length: int) -> np.ndarray:
    part = rows.filter(pa.compute.equal(rows["length"], length))
    i, j, value = (part[c].to_numpy() for c in ("i", "j", "value"))
    out = np.zeros((int(j.max(initial=-1)) + 1,) * 2)
    out[i, j] = out[j, i] = value
    return out


def _added(df: DataFrame) -> pa.Table:
    return df.groupBy("length", "i", "j").agg(F.sum("value").alias("value")).toArrow()


def fit_whitening(groups: DataFrame, components: int = COMPONENTS, counted: bool = True) -> dict[int, Whitener]:
    """The fit for each vector length of ``groups (x, n)``; the driver gets ``d * d`` cells a length.

    With ``counted`` a distinct vector weighs as many as it has rows, else one.
    """
    spark = groups.sparkSession
    sums = (
        groups.mapInArrow(_totals(counted), "length int, dim int, n long, s string")
        .groupBy("length", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .collect()
    )
    fits = {}
    for length in sorted({r["length"] for r in sums}):
        own = sorted((r for r in sums if r["length"] == length), key=lambda r: r["dim"])
        n, exact = own[0]["n"], [int(r["s"]) for r in own]
        floor = np.array([s // n for s in exact], np.int64)
        rest = np.array([s % n for s in exact], np.int64)
        fits[length] = Whitener(n, floor, rest, axes=np.zeros((0, length)), variances=np.zeros(0))
    if not fits:
        return fits
    shared = spark.sparkContext.broadcast({k: vars(v) for k, v in fits.items()})
    products = _added(groups.mapInArrow(_products(shared, counted), "length int, i int, j int, value double"))
    for length, fit in fits.items():
        covariance = _square(products, length) / fit.n
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        fit.trace = float(np.trace(covariance))
        # Beyond the rounding of the largest one, an eigenvalue is none.
        tiny = max(float(values.max(initial=0)), 0.0) * length * np.finfo(float).eps
        fit.variances = np.where(values[order] > tiny, values[order], 0.0)
        fit.axes = vectors[:, order].T.copy()
    return fits


def whiten(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    counted: bool = True,
) -> DataFrame:
    """For each usable row and component ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, or holds a null, NaN, infinite entry or one beyond
    ``2**62 / 64`` are left out. ``x = floor(64 * c) + 1000000``; the mean and the
    covariance (divisor ``n``, the sum of weights) are over all other rows of the same
    vector length, and an empty vector has no components. ``deviation`` is
    ``sum((n * x - S) ** 2)`` as an exact decimal, with ``S`` the weighted sums. A
    component without variance has ``whitened`` null and ``explained`` 0, and takes
    no part in ``identity_error``. Repeated rows and null ids give rows of their
    own; an empty table gives none; other columns are ignored.
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    vectors = rows.mapInArrow(_grid, f"vec_id {kind}, x binary").where(F.octet_length("x") > 0)
    groups = _written(vectors.groupBy("x").agg(F.count(F.lit(1)).alias("n")), "vectors")
    fits = fit_whitening(groups, components, counted)

    shared = spark.sparkContext.broadcast({k: vars(v) for k, v in fits.items()})
    schema = "x binary, n long, length int, deviation string, whitened array<double>"
    done = _written(groups.mapInArrow(_whitened(shared), schema), "whitened")
    moments = _added(done.mapInArrow(_identity(counted), "length int, i int, j int, value double"))
    facts = []
    for length, fit in fits.items():
        sums = _square(moments, length) / fit.n
        off = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:]) - np.eye(len(fit.variances))
        used = fit.variances > 0
        error = float(np.abs(off[np.ix_(used, used)]).max(initial=0.0))
        for c, value in enumerate(fit.variances):
            facts.append((length, c, fit.n, float(value / fit.trace) if fit.trace > 0 else 0.0, error))
    model = spark.createDataFrame(facts, "length int, at int, n long, explained double, identity_error double")

    # At most HOT_SHARE vectors can hold that share of the rows: their rows stay where they are.
    total = groups.agg(F.sum("n")).first()[0] or 1
    hot = F.col("n") * HOT_SHARE >= total
    results = done.select("x", "n", "length", "deviation", "whitened")
    common = F.broadcast(results.where(hot)).drop("n")
    near = vectors.join(common, "x")
    rest = vectors.join(F.broadcast(results.where(hot).select("x")), "x", "left_anti").join(
        results.where(~hot).drop("n"), "x"
    )
    return (
        near.unionByName(rest)
        .select("vec_id", "length", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .join(F.broadcast(model), ["length", "at"])
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            "n",
            F.col("deviation").cast("decimal(38,0)").alias("deviation"),
            "whitened",
            "explained",
            "identity_error",
        )
    )
