"""Whitening of embeddings by incremental eigendecomposition.

The fit list, each distinct quantised vector once, is written to the shared folder. Every task
keeps the mean and the eigenpairs of the scatter of its vectors and brings them up to date by a
centred rank-one change for each vector, whose secular equation is solved with deflation
(``secular.py``). The tasks' spectra are joined by successive rank-one changes, a few at a time
in a tree, so no task sees more than ``FAN_IN`` of them. A distributed Rayleigh-Ritz pass then
measures the covariance of all vectors in the joined basis, centred exactly, and a small
rotation gives the components to double precision; another pass measures what whitening makes
of the fit list. What travels has the size of one matrix, whatever the table's size."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm.model_store import new_folder
from flowlab.llm.secular import Spectrum

#: Steps of one in an entry.
SCALE = 64
#: Entries at least this large count as not finite: their steps would not fit a long.
LIMIT = 2.0 ** 56
#: Spectra that one task joins.
FAN_IN = 16
#: Vectors of the fit list that one task takes in, at most (about).
TASK_VECTORS = 100_000
#: A component's share of the variance, at least: less is rounding.
LEAST_SHARE = 1e-12
#: Rayleigh-Ritz passes, and the error of whitening that ends them.
PASSES, GOOD = 3, 1e-9
_SAFE = 2 ** 62


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with the exact sums ``sums`` per dimension; ``values`` (falling) and
    ``vectors`` (columns) of their covariance; its trace; and the largest entry of the whitened
    fit list's covariance minus the identity, for the first ``components``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    components: int
    identity_error: float


def steps(embedding: Column) -> Column:
    """The whole steps of every entry, null for a vector that is null or holds an entry that is
    null, not finite or beyond ``LIMIT``."""
    fine = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LIMIT))
    return F.when(fine, F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("long")))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as an array of whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(y: np.ndarray) -> list[int]:
    if len(y) and int(np.abs(y).max()) * len(y) >= _SAFE:
        return [int(v) for v in y.astype(object).sum(axis=0)]
    return [int(v) for v in y.sum(axis=0)]


def _from_mean(y: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * y - S, exact: whole numbers of 64 bits where they fit, else Python's."""
    top = max((abs(int(s)) for s in sums), default=0)
    if len(y) and int(np.abs(y).max()) * n + top >= _SAFE:
        return n * y.astype(object) - np.array(sums, object)
    return n * y - np.array(sums, np.int64)


def _tree(parts: DataFrame, count: int, merge, schema: str) -> DataFrame:
    """One row from at most ``count`` rows numbered by ``part``, ``FAN_IN`` at a time."""
    while count > 1:
        parts = parts.groupBy(F.expr(f"part div {FAN_IN}").alias("up")).applyInArrow(merge, schema)
        count = -(-count // FAN_IN)
    return parts


_SPECTRUM = "part long, n long, sums array<string>, mean array<double>, pairs array<double>, vectors array<double>"
_MOMENTS = "part long, moments array<double>"


def _spectrum_row(part: int, s: Spectrum, sums: list[int]) -> dict:
    return {"part": [part], "n": [s.n], "sums": [[str(v) for v in sums]], "mean": [s.mean], "pairs": [s.values], "vectors": [s.vectors.ravel()]}


def _spectra(fit_list: DataFrame, dims: int) -> DataFrame:
    """A row for each task: number, sums, mean and eigenpairs of its vectors."""
    types = {"part": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.string()), **dict.fromkeys(("mean", "pairs", "vectors"), pa.list_(pa.float64()))}

    def batch(row):
        return pa.RecordBatch.from_arrays([pa.array(row[k], t) for k, t in types.items()], names=list(types))

    def scan(batches):
        s, sums = Spectrum(dims), [0] * dims
        for b in batches:
            y = _matrix(b.column(0), dims)
            sums = [p + q for p, q in zip(sums, _sums(y))]
            for x in y.astype(np.float64):
                s.add(x)
        if s.n:
            yield batch(_spectrum_row(TaskContext.get().partitionId(), s, sums))

    def merge(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        s, sums = Spectrum(dims), [0] * dims
        for r in rows:
            other = Spectrum(dims, r["n"], np.array(r["mean"]), np.array(r["pairs"]), np.array(r["vectors"]).reshape(dims, dims))
            sums = [p + int(q) for p, q in zip(sums, r["sums"])]
            if s.n:
                s.join(other)
            else:
                s = other
        return pa.Table.from_batches([batch(_spectrum_row(key[0].as_py(), s, sums))])

    return _tree(fit_list.mapInArrow(scan, _SPECTRUM), fit_list.rdd.getNumPartitions(), merge, _SPECTRUM)


def _moments(fit_list: DataFrame, n: int, sums: tuple[int, ...], basis: np.ndarray) -> np.ndarray:
    """The covariance of the fit list in ``basis``, centred before multiplying, in one pass."""
    dims, k = basis.shape

    def scan(batches):
        total = np.zeros((k, k))
        for b in batches:
            y = _matrix(b.column(0), dims)
            for i in range(0, len(y), 4096):
                z = (_from_mean(y[i:i + 4096], n, sums) / n).astype(np.float64) @ basis
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], names=["part", "moments"])

    def merge(key, table):
        rows = sorted(zip(table.column("part").to_pylist(), table.column("moments").to_pylist()))
        total = np.sum([m for _, m in rows], axis=0)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "moments": pa.array([total], pa.list_(pa.float64()))})

    top = _tree(fit_list.mapInArrow(scan, _MOMENTS), fit_list.rdd.getNumPartitions(), merge, _MOMENTS)
    return np.array(top.first()["moments"]).reshape(k, k) / n


def _in_task(spark: SparkSession, work, *arrays: np.ndarray) -> list[np.ndarray]:
    """``work`` on a few small arrays, in a task: a driver's linear-algebra threads may wait for
    ever once it has forked."""
    shapes = [a.shape for a in arrays]

    def run(batches):
        for b in batches:
            given = [np.array(c.to_pylist()[0], np.float64).reshape(s) for c, s in zip(b.columns, shapes)]
            yield pa.RecordBatch.from_arrays([pa.array([[a.ravel().tolist() for a in work(*given)]], pa.list_(pa.list_(pa.float64())))], names=["out"])

    df = spark.createDataFrame([tuple(a.ravel().tolist() for a in arrays)], ", ".join(f"a{i} array<double>" for i in range(len(arrays))))
    return [np.array(x) for x in df.mapInArrow(run, "out array<array<double>>").first()["out"]]


def _orthonormal(vectors):
    q, r = np.linalg.qr(vectors)
    return [q * np.where(np.diag(r) < 0, -1, 1)]


def _rotate(moments, basis):
    e, r = np.linalg.eigh((moments + moments.T) / 2)
    return [e[::-1], (basis @ r)[:, ::-1]]


def fit(embeddings: DataFrame, components: int = 16, embedding_col: str = "embedding") -> Whitening | None:
    """The whitening of all distinct vectors of ``embeddings``; None without any. Vectors whose
    number of entries is not the most common one among them (the larger, if tied) are left out.
    Only eigenvalues above ``LEAST_SHARE`` of the trace make components."""
    spark = embeddings.sparkSession
    folder = new_folder(spark, "whitening")
    y = steps(embeddings[embedding_col])
    embeddings.select(y.alias("y")).where("y is not null").distinct().write.parquet(folder)
    written = spark.read.parquet(folder)
    sizes = written.groupBy(F.size("y").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if sizes is None or not sizes["dims"]:
        return None
    dims, n = sizes["dims"], sizes["count"]
    tasks = max(-(-n // TASK_VECTORS), min(spark.sparkContext.defaultParallelism, n))
    fit_list = written.where(F.size("y") == dims).repartition(tasks, "y")
    top = _spectra(fit_list, dims).first()
    sums = tuple(int(s) for s in top["sums"])
    basis = _in_task(spark, _orthonormal, np.array(top["vectors"]).reshape(dims, dims))[0].reshape(dims, dims)
    moments = _moments(fit_list, n, sums, basis)
    for _ in range(PASSES):
        values, basis = _in_task(spark, _rotate, moments, basis)
        basis = basis.reshape(dims, dims)
        trace = float(values.sum())
        k = min(components, int((values > LEAST_SHARE * trace).sum())) if trace > 0 else 0
        moments = _moments(fit_list, n, sums, basis)
        e = values[:k]
        white = moments[:k, :k] / np.sqrt(np.outer(e, e))
        error = float(np.abs(white - np.eye(k)).max()) if k else 0.0
        if error <= GOOD:
            break
    return Whitening(n, sums, values, basis, trace, k, error)


_ROWS = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, model: Whitening | None, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """A row for each vector and component (from 1): vec_id, component, n, deviation (sum over
    the dimensions of (n*x - S)^2, exact), whitened, explained, identity_error.

    Vectors that :func:`steps` makes null, or whose number of entries is not the model's, have no
    rows; repeated rows and null ids are scored as they come; other columns are not looked at.
    One distinct vector alone has no variance and so no component; empty in, empty out."""
    spark = embeddings.sparkSession
    if model is None or not model.components:
        return spark.createDataFrame([], _ROWS)
    k, n, sums, dims, error = model.components, model.n, model.sums, len(model.sums), model.identity_error
    axes = model.vectors[:, :k] / np.sqrt(model.values[:k])
    share = model.values[:k] / model.trace

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                ids, m = b.column(0).slice(i, 2048), min(2048, b.num_rows - i)
                away = _from_mean(_matrix(b.column(1).slice(i, 2048), dims), n, sums)
                white = (away / n).astype(np.float64) @ axes
                if away.dtype != object and int(np.abs(away).max()) ** 2 * dims >= _SAFE:
                    away = away.astype(object)
                far = (away * away).sum(axis=1)
                far = pa.array([Decimal(int(v)) for v in far], pa.decimal128(38, 0))
                rows = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), far.take(rows),
                     pa.array(white.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), steps(embeddings[embedding_col]).alias("y")) \
        .where(F.size("y") == dims).mapInArrow(run, _ROWS)
