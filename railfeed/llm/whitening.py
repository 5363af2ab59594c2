"""Whitening of embeddings from covariances recovered by polarisation."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from railfeed.llm.common import staged, table

#: Rows held at a time; sums of a block stay far below 64 bits unless its values are very large.
BLOCK = 4096
_SAFE = 1 << 62


def grid(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``(vec_id, x)``: entries as whole numbers, floor(scale * c) + shift; vectors that are not wholly finite are left out.

    Numbers beyond 2^50 on either side count as 2^50, so that sums of their squares fit 38 digits.
    """
    most = float(1 << 50)
    vec = F.col(vec_col).cast("array<double>")
    whole = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    fine = df.where(F.col(vec_col).isNotNull() & F.coalesce(whole, F.lit(False)))
    number = lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(most)), F.lit(-most))) + F.lit(shift)
    return fine.select(F.col(id_col).alias("vec_id"), F.transform(vec, number).alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Blocks of rows as matrices of 64-bit integers; all vectors have ``d`` entries."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.column("x").slice(at, BLOCK)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _top(block: np.ndarray) -> int:
    return max(abs(int(block.min())), abs(int(block.max()))) if block.size else 0


def _rows(keys: list[list[int]], values: list[int], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(k, pa.int32()) for k in keys] + [pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))]
    return pa.RecordBatch.from_arrays(columns, names=names)


def dimension_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sum of every dimension; each task adds its own rows up first."""

    def run(batches):
        total = [0] * d
        for block in _matrices(batches, d):
            block = block if _top(block) * BLOCK < _SAFE else block.astype(object)
            total = [t + int(s) for t, s in zip(total, block.sum(axis=0))]
        yield _rows([list(range(d))], total, ["i", "s"])

    got = fit.select("x").mapInArrow(run, "i INT, s DECIMAL(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = {r.i: int(r.s) for r in got}
    return [sums.get(i, 0) for i in range(d)]


def squared_sums(fit: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of squares of the centred dimensions, ``(i, i)``, and of their pairwise sums, ``(i, j)`` with i < j.

    Nothing else is aggregated: products of two dimensions never occur. Each task adds up its own rows, so d(d+1)/2
    numbers leave it, however many rows it has.
    """
    d = len(centre)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches):
        total = [0] * len(pairs)
        for block in _matrices(batches, d):
            z = block - np.array(centre, np.int64)
            z = z.T.copy() if (2 * _top(z)) ** 2 * BLOCK < _SAFE else z.T.astype(object)
            found = []
            for i in range(d):
                both = z[i + 1 :] + z[i]
                found += [(z[i] * z[i]).sum(), *(both * both).sum(axis=1).tolist()]
            total = [t + int(f) for t, f in zip(total, found)]
        yield _rows([[i for i, _ in pairs], [j for _, j in pairs]], total, ["i", "j", "q"])

    got = fit.select("x").mapInArrow(run, "i INT, j INT, q DECIMAL(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q"))
    return {(r.i, r.j): int(r.q) for r in got.collect()}


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance with divisor ``n`` from the variances of dimensions and of their pairwise sums.

    Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2. ``rest`` has the sums of the centred values, which are no zeros
    because the centres are whole numbers. n^2 times a variance is whole, so only the last division rounds.
    """
    d = len(rest)
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return out


class Whitening:
    """A fitted transform: centre, and up to ``components`` unit eigenvectors by falling eigenvalue."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int], centre: list[int], components: int):
        self.n, self.centre = n, centre
        self.rest = [s - n * c for s, c in zip(sums, centre)]
        self.covariance = covariance(n, self.rest, squares)
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.values, self.vectors = values[order], vectors[:, order].T
        self.trace = float(np.trace(self.covariance))
        # a direction without variance has no scale; its values are NULL
        self.open = self.values > max(values[-1], 0) * len(values) * np.finfo(float).eps

    def project(self, block: np.ndarray) -> np.ndarray:
        """Whitened values of rows of whole numbers."""
        z = (block - np.array(self.centre, np.int64)) - np.array([r / self.n for r in self.rest])
        scale = np.sqrt(np.where(self.open, self.values, 1.0))
        return np.where(self.open, z @ self.vectors.T / scale, np.nan)

    def deviations(self, block: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2 of each row, exactly."""
        z = block - np.array(self.centre, np.int64)
        if (self.n * (_top(z) + 1)) ** 2 * max(1, len(self.centre)) < _SAFE:
            y = z * self.n - np.array(self.rest, np.int64)
        else:
            y = z.astype(object) * self.n - np.array(self.rest, object)
        return (y * y).sum(axis=1).tolist()


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, as measured on its rows."""
    k, d = int(model.open.sum()), len(model.centre)

    def run(batches):
        total = np.zeros(k * k + k)
        for block in _matrices(batches, d):
            w = model.project(block)[:, model.open]
            total += np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "v"])

    if not k:
        return 0.0
    got = {r.at: r.v for r in fit.select("x").mapInArrow(run, "at INT, v DOUBLE").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([got[i] for i in range(k * k + k)]) / model.n
    mean = flat[k * k :]
    return float(np.abs(flat[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, shift: int = 1_000_000, components: int = 16
) -> DataFrame:
    """Per row and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    The transform is fitted to every distinct vector once; components number the eigenvectors by falling eigenvalue.
    Vectors that are NULL or hold NULL, NaN or infinite entries give no rows. Vectors have the length that most rows
    have (of equally frequent ones the larger); those of another length get ``deviation`` and ``whitened`` NULL.
    ``whitened`` is also NULL for components without variance, as with a single distinct vector. Repeated rows repeat,
    a NULL id stays, a table without vectors gives no rows, other columns are ignored. ``deviation`` is a decimal of
    38 digits. The driver holds d(d+1)/2 numbers for vectors of d entries.
    """
    spark = df.sparkSession
    rows = grid(df, id_col, vec_col, scale, shift)
    kind = rows.schema["vec_id"].dataType
    schema = StructType([StructField("vec_id", kind)] + StructType.fromDDL("deviation DECIMAL(38,0), whitened ARRAY<DOUBLE>").fields)
    out = "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    rows = staged(rows, "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).where("d > 0")
    usual = sizes.orderBy(F.desc("rows"), F.desc("d")).first()
    if usual is None:
        ddl = "component INT, n BIGINT, deviation DECIMAL(38,0), whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
        return spark.createDataFrame([], StructType([StructField("vec_id", kind)] + StructType.fromDDL(ddl).fields))
    d = usual.d
    fit = staged(rows.where(F.size("x") == d).select("x").distinct(), "distinct")
    n, sums = fit.count(), dimension_sums(fit, d)
    centre = [s // n for s in sums]
    model = Whitening(n, sums, squared_sums(fit, centre), centre, components)
    error = identity_error(fit, model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column("x")
                fits = x.value_lengths().to_numpy(zero_copy_only=False) == d
                block = x.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                place = np.cumsum(fits) - 1
                far = pa.array([Decimal(v) for v in model.deviations(block)], pa.decimal128(38, 0))
                white = model.project(block)
                values = pa.array(white.ravel(), mask=np.isnan(white).ravel())
                white = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1) * white.shape[1], pa.int32()), values)
                where = pa.array(place, mask=~fits)
                empty = pa.array([[None] * len(model.values)], pa.list_(pa.float64()))
                white = pa.concat_arrays([white, empty]).take(where.fill_null(len(block)))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), far.take(where), white], names=schema.names)

    shares = [float(v / model.trace) if model.trace else 0.0 for v in model.values]
    spread = rows.mapInArrow(run, schema).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(s) for s in shares])[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    ).select(*out)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits is NULL here; ``whiten`` has it whole."""
    white = whiten(table(spark, sf_dir, "embeddings"), scale=64, shift=1_000_000, components=16)
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
