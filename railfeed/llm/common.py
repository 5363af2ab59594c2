"""Helpers shared by the operators: tables, scratch data, Arrow passes, connected groups."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from railfeed.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and reread, which cuts the lineage and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: str = "16m"):
    """Arrow batches of at most ``size`` for jobs run inside, where rows may be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hash_bitmap(df: DataFrame, column: str, bits: int):
    """A broadcast bitmap with two bits set per 64-bit hash. Its size is fixed; more hashes only set more of its bits."""
    at = [F.shiftrightunsigned(column, shift).bitwiseAND(F.lit(bits - 1)) for shift in _SHIFTS]
    df = df.select(F.explode(F.array(*at)).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(31)).cast("int"))
    words = df.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(one).alias("set")).toArrow()
    out = np.zeros(bits // 32, "<u4")
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().astype(np.uint32)
    return df.sparkSession.sparkContext.broadcast(out.tobytes())


_SHIFTS = (4, 36)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in a bitmap, given as bytes; all that are in it, and a few others."""
    out = np.ones(len(hashes), bool)
    for shift in _SHIFTS:
        bit = (hashes >> np.uint64(shift)) & np.uint64(8 * len(bitmap) - 1)
        out &= ((bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out


def maybe_in(bitmap, column: Column) -> Column:
    """``in_bitmap`` for a column of hashes; false for NULL."""

    @F.arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        found = in_bitmap(np.frombuffer(bitmap.value, np.uint8), values.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
        return pa.array(found & ~values.is_null().to_numpy(zero_copy_only=False))

    return test(column)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, so extra columns cannot clash; a NULL text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema_of(df: DataFrame, *fields: str, keep: tuple[str, ...] = ("doc_id",)) -> StructType:
    """The kept columns of ``df`` followed by fields written as DDL."""
    added = StructType.fromDDL(", ".join(fields)) if fields else StructType()
    return StructType([StructField(c, df.schema[c].dataType) for c in keep] + added.fields)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small runs of rows, so that no more than a few texts are held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected graph ``(u, v)``; root is the smallest node reachable.

    Alternates two star contractions until the edges stop changing, which takes a number of rounds that grows with
    the logarithm of the nodes. Minima are pre-aggregated per task, joins can be split by adaptive execution, and
    every round is written to the shared folder.
    """
    edges = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")  # the last one is read by the result
    seen = _signature(edges)
    while seen[0]:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(low.select("u", F.col("m").alias("v")))
        before, edges = edges, staged(small.where("u <> v").distinct(), "small-star")
        release(before, large)
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def each_text(df: DataFrame, fields: list[str], fn: Callable, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the kept columns and ``fn(text)``, a tuple of the fields."""
    schema = schema_of(df, *fields, keep=keep)
    names = [f.name for f in schema.fields[len(keep) :]]

    def run(batches):
        arrow = None
        for part in slices(batches):
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                arrow = to_arrow_schema(schema)
            got = [fn(x) for x in part.column(part.schema.get_field_index("text")).to_pylist()]
            columns = [part.column(part.schema.get_field_index(c)) for c in keep]
            columns += [pa.array([g[i] for g in got], type=arrow.field(n).type) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return df.select(*keep, "text").mapInArrow(run, schema)

