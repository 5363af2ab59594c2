"""Batch-partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import staged

RAW_SCHEMA = "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ, batch_id STRING"


def write_partitions(df: DataFrame, path: str, *partitions: str, rebalance: bool = False, sort: tuple[str, ...] = ()) -> None:
    """Write, replacing exactly the partitions present in ``df``; a rerun replaces instead of doubling.

    ``rebalance`` lets adaptive execution cut hot partitions and join small ones into well-sized files.
    ``sort`` orders the rows of a file, so that file statistics can skip row groups.
    """
    if rebalance:
        df = df.hint("rebalance", *partitions)
    if sort:
        df = df.sortWithinPartitions(*partitions, *sort)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def numbered(df: DataFrame) -> DataFrame:
    """Landed rows with ids 0, 1, 2, ... in the order they were landed."""
    parts = staged(df.select(F.monotonically_increasing_id().alias("at"), "payload", "ingested_at", "batch_id"), "numbered")
    # an id is the part of the frame above bit 33 and the place in it below: written down, neither changes any more
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parts.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part of the frame
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = parts.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return rows.select((F.col("_start") + place).alias("raw_id"), "payload", "ingested_at", "batch_id")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    # the schema is given: inference would turn an all-digit batch id into a number
    return spark.read.schema(RAW_SCHEMA).parquet(path).select("raw_id", "payload", "ingested_at", "batch_id")


def scan_batch(table: DataFrame, *batch_ids: str) -> DataFrame:
    """Rows of the given batches; the filter prunes partitions."""
    return table.filter(F.col("batch_id").isin(*batch_ids))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a table or scratch folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
