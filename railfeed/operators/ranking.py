"""Latest version per key and gap-free numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import work_dir


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``; NULL keys form one group.

    Spark limits each map task to one row per key before the shuffle, so a hot key does not pile up.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def number_rows(df: DataFrame, order: str, name: str = "row_no") -> DataFrame:
    """1, 2, 3, ... in the order of a unique column, without one task seeing all rows.

    Range parts are written once, since a range shuffle need not cut at the same place when repeated.
    """
    spark = df.sparkSession
    path = work_dir(spark, "numbered")
    df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    parts = spark.read.parquet(path)
    # one row per range part, so at most as many as there are shuffle partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_part").orderBy(order)
    return (
        parts.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.row_number().over(within))
        .drop("_part", "_start")
    )
