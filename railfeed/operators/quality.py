"""Data quality of weather rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import json_map
from .ranking import number_rows

# Ranges outside of which a value is not credible: measure, lowest, highest.
PLAUSIBLE = [
    ("temperature_2m", -60.0, 60.0),
    ("apparent_temperature", -80.0, 70.0),
    ("relative_humidity_2m", 0.0, 100.0),
    ("precipitation", 0.0, 200.0),
    ("precipitation_probability", 0.0, 100.0),
    ("cloud_cover", 0.0, 100.0),
    ("wind_speed_10m", 0.0, 250.0),
    ("pressure_msl", 850.0, 1100.0),
    ("weather_code", 0.0, 99.0),
]

# Alert name, measure, and the value from which it is raised.
EXTREMES = [
    ("heat", "temperature_2m", 35.0),
    ("heavy_rain", "precipitation", 30.0),
    ("storm", "wind_speed_10m", 75.0),
]


def list_length_gaps(objects: DataFrame) -> DataFrame:
    """Measure lists whose length differs from that of ``time``, per weather object."""
    lists = F.try_variant_get("obj", "$.hourly", "map<string,array<variant>>")
    sizes = objects.select(
        "raw_id",
        "batch_id",
        "obj_pos",
        F.transform_values(lists, lambda _, v: F.array_size(v)).alias("sizes"),
    ).withColumn("n_time", F.col("sizes")["time"])
    gaps = F.map_filter("sizes", lambda k, n: (k != "time") & (n != F.col("n_time")))
    return (
        sizes.select("raw_id", "batch_id", "obj_pos", "n_time", F.explode_outer(gaps).alias("measure", "n_values"))
        .filter("measure IS NOT NULL")
    )


def _limits(which: int) -> Column:
    return F.create_map(*[F.lit(x) for rule in PLAUSIBLE for x in (rule[0], rule[which])])


def implausible_values() -> Column:
    """Map of the measures outside their range; measures without a rule are left out."""
    return F.map_filter("measures", lambda k, v: (v < _limits(1)[k]) | (v > _limits(2)[k]))


def range_violations(vertical: DataFrame, *keys: str) -> DataFrame:
    return vertical.select(*keys, F.explode_outer(implausible_values()).alias("measure", "value")).filter("measure IS NOT NULL")


def batch_summary(vertical: DataFrame) -> DataFrame:
    """One pass of conditional counts per batch."""
    missing = lambda name: F.count_if(F.col("measures")[name].isNull())
    return vertical.withColumn("n_bad", F.size(implausible_values())).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("time").isNull()).alias("n_no_time"),
        F.count_if(F.col("station_id").isNull()).alias("n_no_station"),
        missing("temperature_2m").alias("n_no_temperature"),
        missing("precipitation").alias("n_no_precipitation"),
        F.sum("n_bad").alias("n_implausible"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )


def extreme_alerts(hourly: DataFrame, *keys: str) -> DataFrame:
    """One row per hour and exceeded threshold."""
    known = [rule for rule in EXTREMES if rule[1] in hourly.columns]
    hits = F.array_compact(
        F.array(
            *[
                F.when(F.col(m) >= limit, F.struct(F.lit(name).alias("alert"), F.col(m).alias("value")))
                for name, m, limit in known
            ]
        )
    )
    rows = hourly.select(*keys, F.explode_outer(hits).alias("hit")).filter("hit IS NOT NULL")
    return rows.select(*keys, "hit.alert", "hit.value")


def layer_reconcile(objects: DataFrame, vertical: DataFrame) -> DataFrame:
    """Per batch: hours the raw payloads announce against the rows that were written."""
    announced = objects.groupBy("batch_id").agg(
        F.sum(F.array_size(F.try_variant_get("obj", "$.hourly.time", "array<variant>")).cast("bigint")).alias("expected_rows")
    )
    written = vertical.groupBy("batch_id").agg(F.count(F.lit(1)).alias("actual_rows"))
    both = announced.join(written, "batch_id", "full_outer")
    expected, actual = F.coalesce("expected_rows", F.lit(0)), F.coalesce("actual_rows", F.lit(0))
    return both.select(
        "batch_id", expected.alias("expected_rows"), actual.alias("actual_rows"), (expected - actual).alias("missing_rows")
    )


def _keys(raw: DataFrame, doc: Column, *columns: str) -> DataFrame:
    keys = raw.select("batch_id", *columns, F.explode_outer(F.map_keys(json_map(doc))).alias("measure"))
    return keys.filter("measure IS NOT NULL")


def key_changes(raw: DataFrame, doc: Column) -> DataFrame:
    """Keys that a batch has and the batch before it had not, or the other way round.

    Batches follow each other as they arrived, whatever their ids. A key is ``new`` in the first batch that has it (but
    not in the very first batch), ``vanished`` in the first one that lacks it again, ``returning`` when it is back.
    Batches are numbered in range parts and a key is ordered by itself, so no task sees the history of all.
    """
    batches = raw.groupBy("batch_id").agg(F.min("ingested_at").alias("arrived_at")).filter("batch_id IS NOT NULL")
    ordered = number_rows(batches.withColumn("place", F.struct("arrived_at", "batch_id")), "place", "no").select("batch_id", "no")
    has = _keys(raw, doc).select("batch_id", "measure").distinct().join(ordered, "batch_id")
    of_key = Window.partitionBy("measure").orderBy("no")
    around = has.withColumns({"before": F.lag("no").over(of_key), "after": F.lead("no").over(of_key)})
    came = F.when(F.col("before").isNull(), F.when(F.col("no") > 1, "new")).when(F.col("before") < F.col("no") - 1, "returning")
    gone = F.when(F.coalesce(F.col("after") > F.col("no") + 1, F.lit(True)), "vanished")
    told = F.array(F.struct(F.col("no"), came.alias("change")), F.struct((F.col("no") + 1).alias("no"), gone.alias("change")))
    changes = around.select("measure", F.explode(told).alias("c")).select("measure", "c.*").filter("change IS NOT NULL")
    # after the last batch there is none in which a key could be missing
    return changes.join(ordered, "no").select("batch_id", "measure", "change")


def measure_drift(raw: DataFrame, doc: Column) -> DataFrame:
    """Keys per batch, and whether the batch is the first one to carry the key, by its id; ``key_changes`` goes by arrival."""
    per_batch = _keys(raw, doc).groupBy("batch_id", "measure").agg(F.count(F.lit(1)).alias("n_payloads"))
    first = per_batch.groupBy("measure").agg(F.min("batch_id").alias("first_batch"))
    return per_batch.join(first, "measure").select(
        "batch_id", "measure", "n_payloads", (F.col("batch_id") == F.col("first_batch")).alias("is_new")
    )
