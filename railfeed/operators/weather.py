"""Weather payloads to one row per station and hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import json_array, json_map, parse_json
from ..schemas import FORECAST_MEASURES, HISTORY_MEASURES, INTEGER_MEASURES
from ..session import staged
from ..sources.tables import write_partitions
from .matching import StationIndex, stored_matches
from .ranking import latest_per_key


def weather_objects(raw: DataFrame, history: bool = False) -> DataFrame:
    """One row per weather object: history payloads may be a list, ``{results: [...]}`` or one object."""
    parsed = raw.select("raw_id", "batch_id", parse_json(F.col("payload")).alias("doc"))
    doc = F.col("doc")
    objects = F.coalesce(json_array(doc), json_array(doc, "$.results"), F.array(doc)) if history else F.array(doc)
    return parsed.select("raw_id", "batch_id", F.posexplode_outer(objects).alias("obj_pos", "obj"))


def _coordinate(name: str) -> Column:
    return F.try_variant_get("obj", f"$.{name}", "double")


def _unreadable(name: str) -> Column:
    text = F.try_variant_get("obj", f"$.{name}", "variant")
    return text.isNotNull() & ~F.is_variant_null(text) & _coordinate(name).isNull()


def quarantine_reason() -> Column:
    """Why an object yields no rows; NULL when it does."""
    hourly = F.try_variant_get("obj", "$.hourly", "map<string,variant>")
    times = F.try_variant_get("obj", "$.hourly.time", "array<variant>")
    return (
        F.when(F.col("obj").isNull(), "not_json")
        .when(json_map(F.col("obj")).isNull(), "not_object")
        .when(_unreadable("latitude"), "bad_latitude")
        .when(_unreadable("longitude"), "bad_longitude")
        .when(hourly.isNull(), "no_hourly")
        .when(F.map_contains_key(hourly, "time") & times.isNull(), "time_not_list")
    )


def weather_quarantine(objects: DataFrame) -> DataFrame:
    """Rejected objects with the reason; one bad object does not touch its neighbours."""
    return (
        objects.withColumn("reason", quarantine_reason())
        .filter("reason IS NOT NULL")
        .select("raw_id", "batch_id", "obj_pos", "reason")
    )


def _doubles(value: Column) -> Column:
    """List of doubles, or NULL for anything but a list.

    A list of plain numbers is read at once; VARIANT casts one element at a time, which is several times
    slower but keeps the good elements of a mixed list.
    """
    numbers = F.from_json(F.to_json(value), "ARRAY<DOUBLE>")
    return F.coalesce(numbers, F.try_variant_get(value, "$", "array<double>"))


def _with_lists(objects: DataFrame, exact: bool) -> DataFrame:
    """Typed lists of an object, read once: inside a lambda they would be read again for every hour."""

    def lists(read: Callable[[Column], Column]) -> Column:
        # times are left out first: read as numbers, each list of them would fail, which is dear
        measures = F.map_filter(json_map(F.col("obj"), "$.hourly"), lambda k, _: k != "time")
        return F.map_filter(F.transform_values(measures, lambda _, v: read(v)), lambda _, v: v.isNotNull())

    columns = {"lists": lists(_doubles), "times": F.try_variant_get("obj", "$.hourly.time", "array<string>")}
    if exact:
        columns["sent"] = lists(json_array)
    return objects.withColumns(columns).drop("obj")


def _hours(exact: bool) -> Column:
    """Array of (pos, time, measures): built per object, so lists are not copied to every hour.

    Keys that hold no list are ignored, lists shorter than ``time`` end early, NULL measures are dropped. ``measures``
    has what reads as a number. With ``exact``, ``payload`` has every value that is not null as JSON text of the type
    it was sent with: numbers, text, true and false, lists and objects.
    """

    def one(time: Column, pos: Column) -> Column:
        values = F.transform_values("lists", lambda _, v: F.get(v, pos))
        fields = [pos.alias("pos"), time.alias("time"), F.map_filter(values, lambda _, v: v.isNotNull()).alias("measures")]
        if exact:
            sent = F.transform_values("sent", lambda _, v: F.get(v, pos))
            fields.append(F.to_json(F.map_filter(sent, lambda _, v: v.isNotNull() & ~F.is_variant_null(v))).alias("payload"))
        return F.struct(*fields)

    return F.transform("times", one)


def weather_vertical(objects: DataFrame, index: StationIndex | None, exact: bool = False) -> DataFrame:
    """One row per object and hour. Stations are matched per distinct coordinate, before hours are spread.

    ``exact`` adds ``payload``: the hour's values as they were sent, beside the numbers in ``measures``.
    """
    usable = _with_lists(
        objects.filter(~(_unreadable("latitude") | _unreadable("longitude"))).withColumns(
            {"latitude": _coordinate("latitude"), "longitude": _coordinate("longitude")}
        ),
        exact,
    )
    return _spread(_located(usable, index), _hours(exact), exact)


def _located(objects: DataFrame, index: StationIndex | None) -> DataFrame:
    if index is None:
        return objects.withColumn("station_id", F.lit(None).cast("string"))
    return objects.join(stored_matches(objects, index), ["latitude", "longitude"], "left")


def _spread(located: DataFrame, hours: Column, exact: bool) -> DataFrame:
    # the outer form with a later filter keeps the payload from being parsed again for a size check
    spread = located.select(
        "raw_id", "batch_id", "obj_pos", "station_id", "latitude", "longitude", F.explode_outer(hours).alias("h")
    ).filter("h IS NOT NULL")
    return spread.select(
        F.col("raw_id").alias("psa_id"), "obj_pos", "batch_id", "station_id", "latitude", "longitude", "h.pos", "h.time", "h.measures",
        *(["h.payload"] if exact else []),
    )


def _odd_values() -> Column:
    """Measures of an object that are no lists, and values in lists that are no numbers, as (field, reason, text)."""

    def told(field: Column, reason: str, value: Column) -> Column:
        return F.struct(field.alias("field"), F.lit(reason).alias("reason"), F.to_json(value).alias("text"))

    other = F.map_filter("others", lambda _, v: ~F.is_variant_null(v))
    no_lists = F.transform(F.map_entries(other), lambda e: told(e["key"], "not_a_list", e["value"]))
    unread = F.map_zip_with(
        "lists",
        "sent",
        lambda k, read, sent: F.array_compact(
            F.zip_with(read, sent, lambda x, y: F.when(x.isNull() & y.isNotNull() & ~F.is_variant_null(y), told(k, "not_a_number", y)))
        ),
    )
    return F.coalesce(F.concat(no_lists, F.flatten(F.map_values(unread))), no_lists, F.expr("array()"))


def parsed_objects(raw: DataFrame, history: bool = False) -> DataFrame:
    """One row per object with its hours as an array, ``reject`` where it gives none, and the values that do not read.

    ``n_hours`` is what the object announces, read or not.
    """
    objects = weather_objects(raw, history)
    others = F.map_filter(json_map(F.col("obj"), "$.hourly"), lambda k, v: (k != "time") & json_array(v).isNull())
    known = objects.withColumns(
        {"reason": quarantine_reason(), "latitude": _coordinate("latitude"), "longitude": _coordinate("longitude"), "others": others}
    )
    return _with_lists(known, exact=True).select(
        "raw_id", "batch_id", "obj_pos", "latitude", "longitude",
        F.coalesce(F.array_size("times"), F.lit(0)).alias("n_hours"),
        F.when(F.col("reason").isNull(), _hours(True)).alias("hours"),
        F.when(F.col("reason").isNotNull(), F.struct("reason")).alias("reject"),
        F.when(F.col("reason").isNull(), _odd_values()).otherwise(F.expr("array()")).alias("errors"),
    )


def placed_hours(objects: DataFrame, index: StationIndex | None) -> DataFrame:
    """One row per hour of written ``parsed_objects``, with the station its place belongs to."""
    return _spread(_located(objects, index), F.col("hours"), exact=True)


def _measure(name: str) -> Column:
    value = F.col("measures")[name]
    if name in INTEGER_MEASURES:
        # a fraction is no valid code
        value = F.when(value == F.floor(value), value.try_cast("int"))
    return value.alias(name)


_VERSION = [F.desc_nulls_first, F.desc, F.desc, F.desc]
_VERSION_BY = ["batch_id", "psa_id", "obj_pos", "pos"]


def weather_hourly(vertical: DataFrame, stations: DataFrame, measures: list[str]) -> DataFrame:
    """Latest batch per station and hour, with station attributes.

    The key is the dimension's station id: rows of stations it does not know share the NULL key.
    """
    return _latest_hours(vertical, stations, measures).drop("obj_pos", "pos")


def _latest_hours(vertical: DataFrame, stations: DataFrame, measures: list[str]) -> DataFrame:
    """``weather_hourly`` with all that orders versions, so that a later one can be compared with it."""
    dim = stations.select(
        F.col("station_id").alias("dim_id"), F.col("name").alias("station_name"), "ds100", "eva_number"
    )
    rows = vertical.filter(F.col("time").isNotNull() & F.col("station_id").isNotNull()).select(
        *_VERSION_BY, "latitude", "longitude", "station_id", "time", *[_measure(m) for m in measures]
    )
    joined = rows.join(dim, rows["station_id"] == dim["dim_id"], "left").drop("station_id")
    latest = latest_per_key(joined, ["dim_id", "time"], [f(c) for f, c in zip(_VERSION, _VERSION_BY)])
    return latest.select(
        "psa_id", "batch_id", "latitude", "longitude", F.col("dim_id").alias("station_id"),
        "station_name", "ds100", "eva_number", "time", *measures, "obj_pos", "pos",
    )


def forecast_hourly(vertical: DataFrame, stations: DataFrame) -> DataFrame:
    return weather_hourly(vertical, stations, FORECAST_MEASURES)


def history_hourly(vertical: DataFrame, stations: DataFrame) -> DataFrame:
    return weather_hourly(vertical, stations, HISTORY_MEASURES)


VERTICAL_SCHEMA = (
    "psa_id BIGINT, obj_pos INT, station_id STRING, latitude DOUBLE, longitude DOUBLE, pos INT, time STRING, "
    "measures MAP<STRING, DOUBLE>, payload STRING, day STRING, batch_id STRING, load STRING"
)


def _day(time: Column) -> Column:
    """Day of an ISO time; any other text shares one partition."""
    return F.when(time.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(time, 1, 10)).otherwise("other")


def write_vertical(vertical: DataFrame, path: str, load: str = "all") -> None:
    """Add by day, batch and load; repeating a load replaces it and no other.

    A job writes whole batches and needs one load; a stream names a load per micro-batch, as a batch may be spread
    over several of them.
    """
    rows = vertical.withColumns({"day": _day(F.col("time")), "load": F.lit(load)})
    write_partitions(rows, path, "day", "batch_id", "load", rebalance=True, sort=("station_id", "time"))


def read_vertical(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VERTICAL_SCHEMA).parquet(path)


#: The stored view is cut by day and by station bucket, so that a correction for one station rewrites little.
STATION_BUCKETS = 8


def _keyed(hours: DataFrame) -> DataFrame:
    bucket = F.pmod(F.xxhash64("station_id"), F.lit(STATION_BUCKETS)).cast("int")
    return hours.withColumns({"day": _day(F.col("time")), "bucket": bucket})


def refresh_hours(spark: SparkSession, rows: DataFrame, target: str, stations: DataFrame, measures: list[str]) -> int:
    """Bring new rows of the vertical table into the stored latest view; returns how many hours they are about.

    A stored hour carries the version it came from, and of it and the new one the newer stays. So only the buckets and
    days of the new rows are read and written, and the vertical table is not read at all. Any order and any repetition
    of the rows gives the same view. Hours keep the key they had when they came: after a change of the dimension,
    ``rebuild_hours`` gives stations that have become known their own rows.
    """
    fresh = staged(_keyed(_latest_hours(rows, stations, measures)), "fresh")
    touched = fresh.groupBy("day", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # calendar days times buckets
    if not touched:
        return 0
    merged = fresh
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        stored = spark.read.schema(fresh.schema).parquet(target)
        stored = stored.filter(F.col("day").isin(sorted({r.day for r in touched})) & F.col("bucket").isin(sorted({r.bucket for r in touched})))
        stored = stored.join(fresh.select("day", "bucket").distinct(), ["day", "bucket"], "left_semi")
        both = fresh.unionByName(stored)
        merged = staged(latest_per_key(both, ["station_id", "time"], [f(c) for f, c in zip(_VERSION, _VERSION_BY)]), "merged")
    write_partitions(merged, target, "day", "bucket", rebalance=True, sort=("station_id", "time"))
    return sum(r.n for r in touched)


def rebuild_hours(spark: SparkSession, vertical: str, target: str, stations: DataFrame, measures: list[str]) -> None:
    """The stored latest view from the whole vertical table, with the stations of today."""
    whole = staged(_keyed(_latest_hours(read_vertical(spark, vertical), stations, measures)), "rebuilt")
    whole.hint("rebalance", "day", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day", "bucket").parquet(target)


def read_hours(spark: SparkSession, target: str) -> DataFrame:
    """The stored latest view."""
    return spark.read.parquet(target).drop("day", "bucket", "obj_pos", "pos")
