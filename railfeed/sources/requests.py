"""What to request: plan hours, coordinate groups, archive window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .. import settings
from ..functions import local_wall_clock
from ..operators.ranking import number_rows
from ..schemas import (
    ARCHIVE_LAG_DAYS,
    COORDS_PER_REQUEST,
    FALLBACK_COORDINATE,
    LOCAL_ZONE,
    PLAN_HOURS,
)


def plan_request_grid(stations: DataFrame, logical: Column, zone: str = LOCAL_ZONE) -> DataFrame:
    """Each station times the wall-clock hours of its logical day and the first six of the next.

    Always 30 slots, also on days when the clocks change: hours are counted on the wall clock.
    """
    midnight = F.date_trunc("day", local_wall_clock(logical, zone)).cast("timestamp_ntz")
    slots = stations.select(
        "eva_number", midnight.alias("midnight"), F.explode(F.sequence(F.lit(0), F.lit(PLAN_HOURS - 1))).alias("slot")
    )
    hour = F.col("midnight") + F.make_dt_interval(hours=F.col("slot"))
    return slots.select(
        "eva_number",
        F.date_format(hour, "yyMMdd").alias("date_yymmdd"),
        F.date_format(hour, "HH").alias("hour_hh"),
    )


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.round(v, 6).cast("string")), ",")


def coord_batches(coords: DataFrame, order: str, size: int = COORDS_PER_REQUEST, fallback: bool = True) -> DataFrame:
    """Request groups of at most ``size`` coordinates, in the order of the unique column ``order``."""
    numbered = number_rows(coords.select(order, "latitude", "longitude"), order)
    groups = (
        numbered.withColumn("request_no", F.floor((F.col("row_no") - 1) / size))
        .groupBy("request_no")
        .agg(F.array_sort(F.collect_list(F.struct("row_no", "latitude", "longitude"))).alias("c"))
    )
    requests = groups.select(
        "request_no",
        F.size("c").alias("station_count"),
        _joined(F.col("c.latitude")).alias("latitude"),
        _joined(F.col("c.longitude")).alias("longitude"),
    )
    if not fallback:
        return requests
    lat, lon = FALLBACK_COORDINATE
    # a grand total has exactly one row even over no coordinates at all
    default = (
        coords.agg(F.count(F.lit(1)).alias("n"))
        .filter("n = 0")
        .select(
            F.lit(0).cast("bigint").alias("request_no"),
            F.lit(1).alias("station_count"),
            F.lit(str(lat)).alias("latitude"),
            F.lit(str(lon)).alias("longitude"),
        )
    )
    return requests.unionByName(default)


def archive_window(
    api_log: DataFrame, today: dt.date, first_day: str | None = None, require_results: bool = False
) -> DataFrame:
    """Next archive request: from the last answered end date to two days ago, both inclusive.

    ``require_results`` ignores calls that answered without data; by default they move the window too.
    """
    calls = api_log.filter(
        (F.col("source") == "open_meteo")
        & (F.col("endpoint") == "archive")
        & F.col("status_code").between(200, 299)
        & F.array_contains(F.json_object_keys("params"), "end_date")
    )
    if require_results:
        calls = calls.filter(F.col("result_count") > 0)
    end_date = F.get_json_object("params", "$.end_date")
    # a call without time sorts as the newest one
    newest = F.struct(F.col("called_at").isNull(), F.col("called_at"), end_date)
    last = F.max_by(end_date, newest)
    return calls.agg(last.alias("last_end")).select(
        F.coalesce(F.nullif(F.col("last_end"), F.lit("")), F.lit(first_day or settings.archive_first_day())).alias("start_date"),
        F.lit((today - dt.timedelta(days=ARCHIVE_LAG_DAYS)).isoformat()).alias("end_date"),
    )
