"""File streams over the feeds."""

from .streams import (
    land_stream,
    latest_weather_stream,
    page_stream,
    plan_stream,
    rchg_dedup_stream,
    rchg_insert_stream,
    station_hour_stream,
)

__all__ = [
    "land_stream",
    "latest_weather_stream",
    "page_stream",
    "plan_stream",
    "rchg_dedup_stream",
    "rchg_insert_stream",
    "station_hour_stream",
]
