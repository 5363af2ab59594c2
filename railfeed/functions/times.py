"""Time formats of the feeds.

Modelled times are TIMESTAMP_NTZ in UTC, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def compact_to_iso(value: Column) -> Column:
    """``YYMMDDHHMM`` to ISO text; anything but ten digits gives NULL. No calendar check here."""
    parts = [F.substring(value, i, 2) for i in (1, 3, 5, 7, 9)]
    text = F.concat(
        F.lit("20"), parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2],
        F.lit("T"), parts[3], F.lit(":"), parts[4], F.lit(":00Z"),
    )
    return F.when(value.rlike("^[0-9]{10}$"), text)


def dashed_to_iso(value: Column) -> Column:
    """``yy?MM?dd?HH?mm?ss`` by position; separators and any fraction are ignored."""
    parts = [F.substring(value, i, 2) for i in (1, 4, 7, 10, 13)]
    seconds = F.lpad(F.substring(value, 16, 2), 2, "0")
    text = F.concat(
        F.lit("20"), parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2],
        F.lit("T"), parts[3], F.lit(":"), parts[4], F.lit(":"), seconds, F.lit("Z"),
    )
    return F.when(value.rlike("^([0-9]{2}.){5}([0-9]{2}|[0-9]$)"), text)


def iso_to_ts(iso: Column, source_tz: str = "UTC") -> Column:
    """ISO text to UTC time; an impossible date gives NULL instead of failing the batch."""
    ts = F.substring(iso, 1, 19).try_cast("timestamp_ntz")
    return ts if source_tz == "UTC" else F.convert_timezone(F.lit(source_tz), F.lit("UTC"), ts)


def compact_to_ts(value: Column, source_tz: str = "UTC") -> Column:
    return iso_to_ts(compact_to_iso(value), source_tz)


def local_wall_clock(utc: Column, zone: str) -> Column:
    """Same instant on the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
