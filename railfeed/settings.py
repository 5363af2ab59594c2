"""Settings of the jobs that may come from the environment."""

from __future__ import annotations

import os

from .schemas import ARCHIVE_FIRST_DAY, HISTORY_MEASURES, REGION_DS100_PATTERN, REGION_NAME_PATTERN


# The names of the environment variables below.


def region_name_pattern() -> str:
    return os.environ.get("DB_TIMETABLES_FILTER_NAME_PREFIX", REGION_NAME_PATTERN)


def region_ds100_pattern() -> str:
    return os.environ.get("DB_TIMETABLES_FILTER_DS100_PREFIX", REGION_DS100_PATTERN)


def region_limit() -> int | None:
    limit = os.environ.get("DB_TIMETABLES_STATIONS_LIMIT")
    return int(limit) if limit else None


def archive_first_day() -> str:
    return os.environ.get("ARCHIVE_START_DATE", ARCHIVE_FIRST_DAY)


def archive_measures() -> list[str]:
    """Measures to request from the archive; the visibility column stays empty unless asked for here."""
    default = ",".join(m for m in HISTORY_MEASURES if m != "visibility")
    return os.environ.get("OPEN_METEO_ARCHIVE_HOURLY", default).split(",")
