"""Time the headline queries and print one JSON line.

Each query is run to the end without keeping its rows; the best of the repeats is reported. Raw payload
tables are written before the clock starts, as a warehouse would find them. With ``BENCH_JOBS=1`` whole jobs follow.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from railfeed.checks import QUERIES  # noqa: E402
from railfeed.checks import fixtures as fx  # noqa: E402
from railfeed.plans.jobs import Warehouse  # noqa: E402
from railfeed.session import get_session, work_dir  # noqa: E402

HEADLINE = [
    "weather_vertical_forecast",
    "weather_vertical_history",
    "weather_forecast_hourly",
    "station_match_nearest",
    "station_latest",
    "fchg_events",
    "plan_events",
    "rchg_events",
    "plan_vs_change",
    "rchg_insert_ignore",
    "station_hour_kpi",
    "weather_asof",
    "page_concat",
    "api_perf",
    "process_state",
]
REPEATS = 3


JOB_SECONDS = 180


def _jobs(spark, sf_dir: str) -> dict[str, float]:
    """Whole jobs over landed batches: the second poll of recent changes meets a filled target. Late ones are left out."""
    house, seconds, begin = Warehouse(spark, work_dir(spark, "bench")), {}, time.perf_counter()
    docs, weather, stations = fx.timetable_raw(spark, sf_dir), fx.history_raw(spark, sf_dir), fx.station_raw(spark, sf_dir)
    house.ingest("db_stations", stations.select("payload"), dt.datetime(2024, 1, 1))
    jobs = [
        ("transform_weather_history", "weather_history", weather, lambda: house.transform_weather("weather_history")),
        ("transform_rchg_first", "timetables_rchg", docs, house.transform_rchg),
        ("transform_rchg_known", "timetables_rchg", docs, house.transform_rchg),
    ]
    for at, (name, feed, raw, job) in enumerate(jobs):
        if time.perf_counter() - begin > JOB_SECONDS:
            break
        house.ingest(feed, raw.select("payload"), dt.datetime(2024, 1, 1, 0, 0, at))
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for raw in (fx.station_raw, fx.forecast_raw, fx.history_raw, fx.timetable_raw):
        raw(spark, sf_dir)
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    headline = round(sum(seconds.values()), 3)
    if os.environ.get("BENCH_JOBS") == "1":
        seconds |= _jobs(spark, sf_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": headline,
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
