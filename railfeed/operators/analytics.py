"""Consumer questions over the modelled tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ranking import latest_per_key


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty for a latest view."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def ingested_on(raw: DataFrame, day: dt.date) -> DataFrame:
    """Rows that arrived on a day, as a time range, which file statistics can prune."""
    start = F.lit(day.isoformat()).cast("timestamp_ntz")
    end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return raw.filter((F.col("ingested_at") >= start) & (F.col("ingested_at") < end))


def payload_peek(raw: DataFrame, n: int, *newest_first: Column, chars: int = 200) -> DataFrame:
    """Start of the newest payloads, as a report; stored payloads stay whole."""
    head = F.substring("payload", 1, chars).alias("payload_head")
    return raw.select(*[c for c in raw.columns if c != "payload"], head).orderBy(*newest_first).limit(n)


def incidents(events: DataFrame) -> DataFrame:
    return events.filter((F.col("type") == "h") & (F.col("category") == "Störung"))


def delays(events: DataFrame) -> DataFrame:
    return events.filter(F.col("type").isin("d", "f") & F.col("delay_in_min").isNotNull())


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def station_hour_kpi(events: DataFrame, station: str, ts: str, delay: Column, incident: Column) -> DataFrame:
    """Events, mean delay and incidents per station and hour.

    The mean comes from an exact decimal sum, so it does not depend on the order of partial sums.
    """
    exact = delay.cast("decimal(18,2)")
    return events.groupBy(station, hour_of(F.col(ts)).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_events"),
        (F.sum(exact).cast("double") / F.count(exact)).alias("mean_delay"),
        F.count_if(incident).alias("n_incidents"),
    )


def plan_vs_change(plan: DataFrame, changes: DataFrame) -> DataFrame:
    """Planned rows with the latest change of the same ride and direction, and the delay in minutes."""
    nodes = changes.filter(F.col("event_type").isin("ar", "dp"))
    newest = latest_per_key(
        nodes.select("event_id", "event_type", "new_time", "timestamp_event", "delay_minutes", "event_hash"),
        ["event_id", "event_type"],
        [F.desc("timestamp_event"), F.asc("event_hash")],
    ).withColumnRenamed("event_type", "change_node")
    joined = plan.join(
        newest, (F.col("train_line_ride_id") == F.col("event_id")) & (plan["event_type"] == F.col("change_node")), "left"
    )
    delay = F.timestamp_diff("MINUTE", F.col("event_time"), F.col("new_time"))
    return joined.select(
        "station_name", "train_line_ride_id", "event_type", F.col("event_time").alias("planned_time"),
        F.col("new_time").alias("changed_time"), delay.alias("delay_min"), "delay_minutes",
    )


def rail_weather_features(kpi: DataFrame, weather: DataFrame, station: str) -> DataFrame:
    """Hourly indicators of a station beside its weather of the same hour.

    Events are summed up per station and hour first, so a busy station joins as few rows as a quiet one.
    """
    return kpi.join(weather, [station, "hour"], "left")


def rail_weather(events: DataFrame, hourly: DataFrame) -> DataFrame:
    """Modelled rail events per station and hour beside the modelled weather of that station and hour.

    Events carry the station's eva number and a time, the hourly view the eva number and an ISO text without seconds;
    weather of unknown stations or unreadable times joins nothing.
    """
    kpi = station_hour_kpi(events, "eva_number", "event_time", F.col("delay_in_min"), F.col("is_canceled"))
    weather = hourly.filter("eva_number IS NOT NULL").withColumn("hour", F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz"))
    return rail_weather_features(kpi, weather.drop("batch_id", "psa_id", "time"), "eva_number")


def weather_asof(events: DataFrame, weather: DataFrame, station: str, ts: str, values: list[str]) -> DataFrame:
    """Each event with the last hourly weather of its station at or before its hour.

    Only the distinct hours of a station are ordered, so the window grows with the calendar and not with
    the events; events then join their hour by equality.
    """
    struct = F.struct(F.col("hour").alias("weather_hour"), *values)
    known = weather.select(station, "hour", struct.alias("w"))
    asked = events.select(station, hour_of(F.col(ts)).alias("hour")).distinct()
    hours = known.unionByName(asked.withColumn("w", F.lit(None).cast(known.schema["w"].dataType)))
    # at an equal hour the weather row comes first, so that its hour counts
    so_far = (
        Window.partitionBy(station)
        .orderBy("hour", F.col("w").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = (
        hours.withColumn("last", F.last("w", ignorenulls=True).over(so_far))
        .filter(F.col("w").isNull())
        .select(station, "hour", "last.*")
    )
    return events.withColumn("hour", hour_of(F.col(ts))).join(filled, [station, "hour"], "left").drop("hour")


def rail_weather_asof(events: DataFrame, hourly: DataFrame, within_hours: int) -> DataFrame:
    """``rail_weather`` where an hour without weather takes the last one of its station, if it is no older than that."""
    kpi = station_hour_kpi(events, "eva_number", "event_time", F.col("delay_in_min"), F.col("is_canceled"))
    hour = F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz")
    weather = hourly.withColumn("hour", hour).filter("eva_number IS NOT NULL AND hour IS NOT NULL").drop("batch_id", "psa_id", "time")
    values = [c for c in weather.columns if c not in ("eva_number", "hour")]
    joined = weather_asof(kpi.withColumn("at", F.col("hour")).drop("hour"), weather, "eva_number", "at", values)
    fresh = F.timestamp_diff("HOUR", F.col("weather_hour"), F.col("at")) <= within_hours
    taken = {c: F.when(fresh, F.col(c)) for c in ["weather_hour", *values]}
    return joined.withColumns(taken).withColumnRenamed("at", "hour")


#: Size parameter of the quantile sketches: ranks are off by about 1.33 % at most (99 % of the time).
SKETCH_K = 200


def call_sketches(log: DataFrame) -> DataFrame:
    """Per source, endpoint and day: calls, a quantile sketch of the response times and a sketch of the distinct calls.

    Sketches of days merge into those of any span, so weekly or monthly figures never read the log again, and a call
    logged later is added by merging the sketch of its own.
    """
    return log.groupBy("source", "endpoint", F.to_date("called_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.kll_sketch_agg_bigint(F.col("response_time_ms").cast("bigint"), F.lit(SKETCH_K)).alias("ms"),
        F.hll_sketch_agg("params").alias("calls"),
    )


def sketched_performance(sketches: DataFrame, *by: Column, quantile: float = 0.95) -> DataFrame:
    """Response time at a quantile and number of distinct calls of any span of days, merged from ``call_sketches``."""
    merged = sketches.groupBy("source", "endpoint", *by).agg(
        F.sum("n_calls").alias("n_calls"), F.kll_merge_agg_bigint("ms").alias("ms"), F.hll_union_agg("calls").alias("calls")
    )
    at = F.kll_sketch_get_quantile_bigint("ms", F.lit(quantile))
    return merged.withColumns({"ms": at, "calls": F.hll_sketch_estimate("calls")}).withColumnsRenamed({"ms": "quantile_ms", "calls": "n_distinct"})


def api_performance(log: DataFrame) -> DataFrame:
    """Calls, status mix and response times per source, endpoint and day.

    Exact percentile: response times are whole milliseconds below the request timeout, so the counts per
    value it merges stay small.
    """
    ms = F.col("response_time_ms")
    return log.groupBy("source", "endpoint", F.to_date("called_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(F.col("status_code").between(200, 299)).alias("n_success"),
        F.count_if(F.col("status_code") >= 400).alias("n_failed"),
        F.round(F.avg(ms), 6).alias("avg_ms"),
        F.round(F.percentile(ms, 0.95), 6).alias("p95_ms"),
        F.max(ms).alias("max_ms"),
        F.sum(F.col("result_count").cast("bigint")).alias("n_results"),
    )
