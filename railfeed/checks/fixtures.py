"""Feed payloads as text, each built from one row of a given table.

No fixture groups or joins rows, so payloads stay small and the work grows with the table, whatever its
keys look like. The SQL side (``expected``) states the same records without ever seeing payload text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir
from ..sources.tables import read_raw, write_partitions

col, lit = F.col, F.lit

_LANDED: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Raw table as it lies on disk after landing, written once per session and table folder.

    Jobs read payloads as stored text; built in place, a payload would be built again for each use of it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = work_dir(spark, f"raw-{name}")
        write_partitions(build(spark, sf_dir), path, "batch_id")
        _LANDED[key] = path
    return read_raw(spark, _LANDED[key])


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Like ``_landed`` for records without the raw table's columns."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = work_dir(spark, f"raw-{name}")
        build(spark, sf_dir).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def _items(n: Column, make: Callable[[Column], Column]) -> Column:
    """make(0), ..., make(n - 1); n may be 0."""
    return F.transform(F.filter(F.sequence(lit(0), n.cast("int")), lambda i: i < n), make)


def _text(value: Column) -> Column:
    return value.cast("string")


def _pick(selector: Column, *values: str | Column | None) -> Column:
    if not any(isinstance(value, Column) for value in values):
        # a constant list, where a CASE would work the selector out once per value
        return F.get(F.array(*[lit(value) for value in values]), selector.cast("int"))
    out = None
    for i, value in enumerate(values):
        value = value if isinstance(value, Column) else lit(value)
        out = F.when(selector == i, value) if out is None else out.when(selector == i, value)
    return out


def _spread(df: DataFrame) -> DataFrame:
    """Building text is pure CPU work per row: give every core a share, whatever the file layout."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def _versions(df: DataFrame) -> DataFrame:
    return df.withColumn("b", F.explode(F.array(lit(0), lit(1))))


def _arrival(b: Column) -> Column:
    return lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=b)


# ---------------------------------------------------------------- stations


def station_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stations", station_rows)


def station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per supplier; every third comes again a day later under a new name."""
    rows = _versions(table(spark, sf_dir, "supplier")).filter("b = 0 OR s_suppkey % 3 = 0")
    sk, nk, b = col("s_suppkey"), col("s_nationkey"), col("b")

    def eva(i: Column) -> Column:
        lon = (6000000 + (sk * 104729 + i * 5003) % 9000000) / 1e6
        lat = (47000000 + (sk * 102947 + i * 10007) % 8000000) / 1e6
        return F.struct(
            _text(8000000 + sk * 4 + i).alias("number"),
            _pick((i + sk) % 3, None, lit(False), lit(True)).alias("isMain"),
            F.struct(F.array(lon, lat).alias("coordinates")).alias("geographicCoordinates"),
        )

    def ril(i: Column) -> Column:
        prefix = F.when((nk + i) % 2 == 0, '"HB"').otherwise("XX")
        return F.struct(
            F.concat(prefix, _text(sk), lit("_"), _text(i)).alias("rilIdentifier"), ((sk + i) % 2 == 0).alias("isMain")
        )

    name = F.concat(F.when(nk % 2 == 0, "Brem ").otherwise("Hamb "), col("s_name"), F.when(b == 1, " v2").otherwise(""))
    payload = F.to_json(
        F.struct(
            _text(sk).alias("number"),
            name.alias("name"),
            F.when(sk % 4 > 0, _items(sk % 4, eva)).alias("evaNumbers"),
            F.when(sk % 5 > 0, _items(sk % 5 % 3, ril)).alias("ril100Identifiers"),
        )
    )
    as_number = F.replace(payload, F.concat(lit('{"number":"'), _text(sk), lit('"')), F.concat(lit('{"number":'), _text(sk)))
    return rows.select(
        (sk * 2 + b).alias("raw_id"),
        F.when(sk % 5 == 0, as_number).otherwise(payload).alias("payload"),
        F.format_string("db_stations_2024010%d000000_00000000", b + 1).alias("batch_id"),
        _arrival(b).alias("ingested_at"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "pages", page_rows)


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page response per customer: ten pages of seven items per batch, in changing envelopes."""
    ck = col("c_custkey")
    batch, page = F.floor(ck / 10), ck % 10
    n = F.when(ck % 23 == 22, 0).otherwise(7)
    items = F.to_json(_items(n, lambda i: F.struct((ck * 7 + i).alias("number"))))
    total = F.when(batch % 3 == 0, ',"total":70').when((batch % 3 == 2) & (page >= 1), ',"total":30').otherwise("")

    def wrapped(key: str) -> Column:
        return F.concat(lit(f'{{"note":"x","{key}":'), items, total, lit("}"))

    body = _pick(page % 6, wrapped("data"), wrapped("stations"), wrapped("results"), wrapped("items"), wrapped("other"), items)
    failed = ck % 19 == 18
    return _spread(table(spark, sf_dir, "customer")).select(
        F.format_string("db_stations_%06d", batch).alias("batch_id"),
        (page * 7).cast("int").alias("offset"),
        F.when(failed, 500).otherwise(200).alias("status_code"),
        F.when(failed, '{"error":"down"}').otherwise(body).alias("payload"),
    )


# ---------------------------------------------------------------- weather


def _weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(_spread(table(spark, sf_dir, "events"))).filter("b = 0 OR user_id % 2 = 0")
    return rows.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _weather_object(shift: int = 0) -> Column:
    e, u, b, k = col("event_id"), col("user_id"), col("b"), col("k")
    hours = 1 + e % 4
    start = F.date_trunc("hour", col("ts")).cast("timestamp_ntz")
    times = _items(hours, lambda i: F.date_format(start + F.make_dt_interval(hours=i), "yyyy-MM-dd'T'HH:mm"))
    temperature = _items(
        hours, lambda i: F.when(~((col("event_type") == "error") & (i == 0)), col("value") + b + lit(shift) + i)
    )
    # one code fewer than hours for every fifth payload
    code = _items(hours - F.when(e % 5 == 0, 1).otherwise(0), lambda i: k + i)
    rain = _items(hours, lambda i: k % 10 + lit(0.5) * i)
    near = u % 3 == 0
    lat = F.when(near, 47000050 + (u * 102947) % 8000000).otherwise(47000000 + (u * 52711) % 8000000) / 1e6
    lon = F.when(near, 6000050 + (u * 104729) % 9000000).otherwise(6000000 + (u * 35317) % 9000000) / 1e6
    lat_json = F.when(u % 11 == 0, "null").when(u % 13 == 0, F.concat(lit('"'), _text(lat), lit('"'))).otherwise(_text(lat))
    return F.concat(
        lit('{"latitude":'), lat_json, lit(',"longitude":'), _text(lon),
        lit(',"hourly_units":{"time":"iso8601"},"hourly":{"time":'), F.to_json(times),
        lit(',"temperature_2m":'), F.to_json(temperature),
        lit(',"weather_code":'), F.to_json(code),
        lit(',"precipitation":'), F.when(e % 7 == 0, "5").otherwise(F.to_json(rain)),
        lit("}}"),
    )


def _broken_weather() -> Column:
    return _pick(
        F.floor(col("event_id") / 50) % 5,
        '{"latitude":53.1,"hourly":',
        '{"latitude":53.1,"longitude":8.8}',
        '{"latitude":53.1,"longitude":8.8,"hourly":[1,2]}',
        '{"latitude":"abc","longitude":8.8,"hourly":{"time":["2024-01-01T00:00"]}}',
        '{"latitude":53.1,"longitude":8.8,"hourly":{"time":7}}',
    )


def _weather_raw(rows: DataFrame, payload: Column, prefix: str) -> DataFrame:
    b = col("b")
    return rows.select(
        (col("event_id") * 2 + b).alias("raw_id"),
        F.when(col("event_id") % 50 == 49, _broken_weather()).otherwise(payload).alias("payload"),
        F.format_string(f"{prefix}_2024010%d000000_00000000", b + 1).alias("batch_id"),
        _arrival(b).alias("ingested_at"),
    )


def forecast_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "forecast", forecast_rows)


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "history", history_rows)


def forecast_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast of one to four hours per event; even users are corrected by a second batch."""
    return _weather_raw(_weather_rows(spark, sf_dir), _weather_object(), "open_meteo")


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as history: a bare object, a list, or a list under ``results``."""
    e = col("event_id")
    second = F.when(e % 6 == 1, '"bad"').otherwise(_weather_object(100))
    payload = _pick(
        e % 3,
        _weather_object(),
        F.concat(lit("["), _weather_object(), lit(","), second, lit("]")),
        F.concat(lit('{"results":['), _weather_object(), lit("]}")),
    )
    return _weather_raw(_weather_rows(spark, sf_dir), payload, "open_meteo_archive")


# ---------------------------------------------------------------- timetables


def _attr(name: str, value: Column) -> Column:
    # the text of a missing value is NULL: the value itself is worked out once
    return F.coalesce(F.concat(lit(f' {name}="'), value, lit('"')), lit(""))


def _compact(ts: Column) -> Column:
    return F.date_format(ts, "yyMMddHHmm")


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(mins=n.cast("int"))


def _message(base: Column, ok: Column, w: Column) -> Column:
    window = w % 3 == 1
    return F.concat(
        lit("<m"),
        _attr("id", F.when(w % 13 != 0, F.concat(lit("M"), _text(ok), lit("_"), _text(w)))),
        _attr("t", _pick(w % 3, "f", "h", "d")),
        _attr("cat", _pick(w % 3, None, "Störung", "Information")),
        _attr("c", _pick(w % 5, "0", "12", "x", "-3")),
        _attr("pr", _pick(w % 4, "1", "2", "a")),
        _attr("ts", F.when((w % 4 == 1) | (w % 4 == 2), _compact(base + _minutes(w % 1440)))),
        _attr("ts-tts", F.when(w % 4 == 3, F.date_format(base + _minutes(w % 1440), "yy-MM-dd HH:mm:ss.'123'"))),
        _attr("from", F.when(window, _compact(base))),
        _attr("to", F.when(window, _compact(base + F.make_dt_interval(days=lit(1))))),
        lit("/>"),
    )


def _messages(n: Column, first: Column, base: Column, ok: Column) -> Column:
    """n messages, each made from a number that is worked out once."""
    return F.array_join(F.transform(_items(n, lambda x: first + 5 * x), lambda w: _message(base, ok, w)), "")


def _node(tag: str, d: int, base: Column, ok: Column, ck: Column, q: Column, i: Column) -> Column:
    planned = base + _minutes(ok % 1440 + 7 * i + 3 * d)
    pt = F.when(q % 19 == 0, "99").when(q % 23 == 0, "2413010900").otherwise(_compact(planned))
    ppth = F.when(q % 15 == 0, "A|").when(q % 3 == 0, F.concat(lit("A|B"), _text(ck))).when(q % 3 == 1, "")
    return F.concat(
        lit(f"<{tag}"),
        _attr("pt", pt),
        _attr("ct", F.when(q % 5 != 0, _compact(planned + _minutes(q % 60)))),
        _attr("pp", _text(q % 12)),
        _attr("cp", F.when(q % 4 == 0, F.concat(_text(q % 12), lit("a")))),
        _attr("l", _pick(q % 4, "", "RS1", "51")),
        _attr("ppth", ppth),
        _attr("cpth", F.when(q % 2 == 0, "C|D&amp;E")),
        lit(">"),
        _messages((q * 3 + 1) % 4 % 3, q, base, ok),
        lit(f"</{tag}>"),
    )


def _nodes(tag: str, n: Column, d: int, base: Column, ok: Column, ck: Column, j: Column) -> Column:
    numbers = _items(n, lambda i: ok + j + 3 * i + d)
    return F.array_join(F.transform(numbers, lambda q, i: _node(tag, d, base, ok, ck, q, i)), "")


def _service(base: Column, ok: Column, ck: Column, pri: Column, j: Column) -> Column:
    label = F.concat(
        lit("<tl"), _attr("f", F.concat(lit("F"), _text(ck % 50))), _attr("t", F.when(ok % 4 != 0, "p")),
        _attr("o", lit("DB")), _attr("c", pri), _attr("n", _text(j)), lit("/>"),
    )
    return F.concat(
        lit("<s"),
        _attr("id", _text(ok * 10 + j)),
        lit(">"),
        F.when((ok * 10 + j) % 11 == 0, "").otherwise(label),
        _nodes("ar", (ok + j) % 3, 0, base, ok, ck, j),
        _messages(((ok + j) * 7 + 2) % 5 % 3, ok * 2 + j, base, ok),
        _nodes("dp", (ok + 2 * j + 1) % 3, 1, base, ok, ck, j),
        lit("</s>"),
    )


def timetable_raw(spark: SparkSession, sf_dir: str, prefix: str = "RCHG") -> DataFrame:
    """The landed documents, under the batch ids of the given feed."""
    docs = _landed(spark, sf_dir, "timetables", timetable_rows)
    return docs.withColumn("batch_id", F.concat(lit(prefix), F.substring("batch_id", 5, 100)))


def timetable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timetable document per order with one or two services; every fortieth is unreadable."""
    rows = _spread(table(spark, sf_dir, "orders")).withColumn("base", F.expr("o_orderdate + INTERVAL 25 YEARS"))
    ok, ck, pri, base = col("o_orderkey"), col("o_custkey"), col("o_orderpriority"), col("base")
    services = F.array_join(_items(1 + ok % 2, lambda j: _service(base, ok, ck, pri, j)), "")
    doc = F.concat(
        lit("<timetable"), _attr("station", F.concat(lit("S"), _text(ck))), _attr("eva", _text(ck)), lit(">"),
        services, lit("</timetable>"),
    )
    broken = _pick(
        F.floor(ok / 40) % 5,
        F.substring(doc, lit(1), F.length(doc) - 5),
        "",
        "Service Unavailable",
        F.concat(doc, lit("<timetable/>")),
        F.concat(doc, lit("junk")),
    )
    dressed = F.concat(lit('<?xml version="1.0" encoding="UTF-8"?>\n<!-- a -->'), doc, lit("<!-- b -->\n"))
    payload = F.when(ok % 40 == 39, broken).when(ok % 40 == 38, dressed).otherwise(doc)
    return rows.select(
        ok.alias("raw_id"),
        payload.alias("payload"),
        F.format_string("RCHG_20240101_00000%d", ok % 2).alias("batch_id"),
        (lit("2024-01-01 00:00:00.5").cast("timestamp_ntz") + F.make_dt_interval(secs=(ok % 2).cast("decimal(18,6)"))).alias(
            "ingested_at"
        ),
    )


# ---------------------------------------------------------------- logs


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API call per event."""
    kind = col("event_type")
    status = F.when(kind == "signup", 204).when(kind == "view", 404).otherwise(200)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(col("event_id") % 3 == 0, "open_meteo").otherwise("deutsche_bahn").alias("source"),
        F.when(col("event_id") % 2 == 0, "archive").otherwise("plan").alias("endpoint"),
        _text(col("user_id")).alias("eva"),
        F.when(kind != "view", F.date_format("ts", "yyyy-MM-dd")).alias("end_date"),
        status.alias("status_code"),
        F.floor("value").cast("int").alias("response_time_ms"),
        F.when(col("event_id") % 4 == 0, "").otherwise("<timetable/>").alias("payload"),
        (kind == "error").alias("raised"),
        (col("event_id") % 3).cast("int").alias("result_count"),
        col("ts").alias("called_at"),
    )


def _user_day() -> Column:
    return F.concat(lit("open_meteo_"), F.date_format("ts", "yyyyMMdd"), lit("_"), F.lpad(_text(col("user_id")), 8, "0"))


def event_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw rows, one batch per user and day."""
    return table(spark, sf_dir, "events").select(
        col("event_id").alias("raw_id"),
        col("props").alias("payload"),
        F.when(col("user_id") % 10 != 9, _user_day()).alias("batch_id"),
        col("ts").alias("ingested_at"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: a start, and an end unless it was a click."""
    kind, e = col("event_type"), col("event_id")
    end_status = F.when(kind == "error", "failed").when(kind == "view", "skipped").otherwise("success")
    rows = table(spark, sf_dir, "events").withColumn(
        "event", F.explode(F.when(kind == "click", F.array(lit("start"))).otherwise(F.array(lit("start"), lit("end"))))
    )
    is_end = col("event") == "end"
    return rows.select(
        F.concat(lit("r"), _text(e)).alias("run_id"),
        F.when(e % 2 == 0, "weather_forecast_transform_dwh").otherwise("db_timetables_fchg_transform").alias("process_name"),
        _user_day().alias("batch_id"),
        "event",
        F.when(is_end, end_status).otherwise("running").alias("status"),
        F.when(is_end, col("ts") + F.make_dt_interval(secs=(e % 90).cast("decimal(18,6)"))).otherwise(col("ts")).alias("ts"),
        F.when(is_end, F.concat(lit("rows_inserted="), _text(e % 50))).otherwise("start").alias("message"),
    )
