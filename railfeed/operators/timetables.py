"""Timetable XML to planned, full-change and recent-change events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import compact_to_iso, compact_to_ts, dashed_to_iso, digits_to_int, first_nonempty, iso_to_ts, last_path_stop
from ..schemas import CORRUPT, FCHG_COLUMNS, PLAN_COLUMNS, PLAN_XML, RCHG_COLUMNS, READABLE_XML, TIMETABLE_XML
from ..session import work_dir
from .ranking import latest_per_key

_XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "ignoreSurroundingSpaces": "false",
    # a text no attribute can hold, so that the value "null" stays a text
    "nullValue": "\u0000",
}
# Possessive groups are matched in a loop; plain ones would recurse once per comment or attribute.
_MISC = r"\s*(?:(?:<!--.*?-->|<\?.*?\?>)\s*)*+"
_NAME = r"[\p{L}_:][\p{L}\p{M}\p{N}_:.\-\u00b7]*+"
_ATTRIBUTE = rf"""\s+{_NAME}\s*=\s*(?:"[^"<]*+"|'[^'<]*+')"""
_SUBSET = r"""\[(?:<!--.*?-->|<\?.*?\?>|"[^"]*+"|'[^']*+'|[^\]"'<]++|<)*+\]\s*"""
_DOCTYPE = rf"""<!DOCTYPE(?:"[^"]*+"|'[^']*+'|[^>\["']++)*+(?:{_SUBSET})?>"""
_PROLOG = rf"(?s)^{_MISC}(?:{_DOCTYPE}{_MISC})?"
_ROOT = rf"{_PROLOG}<{_NAME}(?:{_ATTRIBUTE})*+\s*/?>"
# A document without comments and the like behind its start tag, whose root's name is closed once, at the end.
_PLAIN_ROOT = rf"{_PROLOG}<({_NAME})(?:{_ATTRIBUTE})*+\s*>[^<]*+(?:<(?!/\1|[!?])[^<]*+)*+</\1\s*+>\s*+$"
_HIDDEN = r"(?s)<!--.*?-->|<\?.*?\?>|<!\[CDATA\[.*?\]\]>"


def _single_root(payload: Column, head: Column) -> Column:
    """True if nothing but comments follows the first root element, which from_xml does not check.

    ``head`` is the text up to the end of the root's start tag. Comments and the like are taken out of the rest. A
    document with one close tag of the root's name ends there; where there are more, nested elements of that name are
    counted, and the root must not close before the last of them.
    """
    name = F.regexp_extract(head, rf"<({_NAME})[^<]*>$", 1)
    rest = F.substring(payload, F.length(head) + 1, F.lit(2**31 - 1))
    hidden = rest.contains("<!") | rest.contains("<?")
    rest = F.when(hidden, F.regexp_replace(rest, _HIDDEN, "")).otherwise(rest)
    close = F.concat(F.lit("</"), name)
    before = F.call_function("substring_index", rest, close, F.lit(1))
    after = F.call_function("substring_index", rest, close, F.lit(-1))
    once = F.octet_length(before) + F.octet_length(close) + F.octet_length(after) == F.octet_length(rest)
    quoted = F.concat(F.lit(r"(<(?:/\Q"), name, F.lit(rf"\E\s*+|\Q"), name, F.lit(rf"\E(?:{_ATTRIBUTE})*+\s*+/?+)>)"))
    tags = F.regexp_extract_all(rest, quoted, F.lit(1))
    steps = F.transform(tags, lambda t: F.when(t.startswith("</"), -1).when(t.endswith("/>"), 0).otherwise(1))
    # depth after each tag; -1 once the root has closed with tags still to come
    depth = F.aggregate(steps, F.lit(1), lambda d, x: F.when(d <= 0, -1).otherwise(d + x))
    nested = (depth == 0) & after.rlike(r"^\s*>\s*$")
    closed = F.when(head.endswith("/>"), rest.rlike(r"^\s*$")).when(once, after.rlike(r"^\s*>\s*$")).otherwise(nested)
    return F.coalesce(closed, F.lit(False))


def _with_head(payload: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` the text up to the end of the root's start tag, which is found once; false without one."""
    found = F.array(F.regexp_extract(payload, _ROOT, 0))
    return F.exists(found, lambda head: (head != "") & of(head))


def shred(raw: DataFrame, schema: str = TIMETABLE_XML) -> DataFrame:
    """Parsed document per payload in ``doc``, with ``reason`` set where it must not be used.

    ``plain`` is false where the root moves its children into a namespace: they are no timetable entries.
    """
    # a byte order mark is no part of the document
    bare = F.col("bare")
    parsed = raw.withColumn("bare", F.ltrim("payload", F.lit("\ufeff"))).withColumn("doc", F.from_xml("bare", schema, _XML_OPTIONS))
    # what few documents need is worked out for these alone, and the start tag once
    whole = bare.rlike(_PLAIN_ROOT) | _with_head(bare, lambda head: _single_root(bare, head))
    reason = F.when(F.col("payload").isNull() | F.col(f"doc.{CORRUPT}").isNotNull(), "malformed").when(~whole, "extra_content")
    plain = ~bare.contains("xmlns") | _with_head(bare, lambda head: ~head.rlike(r"\sxmlns\s*="))
    return parsed.withColumns({"reason": reason, "plain": plain}).drop("bare")


def xml_quarantine(raw: DataFrame) -> DataFrame:
    """Unreadable payloads with the reason; whether a document reads is all that is asked of it."""
    docs = shred(raw, READABLE_XML)
    # a filter on the reason itself would be moved below its making, and work it out, document and all, once more per use
    rows = docs.select("raw_id", "batch_id", F.explode_outer(F.array("reason")).alias("reason"), "payload")
    return rows.filter("reason IS NOT NULL")


def services(raw: DataFrame, schema: str = TIMETABLE_XML, rejects: bool = False) -> DataFrame:
    """One row per service of the readable payloads, with its position in the document.

    With ``rejects`` an unreadable payload is a row too, without a service but with ``reject``, its reason and text.
    """
    docs = shred(raw, schema)
    usable = F.when(F.col("reason").isNull() & F.col("plain"), F.col("doc.s"))
    head = [F.col("doc._station").alias("station_name")]
    if "_eva" in schema:
        head.append(F.col("doc._eva").alias("eva_number"))
    if rejects:
        head.append(F.when(F.col("reason").isNotNull(), F.struct("reason", "payload")).alias("reject"))
    # outer form: the inner one adds a size check that parses the document again
    rows = docs.select("raw_id", "batch_id", "ingested_at", *head, F.posexplode_outer(usable).alias("s_pos", "s"))
    return rows.filter("s_pos IS NOT NULL OR reject IS NOT NULL" if rejects else "s_pos IS NOT NULL")


def _some(rejects: bool) -> str:
    return "e IS NOT NULL OR reject IS NOT NULL" if rejects else "e IS NOT NULL"


def _unread(field: str, text: Column, value: Column, shape: str, reasons: tuple[str, str]) -> Column:
    """What is wrong with a text that gave no value: it has the right shape and means nothing, or has another shape."""
    return F.when(
        text.isNotNull() & (text != "") & value.isNull(),
        F.struct(F.lit(field).alias("field"), F.when(text.rlike(shape), reasons[0]).otherwise(reasons[1]).alias("reason"), text.alias("text")),
    )


def bad_time(field: str, text: Column) -> Column:
    """Error of a compact time: a date the calendar does not have, or no time at all; NULL where it reads or is missing."""
    return _unread(field, text, compact_to_ts(text), "^[0-9]{10}$", ("impossible_date", "not_a_time"))


def bad_number(field: str, text: Column) -> Column:
    """Error of a whole number: too large for its column, or not written in digits; NULL where it reads or is missing."""
    return _unread(field, text, digits_to_int(text), "^[0-9]+$", ("out_of_range", "not_a_number"))


def _errors(*found: Column) -> Column:
    """Those of the given errors that there are; the list functions, which are interpreted, run for rows with one only."""
    listed = F.array_compact(F.array(*found))
    return F.when(F.coalesce(*found).isNotNull(), listed).otherwise(F.expr("array()")).alias("errors")


def _message_errors(message: str, time: str, *numbers: tuple[str, str]) -> list[Column]:
    """Errors of a message's time, which may be written in two ways, and of its numbers."""
    m = F.col(message)
    dashed = F.when((m["_ts"] == "") | m["_ts"].isNull(), m["_ts-tts"])
    at = F.coalesce(
        bad_time(time, m["_ts"]), _unread(time, dashed, iso_to_ts(dashed_to_iso(dashed)), "^([0-9]{2}.){5}", ("impossible_date", "not_a_time"))
    )
    return [at, *[bad_number(field, m[name]) for field, name in numbers]]




def _has(nodes: Column) -> Column:
    return F.coalesce(F.array_size(nodes), F.lit(0)) > 0


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def _cancels(message: Column) -> Column:
    """Type f with a positive whole number in c."""
    return F.coalesce((message["_t"] == "f") & message["_c"].rlike("^0*[1-9][0-9]*$"), F.lit(False))


def _message_time(message: str, source_tz: str) -> Column:
    iso = first_nonempty(compact_to_iso(F.col(f"{message}._ts")), dashed_to_iso(F.col(f"{message}.`_ts-tts`")))
    return iso_to_ts(iso, source_tz)


def fchg_services(rows: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Service context shared by its change rows: first label, first arrival, first departure."""
    first = rows.withColumns(
        {
            "tl": F.get("s.tl", F.lit(0)),
            "ar": F.get("s.ar", F.lit(0)),
            "dp": F.get("s.dp", F.lit(0)),
            "has_ar": _has(F.col("s.ar")),
            "has_dp": _has(F.col("s.dp")),
        }
    )
    none = F.expr("array()")
    node_messages = F.concat(F.coalesce(F.col("ar.m"), none), F.coalesce(F.col("dp.m"), none))
    return first.select(
        "raw_id",
        "batch_id",
        *(["reject"] if "reject" in rows.columns else []),
        "s_pos",
        "eva_number",
        "station_name",
        _errors(
            bad_time("arrival_planned_time", F.col("ar._pt")),
            bad_time("arrival_change_time", F.col("ar._ct")),
            bad_time("departure_planned_time", F.col("dp._pt")),
            bad_time("departure_change_time", F.col("dp._ct")),
        ),
        first_nonempty(F.col("ar._l"), F.col("dp._l")).alias("train_name"),
        F.coalesce(
            last_path_stop(F.col("ar._ppth"), F.col("ar._cpth")), last_path_stop(F.col("dp._ppth"), F.col("dp._cpth"))
        ).alias("final_destination_station"),
        F.exists(node_messages, _cancels).alias("service_canceled"),
        F.col("tl._c").alias("train_type"),
        F.col("s._id").alias("train_line_ride_id"),
        F.coalesce(digits_to_int(F.col("ar._l"), "bigint"), digits_to_int(F.col("dp._l"), "bigint")).alias(
            "train_line_station_num"
        ),
        compact_to_ts(F.col("ar._pt"), source_tz).alias("arrival_planned_time"),
        compact_to_ts(F.col("ar._ct"), source_tz).alias("arrival_change_time"),
        compact_to_ts(F.col("dp._pt"), source_tz).alias("departure_planned_time"),
        compact_to_ts(F.col("dp._ct"), source_tz).alias("departure_change_time"),
        F.transform(F.coalesce(F.col("s.m"), none), lambda m: F.struct(F.lit("m").alias("node"), m.alias("m"))).alias("messages"),
        F.filter(
            F.array(
                F.when(F.col("has_ar"), F.struct(F.lit("ar").alias("node"), _last(F.col("ar.m")).alias("m"))),
                F.when(F.col("has_dp"), F.struct(F.lit("dp").alias("node"), _last(F.col("dp.m")).alias("m"))),
            ),
            lambda e: e.isNotNull(),
        ).alias("nodes"),
    )


def fchg_rows(context: DataFrame, entries: Column, source_tz: str = "UTC") -> DataFrame:
    """Event rows of the given entries: service messages, or the last message of each node."""
    rejects = "reject" in context.columns
    spread = context.select("*", F.posexplode_outer(entries).alias("e_pos", "e")).filter(_some(rejects))
    m = F.col("e.m")
    is_message = F.col("e.node") == "m"
    # errors of the service are told once, by its first event
    own = F.array_compact(F.array(*_message_errors("e.m", "event_time", ("delay_in_min", "_c"), ("priority", "_pr"))))
    errors = F.when(F.col("e_pos") == 0, F.concat("errors", own)).otherwise(own)
    dealt = ["raw_id", "reject", errors.alias("errors")] if rejects else []
    return spread.select(
        "*",
        digits_to_int(m["_c"]).alias("delay_in_min"),
        _message_time("e.m", source_tz).alias("event_time"),
        ((is_message & _cancels(m)) | F.col("service_canceled")).alias("is_canceled"),
        m["_t"].alias("type"),
        F.when(is_message, m["_cat"]).alias("category"),
        digits_to_int(m["_pr"]).alias("priority"),
        m["_id"].alias("message_id"),
        F.col("e.node").alias("source_node"),
    ).select(*FCHG_COLUMNS, *dealt)


def fchg_message_rows(raw: DataFrame) -> DataFrame:
    return fchg_rows(fchg_services(services(raw)), F.col("messages"))


def fchg_node_rows(raw: DataFrame) -> DataFrame:
    return fchg_rows(fchg_services(services(raw)), F.col("nodes"))


def fchg_events(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Full-change events: service messages and arrival/departure nodes in one pass over the payloads."""
    return fchg_rows_of(raw, source_tz)


def fchg_rows_of(raw: DataFrame, source_tz: str = "UTC", rejects: bool = False) -> DataFrame:
    context = fchg_services(services(raw, rejects=rejects), source_tz)
    return fchg_rows(context, F.concat("messages", "nodes"), source_tz)


def plan_events(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Planned departures and arrivals, distinct over all columns within a batch."""
    return distinct_plan(plan_rows(raw, source_tz))


def plan_rows(raw: DataFrame, source_tz: str = "UTC", rejects: bool = False) -> DataFrame:
    """Planned departures and arrivals as the documents have them."""

    def tagged(name: str) -> Column:
        return F.transform(
            F.coalesce(F.col(f"s.{name}"), F.expr("array()")), lambda n: F.struct(F.lit(name).alias("node"), n.alias("n"))
        )

    dealt = ["raw_id", "reject"] if rejects else []
    rows = services(raw, PLAN_XML, rejects).select(
        "station_name",
        "batch_id",
        *dealt,
        F.col("s._id").alias("train_line_ride_id"),
        F.get("s.tl", F.lit(0)).alias("tl"),
        F.explode_outer(F.concat(tagged("dp"), tagged("ar"))).alias("e"),
    )
    return rows.filter(_some(rejects)).select(
        "station_name",
        "train_line_ride_id",
        F.col("tl._n").alias("train_number"),
        F.col("tl._c").alias("train_category"),
        F.col("tl._t").alias("train_type"),
        F.col("tl._f").alias("train_direction"),
        F.col("e.node").alias("event_type"),
        compact_to_ts(F.col("e.n._pt"), source_tz).alias("event_time"),
        F.col("e.n._pp").alias("platform"),
        F.col("e.n._l").alias("train_line_name"),
        F.col("e.n._ppth").alias("route_path"),
        "batch_id",
        *([*dealt, _errors(bad_time("event_time", F.col("e.n._pt")))] if rejects else []),
    )


def distinct_plan(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(PLAN_COLUMNS)


def hashed_text(*parts: Column) -> Column:
    """The parts joined by bars, NULL as empty text."""
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])


def event_hash(*parts: Column) -> Column:
    """SHA-1 over the parts joined by bars, NULL as empty text."""
    return F.sha1(hashed_text(*parts))


def text_partition(text: Column) -> Column:
    """Last date in a hashed text, ``none`` without one: equal texts, and so equal hashes, share a partition."""
    days = F.regexp_extract_all(text, F.lit(r"(?s)^.*([0-9]{4}-[0-9]{2}-[0-9]{2})T"), F.lit(1))  # the last one, or none
    return F.when(text.isNotNull(), F.coalesce(F.get(days, F.lit(0)), F.lit("none")))


def rchg_rows(
    raw: DataFrame, kinds: tuple[str, ...] = ("m", "dp", "ar"), source_tz: str = "UTC", rejects: bool = False
) -> DataFrame:
    """Recent-change rows before dedup, with their place in the document.

    Without a time of its own a row takes the arrival of its batch, so a replay hashes the same.
    """
    none = F.expr("array()")

    def messages() -> Column:
        return F.transform(
            F.coalesce(F.col("s.m"), none),
            lambda m, i: F.struct(
                F.lit("m").alias("kind"), F.lit(0).alias("kind_no"), i.alias("pos"), F.get(F.col("s.dp"), F.lit(-1)).alias("n"), m.alias("m")
            ),
        )

    def nodes(name: str, kind_no: int) -> Column:
        return F.transform(
            F.coalesce(F.col(f"s.{name}"), none),
            lambda n, i: F.struct(
                F.lit(name).alias("kind"), F.lit(kind_no).alias("kind_no"), i.alias("pos"), n.alias("n"), _last(n["m"]).alias("m")
            ),
        )

    built = {"m": messages(), "dp": nodes("dp", 1), "ar": nodes("ar", 2)}
    dealt = ["reject"] if rejects else []
    rows = (
        services(raw, rejects=rejects)
        .select(
            *dealt, "raw_id", "batch_id", "ingested_at", "s_pos", "eva_number", "station_name", F.col("s._id").alias("event_id"),
            F.explode_outer(F.concat(*[built[k] for k in kinds])).alias("e"),
        )
        .filter(_some(rejects))
    )
    n, m = F.col("e.n"), F.col("e.m")
    is_message = F.col("e.kind") == "m"
    if rejects:
        found = _errors(
            bad_time("valid_from", m["_from"]), bad_time("valid_to", m["_to"]), bad_time("old_time", n["_pt"]), bad_time("new_time", n["_ct"]),
            bad_time("timestamp_event", F.when((n["_ct"] == "") | n["_ct"].isNull(), m["_ts"])),
            F.when(is_message, bad_number("priority", m["_pr"])), bad_number("delay_minutes", m["_c"]),
        )
        rows, dealt = rows.withColumn("errors", found), ["reject", "errors"]
    arrival = F.date_format(F.date_trunc("second", "ingested_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = rows.select(
        *dealt, "ingested_at", "raw_id", "batch_id", "s_pos", "e.kind_no", "e.pos", "event_id", "eva_number", "station_name",
        m["_id"].alias("message_id"), F.col("e.kind").alias("event_type"), m["_cat"].alias("category"), m["_t"].alias("change_type"),
        F.when(is_message, m["_pr"]).alias("pr"), m["_c"].alias("c"),
        compact_to_iso(m["_from"]).alias("vf"), compact_to_iso(m["_to"]).alias("vt"),
        compact_to_iso(n["_pt"]).alias("pt"), compact_to_iso(n["_ct"]).alias("ct"),
        n["_pp"].alias("platform"), n["_cp"].alias("platform_change"), n["_ppth"].alias("route"), n["_l"].alias("train_line_name"),
        F.coalesce(compact_to_iso(n["_ct"]), compact_to_iso(m["_ts"]), arrival).alias("ts_event"),
    )
    col = F.col
    parts = [
        col("event_id"), col("eva_number"), col("station_name"), col("message_id"), col("event_type"), col("category"),
        col("change_type"), col("pr"), col("vf"), col("vt"), col("pt"), col("ct"), col("c"), col("platform"),
        col("platform_change"), col("route"), col("ts_event"),
    ]
    text = F.when(col("event_type") == "m", hashed_text(*parts)).otherwise(hashed_text(*parts, col("train_line_name")))
    return rows.withColumn("hashed", text).select(
        *[*dealt, "ingested_at", "raw_id", "s_pos", "kind_no", "pos"],
        "event_id", "eva_number", "station_name", "message_id", "event_type", "category", "change_type",
        digits_to_int(col("pr")).alias("priority"),
        iso_to_ts(col("vf"), source_tz).alias("valid_from"), iso_to_ts(col("vt"), source_tz).alias("valid_to"),
        iso_to_ts(col("pt"), source_tz).alias("old_time"), iso_to_ts(col("ct"), source_tz).alias("new_time"),
        digits_to_int(col("c")).alias("delay_minutes"),
        "platform", "platform_change", "route", "train_line_name",
        iso_to_ts(col("ts_event"), source_tz).alias("timestamp_event"),
        "batch_id", F.sha1("hashed").alias("event_hash"), text_partition(col("hashed")).alias("event_date"),
    )


def first_per_hash(rows: DataFrame, order: list[str]) -> DataFrame:
    """First row per event hash in document order."""
    return latest_per_key(rows, ["event_hash"], [F.asc(c) for c in order])


def insert_ignore(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose hash is not stored yet: the batch that came first keeps its row."""
    return new.join(existing.select("event_hash"), "event_hash", "left_anti")


FIRST_ARRIVAL = ["ingested_at", "batch_id", "raw_id", "s_pos", "kind_no", "pos"]


def first_arrivals(rows: DataFrame) -> DataFrame:
    """One row per hash, the one that arrived first, with the partition its text belongs to."""
    return first_per_hash(rows, FIRST_ARRIVAL).select(*RCHG_COLUMNS, "event_date")


def rchg_found(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    return first_arrivals(rchg_rows(raw, source_tz=source_tz))


def rchg_events(raw: DataFrame, existing: DataFrame | None = None, source_tz: str = "UTC") -> DataFrame:
    """Recent-change events, one per hash over the given batches and against the stored ones."""
    rows = rchg_found(raw, source_tz).select(*RCHG_COLUMNS)
    return rows if existing is None else insert_ignore(rows, existing).select(*RCHG_COLUMNS)


def rchg_unstored(spark: SparkSession, raw: DataFrame, target: str | None, leave_out: Column | None = None) -> tuple[DataFrame, str]:
    """Rows of the given batches whose hash is not stored in ``target``, and the scratch folder they are read from.

    The documents are parsed once. Their rows name the partitions of the target that can hold an equal hash; no other
    is read. ``leave_out`` marks stored rows that do not count.
    """
    path = work_dir(spark, "rchg")
    rchg_found(raw).write.parquet(path)
    found = spark.read.parquet(path)
    if target is None:
        return found, path
    stored = spark.read.schema("event_hash STRING, event_date STRING, batch_id STRING").parquet(target)
    if leave_out is not None:
        stored = stored.filter(~leave_out)
    days = [r.event_date for r in found.select("event_date").distinct().collect()]  # calendar days of one job
    return insert_ignore(found, stored.filter(F.col("event_date").isin(days))), path
