"""Schemas and fixed value lists of the feeds."""

# The hourly measures requested from the forecast endpoint.
FORECAST_MEASURES = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation_probability",
    "precipitation",
    "rain",
    "showers",
    "snowfall",
    "snow_depth",
    "weather_code",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "visibility",
    "wind_speed_10m",
    "evapotranspiration",
    "vapour_pressure_deficit",
]

# The history table has no probability, shower and flux measures.
HISTORY_MEASURES = [
    m
    for m in FORECAST_MEASURES
    if m not in ("precipitation_probability", "showers", "evapotranspiration", "vapour_pressure_deficit")
]

# Measures typed as whole numbers; all others are doubles.
INTEGER_MEASURES = {"weather_code"}

# Keys under which a page response may carry its items, in order of preference.
PAGE_ITEM_KEYS = ["data", "stations", "results", "items"]

# Region patterns, request fallback and plan window of the feeds.
REGION_NAME_PATTERN = "Brem%"
REGION_DS100_PATTERN = "HB%"
FALLBACK_COORDINATE = (53.0793, 8.8017)
ARCHIVE_FIRST_DAY = "2025-01-01"
ARCHIVE_LAG_DAYS = 2
COORDS_PER_REQUEST = 200
PLAN_HOURS = 30
LOCAL_ZONE = "Europe/Berlin"
MATCH_TOLERANCE = 1e-4

_MESSAGE = (
    "STRUCT<_id: STRING, _t: STRING, _c: STRING, _cat: STRING, _pr: STRING, _ts: STRING, "
    "`_ts-tts`: STRING, _from: STRING, _to: STRING>"
)
_NODE = (
    "STRUCT<_pt: STRING, _ct: STRING, _pp: STRING, _cp: STRING, _l: STRING, _ppth: STRING, "
    f"_cpth: STRING, m: ARRAY<{_MESSAGE}>>"
)
_LABEL = "STRUCT<_f: STRING, _t: STRING, _o: STRING, _c: STRING, _n: STRING>"

CORRUPT = "_corrupt"

# One schema per timetable variant: from_xml cannot prune columns, so each names only what its job reads.
TIMETABLE_XML = (
    "_station STRING, _eva STRING, "
    f"s ARRAY<STRUCT<_id: STRING, tl: ARRAY<{_LABEL}>, m: ARRAY<{_MESSAGE}>, "
    f"ar: ARRAY<{_NODE}>, dp: ARRAY<{_NODE}>>>, {CORRUPT} STRING"
)
_PLAN_NODE = "STRUCT<_pt: STRING, _pp: STRING, _l: STRING, _ppth: STRING>"
PLAN_XML = (
    f"_station STRING, s ARRAY<STRUCT<_id: STRING, tl: ARRAY<{_LABEL}>, "
    f"ar: ARRAY<{_PLAN_NODE}>, dp: ARRAY<{_PLAN_NODE}>>>, {CORRUPT} STRING"
)

# Reads nothing but whether the document can be read.
READABLE_XML = f"{CORRUPT} STRING"

# Columns of the three event tables, and the fields of the XML they come from above.
FCHG_COLUMNS = [
    "eva_number",
    "station_name",
    "train_name",
    "final_destination_station",
    "delay_in_min",
    "event_time",
    "is_canceled",
    "type",
    "category",
    "priority",
    "train_type",
    "train_line_ride_id",
    "train_line_station_num",
    "arrival_planned_time",
    "arrival_change_time",
    "departure_planned_time",
    "departure_change_time",
    "message_id",
    "batch_id",
    "source_node",
]

PLAN_COLUMNS = [
    "station_name",
    "train_line_ride_id",
    "train_number",
    "train_category",
    "train_type",
    "train_direction",
    "event_type",
    "event_time",
    "platform",
    "train_line_name",
    "route_path",
    "batch_id",
]

RCHG_COLUMNS = [
    "event_id",
    "eva_number",
    "station_name",
    "message_id",
    "event_type",
    "category",
    "change_type",
    "priority",
    "valid_from",
    "valid_to",
    "old_time",
    "new_time",
    "delay_minutes",
    "platform",
    "platform_change",
    "route",
    "train_line_name",
    "timestamp_event",
    "batch_id",
    "event_hash",
]
