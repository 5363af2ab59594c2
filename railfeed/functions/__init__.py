"""Column expressions shared by the jobs; all built from JVM-side functions."""

from .payload import json_array, json_map, json_text, parse_json
from .text import digits_to_int, first_nonempty, last_path_stop, prefix_like
from .times import compact_to_iso, compact_to_ts, dashed_to_iso, iso_to_ts, local_wall_clock

__all__ = [
    "compact_to_iso",
    "compact_to_ts",
    "dashed_to_iso",
    "digits_to_int",
    "first_nonempty",
    "iso_to_ts",
    "json_array",
    "json_map",
    "json_text",
    "last_path_stop",
    "local_wall_clock",
    "parse_json",
    "prefix_like",
]
