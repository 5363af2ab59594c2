"""JSON payload access through VARIANT: a bad value is NULL, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_json(payload: Column) -> Column:
    return F.try_parse_json(payload)


def json_array(variant: Column, path: str = "$") -> Column:
    """Array at ``path``, or NULL when something else is there."""
    return F.try_variant_get(variant, path, "array<variant>")


def json_map(variant: Column, path: str = "$") -> Column:
    """Object at ``path``, or NULL when something else is there."""
    return F.try_variant_get(variant, path, "map<string,variant>")


def json_text(variant: Column, path: str) -> Column:
    return F.try_variant_get(variant, path, "string")
