"""Text rules of the feeds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digits_to_int(value: Column, to: str = "int") -> Column:
    """Whole numbers written in ASCII digits only; signs, decimals and overflow give NULL."""
    return F.when(value.rlike("^[0-9]+$"), value.try_cast(to))


def first_nonempty(a: Column, b: Column) -> Column:
    """``a`` unless it is NULL or empty, else ``b`` as it is."""
    return F.when(a.isNull() | (a == ""), b).otherwise(a)


def last_path_stop(planned: Column, changed: Column) -> Column:
    """Last stop of a ``|`` separated path; a trailing bar gives an empty stop."""
    path = F.coalesce(F.nullif(planned, F.lit("")), F.nullif(changed, F.lit("")))
    return F.substring_index(path, "|", -1)


def prefix_like(value: Column, pattern: str) -> Column:
    """LIKE after removing double quotes."""
    return F.replace(value, F.lit('"'), F.lit("")).like(pattern)
