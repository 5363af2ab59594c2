"""Station dimension from raw station payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import settings
from ..functions import json_array, json_text, parse_json, prefix_like
from ..schemas import REGION_DS100_PATTERN, REGION_NAME_PATTERN
from .ranking import latest_per_key


def _eva(element: Column) -> dict[str, Column]:
    # coordinates come as [longitude, latitude]
    return {
        "eva_number": json_text(element, "$.number"),
        "latitude": F.try_variant_get(element, "$.geographicCoordinates.coordinates[1]", "double"),
        "longitude": F.try_variant_get(element, "$.geographicCoordinates.coordinates[0]", "double"),
    }


def _ril(element: Column) -> dict[str, Column]:
    return {"ds100": json_text(element, "$.rilIdentifier")}


def _is_main(element: Column) -> Column:
    return F.try_variant_get(element, "$.isMain", "boolean")


def _main(elements: Column, fields) -> Column:
    """Main element of a list: isMain true before false before missing, then list position.

    An array expression per row, so no shuffle and no join back.
    """

    def ranked(element: Column, pos: Column) -> Column:
        rank = F.when(_is_main(element), 0).when(~_is_main(element), 1).otherwise(2)
        return F.struct(rank.alias("rank"), pos.alias("pos"), *[c.alias(n) for n, c in fields(element).items()])

    return F.array_min(F.transform(elements, ranked))


def station_base(raw: DataFrame) -> DataFrame:
    doc = parse_json(F.col("payload"))
    return raw.select(
        "raw_id",
        json_text(doc, "$.number").alias("station_id"),
        json_text(doc, "$.name").alias("name"),
        F.col("ingested_at").alias("created_at"),
        doc.alias("doc"),
    )


def station_eva(base: DataFrame) -> DataFrame:
    """One row per EVA number; a station without any keeps one row of NULLs."""
    rows = base.select("raw_id", "station_id", F.posexplode_outer(json_array(F.col("doc"), "$.evaNumbers")).alias("pos", "e"))
    fields = _eva(F.col("e"))
    return rows.select(
        "raw_id", "station_id", "pos", *[c.alias(n) for n, c in fields.items()], _is_main(F.col("e")).alias("is_main")
    )


def station_assembled(base: DataFrame) -> DataFrame:
    """Scalars plus the main EVA number and the main RIL100 code, one row per raw row."""
    picked = base.select(
        "raw_id",
        "station_id",
        "name",
        "created_at",
        _main(json_array(F.col("doc"), "$.evaNumbers"), _eva).alias("eva"),
        _main(json_array(F.col("doc"), "$.ril100Identifiers"), _ril).alias("ril"),
    )
    return picked.select(
        "raw_id", "station_id", "name", "eva.latitude", "eva.longitude", "ril.ds100", "eva.eva_number", "created_at"
    )


def station_dimension(raw: DataFrame) -> DataFrame:
    """Latest version per station; a row without arrival time counts as the newest.

    The version is chosen on the narrow parsed row, so payload text is not shuffled.
    """
    rows = station_assembled(station_base(raw))
    latest = latest_per_key(rows, ["station_id"], [F.desc_nulls_first("created_at"), F.desc("raw_id")])
    return latest.drop("raw_id")


def in_region(name_pattern: str = REGION_NAME_PATTERN, ds100_pattern: str = REGION_DS100_PATTERN) -> Column:
    return F.col("name").like(name_pattern) & prefix_like(F.col("ds100"), ds100_pattern)


def region_eva(
    stations: DataFrame, name_pattern: str | None = None, ds100_pattern: str | None = None, limit: int | None = None
) -> DataFrame:
    """Distinct EVA numbers of the region; a station without one contributes NULL.

    Arguments win over the environment, the environment over the defaults. A limit of 0 is no limit.
    """
    region = in_region(name_pattern or settings.region_name_pattern(), ds100_pattern or settings.region_ds100_pattern())
    limit = settings.region_limit() if limit is None else limit
    evas = stations.filter(region).select("eva_number").distinct()
    return evas.orderBy("eva_number").limit(limit) if limit else evas


def region_coords(
    stations: DataFrame, limit: int | None = None, name_pattern: str | None = None, ds100_pattern: str | None = None
) -> DataFrame:
    """Region stations that have both coordinates and an EVA number; the region is the one of ``region_eva``."""
    usable = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("eva_number").isNotNull()
    region = in_region(name_pattern or settings.region_name_pattern(), ds100_pattern or settings.region_ds100_pattern())
    rows = stations.filter(usable & region).select("station_id", "latitude", "longitude")
    return rows.orderBy("station_id").limit(limit) if limit is not None else rows
