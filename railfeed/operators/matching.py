"""Coordinates to stations: tolerance box first, else nearest, exact at any size.

Stations are cut into a tree of grid cells, each split in 4 x 4 until it holds few distinct coordinates.
A coordinate walks down the tree with equi-joins and keeps only cells that can still hold its answer, so
neither side is paired with the whole other side and no distance limit or candidate cap is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from ..schemas import MATCH_TOLERANCE
from ..session import work_dir

_BITS_PER_LEVEL = 2
_MAX_LEVEL = 12
_GRID = 1 << (_BITS_PER_LEVEL * _MAX_LEVEL)
_LEAF_SIZE = 8

_BOX = ["min_lat", "max_lat", "min_lon", "max_lon"]
_CELL = ["level", "cx", "cy", "is_split", "first_id", *_BOX]


@dataclass
class StationIndex:
    """Cell tree and cell members as written tables; one is built per station version."""

    cells: DataFrame | None
    members: DataFrame | None
    top: list[Row]
    depth: int


def _grid_pos(value: Column, low: float, high: float) -> Column:
    span = (high - low) or 1.0
    return F.least(F.floor((value - F.lit(low)) / F.lit(span) * F.lit(_GRID)), F.lit(_GRID - 1)).cast("bigint")


def build_station_index(stations: DataFrame, leaf_size: int = _LEAF_SIZE) -> StationIndex:
    """Index of (station_id, latitude, longitude); equal coordinates share their smallest id."""
    spark: SparkSession = stations.sparkSession
    path = work_dir(spark, "station-index")
    (
        stations.dropna(subset=["station_id", "latitude", "longitude"])
        .groupBy("latitude", "longitude")
        .agg(F.min("station_id").alias("station_id"))
        .write.parquet(f"{path}/spots")
    )
    spots = spark.read.parquet(f"{path}/spots")
    box = spots.agg(
        F.min("latitude").alias("a"), F.max("latitude").alias("b"), F.min("longitude").alias("c"), F.max("longitude").alias("d")
    ).first()
    if box.a is None:
        return StationIndex(None, None, [], 0)

    level = F.explode(F.sequence(F.lit(0), F.lit(_MAX_LEVEL))).alias("level")
    placed = spots.select(
        "*", _grid_pos(F.col("longitude"), box.c, box.d).alias("x"), _grid_pos(F.col("latitude"), box.a, box.b).alias("y"), level
    )
    shift = (F.lit(_MAX_LEVEL) - F.col("level")) * _BITS_PER_LEVEL
    placed = placed.select(
        "latitude", "longitude", "station_id", "level",
        F.call_function("shiftright", "x", shift).alias("cx"), F.call_function("shiftright", "y", shift).alias("cy"),
    )
    cells = placed.groupBy("level", "cx", "cy").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("station_id").alias("first_id"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )
    cells = cells.withColumn("is_split", (F.col("n") > leaf_size) & (F.col("level") < _MAX_LEVEL))
    parents = cells.filter("is_split").select(
        (F.col("level") + 1).alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py")
    )
    nested = cells.withColumns(
        {"px": F.shiftright("cx", _BITS_PER_LEVEL), "py": F.shiftright("cy", _BITS_PER_LEVEL)}
    )
    inner = nested.join(parents, ["level", "px", "py"], "left_semi").unionByName(nested.filter("level = 0"))
    inner.select(*_CELL, "px", "py").write.partitionBy("level").parquet(f"{path}/cells")
    tree = spark.read.parquet(f"{path}/cells")
    leaves = tree.filter(~F.col("is_split")).select("level", "cx", "cy")
    placed.join(leaves, ["level", "cx", "cy"], "left_semi").write.parquet(f"{path}/members")
    # at most the 16 children of the root, so small enough to travel in the plan
    top = tree.filter("level <= 1").select(*_CELL).collect()
    top = [c for c in top if c.level == 1] or top
    depth = tree.agg(F.max("level")).first()[0]
    return StationIndex(tree, spark.read.parquet(f"{path}/members"), top, depth)


def _squared(value: Column) -> Column:
    return value * value


def _gap(value: Column, low: str, high: str) -> Column:
    """Distance from a value to a range, 0 inside."""
    return F.when(value < F.col(low), F.col(low) - value).when(value > F.col(high), value - F.col(high)).otherwise(0.0)


def _reach(value: Column, low: str, high: str) -> Column:
    """Distance from a value to the farther end of a range."""
    return F.greatest(F.abs(value - F.col(low)), F.abs(value - F.col(high)))


def match_coordinates(coords: DataFrame, index: StationIndex, tolerance: float = MATCH_TOLERANCE) -> DataFrame:
    """(latitude, longitude, tol_station_id, near_station_id, station_id) per distinct coordinate.

    Within the tolerance box the smallest station id wins, else the nearest station by squared degree
    distance with the smallest id on ties. Bounds use the same rounding as the distances, so they are safe.
    """
    # a text key: Spark normalises floating keys and would shuffle anew for every step; + 0.0 drops the sign of zero
    lat, lon = F.col("latitude"), F.col("longitude")
    points = (
        coords.select((lat + 0.0).alias("latitude"), (lon + 0.0).alias("longitude"))
        .dropna()
        .withColumn("point", F.concat_ws(",", "latitude", "longitude"))
        .dropDuplicates(["point"])
    )
    if index.cells is None:
        none = F.lit(None).cast("string")
        return points.drop("point").withColumns({"tol_station_id": none, "near_station_id": none, "station_id": none})

    near = _squared(_gap(lat, "min_lat", "max_lat")) + _squared(_gap(lon, "min_lon", "max_lon"))
    far = _squared(_reach(lat, "min_lat", "max_lat")) + _squared(_reach(lon, "min_lon", "max_lon"))
    touches = (_gap(lat, "min_lat", "max_lat") < tolerance) & (_gap(lon, "min_lon", "max_lon") < tolerance)
    inside = (_reach(lat, "min_lat", "max_lat") < tolerance) & (_reach(lon, "min_lon", "max_lon") < tolerance)
    per_point = Window.partitionBy("point")

    def pruned(cells: DataFrame) -> DataFrame:
        """Cells that may hold the nearest station, or touch the tolerance box."""
        bounded = cells.withColumn("_bound", F.min(far).over(per_point))
        return bounded.filter((near <= F.col("_bound")) | touches).drop("_bound")

    key = ["point", "latitude", "longitude"]
    top = F.array(*[F.struct(*[F.lit(cell[c]).alias(c) for c in _CELL]) for cell in index.top])
    walk = pruned(points.select(*key, F.inline(top)))
    for level in range(index.top[0].level, index.depth):
        children = index.cells.filter(F.col("level") == level + 1).select(
            F.col("px").alias("_px"), F.col("py").alias("_py"), *[F.col(c).alias(f"_{c}") for c in _CELL]
        )
        # cells that are not split stay in the walk as they are; a cell wholly in the box needs no more detail
        opened = walk.join(
            children,
            (F.col("level") == level) & F.col("is_split") & ~inside & (F.col("cx") == F.col("_px")) & (F.col("cy") == F.col("_py")),
            "left",
        )
        walk = pruned(opened.select(*key, *[F.coalesce(f"_{c}", c).alias(c) for c in _CELL]))
    whole = walk.withColumn("_whole", inside)
    members = index.members.select(
        F.col("level").alias("_level"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "station_id",
        F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"),
    )
    pairs = whole.join(
        members,
        ~F.col("_whole") & (F.col("level") == F.col("_level")) & (F.col("cx") == F.col("_cx")) & (F.col("cy") == F.col("_cy")),
        "left",
    )
    in_box = (F.abs(lat - F.col("s_lat")) < tolerance) & (F.abs(lon - F.col("s_lon")) < tolerance)
    hit = F.when(F.col("_whole"), F.col("first_id")).when(in_box, F.col("station_id"))
    distance = _squared(lat - F.col("s_lat")) + _squared(lon - F.col("s_lon"))
    best = pairs.groupBy(*key).agg(
        F.min(hit).alias("tol_station_id"),
        F.min_by("station_id", F.when(F.col("station_id").isNotNull(), F.struct(distance, F.col("station_id")))).alias(
            "near_station_id"
        ),
    )
    return best.drop("point").withColumn("station_id", F.coalesce("tol_station_id", "near_station_id"))


def stored_matches(coords: DataFrame, index: StationIndex) -> DataFrame:
    """``match_coordinates`` as a written table of (latitude, longitude, station_id).

    Spark then joins by the table's real size: a size guessed from the payloads it came from would make it
    shuffle every payload. Requests are made per station, so the table is broadcast unless it outgrows the
    session's limit.
    """
    spark = coords.sparkSession
    path = work_dir(spark, "matches")
    match_coordinates(coords, index).select("latitude", "longitude", "station_id").write.parquet(path)
    return spark.read.parquet(path)
