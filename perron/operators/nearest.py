"""Nearest station to one point or to every row of a point table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.functions import haversine_km, unit_sphere
from perron.operators.joins import split_join, spread_by_work

# Finest grid: cells of 2/16384 of the Earth's radius, about 0.8 km.
FINEST = 14
STEPS = 1 << FINEST
# Far above rounding errors, far below a metre's effect on the result.
SLACK = 1e-9


def located(stations: DataFrame) -> DataFrame:
    return stations.where("latitude is not null and longitude is not null").select(
        "station_key", "station_name", "latitude", "longitude"
    )


def nearest_station(stations: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """The closest station to a point; a tie goes to the lower key."""
    distance = haversine_km(F.lit(latitude), F.lit(longitude), F.col("latitude"), F.col("longitude"))
    return (
        located(stations)
        .select("station_key", "station_name", distance.alias("distance_km"))
        .orderBy("distance_km", "station_key")
        .limit(1)
    )


# ---- many points ------------------------------------------------------------
#
# Points and stations lie in nested cubic grids around the unit sphere. Occupied point
# cells form a tree, and it is descended level by level with the stations that may still be the
# nearest one for some place in the cell: those whose distance from the cell's centre exceeds
# the smallest such distance by no more than twice the way from the centre to a corner. A station that is
# nearest for a place is kept in every cell around that place, so nothing is lost. Cells shrink eightfold
# a step, and so does what is kept - also for places far from all stations. Contenders are
# worked out once per finest cell (there are only so many on Earth) and then meet its points.


# A grid cell is one BIGINT: level, then 20 bits for each axis.
_AXIS_BITS = 20
_AXIS_MASK = (1 << _AXIS_BITS) - 1
_LEVELS = range(2, FINEST + 1, 3)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _pack(level: Column, x: Column, y: Column, z: Column) -> Column:
    high = F.shiftleft(level.cast("long"), 3 * _AXIS_BITS).bitwiseOR(F.shiftleft(x, 2 * _AXIS_BITS))
    return high.bitwiseOR(F.shiftleft(y, _AXIS_BITS)).bitwiseOR(z)


def _axes(cell: Column) -> list[Column]:
    return [F.shiftright(cell, bits).bitwiseAND(_long(_AXIS_MASK)) for bits in (2 * _AXIS_BITS, _AXIS_BITS, 0)]


def _cell(lat: Column, lon: Column) -> Column:
    """The finest cell of a place."""

    def axis(value: Column) -> Column:
        return F.least(F.greatest(F.floor((value + 1) / 2 * STEPS).cast("long"), _long(0)), _long(STEPS - 1))

    return _pack(F.lit(FINEST), *[axis(value) for value in unit_sphere(lat, lon)])


def _coarser(cell: Column, level: int) -> Column:
    """The cell of grid ``level`` around a finest cell."""
    return _pack(F.lit(level), *[F.shiftright(axis, FINEST - level) for axis in _axes(cell)])


def _from_centre(cell: Column, level: int) -> Column:
    """Straight distance from the middle of a cell of grid ``level`` to (sx, sy, sz)."""

    def squared(axis: Column, place: str) -> Column:
        gap = (axis + 0.5) / (1 << level) * 2 - 1 - F.col(place)
        return gap * gap

    x, y, z = (squared(axis, place) for axis, place in zip(_axes(cell), ("sx", "sy", "sz")))
    return F.sqrt(x + y + z)


def _contenders(points: DataFrame, stations: DataFrame) -> DataFrame:
    """(cell, station) pairs that contain the nearest station of every point of the cell.

    The first step compares all stations with at most 64 cells. A step's cells are told by
    the finest ones; the hot cell of a step is split by the join.
    """
    cells = points.select("cell").distinct()
    found = stations.withColumn("grid", _coarser(F.col("cell"), 0)).drop("cell")
    for level in _LEVELS:
        up = _coarser(F.col("cell"), max(level - _LEVELS.step, 0))
        own = cells.select(_coarser(F.col("cell"), level).alias("own"), up.alias("grid")).distinct()
        # on fine grids: few bytes, much work
        own = spread_by_work(own, "grid") if level > FINEST // 2 + 1 else own
        near = split_join(own, found, ["grid"], "inner").drop("grid")
        near = near.withColumn("from_centre", _from_centre(F.col("own"), level))
        closest = F.min("from_centre").over(Window.partitionBy("own"))
        kept = F.col("from_centre") <= F.col("closest") + 2 * 3**0.5 / (1 << level) + SLACK
        found = near.withColumn("closest", closest).where(kept).drop("from_centre", "closest").withColumnRenamed("own", "grid")
    return found.drop("sx", "sy", "sz").withColumnRenamed("grid", "cell")


def nearest_station_batch(points: DataFrame, stations: DataFrame) -> DataFrame:
    """The closest station of every (point_id, lat, lon) row, exactly."""
    lat, lon = F.col("lat"), F.col("lon")
    placed = points.withColumn("cell", _cell(lat, lon))
    # stations at one spot are one candidate: the lowest key wins any tie
    spots = (
        located(stations)
        .groupBy("latitude", "longitude")
        .agg(F.min_by(F.struct("station_key", "station_name"), "station_key").alias("s"))
        .select("latitude", "longitude", "s.*")
    )
    latitude, longitude = F.col("latitude"), F.col("longitude")
    sx, sy, sz = unit_sphere(latitude, longitude)
    spots = spots.withColumns({"cell": _cell(latitude, longitude), "sx": sx, "sy": sy, "sz": sz})
    distance = haversine_km(lat, lon, latitude, longitude)
    return (
        split_join(placed, _contenders(placed, spots), ["cell"], "inner")
        .select("point_id", "station_key", "station_name", distance.alias("distance_km"))
        .groupBy("point_id")
        .agg(
            F.min_by(
                F.struct("station_key", "station_name", "distance_km"), F.struct("distance_km", "station_key")
            ).alias("best")
        )
        .select("point_id", "best.*")
    )
