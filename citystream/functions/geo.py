"""Great-circle distance and a latitude/longitude grid, as plain column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000  # fixed value
CELL_REACHES = 4  # cell edge, in multiples of the search radius


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * F.lit(2.0 * EARTH_RADIUS_M)


def _lat_reach(radius_m: float) -> float:
    return math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)


def _lon_reach(abs_lat: Column, radius_m: float) -> Column:
    """Degrees of longitude that ``radius_m`` can span up to latitude ``abs_lat``."""
    chord = math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))
    shrink = F.cos(F.radians(F.least(abs_lat, F.lit(90.0))))
    ratio = F.when(shrink > chord, F.lit(chord) / shrink).otherwise(F.lit(1.0))
    return F.degrees(2 * F.asin(ratio)) * (1 + 1e-9)


def _band(lat: Column, radius_m: float) -> Column:
    return F.floor(lat / F.lit(CELL_REACHES * _lat_reach(radius_m)))


def _cells_in_band(band: Column, radius_m: float) -> Column:
    """How many cells ring the globe in a band: fewer towards the poles, one at them."""
    height = CELL_REACHES * _lat_reach(radius_m)
    edge = F.greatest(F.abs(band), F.abs(band + 1)) * F.lit(height) + F.lit(2 * _lat_reach(radius_m))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) / (CELL_REACHES * _lon_reach(edge, radius_m))))


def _column_of(lon: Column, cells: Column) -> Column:
    return F.floor((lon + 180) / 360 * cells)


def with_cell(df: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
    """Adds ``band`` and ``cell``, the one grid cell that holds a point."""
    ringed = df.withColumn("band", _band(F.col(lat), radius_m)).withColumn(
        "_cells", _cells_in_band(F.col("band"), radius_m))
    return ringed.withColumn("cell", F.pmod(_column_of(F.col(lon), F.col("_cells")), F.col("_cells"))).drop("_cells")


def with_cells_within(df: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
    """Repeats each row for every cell that may hold a point closer than ``radius_m``.

    Adds ``band`` and ``cell``; the pairs of one row are distinct, also across ±180°.
    """
    reach = _lat_reach(radius_m)
    lon_reach = _lon_reach(F.abs(F.col(lat)) + reach, radius_m)
    bands = F.sequence(_band(F.col(lat) - reach, radius_m), _band(F.col(lat) + reach, radius_m))
    ringed = df.withColumn("band", F.explode(bands)).withColumns({
        "_cells": _cells_in_band(F.col("band"), radius_m), "_reach": lon_reach})
    west = _column_of(F.col(lon) - F.col("_reach"), F.col("_cells"))
    east = _column_of(F.col(lon) + F.col("_reach"), F.col("_cells"))
    spread = ringed.withColumns({"_west": west, "_east": F.least(east, west + F.col("_cells") - 1)})
    return (spread.withColumn("_column", F.explode(F.sequence("_west", "_east")))
            .withColumn("cell", F.pmod("_column", "_cells"))
            .drop("_cells", "_reach", "_west", "_east", "_column"))
