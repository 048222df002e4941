"""DataFrame forms of the distance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from geoincident.functions.geo import EARTH_RADIUS_KM, destination, great_circle_km
from geoincident.operators.geodesic import geodesic_km


def with_great_circle_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                         out: str = "great_circle_km", radius_km: float = EARTH_RADIUS_KM,
                         unit: str = "km") -> DataFrame:
    """Add the great-circle distance between two points of each row."""
    return df.withColumn(out, great_circle_km(lat1, lon1, lat2, lon2, radius_km, unit))


def with_geodesic_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                     out: str = "geodesic_km", ellipsoid="WGS-84", unit: str = "km") -> DataFrame:
    """Add the ellipsoidal distance (named ellipsoid or (a, b, f) tuple)."""
    return df.withColumn(out, geodesic_km(lat1, lon1, lat2, lon2, ellipsoid, unit))


def with_destination(df: DataFrame, lat: str, lon: str, bearing: str, distance: str,
                     out_lat: str = "dest_lat", out_lon: str = "dest_lon", unit: str = "km",
                     radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """Add the great-circle destination reached from (lat, lon) along an
    initial bearing (degrees) after ``distance`` (in ``unit``)."""
    la, lo = destination(lat, lon, bearing, distance, unit, radius_km)
    return df.withColumns({out_lat: la, out_lon: lo})
