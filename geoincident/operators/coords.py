"""Coordinate cleaning and parsing as table jobs.

The ``tag_*`` forms add a ``reject_reason`` column (null = valid) in one
projection and keep every row; the split forms return (valid, rejects).
Prefer the tagged form when both halves go to the same sink: a filter on the
reason would be pushed below the projections and re-evaluate the parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoincident.functions.coordtext import parsed_point
from geoincident.functions.geo import (REJECT_UNPARSEABLE, altitude_mismatch,
                                        coordinate_reject_reason, wrap_longitude)

REASON_COL = "reject_reason"


def tag_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon",
                    alt: str | None = None) -> DataFrame:
    """Add ``reject_reason``; on valid rows wrap the longitude (only when
    abs > 180) and read a null altitude as 0 km. Rejected rows keep their
    values. Valid: both parts present and finite, abs(lat) <= 90."""
    tagged = df.withColumn(REASON_COL, coordinate_reject_reason(lat, lon, alt))
    ok = F.col(REASON_COL).isNull()
    tagged = tagged.withColumn(lon, F.when(ok, wrap_longitude(lon)).otherwise(F.col(lon)))
    if alt is not None:
        tagged = tagged.withColumn(alt, F.when(ok, F.coalesce(F.col(alt), F.lit(0.0))).otherwise(F.col(alt)))
    return tagged


def _split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = tagged.where(F.col(REASON_COL).isNull()).drop(REASON_COL)
    rejects = tagged.where(F.col(REASON_COL).isNotNull())
    return valid, rejects


def clean_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon",
                      alt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of :func:`tag_coordinates`."""
    return _split(tag_coordinates(df, lat, lon, alt))


def tag_parsed_coordinates(df: DataFrame, text: str, lat: str = "lat", lon: str = "lon",
                           alt: str = "alt_km") -> DataFrame:
    """Parse coordinate text (decimal or degree/minute/second, N/S/E/W in
    front or behind, optional altitude with km, m, mi, ft, nm or nmi) into
    lat, lon, alt_km and tag it as :func:`tag_coordinates` does; text that
    does not fit the grammar is tagged ``unparseable``.

    All of it are column expressions; the work is linear in the texts' length."""
    out = df.withColumn("__point", parsed_point(F.col(text)))
    out = (out.withColumn(lat, F.col("__point.lat")).withColumn(lon, F.col("__point.lon"))
           .withColumn(alt, F.col("__point.alt_km")))
    tagged = tag_coordinates(out, lat, lon, alt)
    tagged = tagged.withColumn(alt, F.when(F.col("__point.ok"), F.col(alt)))
    return tagged.withColumn(REASON_COL, F.when(~F.col("__point.ok"), F.lit(REJECT_UNPARSEABLE))
                             .otherwise(F.col(REASON_COL))).drop("__point")


def parse_coordinates(df: DataFrame, text: str, lat: str = "lat", lon: str = "lon",
                      alt: str = "alt_km") -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of :func:`tag_parsed_coordinates`."""
    return _split(tag_parsed_coordinates(df, text, lat, lon, alt))


def altitude_conflicts(df: DataFrame, alt1: str, alt2: str) -> DataFrame:
    """Rows whose two altitudes differ by more than the tolerance."""
    return df.where(altitude_mismatch(alt1, alt2))
