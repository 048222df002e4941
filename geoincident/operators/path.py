"""Length of ordered point tracks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoincident.functions.geo import EARTH_RADIUS_KM, great_circle_km
from geoincident.functions.units import length_factor
from geoincident.operators.geodesic import ellipsoid_params, geodesic_km, inverse, principal_radii
from geoincident.session import ship_package


def _great_circle(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Arc on the unit sphere, by the formula of ``great_circle_km``."""
    p1, p2, dl = np.radians(lat1), np.radians(lat2), np.radians(lon2) - np.radians(lon1)
    y = np.hypot(np.cos(p2) * np.sin(dl), np.cos(p1) * np.sin(p2) - np.sin(p1) * np.cos(p2) * np.cos(dl))
    return np.arctan2(y, np.sin(p1) * np.sin(p2) + np.cos(p1) * np.cos(p2) * np.cos(dl))


def _starts(columns: list[pa.Array]) -> np.ndarray:
    """Where a row's track differs from that of the row before (the first row counts as different); nulls are equal."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        new[1:] |= differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return new


def path_length(df: DataFrame, track_cols: Sequence[str], order_cols: Sequence[str],
                lat: str = "lat", lon: str = "lon", metric: str = "great_circle",
                radius_km: float = EARTH_RADIUS_KM, ellipsoid="WGS-84",
                out_col: str = "path_km", points_col: str = "points",
                slices: int | None = None, unit: str = "km") -> DataFrame:
    """Sum of the distances between consecutive points of every track, in ``unit``.

    ``order_cols`` must order a track totally. A track of one point has
    length 0. Rows with a null coordinate are skipped.

    Skew-safe plan with one exchange of the rows: they are range-partitioned on
    (track, order) into ``slices`` ranges, so one very long track is spread over
    many tasks, and sorted there. Each task reads its rows once, in Arrow
    batches, and gives one row per track that it holds: length, points, first and
    last point. The pairs that cross from one range to the next come from those
    rows, at most one per track and range.
    """
    if metric not in ("great_circle", "geodesic"):
        raise ValueError("metric must be 'great_circle' or 'geodesic'")
    tracks, order = list(track_cols), list(order_cols)
    scale = length_factor("km", unit)
    a, f = ellipsoid_params(ellipsoid)
    principal_radii(a, f)
    ship_package(df.sparkSession)
    pts = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        *tracks, *order, F.col(lat).cast("double").alias("__lat"), F.col(lon).cast("double").alias("__lon"))
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (pts.repartitionByRange(n, *tracks, *order).sortWithinPartitions(*tracks, *order)
             .select(*tracks, "__lat", "__lon"))
    schema = T.StructType([*dealt.select(*tracks).schema, T.StructField("__slice", T.IntegerType()),
                           T.StructField("__nth", T.LongType()), T.StructField("__len", T.DoubleType()),
                           T.StructField("__n", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("__lat0", "__lon0", "__lat1", "__lon1")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i) for i in range(len(tracks))]
            x, y = (batch.column(i).to_numpy() for i in (len(tracks), len(tracks) + 1))
            at = np.flatnonzero(_starts(columns))
            if metric == "great_circle":
                step = _great_circle(x[:-1], y[:-1], x[1:], y[1:]) * radius_km
            else:
                step = inverse(x[:-1], y[:-1], x[1:], y[1:], a, f)[0]
            step = np.concatenate([[0.0], step])
            step[at] = 0.0  # no way leads from one track to the next
            count = np.diff(np.append(at, len(x)))
            end = at + count - 1
            numbers = nth + np.arange(len(at))
            nth += len(at)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(at)) for c in columns), pa.array(np.full(len(at), part, dtype=np.int32)),
                 pa.array(numbers), pa.array(np.add.reduceat(step, at)), pa.array(count),
                 *(pa.array(v) for v in (x[at], y[at], x[end], y[end]))], names=schema.names)

    # a track that goes on in the next batch or the next range has a row for each
    parts = dealt.mapInArrow(run, schema)
    along = Window.partitionBy(*tracks).orderBy("__slice", "__nth")
    before = [F.lag(c).over(along) for c in ("__lat1", "__lon1")]
    joined = parts.withColumns({"__lat2": before[0], "__lon2": before[1]})
    ends = [F.col(c) for c in ("__lat2", "__lon2", "__lat0", "__lon0")]
    bridge = great_circle_km(*ends, radius_km) if metric == "great_circle" else geodesic_km(*ends, ellipsoid)
    joined = joined.withColumn("__bridge", F.when(F.col("__lat2").isNull(), F.lit(0.0)).otherwise(bridge))
    return joined.groupBy(*tracks).agg(
        ((F.sum("__len") + F.sum("__bridge")) * F.lit(scale)).alias(out_col), F.sum("__n").alias(points_col))
