"""Spatial joins without a cross product.

Points are mapped to unit vectors on the sphere and bucketed into a 3-D grid of
cubes: no poles and no date line. A range join uses cubes whose edge is twice
the reach: a point of the right side is copied into the cubes that its ball's
box touches, at most 8, a point of the left side lies in one, so a pair meets
once and none outside the neighbourhood is ever formed. Cubes that hold many rows
are counted and split on both sides. The nearest search descends an octree
(``octree.py``).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoincident.functions.geo import EARTH_RADIUS_KM, chord_of_km, great_circle_km, unit_vector
from geoincident.operators.geodesic import (ellipsoid_params, geodesic_km, ratio_bound,
                                            spherical_ratio_bounds)
from geoincident.operators.joins import MAX_BROADCAST_ROWS, checked_broadcast
from geoincident.operators.octree import cell_key, nearest_candidates
from geoincident.session import ensure_checkpoint_dir

_SLACK = 1e-9
#: rows of one side in a cube of the range join beyond which it is split
CUBE_ROWS = 100_000
#: distances rounded to float32 tie when they are this close
_FLOAT_SLACK = 2.5e-7


def _xyz(df: DataFrame, lat: str, lon: str, p: str) -> DataFrame:
    x, y, z = unit_vector(lat, lon)
    return df.withColumns({p + "x": x, p + "y": y, p + "z": z})


def _keys(prefix: str) -> list[str]:
    return [prefix + "x", prefix + "y", prefix + "z"]


def _check_disjoint(a: DataFrame, b: DataFrame) -> None:
    both = sorted(set(a.columns) & set(b.columns))
    if both:
        raise ValueError(f"column names present on both sides, rename them first: {both}")


def _split_cubes(left: DataFrame, right: DataFrame, cube: list[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the part of their cube (__i of the left rows, __j of the right ones); cubes of more than ``rows``
    rows of a side have several, all others one. The counts are map-side sums; only the large cubes are kept of them."""
    counts = left.groupBy(*cube).agg(F.count(F.lit(1)).alias("l")).join(
        right.groupBy(*cube).agg(F.count(F.lit(1)).alias("r")), cube)  # a cube of one side has no pairs
    large = counts.where((F.col("l") > rows) | (F.col("r") > rows)).select(
        *cube, F.ceil(F.col("l") / F.lit(rows)).alias("__nl"), F.ceil(F.col("r") / F.lit(rows)).alias("__nr"))

    def parts(df: DataFrame, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
        turn = F.when(F.col(n_own).isNull(), F.lit(0)).otherwise(F.pmod(F.col("__t"), F.col(n_own)))
        every = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(n_other), F.lit(1)) - F.lit(1))
        return (df.withColumn("__t", F.monotonically_increasing_id()).join(large, cube, "left")
                .withColumn(own, turn.cast("long")).withColumn(other, F.explode(every)).drop("__nl", "__nr", "__t"))

    return parts(left, "__i", "__j", "__nl", "__nr"), parts(right, "__j", "__i", "__nr", "__nl")


def within_distance_join(left: DataFrame, right: DataFrame, km: float,
                         left_lat: str = "lat", left_lon: str = "lon",
                         right_lat: str = "lat", right_lon: str = "lon",
                         radius_km: float = EARTH_RADIUS_KM,
                         distance_col: str = "distance_km",
                         max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                         metric: str = "great_circle", ellipsoid="WGS-84",
                         cube_rows: int = CUBE_ROWS) -> DataFrame:
    """All (left, right) pairs within ``km`` of each other (range join).

    ``metric="great_circle"`` measures on the sphere of ``radius_km``;
    ``"geodesic"`` on the ellipsoid: candidate pairs come from the sphere
    bound geodesic >= lo * great-circle (lo proven for the ellipsoid), then
    the geodesic UDF filters them exactly.

    ``right`` is the side that is copied, at most 8 times (pass the smaller
    table as ``right``); it is broadcast only if its copied size is proven below
    the bound, else both sides shuffle on the cube. Cubes of more than
    ``cube_rows`` rows of a side are then split: a row of that side takes one of
    the parts by turns and meets a copy of the other side's rows in each.
    Column names of the two inputs must not overlap (rename first).
    """
    if km < 0:
        raise ValueError("km must be >= 0")
    _check_disjoint(left, right)
    if metric not in ("great_circle", "geodesic"):
        raise ValueError("metric must be 'great_circle' or 'geodesic'")
    reach = km
    if metric == "geodesic":
        lo, _hi = spherical_ratio_bounds(ellipsoid, radius_km)
        reach = km / lo
    size = chord_of_km(reach, radius_km) * (1 + _SLACK) + 1e-15
    edge = F.lit(2.0 * size)
    L = _xyz(left.where(F.col(left_lat).isNotNull() & F.col(left_lon).isNotNull()), left_lat, left_lon, "__l")
    L = L.withColumns({"__g" + a: F.floor(F.col("__l" + a) / edge) for a in "xyz"}).drop(*_keys("__l"))
    R = _xyz(right.where(F.col(right_lat).isNotNull() & F.col(right_lon).isNotNull()), right_lat, right_lon, "__r")
    for a in "xyz":
        from_to = [F.floor((F.col("__r" + a) + s * F.lit(size)) / edge) for s in (F.lit(-1.0), F.lit(1.0))]
        R = R.withColumn("__g" + a, F.explode(F.sequence(*from_to)))
    R = R.drop(*_keys("__r"))
    R, small = checked_broadcast(R, max_broadcast_rows)
    on = _keys("__g")
    if not small:
        L, R = _split_cubes(L, R, on, cube_rows)
        on = [*on, "__i", "__j"]
    gc = great_circle_km(F.col(left_lat), F.col(left_lon), F.col(right_lat), F.col(right_lon), radius_km)
    pairs = L.join(R, on=on, how="inner")
    if metric == "great_circle":
        pairs = pairs.withColumn(distance_col, gc).where(F.col(distance_col) <= F.lit(km))
    else:
        pairs = (pairs.where(gc <= F.lit(reach * (1 + _SLACK)))
                 .withColumn(distance_col, geodesic_km(left_lat, left_lon, right_lat, right_lon, ellipsoid))
                 .where(F.col(distance_col) <= F.lit(km)))
    helper = [c for c in pairs.columns if c.startswith("__")]
    return pairs.drop(*helper)


# ------------------------------------------------------------ nearest

def nearest_facility(inc: DataFrame, fac: DataFrame, id_cols: Sequence[str],
                     inc_lat: str = "lat", inc_lon: str = "lon",
                     fac_lat: str = "lat", fac_lon: str = "lon",
                     keep_ties: bool = False, metric: str = "great_circle",
                     ellipsoid="WGS-84", radius_km: float = EARTH_RADIUS_KM,
                     cell_km: float | None = None, distance_col: str = "distance_km",
                     checkpoint: bool = True,
                     max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                     precision: str = "double") -> DataFrame:
    """Distance from every incident group to its nearest facility, exactly.

    ``id_cols`` name an incident group (a repeated id forms one group).
    * ``keep_ties=False``: one row per group: ``id_cols`` + ``distance_col``
      (the minimum over all rows of the group and all facilities).
    * ``keep_ties=True``: every (incident row, facility) pair whose distance
      equals its group's minimum, with all incident and facility columns.

    ``metric`` is ``"great_circle"`` (sphere of ``radius_km``) or
    ``"geodesic"`` (an ellipsoid of either sign of flattening). For the ellipsoid
    the candidates' reach is widened by the proven ellipsoid/sphere distance
    ratio, and the geodesic UDF runs on each incident's candidates only.

    Plan: the candidates of every occupied cell come from a descent of an octree
    of both tables (``octree.nearest_candidates``); then the incident table
    joins its cells' candidates once per level at which cells settled (one,
    unless facilities cluster). ``cell_km`` overrides the counted edge of the
    cells at which most settle. No incident x facility cross product is formed.
    Incident and facility column names must not overlap.

    ``precision="float"`` rounds every distance to float32 before minima and
    ties are taken (the original per-row UDF returned float32, which ties
    more often); the default keeps doubles.

    ``checkpoint=False`` keeps everything lazy, without cutting lineage; it
    is meant for small inputs and tests only.
    """
    if metric not in ("great_circle", "geodesic"):
        raise ValueError("metric must be 'great_circle' or 'geodesic'")
    if precision not in ("double", "float"):
        raise ValueError("precision must be 'double' or 'float'")
    _check_disjoint(inc, fac)
    spark = inc.sparkSession
    if checkpoint:
        ensure_checkpoint_dir(spark)
    base = None if cell_km is None else round(math.log2(2.0 * radius_km / cell_km))
    ratio = ratio_bound(ellipsoid_params(ellipsoid)[1]) if metric == "geodesic" else 1.0
    slack = _SLACK if precision == "double" else _FLOAT_SLACK
    I = _xyz(inc.where(F.col(inc_lat).isNotNull() & F.col(inc_lon).isNotNull()), inc_lat, inc_lon, "__i")
    Fc = _xyz(fac.where(F.col(fac_lat).isNotNull() & F.col(fac_lon).isNotNull()), fac_lat, fac_lon, "__s")
    if not keep_ties:  # a place counts once
        Fc = Fc.select(fac_lat, fac_lon, *_keys("__s")).dropDuplicates([fac_lat, fac_lon])
    if checkpoint:
        Fc = Fc.checkpoint()
    pairs = None
    for level, cand in nearest_candidates(I, "__i", Fc, "__s", ratio, slack, max_broadcast_rows, checkpoint, base):
        if checkpoint:
            cand = cand.checkpoint()
        cand, _ = checked_broadcast(cand.drop(*_keys("__s")), max_broadcast_rows)
        part = I.withColumn("__q", cell_key("__i", level)).join(cand, "__q").drop("__q", *_keys("__i"))
        pairs = part if pairs is None else pairs.unionByName(part)
    if pairs is None:  # no incident or no facility
        pairs = I.drop(*_keys("__i")).join(Fc.drop(*_keys("__s")), F.lit(False))
    if metric == "great_circle":
        dist = great_circle_km(F.col(inc_lat), F.col(inc_lon), F.col(fac_lat), F.col(fac_lon), radius_km)
    else:
        dist = geodesic_km(inc_lat, inc_lon, fac_lat, fac_lon, ellipsoid)
    pairs = pairs.withColumn(distance_col, dist.cast(precision))
    if keep_ties and checkpoint:
        pairs = pairs.checkpoint()  # measured once for the minimum and for the ties
    ids = list(id_cols)
    best = pairs.groupBy(*ids).agg(F.min(distance_col).alias(distance_col))
    if not keep_ties:
        return best
    best = best.select(*(F.col(c).alias(f"__id{i}") for i, c in enumerate(ids)), F.col(distance_col).alias("__best"))
    same = F.lit(True)  # a null id is a group like any other
    for i, c in enumerate(ids):
        same = same & F.col(c).eqNullSafe(F.col(f"__id{i}"))
    return (pairs.join(best, same, "inner").where(F.col(distance_col) == F.col("__best"))
            .drop("__best", *(f"__id{i}" for i in range(len(ids)))))
