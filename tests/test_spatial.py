import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoincident.operators.geodesic import ellipsoid_params, vincenty_km
from geoincident.operators.joins import plan_text
from geoincident.operators.spatial import nearest_facility, within_distance_join

R = 6371.009


def gc(a, b, c, d):
    p1, p2, dl = map(math.radians, (a, c, d - b))
    return R * math.atan2(math.hypot(math.cos(p2) * math.sin(dl), math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(dl)),
                          math.sin(p1) * math.sin(p2) + math.cos(p1) * math.cos(p2) * math.cos(dl))


def _points(rng, n, world):
    if world:
        lat = np.degrees(np.arcsin(rng.uniform(-1, 1, n)))
        lon = rng.uniform(-180, 180, n)
    else:
        lat = rng.uniform(33.7, 34.35, n)
        lon = rng.uniform(-118.7, -118.1, n)
    return list(zip(lat.tolist(), lon.tolist()))


@pytest.mark.parametrize("world", [False, True])
def test_nearest_great_circle_matches_brute_force(spark, world):
    rng = np.random.default_rng(11 if world else 5)
    inc = _points(rng, 300, world) + [(89.9, 10.0), (-89.95, -170.0), (0.0, 179.999), (0.0, -179.999)]
    fac = _points(rng, 40, world) + [(90.0, 0.0), (0.0, -179.99)]
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    got = {r.id: r.distance_km for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon",
                                                         cell_km=5.0 if not world else 200.0).collect()}
    assert len(got) == len(inc)
    for i, (a, b) in enumerate(inc):
        exp = min(gc(a, b, c, d) for c, d in fac)
        assert got[i] == pytest.approx(exp, abs=1e-9), i


def test_nearest_keeps_ties_and_repeated_ids(spark):
    # incident 1 lies exactly between two stations; id 2 appears twice
    idf = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 10.0), (2, 10.0, 10.5), (3, None, 1.0)],
                                "id long, lat double, lon double")
    fdf = spark.createDataFrame([("A", 0.0, -1.0), ("B", 0.0, 1.0), ("C", 10.0, 10.4)],
                                "div string, flat double, flon double")
    ties = nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True).collect()
    by_id = {}
    for r in ties:
        by_id.setdefault(r.id, []).append(r)
    assert sorted(r.div for r in by_id[1]) == ["A", "B"]
    assert [(r.lon, r.div) for r in by_id[2]] == [(10.5, "C")]   # min over both rows of id 2
    assert 3 not in by_id                                         # null coordinate rejected
    best = {r.id: r.distance_km for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon").collect()}
    assert best[1] == pytest.approx(gc(0, 0, 0, 1))


def test_nearest_geodesic_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    inc = _points(rng, 200, True)
    fac = _points(rng, 30, True)
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    got = {r.id: r for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True,
                                             metric="geodesic", cell_km=300.0).collect()}
    a, f = ellipsoid_params("WGS-84")
    for i, (la, lo) in enumerate(inc):
        d = vincenty_km([la] * len(fac), [lo] * len(fac), [c for c, _ in fac], [e for _, e in fac], a, f)
        if np.isnan(d).any():
            continue
        j = int(np.argmin(d))
        assert got[i].fid == j and got[i].distance_km == pytest.approx(d[j], abs=1e-9)


def test_nearest_has_no_cartesian_product(spark):
    idf = spark.createDataFrame([(1, 34.0, -118.0)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(1, 34.1, -118.1)], "fid long, flat double, flon double")
    text = plan_text(nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon"))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_within_distance_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    a = _points(rng, 400, False) + [(0.0, 179.9999), (89.99, 0.0)]
    b = _points(rng, 30, False) + [(0.0, -179.9999), (89.99, 120.0)]
    adf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(a)], "aid long, lat double, lon double")
    bdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(b)], "bid long, blat double, blon double")
    km = 5.0
    got = {(r.aid, r.bid) for r in within_distance_join(adf, bdf, km, "lat", "lon", "blat", "blon").collect()}
    exp = {(i, j) for i, (x, y) in enumerate(a) for j, (u, v) in enumerate(b) if gc(x, y, u, v) <= km}
    assert got == exp
    assert (len(a) - 2, len(b) - 2) in got and (len(a) - 1, len(b) - 1) in got
    text = plan_text(within_distance_join(adf, bdf, km, "lat", "lon", "blat", "blon"))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_shuffle_paths_and_hot_cube(spark):
    """No broadcast allowed, and one cube holding a third of all incidents."""
    rng = np.random.default_rng(21)
    spread = _points(rng, 200, False)
    hot = [(34.0 + 1e-5 * i, -118.3) for i in range(100)]          # ~1 m apart, same cube
    inc = spread + hot
    fac = _points(rng, 25, False)
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    got = {r.id: r.distance_km for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon",
                                                         max_broadcast_rows=0).collect()}
    for i, (a, b) in enumerate(inc):
        assert got[i] == pytest.approx(min(gc(a, b, c, d) for c, d in fac), abs=1e-9)
    pairs = within_distance_join(idf, fdf, 3.0, "lat", "lon", "flat", "flon", max_broadcast_rows=0)
    exp = {(i, j) for i, (x, y) in enumerate(inc) for j, (u, v) in enumerate(fac) if gc(x, y, u, v) <= 3.0}
    assert {(r.id, r.fid) for r in pairs.collect()} == exp


def test_dense_facility_cluster_is_refined_and_exact(spark):
    """A third of the facilities packed into a few metres next to incidents."""
    rng = np.random.default_rng(33)
    fac = _points(rng, 40, False) + [(34.0 + 2e-5 * (i % 10), -118.3 + 2e-5 * (i // 10)) for i in range(30)]
    fac += [fac[-1]]                                   # an exact duplicate row stays a tie
    inc = _points(rng, 150, False) + [(34.0 + 1e-3 * i, -118.3005 + 1e-4 * i) for i in range(40)]
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    ties = nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True).collect()
    got = {}
    for r in ties:
        got.setdefault(r.id, []).append((r.fid, r.distance_km))
    for i, (a, b) in enumerate(inc):
        d = [gc(a, b, c, e) for c, e in fac]
        m = min(d)
        assert sorted(f for f, _ in got[i]) == sorted(j for j, x in enumerate(d) if x == m), i
        assert all(x == pytest.approx(m, abs=1e-9) for _, x in got[i])


@pytest.mark.parametrize("world,metric", [(False, "great_circle"), (True, "great_circle"), (True, "geodesic")])
def test_search_beside_a_cluster_is_exact(spark, world, metric):
    """The descent gives the same exact answer as brute force, ties included."""
    rng = np.random.default_rng(44 if world else 45)
    inc = _points(rng, 250, world) + [(89.9, 10.0), (0.0, 179.999)]
    fac = _points(rng, 35, world) + [(34.0 + 2e-5 * i, -118.3) for i in range(25)] + [(0.0, -179.99)]
    fac += [fac[3]]                                     # duplicate row: a tie
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    rows = nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True, metric=metric,
                            cell_km=200.0 if world else 2.0).collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.fid, r.distance_km))
    A_, F2 = ellipsoid_params("WGS-84")
    for i, (a, b) in enumerate(inc):
        if metric == "great_circle":
            d = [gc(a, b, c, e) for c, e in fac]
        else:
            d = list(vincenty_km([a] * len(fac), [b] * len(fac), [c for c, _ in fac], [e for _, e in fac], A_, F2))
        m = min(d)
        assert sorted(f for f, _ in got[i]) == sorted(j for j, x in enumerate(d) if x == m), i
        assert all(x == pytest.approx(m, abs=1e-9) for _, x in got[i])


def test_nearest_with_no_facilities_is_empty(spark):
    idf = spark.createDataFrame([(1, 34.0, -118.0)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([], "fid long, flat double, flon double")
    assert nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon").count() == 0
    assert nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True).count() == 0


def test_within_distance_geodesic_matches_brute_force(spark):
    rng = np.random.default_rng(12)
    a = _points(rng, 300, False)
    b = _points(rng, 25, False)
    adf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(a)], "aid long, lat double, lon double")
    bdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(b)], "bid long, blat double, blon double")
    A_, F2 = ellipsoid_params("WGS-84")
    km = 6.0
    got = {(r.aid, r.bid) for r in within_distance_join(adf, bdf, km, "lat", "lon", "blat", "blon",
                                                         metric="geodesic").collect()}
    exp = {(i, j) for i, (x, y) in enumerate(a) for j, (u, v) in enumerate(b)
           if vincenty_km([x], [y], [u], [v], A_, F2)[0] <= km}
    assert got == exp and len(exp) > 0


def test_overlapping_column_names_are_refused(spark):
    a = spark.createDataFrame([(1, 34.0, -118.0)], "id long, lat double, lon double")
    with pytest.raises(ValueError):
        nearest_facility(a, a, ["id"])
    with pytest.raises(ValueError):
        within_distance_join(a, a, 1.0)


def test_hot_repeated_id_holds_a_third_of_rows(spark):
    rng = np.random.default_rng(77)
    pts = _points(rng, 300, False)
    ids = [0 if i % 3 == 0 else i for i in range(len(pts))]          # id 0: a third of all rows
    fac = _points(rng, 20, False)
    idf = spark.createDataFrame([(k, a, b) for k, (a, b) in zip(ids, pts)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    best = {r.id: r.distance_km for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon",
                                                          max_broadcast_rows=0).collect()}
    exp = {}
    for k, (a, b) in zip(ids, pts):
        d = min(gc(a, b, c, e) for c, e in fac)
        exp[k] = min(exp.get(k, d), d)
    assert set(best) == set(exp)
    for k in exp:
        assert best[k] == pytest.approx(exp[k], abs=1e-9)
    ties = nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True,
                            max_broadcast_rows=0).where("id = 0").collect()
    assert len(ties) >= 1 and all(r.distance_km == pytest.approx(exp[0], abs=1e-9) for r in ties)


@pytest.mark.parametrize("ellipsoid", [(6378.137, 6697.0, -0.05), (6378.137, 5102.5, 0.2)])
def test_searches_on_ellipsoids_of_either_sign(spark, ellipsoid):
    rng = np.random.default_rng(18)
    a = _points(rng, 250, True) + [(0.3, 10.0), (-89.9, 0.0), (0.0, 179.9999)]
    b = _points(rng, 60, True) + [(0.3, 11.0), (-89.5, 120.0), (0.0, -179.9999)]
    adf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(a)], "aid long, lat double, lon double")
    bdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(b)], "bid long, blat double, blon double")
    km = [vincenty_km([x] * len(b), [y] * len(b), [u for u, _ in b], [v for _, v in b], ellipsoid[0], ellipsoid[2]) for x, y in a]
    for reach in (100.0, 1500.0):
        got = {(r.aid, r.bid) for r in within_distance_join(adf, bdf, reach, "lat", "lon", "blat", "blon",
                                                            metric="geodesic", ellipsoid=ellipsoid).collect()}
        assert got == {(i, j) for i in range(len(a)) for j in range(len(b)) if km[i][j] <= reach}
    best = {r.aid: (r.bid, r.distance_km) for r in nearest_facility(
        adf, bdf, ["aid"], "lat", "lon", "blat", "blon", keep_ties=True, metric="geodesic", ellipsoid=ellipsoid,
        cell_km=300.0).collect()}
    assert {i: best[i][0] for i in best} == {i: int(np.argmin(d)) for i, d in enumerate(km)}


@pytest.mark.parametrize("cube_rows", [100_000, 7])
def test_range_join_with_half_of_all_points_in_one_cube(spark, cube_rows):
    rng = np.random.default_rng(40)
    a = _points(rng, 150, False) + [(34.01 + 1e-5 * (i % 20), -118.31) for i in range(150)]  # also repeated points
    b = _points(rng, 40, False) + [(34.0101 + 1e-5 * (i % 9), -118.3101) for i in range(40)]
    adf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(a)], "aid long, lat double, lon double")
    bdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(b)], "bid long, blat double, blon double")
    got = within_distance_join(adf, bdf, 2.0, "lat", "lon", "blat", "blon", max_broadcast_rows=0, cube_rows=cube_rows).collect()
    exp = [(i, j) for i, (x, y) in enumerate(a) for j, (u, v) in enumerate(b) if gc(x, y, u, v) <= 2.0]
    assert sorted((r.aid, r.bid) for r in got) == exp and len(exp) >= 6000  # every pair once


def test_range_join_copies_a_point_eight_times_at_most(spark):
    bdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(_points(np.random.default_rng(3), 500, True))],
                                "bid long, blat double, blon double")
    adf = spark.createDataFrame([(1, 0.0, 0.0)], "aid long, lat double, lon double")
    import re
    pairs = within_distance_join(adf, bdf, 50.0, "lat", "lon", "blat", "blon")
    text = plan_text(pairs, "extended")
    assert len(re.findall("Generate explode", text.split("Physical Plan")[1])) == 3  # two cubes an axis
    assert within_distance_join(adf, bdf, 21000.0, "lat", "lon", "blat", "blon").count() == 500


def test_a_cluster_takes_the_same_search(spark):
    """Nine tenths of the facilities within 20 m, incidents beside and far from it."""
    rng = np.random.default_rng(5)
    fac = _points(rng, 60, True) + [(34.0 + 1e-6 * (i % 23), -118.3 + 1e-6 * (i // 23)) for i in range(540)]
    inc = _points(rng, 80, True) + [(34.0 + 1e-4 * i, -118.3) for i in range(60)] + [(34.0, -118.3)] * 40
    idf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(inc)], "id long, lat double, lon double")
    fdf = spark.createDataFrame([(j, a, b) for j, (a, b) in enumerate(fac)], "fid long, flat double, flon double")
    got = {r.id: r.distance_km for r in nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon").collect()}
    for i, (a, b) in enumerate(inc):
        assert got[i] == pytest.approx(min(gc(a, b, c, d) for c, d in fac), abs=1e-9)
    single = nearest_facility(idf, fdf, ["id"], "lat", "lon", "flat", "flon", keep_ties=True, precision="float")
    assert single.select("id").distinct().count() == len(inc)
