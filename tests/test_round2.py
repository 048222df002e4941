"""Cases that used to lose rows, swap columns or take too long."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from coord_reader import read_point
from geoincident.functions.coordtext import parsed_point
from geoincident.operators.joins import plan_text
from geoincident.operators.geodesic import ellipsoid_params, vincenty_km
from geoincident.operators.path import path_length
from geoincident.operators.spatial import nearest_facility
from geoincident.sources import read_facilities, union_aligned

A, FL = ellipsoid_params("WGS-84")


def test_equator_has_no_null():
    lon = np.linspace(179.3, 180.0, 10_000)
    zero = np.zeros_like(lon)
    out = vincenty_km(zero, zero, zero, lon, A, FL)
    assert np.isfinite(out).all()
    # beyond the lift-off longitude the way over the pole side is shorter than the equator
    assert (out <= A * np.radians(lon) + 1e-6).all() and out[-1] == pytest.approx(20003.931458625, abs=1e-6)
    assert vincenty_km([0.0], [0.0], [0.0], [179.5], A, FL)[0] == pytest.approx(19980.861909, abs=1e-5)
    rng = np.random.default_rng(5)
    lat, west = rng.uniform(-1, 1, 10_000), rng.uniform(-180, 180, 10_000)
    far = vincenty_km(lat, west, -lat + rng.normal(0, 0.05, 10_000), west + 180 + rng.normal(0, 0.2, 10_000), A, FL)
    assert np.isfinite(far).all() and far.min() > 19_900


def test_equator_in_path_and_nearest(spark):
    pts = spark.createDataFrame([(1, 1, 0.0, 0.0), (1, 2, 0.0, 179.5), (1, 3, 10.0, 179.5)],
                                "t int, o int, lat double, lon double")
    got = path_length(pts, ["t"], ["o"], metric="geodesic").first()["path_km"]
    assert got == pytest.approx(19980.861909 + 1105.854833, abs=1e-3)
    inc = spark.createDataFrame([(None, 0.0, 0.0), (2, 0.0, 1.0), (2, 0.0, 179.0)], "id int, lat double, lon double")
    fac = spark.createDataFrame([("f", 0.0, 179.6)], "name string, flat double, flon double")
    near = nearest_facility(inc, fac, ["id"], "lat", "lon", "flat", "flon", keep_ties=True, metric="geodesic")
    assert sorted(((r["id"], r["name"]) for r in near.collect()), key=str) == sorted([(None, "f"), (2, "f")], key=str)


def test_union_widens(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(1.9, 7), (5e12, None)], "n double, s int")
    out = union_aligned([a, b])
    assert dict(out.dtypes) == {"n": "double", "s": "string"}
    assert sorted(tuple(r) for r in out.where("s is not null").collect()) == [(1.0, "x"), (1.9, "7")]
    assert out.where(F.col("n") == 5e12).count() == 1


def test_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Y,X,FID,DIVISION,LOCATION,PREC\n34.0,-118.0,1,A,B,2\n")
    row = read_facilities(spark, str(tmp_path / "s.csv")).first()
    assert (row["X"], row["Y"]) == (-118.0, 34.0)
    (tmp_path / "t.csv").write_text("Y,FID,DIVISION,LOCATION,PREC\n34.0,1,A,B,2\n")
    with pytest.raises(ValueError, match="header"):
        read_facilities(spark, str(tmp_path / "t.csv"))


POINTS = [
    ("48.25;16.5", (48.25, 16.5, 0.0)), ("48.25\u00a016.5", (48.25, 16.5, 0.0)),
    ("N 10° 30' 36\" / W 20D15m", (10.51, -20.25, 0.0)), ("10 30' S, 20 15' 0'' E, 2 km", (-10.5, 20.25, 2.0)),
    ("at pier 5: 12.5, 99", (12.5, 99.0, 0.0)), ("-0 30m, 1", (0.5, 1.0, 0.0)), ("10 20 30m", (10.0, 20.5, 0.0)),
    ("10, 20, 1500 m", (10.0, 20.0, 1.5)), ("10S 20W", (-10.0, -20.0, 0.0)), ("nowhere", None), ("1", None),
    ("10-20", None), ("", None), (None, None)]


def parsed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, t string").select("n", parsed_point(F.col("t")).alias("p"))
    assert "Python" not in plan_text(df) and "Arrow" not in plan_text(df) and "Pandas" not in plan_text(df)
    rows = {r["n"]: r["p"] for r in df.collect()}
    return [(rows[n].lat, rows[n].lon, rows[n].alt_km) if rows[n].ok else None for n in range(len(texts))]


def test_points_of_the_table(spark):
    got = parsed(spark, [t for t, _ in POINTS])
    for (text, point), own in zip(POINTS, got, strict=True):
        assert own is None if point is None else own == pytest.approx(point), text
        plain = read_point(text)
        assert plain is None if point is None else plain == pytest.approx(point), text


def test_points_against_the_plain_reader(spark):
    rnd = random.Random(14)
    parts = ["1", "20", "30.5", "7.", ".5", "-", "+", " ", "  ", "\t", "\u00a0", "\u2003", ",", ";", "/", "N", "S", "E", "W", "°", "D",
             "*", "′", "'", "m", "″", "\"", "''", "s", "km", "mi", "ft", "nm", "nmi", "x", "at ", "\n"]
    angle = lambda a, b: "".join([rnd.choice(["", "", a + " ", b]), rnd.choice(["", "-", "+"]), rnd.choice(["5", "12.25", "0", "007"]),
                                  rnd.choice(["", "°", "° ", " ", "D"]), rnd.choice(["", "30'", "30' ", "15.5m "]),
                                  rnd.choice(["", "9\"", "6''"]), rnd.choice(["", a, b, " " + a])])
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(14))) for _ in range(4000)]
    for _ in range(4000):
        text = rnd.choice(["", "", "pier 5: ", "1.5.", "N"]) + angle("N", "S") + rnd.choice([" ", ",", ", ", ";", " / "]) + angle("E", "W")
        texts.append(text + rnd.choice(["", "", " 3 km", ", -2.5 mi ", ",", " 7m", " 7ft x"]))
    got, want = parsed(spark, texts), [read_point(t) for t in texts]
    assert sum(p is not None for p in want) > 1500
    for text, own, plain in zip(texts, got, want, strict=True):
        assert own is None if plain is None else own is not None and own == pytest.approx(plain, abs=1e-12), text


def test_long_texts_are_quick(spark):
    texts = ["1" + " " * 100_000 + "x", "1" + " " * 100_000 + "2", "1 " * 200_000 + "x", "9" * 50_000 + "x", "x" * 300_000 + " 1 2"]
    parsed(spark, ["1 2"])
    began = time.time()
    assert parsed(spark, texts) == [None, (1.0, 2.0, 0.0), None, None, (1.0, 2.0, 0.0)]
    assert time.time() - began < 30


def test_workers_get_the_package(spark):
    from geoincident.session import ship_package

    ship_package(spark)
    got = spark.range(1).select(F.udf(lambda _: __import__("geoincident").__name__)("id")).first()[0]
    assert got == "geoincident"
