import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoincident.functions.codes import DESCENT_CODES, decode
from geoincident.functions.daypart import part_of_day
from geoincident.functions.geo import (COMPASS_POINTS, compass_point, destination, great_circle_km,
                                        initial_bearing, wrap_longitude)
from geoincident.functions.money import parse_money
from geoincident.functions.timeops import text_to_date
from geoincident.functions.units import angle_factor, convert_length, length_factor


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def test_part_of_day_band_edges(spark):
    cases = {459: "night", 500: "morning", 1159: "morning", 1160: "night", 1199: "night",
             1200: "afternoon", 1659: "afternoon", 1660: "night", 1700: "evening",
             2059: "evening", 2060: "night", 2359: "night", 1: "night", None: None}
    df = _one_col(spark, list(cases), T.IntegerType())
    got = {r.v: r.p for r in df.select("v", part_of_day("v").alias("p")).collect()}
    assert got == cases


def test_decode_all_codes_unknown_and_null(spark):
    codes = list(DESCENT_CODES) + ["X", "-", None]
    df = _one_col(spark, codes, T.StringType())
    got = {r.v: r.n for r in df.select("v", decode("v").alias("n")).collect()}
    for k, name in DESCENT_CODES.items():
        assert got[k] == name
    assert got["X"] is None and got["-"] is None and got[None] is None
    assert len(DESCENT_CODES) == 18


def test_parse_money(spark):
    vals = ["$33,887", "$1,234,567", "$90", "---", "No 2021 estimate ($90,546 in 2020)", None, "$", "33887"]
    df = _one_col(spark, vals, T.StringType())
    got = [r.m for r in df.select(parse_money("v").alias("m")).collect()]
    assert got == [33887, 1234567, 90, None, None, None, None, None]


def test_text_to_date(spark):
    vals = ["03/01/2020 12:00:00 AM", "12/31/2019 11:59:59 PM", "01/05/2015 12:00:00 PM", "bad", None]
    df = _one_col(spark, vals, T.StringType())
    got = [r.d for r in df.select(text_to_date("v").alias("d")).collect()]
    assert got == [dt.date(2020, 3, 1), dt.date(2019, 12, 31), dt.date(2015, 1, 5), None, None]


def test_units():
    assert length_factor("mi", "km") == pytest.approx(1.609344)
    assert length_factor("km", "m") == pytest.approx(1000.0)
    assert length_factor("ft", "mi") == pytest.approx(1 / 5280)
    assert length_factor("nm", "km") == pytest.approx(1.852)
    assert angle_factor("deg", "arcmin") == pytest.approx(60.0)
    assert angle_factor("rad", "deg") == pytest.approx(57.29577951308232)
    with pytest.raises(ValueError):
        length_factor("furlong", "km")


def test_convert_length_column(spark):
    df = _one_col(spark, [1.0], T.DoubleType())
    r = df.select(convert_length("v", "mi", "km").alias("a"), convert_length("v", "km", "ft").alias("b")).first()
    assert r.a == pytest.approx(1.609344)
    assert r.b == pytest.approx(3280.839895, rel=1e-9)


def test_great_circle_golden(spark):
    df = spark.createDataFrame([(41.49008, -71.312796, 41.499498, -81.695391)], "a double, b double, c double, d double")
    r = df.select(great_circle_km("a", "b", "c", "d", unit="mi").alias("mi"),
                  great_circle_km("a", "b", "a", "b").alias("zero")).first()
    assert r.mi == pytest.approx(536.997990696, abs=1e-8)
    assert r.zero == 0.0


def test_wrap_longitude(spark):
    vals = [179.0, 180.0, 181.0, -181.0, 540.0, -540.0, 360.0, -180.0]
    df = _one_col(spark, vals, T.DoubleType())
    got = [r.w for r in df.select(wrap_longitude("v").alias("w")).collect()]
    assert got == [179.0, 180.0, -179.0, 179.0, -180.0, -180.0, 0.0, -180.0]


def test_destination_and_bearing_roundtrip(spark):
    df = spark.createDataFrame([(34.0, 148.0, 90.0, 16.09344), (0.0, 179.99, 90.0, 10.0)],
                               "lat double, lon double, b double, km double")
    lat2, lon2 = destination("lat", "lon", "b", "km")
    out = df.select("lat", "lon", lat2.alias("lat2"), lon2.alias("lon2")).collect()
    # 10 miles east of (34, 148): close to the ellipsoidal answer (33.99988, 148.17420)
    assert out[0].lat2 == pytest.approx(33.99987666492774, abs=5e-4)
    assert out[0].lon2 == pytest.approx(148.17419994321995, abs=5e-4)
    # crossing the date line wraps into [-180, 180)
    assert -180.0 <= out[1].lon2 < -179.9
    b = df.select(initial_bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("e"),
                  initial_bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("n"),
                  initial_bearing(F.lit(0.0), F.lit(0.0), F.lit(-1.0), F.lit(0.0)).alias("s")).first()
    assert b.e == pytest.approx(90.0) and b.n == pytest.approx(0.0) and b.s == pytest.approx(180.0)


def test_compass_points(spark):
    assert len(COMPASS_POINTS) == 32
    vals = [0.0, 11.25, 22.5, 90.0, 180.0, 270.0, 354.0, 359.9, 5.6, 5.7]
    df = _one_col(spark, vals, T.DoubleType())
    got = [r.c for r in df.select(compass_point("v").alias("c")).collect()]
    assert got == ["N", "NbE", "NNE", "E", "S", "W", "NbW", "N", "N", "NbE"]
