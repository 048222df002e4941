import datetime as dt
import math

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoincident.operators.geodesic import ellipsoid_params, vincenty_km
from geoincident.operators.joins import join_strategy_used
from geoincident.plans.reports import (descent_income_report, distance_report, nearest_report,
                                       part_of_day_counts, weapon_filter)

INC_COLS = "DR_NO long, `DATE OCC` date, `TIME OCC` int, `AREA ` int, `Premis Cd` int, " \
           "`Vict Descent` string, `Weapon Used Cd` int, LAT double, LON double"


def part_of_day_counts_rdd(df: DataFrame, time_col: str = "TIME OCC",
                           premise_col: str = "Premis Cd", premise: int = 101) -> list[tuple[str, int]]:
    """Q2 as RDD map/filter/reduceByKey/sortBy, kept only to show that the
    DataFrame form gives the same answer (tests); it bypasses Catalyst."""
    from geoincident.functions.daypart import DAY_PARTS, NIGHT

    def band(t):
        if t is None:
            return None
        for name, lo, hi in DAY_PARTS:
            if lo <= t <= hi:
                return name
        return NIGHT

    rdd = (df.select(F.col(f"`{time_col}`").alias("t"), F.col(f"`{premise_col}`").alias("p")).rdd
           .filter(lambda r: r.p == premise)
           .map(lambda r: (band(r.t), 1))
           .reduceByKey(lambda a, b: a + b)
           .sortBy(lambda kv: (-kv[1], kv[0] or "")))
    return rdd.collect()



def _incidents(spark):
    d15, d16 = dt.date(2015, 5, 1), dt.date(2016, 5, 1)
    rows = [
        (1, d15, 500, 5, 101, "H", 102, 33.80, -118.30),
        (2, d15, 1200, 5, 101, "W", 199, 33.80, -118.30),
        (3, d15, 1700, 12, 101, "B", 100, 33.95, -118.28),
        (4, d15, 2300, 12, 101, "X", 300, 33.95, -118.28),
        (5, d15, 1160, 14, 102, "A", 150, 33.99, -118.42),
        (6, d15, 100, 14, 101, "Q", 150, 33.99, -118.42),
        (7, d16, 900, 18, 101, "H", 110, 34.05, -118.20),
        (8, d15, 900, 99, 101, None, 120, 0.0, 0.0),
        (9, d15, 915, 5, 101, "K", 130, 34.10, -118.50),
        (9, d15, 915, 5, 101, "K", 130, 34.10, -118.50),
        (10, d15, 1000, 18, 101, "C", 140, 34.00, -118.00),
    ]
    return spark.createDataFrame(rows, INC_COLS)


def _stations(spark):
    return spark.createDataFrame([
        (-118.289241553, 33.7576608970001, "HARBOR", 5), (-118.277669655, 33.9703073800001, "77TH STREET", 12),
        (-118.419841576, 33.9916553210001, "PACIFIC", 14), (-118.275394206, 33.9386273800001, "SOUTHEAST", 18)],
        "X double, Y double, DIVISION string, PREC int")


def test_part_of_day_dataframe_equals_rdd(spark):
    df = _incidents(spark)
    a = [tuple(r) for r in part_of_day_counts(df).collect()]
    b = part_of_day_counts_rdd(df)
    assert a == b
    assert dict(a) == {"morning": 6, "afternoon": 1, "evening": 1, "night": 2}


def test_descent_income_all_strategies_agree(spark):
    inc = _incidents(spark)
    geo = spark.createDataFrame([(33.80, -118.30, "90001-1234"), (33.95, -118.28, "90002"),
                                 (33.99, -118.42, "90003"), (34.10, -118.50, "90004"),
                                 (34.10, -118.50, "90004"), (34.00, -118.00, "ABCDE"),
                                 (34.05, -118.20, "90005")], "LAT double, LON double, ZIPcode string")
    income = spark.createDataFrame([
        (90001, "a", "$10,000", 2015), (90002, "b", "$20,000", 2015), (90003, "c", "$30,000", 2015),
        (90004, "d", "$40,000", 2015), (90005, "e", "---", 2015), (90001, "a", "$99,999", 2017)],
        "`Zip Code` int, Community string, `Estimated Median Income` string, year int")
    base = [tuple(r) for r in descent_income_report(inc, geo, income).collect()]
    # 2015, descent not X/null; geocode duplicates multiply the K rows (2 rows x 2 geocodes)
    assert dict(base) == {"Korean": 4, "Hispanic/Latin/Mexican": 1, "White": 1, "Black": 1,
                          "Other Asian": 1, None: 1}
    for strategy in ("broadcast", "merge", "shuffle_hash"):
        df = descent_income_report(inc, geo, income, strategy=strategy)
        assert [tuple(r) for r in df.collect()] == base, strategy


def _geod(a, b, c, d):
    A, F_ = ellipsoid_params("WGS-84")
    return float(vincenty_km([a], [b], [c], [d], A, F_)[0])


def test_distance_report_per_year_and_division(spark):
    inc = weapon_filter(_incidents(spark)).withColumn("year", F.year("DATE OCC"))
    st = _stations(spark)
    per_div = {r.DIVISION: r for r in distance_report(inc, st, "AREA ", "PREC", "DIVISION", order="count").collect()}
    # weapon 100-199 and LAT != 0; area 99 has no station and drops; DR_NO 9 counts twice
    assert per_div["HARBOR"].n_incidents == 4
    exp = (2 * _geod(33.7576608970001, -118.289241553, 33.80, -118.30)
           + 2 * _geod(33.7576608970001, -118.289241553, 34.10, -118.50)) / 4
    assert per_div["HARBOR"].average_distance == pytest.approx(exp, abs=1e-9)
    per_year = {r.year: r.n_incidents for r in distance_report(inc, st, "AREA ", "PREC", "year").collect()}
    assert per_year == {2015: 8, 2016: 1}


def test_nearest_report_forms(spark):
    inc = weapon_filter(_incidents(spark)).withColumn("year", F.year("DATE OCC"))
    st = _stations(spark)
    per_year = {r.year: r for r in nearest_report(inc, st, ["DR_NO", "year"], "year", False).collect()}
    # repeated DR_NO 9 collapses per (DR_NO, year)
    assert per_year[2015].n_incidents == 7 and per_year[2016].n_incidents == 1
    per_div = {r.DIVISION: r.n_incidents for r in nearest_report(inc, st, ["DR_NO"], "DIVISION", True,
                                                                    order="count").collect()}
    assert sum(per_div.values()) == 9    # repeated id rows both kept


def test_report_plans_follow_strategy(spark):
    inc = weapon_filter(_incidents(spark))
    st = _stations(spark)
    for strategy, node in (("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"),
                           ("broadcast", "BroadcastHashJoin")):
        df = distance_report(inc, st, "AREA ", "PREC", "DIVISION", strategy=strategy, metric="great_circle")
        assert node in join_strategy_used(df)


def test_float_precision_switch(spark):
    inc = weapon_filter(_incidents(spark))
    st = _stations(spark)
    d = {r.DIVISION: r.average_distance for r in distance_report(inc, st, "AREA ", "PREC", "DIVISION").collect()}
    f = {r.DIVISION: r.average_distance for r in distance_report(inc, st, "AREA ", "PREC", "DIVISION",
                                                                 precision="float").collect()}
    for k in d:
        assert f[k] == pytest.approx(d[k], rel=1e-6)
    near = nearest_report(inc, st, ["DR_NO"], "DIVISION", True, precision="float").collect()
    assert sum(r.n_incidents for r in near) == 9


def test_units_and_altitudes_of_distances(spark):
    inc = spark.createDataFrame([(1, 5, 0.0, 0.0, 0.0), (2, 5, 0.0, 1.0, 0.2), (3, 5, 0.0, 2.0, None)],
                                "DR_NO long, area int, lat double, lon double, alt double")
    st = spark.createDataFrame([(5, "A", 0.0, 3.0, 0.0)], "prec int, division string, st_lat double, st_lon double, st_alt double")
    args = (inc, st, "area", "prec", "division", "lat", "lon", "st_lat", "st_lon")
    km = distance_report(*args, metric="great_circle").first()
    m = distance_report(*args, metric="great_circle", unit="m", altitude=("alt", "st_alt")).first()
    assert (km.n_incidents, m.n_incidents) == (3, 2)
    assert m.average_distance == pytest.approx(1000 * 6371.009 * math.radians(2)) == pytest.approx(1000 * km.average_distance)
    near = nearest_report(inc, st, ["DR_NO"], "division", True, "lat", "lon", "st_lat", "st_lon", metric="great_circle", unit="mi")
    assert near.first().average_distance == pytest.approx(km.average_distance / 1.609344)
