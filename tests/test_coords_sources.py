import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from geoincident.operators.coords import (clean_coordinates, parse_coordinates, tag_parsed_coordinates)
from geoincident.sources.files import (profile, read_facilities, read_income, read_incidents,
                                        union_aligned)

# Fixed test rows copied from the public station and income tables.
STATIONS_CSV = (
    "﻿X,Y,FID,DIVISION,LOCATION,PREC\n"
    "-118.289241553,33.7576608970001,1,HARBOR,2175 JOHN S. GIBSON BLVD.,5\n"
    "-118.275394206,33.9386273800001,2,SOUTHEAST,145 W. 108TH ST.,18\n"
    "-118.277669655,33.9703073800001,3,77TH STREET,7600 S. BROADWAY,12\n"
    "-118.419841576,33.9916553210001,4,PACIFIC,12312 CULVER BLVD.,14\n"
)
INCOME_2015_CSV = (
    '"Zip Code","Community","Estimated Median Income"\n'
    '90001,"Los Angeles (South Los Angeles), Florence-Graham","$33,887"\n'
    '90002,"Los Angeles (Southeast Los Angeles, Watts)","$30,413"\n'
)
INCOME_2021_CSV = (
    '"Zip Code","Community","Estimated Median Income"\n'
    '90071,"Los Angeles (Downtown Civic Center)","No 2021 estimate ($90,546 in 2020)"\n'
    '91046,"Verdugo City","---"\n'
    '90001,"Los Angeles (South Los Angeles), Florence-Graham","$41,000"\n'
)


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_read_facilities_drops_bom(spark, tmp_path):
    df = read_facilities(spark, _write(tmp_path, "st.csv", STATIONS_CSV))
    assert df.columns[0] == "X"
    rows = df.orderBy("PREC").collect()
    assert [r.PREC for r in rows] == [5, 12, 14, 18]
    assert rows[0].DIVISION == "HARBOR" and rows[0].Y == pytest.approx(33.7576608970001)


def test_read_income_years_and_bad_money(spark, tmp_path):
    from geoincident.functions.money import parse_money
    df = read_income(spark, {2015: _write(tmp_path, "i15.csv", INCOME_2015_CSV),
                             2021: _write(tmp_path, "i21.csv", INCOME_2021_CSV)})
    got = {(r.year, r["Zip Code"]): r.m for r in df.select("*", parse_money("Estimated Median Income").alias("m")).collect()}
    assert got == {(2015, 90001): 33887, (2015, 90002): 30413, (2021, 90071): None,
                   (2021, 91046): None, (2021, 90001): 41000}


def test_read_incidents_two_files_union_by_position(spark, tmp_path):
    header1 = ",".join(["DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA "] + [f"c{i}" for i in range(21)] + ["LAT", "LON"])
    header2 = header1.replace("AREA ", "AREA")
    filler = ",".join([""] * 21)
    f1 = _write(tmp_path, "a.csv", header1 + "\n" + f"1,01/02/2015 12:00:00 AM,01/01/2015 12:00:00 AM,1200,5,{filler},34.0,-118.3\n")
    f2 = _write(tmp_path, "b.csv", header2 + "\n" + f"2,bad,03/04/2021 12:00:00 PM,2300,12,{filler},0.0,0.0\n")
    df = read_incidents(spark, [f1, f2]).orderBy("DR_NO")
    rows = df.collect()
    assert [r["AREA "] for r in rows] == [5, 12]
    assert str(rows[0]["DATE OCC"]) == "2015-01-01" and rows[1]["Date Rptd"] is None
    prof = {r.column_name: r for r in profile(df).collect()}
    assert prof["DATE OCC"].data_type == "date" and prof["Date Rptd"].non_null == 1
    assert prof["DR_NO"].row_count == 2


def test_union_aligned_names_and_types_from_first(spark):
    a = spark.createDataFrame([(1, "x")], "k long, s string")
    b = spark.createDataFrame([("2", "y"), ("oops", "z")], "K2 string, S2 string")
    u = union_aligned([a, b])
    assert u.columns == ["k", "s"] and dict(u.dtypes)["k"] == "bigint"
    assert sorted((r.k for r in u.collect()), key=lambda v: (v is None, v)) == [1, 2, None]
    with pytest.raises(ValueError):
        union_aligned([a, a.select("k")])


def test_tagged_texts(spark):
    texts = {1: "12.25/ -7.5", 2: "somewhere", 3: None, 4: "93.5, 1.0", 5: "5.0, 545.0", 6: "7.5, -7.5, 90ft"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    out = {r.id: (r.lat, r.lon, r.alt_km, r.reject_reason) for r in tag_parsed_coordinates(df, "t").collect()}
    assert out[1] == (12.25, -7.5, 0.0, None)
    assert out[2] == out[3] == (None, None, None, "unparseable")
    assert out[4][3] == "latitude_out_of_range"
    assert out[5] == (5.0, -175.0, 0.0, None)
    assert math.isclose(out[6][2], 0.027432)
    valid, rejects = parse_coordinates(df, "t")
    assert valid.count() == 3 and rejects.count() == 3


def test_clean_coordinates_rules(spark):
    df = spark.createDataFrame([(1, 10.0, 190.0), (2, None, 1.0), (3, 1.0, None), (4, 95.0, 0.0),
                                (5, float("nan"), 0.0), (6, -90.0, -180.0)], "id int, lat double, lon double")
    valid, rejects = clean_coordinates(df)
    assert {r.id: (r.lat, r.lon) for r in valid.collect()} == {1: (10.0, -170.0), 6: (-90.0, -180.0)}
    assert {r.id: r.reject_reason for r in rejects.collect()} == {
        2: "null_coordinate", 3: "null_coordinate", 4: "latitude_out_of_range", 5: "not_finite"}


def test_altitude_conflicts(spark):
    from geoincident.operators.coords import altitude_conflicts
    df = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.5, 0.5000005), (3, 0.0, 0.712), (4, None, 1.0)],
                               "id int, a1 double, a2 double")
    assert [r.id for r in altitude_conflicts(df, "a1", "a2").collect()] == [3]


# ---- folders of files

def test_folder_of_mixed_headers_and_bad_values(spark, tmp_path):
    folder = tmp_path / "stations of 2020"
    folder.mkdir()
    (folder / "a.csv").write_text("\ufeffX,Y,FID,DIVISION,LOCATION,PREC\n-118.0,34.0,1,A,\"q,r\",2\nn/a,35.0,2,B,x,\n", encoding="utf-8")
    (folder / "b.csv").write_text("Y,X,FID,DIVISION,LOCATION,PREC\n36.0,-119.0,3,C,y,7x\n")
    (folder / "c.csv").write_text("Y , x,FID,division,LOCATION,PREC\r\n37.0,-120.0,4,D,,9\r\n")
    (folder / "empty.csv").write_text("")
    expected = {1: (-118.0, 34.0, "A", "q,r", 2), 2: (None, 35.0, "B", "x", None), 3: (-119.0, 36.0, "C", "y", None),
                4: (-120.0, 37.0, "D", None, 9)}
    for path in (str(folder), f"{folder}/*.csv"):
        counted = Observation()
        df = read_facilities(spark, path, counted)
        assert {r.FID: (r.X, r.Y, r.DIVISION, r.LOCATION, r.PREC) for r in df.collect()} == expected
        assert {k: v for k, v in counted.get.items() if v} == {"rows": 4, "bad_X": 1, "bad_PREC": 1}
        assert read_facilities(spark, path).schema == df.schema
        assert {r.FID: (r.X, r.Y, r.DIVISION, r.LOCATION, r.PREC) for r in read_facilities(spark, path).collect()} == expected
    (folder / "d.csv").write_text("Y,FID,X,DIVISION,LOCATION,OTHER\n1,2,3,4,5,6\n")
    with pytest.raises(ValueError, match="header"):
        read_facilities(spark, str(folder))


def test_a_header_that_changes_after_planning_fails(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("X,Y,FID,DIVISION,LOCATION,PREC\n-118.0,34.0,1,A,B,2\n")
    df = read_facilities(spark, str(path))
    path.write_text("Y,X,FID,DIVISION,LOCATION,PREC\n34.0,-118.0,1,A,B,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_bad_dates_are_counted(spark, tmp_path):
    from geoincident.sources import INCIDENT_SCHEMA, read_incidents
    names = [f.name for f in INCIDENT_SCHEMA]
    line = lambda d, t: ",".join({"DATE OCC": d, "TIME OCC": t, "DR_NO": "1"}.get(n, "") for n in names)
    (tmp_path / "i.csv").write_text("\n".join([",".join(names), line("01/02/2015 12:00:00 AM", "900"), line("never", "noon"), line("", "")]) + "\n")
    counted = Observation()
    rows = read_incidents(spark, str(tmp_path / "i.csv"), counted=counted).select("DATE OCC", "TIME OCC").collect()
    assert [r["TIME OCC"] for r in rows] == [900, None, None] and rows[1]["DATE OCC"] is None
    assert {k: v for k, v in counted.get.items() if v} == {"rows": 3, "bad_DATE OCC": 1, "bad_TIME OCC": 1}
    with pytest.raises(ValueError, match="one path"):
        read_incidents(spark, ["a", "b"], counted=Observation())
