"""End to end as a user runs it: CSV files through the readers and reports."""

import pytest
from pyspark.sql import functions as F

from geoincident.plans import (descent_income_report, distance_report, nearest_report,
                               part_of_day_counts, top_months, weapon_filter)
from geoincident.sources import (INCIDENT_SCHEMA, read_facilities, read_geocodes, read_income,
                                 read_incidents)

COLS = [f.name for f in INCIDENT_SCHEMA.fields]


def _row(i, date, t, area, desc, prem, weap, lat, lon):
    v = {c: "" for c in COLS}
    v.update({"DR_NO": str(i), "Date Rptd": date, "DATE OCC": date, "TIME OCC": str(t), "AREA ": str(area),
              "Vict Descent": desc, "Premis Cd": str(prem), "Weapon Used Cd": str(weap),
              "LAT": str(lat), "LON": str(lon), "LOCATION": "somewhere"})
    return ",".join(v[c] for c in COLS)


def test_readme_flow(spark, tmp_path):
    (tmp_path / "c1.csv").write_text(",".join(COLS) + "\n" + "\n".join([
        _row(1, "01/05/2015 12:00:00 AM", 900, 5, "H", 101, 102, 33.80, -118.30),
        _row(2, "02/05/2015 12:00:00 AM", 1300, 12, "W", 101, 150, 33.95, -118.28),
        _row(3, "02/07/2015 12:00:00 AM", 1800, 12, "B", 102, 400, 33.95, -118.28)]) + "\n")
    (tmp_path / "c2.csv").write_text(",".join(c.replace("AREA ", "AREA") for c in COLS) + "\n"
                                     + _row(4, "03/01/2021 12:00:00 PM", 2300, 5, "K", 101, 110, 33.80, -118.30) + "\n")
    (tmp_path / "st.csv").write_text("﻿X,Y,FID,DIVISION,LOCATION,PREC\n"
                                     "-118.289241553,33.7576608970001,1,HARBOR,x,5\n"
                                     "-118.277669655,33.9703073800001,3,77TH STREET,y,12\n", encoding="utf-8")
    (tmp_path / "i15.csv").write_text('"Zip Code","Community","Estimated Median Income"\n'
                                      '90001,"a","$33,887"\n90002,"b","$30,413"\n')
    (tmp_path / "geo.csv").write_text("LAT,LON,ZIPcode\n33.80,-118.30,90001-1\n33.95,-118.28,90002\n")

    inc = read_incidents(spark, [str(tmp_path / "c1.csv"), str(tmp_path / "c2.csv")])
    st = read_facilities(spark, str(tmp_path / "st.csv"))
    assert [tuple(r) for r in top_months(inc).collect()] == [(2015, 2, 2, 1), (2015, 1, 1, 2), (2021, 3, 1, 1)]
    assert {r.partofday: r.crime_total for r in part_of_day_counts(inc).collect()} == {
        "morning": 1, "afternoon": 1, "night": 1}
    d = descent_income_report(inc, read_geocodes(spark, str(tmp_path / "geo.csv")),
                              read_income(spark, {2015: str(tmp_path / "i15.csv")}), strategy="merge")
    assert {r["Victim Descent"]: r.n_incidents for r in d.collect()} == {
        "Hispanic/Latin/Mexican": 1, "White": 1, "Black": 1}
    fire = weapon_filter(inc).withColumn("year", F.year("DATE OCC"))
    per_year = {r.year: r.n_incidents for r in distance_report(fire, st, "AREA ", "PREC", "year").collect()}
    assert per_year == {2015: 2, 2021: 1}
    near = {r.DIVISION: r for r in nearest_report(fire, st, ["DR_NO"], "DIVISION", keep_ties=True).collect()}
    assert near["HARBOR"].n_incidents == 2 and near["77TH STREET"].n_incidents == 1
    assert near["77TH STREET"].average_distance == pytest.approx(2.262802843776525, abs=1e-9)
