import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from geoincident.plans.reports import part_of_day_counts
from geoincident.streaming import incident_stream

SF001 = "/root/testdata/sf0.001"


def run_available(df, query_name: str, checkpoint_dir: str,
                  output_mode: str = "complete"):
    """Process everything available now into a memory table and return it
    as a batch DataFrame (for tests and one-shot catch-up runs)."""
    q = (df.writeStream.format("memory").queryName(query_name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.sql(f"SELECT * FROM {query_name}")


def test_part_of_day_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    header = ",".join(["DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA "] + [f"c{i}" for i in range(9)]
                      + ["Premis Cd"] + [f"d{i}" for i in range(11)] + ["LAT", "LON"])
    def line(i, t, p):
        return ",".join([str(i), "", "01/01/2015 12:00:00 AM", str(t), "1"] + [""] * 9 + [str(p)] + [""] * 11 + ["0", "0"])
    (src / "a.csv").write_text(header + "\n" + "\n".join([line(1, 600, 101), line(2, 1300, 101), line(3, 700, 102)]) + "\n")
    (src / "b.csv").write_text(header + "\n" + "\n".join([line(4, 800, 101), line(5, 2200, 101)]) + "\n")
    stream = incident_stream(spark, str(src))
    out = run_available(part_of_day_counts(stream), "pod_stream", str(tmp_path / "ck"))
    assert {r.partofday: r.crime_total for r in out.collect()} == {"morning": 2, "afternoon": 1, "night": 1}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["year", "month", "crime_total", "rank"] and len(rows) > 0


@pytest.mark.skipif(not os.path.isdir(SF001), reason="driver tables not present")
def test_every_query_matches_its_sql_on_sf0001(spark):
    import sys
    from pathlib import Path
    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
    from oracle_check import _rows

    from geoincident.plans import catalog
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    assert qs.keys() <= E.queries().keys() and sqls.items() <= E.oracle_sql().items()
    for name, fn in qs.items():
        df = fn(spark, SF001)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        if name not in sqls:
            continue
        rel = con.sql(sqls[name])
        cols = rel.columns
        assert sorted(cols) == sorted(df.columns), name
        duck_types = dict(zip(cols, [str(t) for t in rel.types]))
        spark_to_duck = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                         "date": "DATE"}
        for c, t in df.dtypes:
            assert spark_to_duck.get(t, t) == duck_types[c], (name, c, t, duck_types[c])
        assert got == _rows(cols, rel.fetchall()), name


def test_distance_report_on_a_stream_joins_static_stations(spark, tmp_path):
    from geoincident.plans.reports import distance_report, weapon_filter
    src = tmp_path / "inc"
    src.mkdir()
    header = ",".join(["DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA "] + [f"c{i}" for i in range(11)]
                      + ["Weapon Used Cd"] + [f"d{i}" for i in range(9)] + ["LAT", "LON"])

    def line(i, area, weapon, lat, lon):
        return ",".join([str(i), "", "01/01/2015 12:00:00 AM", "100", str(area)] + [""] * 11 + [str(weapon)]
                        + [""] * 9 + [str(lat), str(lon)])
    (src / "a.csv").write_text(header + "\n" + "\n".join([
        line(1, 5, 101, 33.80, -118.30), line(2, 5, 300, 33.80, -118.30),
        line(3, 12, 150, 33.95, -118.28), line(4, 12, 150, 0.0, 0.0)]) + "\n")
    stations = spark.createDataFrame([(-118.289241553, 33.7576608970001, "HARBOR", 5),
                                      (-118.277669655, 33.9703073800001, "77TH STREET", 12)],
                                     "X double, Y double, DIVISION string, PREC int")
    stream = weapon_filter(incident_stream(spark, str(src)))
    report = distance_report(stream, stations, "AREA ", "PREC", "DIVISION", metric="great_circle", order="count")
    out = {r.DIVISION: r.n_incidents for r in run_available(report, "dist_stream", str(tmp_path / "ck")).collect()}
    assert out == {"HARBOR": 1, "77TH STREET": 1}
