"""Driver queries on the Parquet test tables, each with an independent SQL
form for DuckDB. Computed columns carry the same alias on both sides;
floating results are rounded (6 digits for km, 9 for degrees)."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoincident.functions.codes import decode
from geoincident.functions.daypart import hhmm_of
from geoincident.functions.geo import EARTH_RADIUS_KM, destination, great_circle_km
from geoincident.functions.money import parse_money
from geoincident.functions.timeops import in_year, text_to_date
from geoincident.functions.units import convert_angle, convert_length
from geoincident.operators.coords import REASON_COL, altitude_conflicts, tag_coordinates, tag_parsed_coordinates
from geoincident.operators.geodesic import vincenty_sql
from geoincident.operators.joins import bucketed_table, join_with_strategy
from geoincident.operators.path import path_length
from geoincident.operators.spatial import within_distance_join
from geoincident.plans import reports as R
from geoincident.plans import standins as S
from geoincident.session import ensure_checkpoint_dir
from geoincident.sources.files import profile, read_facilities, read_table, union_aligned

KM_DIGITS = 6
DEG_DIGITS = 9
WITHIN_KM = 5.0
DEST_KM = 10.0
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------- SQL helpers

def lat_sql(k: str, per_region: int | None = None) -> str:
    row = f" + {k} // {per_region} // 400 % 75 * 7000" if per_region else ""
    return f"(CAST(33.7 AS DOUBLE) + CAST(({k} * 7919) % 6500{row} AS DOUBLE) / CAST(10000 AS DOUBLE))"


def lon_sql(k: str, per_region: int | None = None) -> str:
    column = f" + {k} // {per_region} % 400 * 7000" if per_region else ""
    return f"(CAST(-118.7 AS DOUBLE) + CAST(({k} * 104729) % 6000{column} AS DOUBLE) / CAST(10000 AS DOUBLE))"


def gc_sql(lat1: str, lon1: str, lat2: str, lon2: str, r: float = EARTH_RADIUS_KM) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    dl = f"(radians({lon2}) - radians({lon1}))"
    return (f"(atan2(sqrt(power(cos({p2}) * sin({dl}), 2) + power(cos({p1}) * sin({p2}) - "
            f"sin({p1}) * cos({p2}) * cos({dl}), 2)), sin({p1}) * sin({p2}) + "
            f"cos({p1}) * cos({p2}) * cos({dl})) * CAST({r!r} AS DOUBLE))")


INC_CTE = (f"inc AS (SELECT c_custkey AS incident_id, c_nationkey AS area, c_mktsegment AS segment, "
           f"{lat_sql('c_custkey', 1500)} AS lat, {lon_sql('c_custkey', 1500)} AS lon FROM customer)")
NATION_CTE = (f"nst AS (SELECT n_nationkey AS prec, n_name AS division, {lat_sql('n_nationkey')} AS st_lat, "
              f"{lon_sql('n_nationkey')} AS st_lon FROM nation)")
SUPP_CTE = (f"sst AS (SELECT s_suppkey AS station_id, s_name AS division, {lat_sql('s_suppkey', 100)} AS st_lat, "
            f"{lon_sql('s_suppkey', 100)} AS st_lon FROM supplier)")


def _r(col: str, digits: int = KM_DIGITS) -> F.Column:
    return F.round(F.col(col), digits).alias(col)


# ----------------------------------------------------------- Q0 / U1 / F1

def _orders_union(spark: SparkSession, sf: str) -> DataFrame:
    first, second = S.orders_as_text_files(spark, sf)
    u = union_aligned([first, second])
    return u.withColumn("order_date", text_to_date("order_date"))


def q_union_aligned(spark, sf):
    return _orders_union(spark, sf)


SQL_UNION_ALIGNED = """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM orders"""


def q_profile(spark, sf):
    return R.load_report(_orders_union(spark, sf))


SQL_PROFILE = " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null, COUNT(*) AS row_count FROM orders"
    for n, t, c in (("o_orderkey", "bigint", "o_orderkey"), ("o_custkey", "bigint", "o_custkey"),
                    ("order_date", "date", "o_orderdate"), ("o_totalprice", "double", "o_totalprice")))


# ----------------------------------------------------------- Q1

def q_top_months(spark, sf):
    return R.top_months(read_table(spark, sf, "orders"), "o_orderdate")


def q_top_months_sql(spark, sf):
    return R.top_months_sql(spark, read_table(spark, sf, "orders"), "o_orderdate")


SQL_TOP_MONTHS = """WITH m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         COUNT(*) AS crime_total
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS INTEGER) AS rank
      FROM m)
SELECT year, month, crime_total, rank FROM r WHERE rank <= 3 ORDER BY year, crime_total DESC, month"""


# ----------------------------------------------------------- Q2

def q_part_of_day(spark, sf):
    ev = read_table(spark, sf, "events").select(hhmm_of("ts").alias("time_occ"), "event_type")
    return R.part_of_day_counts(ev, "time_occ", "event_type", "purchase")


SQL_PART_OF_DAY = """SELECT CASE WHEN t BETWEEN 500 AND 1159 THEN 'morning'
            WHEN t BETWEEN 1200 AND 1659 THEN 'afternoon'
            WHEN t BETWEEN 1700 AND 2059 THEN 'evening'
            WHEN t IS NOT NULL THEN 'night' END AS partofday,
       COUNT(*) AS crime_total
FROM (SELECT CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS t FROM events WHERE event_type = 'purchase')
GROUP BY 1 ORDER BY crime_total DESC, partofday"""


# ----------------------------------------------------------- Q3 (A6 + J5-J9)

def _extreme_groups(strategy):
    def run(spark, sf):
        li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
        o = (read_table(spark, sf, "orders").where(in_year("o_orderdate", 1996))
             .select("o_orderkey", "o_orderpriority"))
        p = read_table(spark, sf, "part").select("p_partkey", "p_size")
        j = join_with_strategy(li, o, li["l_orderkey"] == o["o_orderkey"], strategy=strategy)
        j = join_with_strategy(j, p, j["l_partkey"] == p["p_partkey"], strategy=strategy)
        return R.extreme_group_counts(j.select("o_orderpriority", "p_size"), "p_size", "o_orderpriority", 3)
    return run


SQL_EXTREME_GROUPS = """WITH j AS (
  SELECT o.o_orderpriority, p.p_size FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE year(o.o_orderdate) = 1996),
v AS (SELECT DISTINCT p_size FROM j WHERE p_size IS NOT NULL),
e AS (SELECT p_size FROM (SELECT p_size FROM v ORDER BY p_size DESC LIMIT 3)
      UNION SELECT p_size FROM (SELECT p_size FROM v ORDER BY p_size ASC LIMIT 3))
SELECT o_orderpriority, COUNT(*) AS n_incidents FROM j
WHERE p_size IN (SELECT p_size FROM e)
GROUP BY o_orderpriority ORDER BY n_incidents DESC, o_orderpriority"""


def _descent_income(strategy):
    def run(spark, sf):
        return R.descent_income_report(S.order_incidents(spark, sf), S.customer_geocodes(spark, sf),
                                       S.nation_income(spark, sf), year=1996, k=3, strategy=strategy)
    return run


def _case_sql(col: str) -> str:
    # fixed values: the descent codes among the letters that the driver tables hold (A F N O P R)
    return (f"CASE {col} WHEN 'A' THEN 'Other Asian' WHEN 'F' THEN 'Filipino' WHEN 'O' THEN 'Other' "
            f"WHEN 'P' THEN 'Pacific Islander' END")


def _descent_income_sql() -> str:
    return f"""WITH inc AS (
  SELECT o_orderstatus AS descent, {lat_sql('o_custkey', 1500)} AS lat, {lon_sql('o_custkey', 1500)} AS lon
  FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus <> 'X' AND o_orderstatus IS NOT NULL),
geo AS (
  SELECT {lat_sql('c_custkey', 1500)} AS g_lat, {lon_sql('c_custkey', 1500)} AS g_lon,
         c_nationkey + 90000 AS zip FROM customer),
inc_geo AS (SELECT descent, zip FROM inc JOIN geo ON inc.lat = geo.g_lat AND inc.lon = geo.g_lon),
income AS (
  SELECT n_nationkey + 90000 AS zip_code,
         CASE WHEN n_nationkey = 7 THEN NULL ELSE 20000 + (n_nationkey * 7919) % 60000 END AS income
  FROM nation),
j AS (SELECT descent, income FROM inc_geo JOIN income ON inc_geo.zip = income.zip_code),
v AS (SELECT DISTINCT income FROM j WHERE income IS NOT NULL),
e AS (SELECT income FROM (SELECT income FROM v ORDER BY income DESC LIMIT 3)
      UNION SELECT income FROM (SELECT income FROM v ORDER BY income ASC LIMIT 3))
SELECT {_case_sql('descent')} AS "Victim Descent", COUNT(*) AS n_incidents
FROM j WHERE income IN (SELECT income FROM e) GROUP BY 1"""


# ----------------------------------------------------------- F5 / F6

def q_decode_codes(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return (li.select("l_returnflag", decode("l_returnflag").alias("returnflag_name"),
                      "l_linestatus", decode("l_linestatus").alias("linestatus_name"))
            .groupBy("l_returnflag", "returnflag_name", "l_linestatus", "linestatus_name")
            .agg(F.count(F.lit(1)).alias("n_rows")))


SQL_DECODE_CODES = f"""SELECT l_returnflag, {_case_sql('l_returnflag')} AS returnflag_name,
       l_linestatus, {_case_sql('l_linestatus')} AS linestatus_name, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2, 3, 4"""


def q_parse_money(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    text = (F.when(k % 11 == 0, F.lit("---"))
            .when(k % 13 == 0, F.lit("No 2021 estimate ($90,546 in 2020)"))
            .otherwise(F.concat(F.lit("$"), F.format_number(F.floor("p_retailprice"), 0))))
    return p.select("p_partkey", text.alias("money_text")).select(
        "p_partkey", parse_money("money_text").alias("income"))


SQL_PARSE_MONEY = """SELECT p_partkey,
  CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN NULL
       ELSE CAST(floor(p_retailprice) AS BIGINT) END AS income
FROM part"""


# ----------------------------------------------------------- Q4-1 (responsible station)

def _area(by: str, order: str, strategy=None, metric="great_circle"):
    def run(spark, sf):
        inc = R.weapon_filter(S.customer_incidents(spark, sf), lat="lat", weapon_col=None)
        fac = S.nation_stations(spark, sf)
        out = R.distance_report(inc, fac, "area", "prec", by, "lat", "lon", "st_lat", "st_lon",
                                metric=metric, strategy=strategy, order=order)
        return out.select(by, _r("average_distance"), "n_incidents")
    return run


def _sql_area(by: str, metric="great_circle") -> str:
    if metric == "great_circle":
        return f"""WITH {INC_CTE}, {NATION_CTE},
j AS (SELECT {by} AS {by}, {gc_sql('lat', 'lon', 'st_lat', 'st_lon')} AS d
      FROM inc JOIN nst ON inc.area = nst.prec WHERE inc.lat <> 0)
SELECT {by}, ROUND(AVG(d), {KM_DIGITS}) AS average_distance, COUNT({by}) AS n_incidents FROM j GROUP BY {by}"""
    ctes, final = vincenty_sql("lat", "lon", "st_lat", "st_lon", "pairs", keep="grp")
    return f"""WITH {INC_CTE}, {NATION_CTE},
pairs AS (SELECT {by} AS grp, lat, lon, st_lat, st_lon
          FROM inc JOIN nst ON inc.area = nst.prec WHERE inc.lat <> 0),
{ctes}
SELECT grp AS {by}, ROUND(AVG(geodesic_km), {KM_DIGITS}) AS average_distance, COUNT(grp) AS n_incidents
FROM {final} GROUP BY grp"""


def q_weapon_area(spark, sf):
    """Weapon codes 100 to 199 only; one segment is unknown, so the report has
    a null group, whose count of non-null values is 0."""
    inc = (S.customer_incidents(spark, sf).withColumn("weapon", F.col("area") * F.lit(10))
           .withColumn("segment", F.nullif(F.col("segment"), F.lit("BUILDING"))))
    inc = R.weapon_filter(inc, lat="lat", weapon_col="weapon")
    out = R.distance_report(inc, S.nation_stations(spark, sf), "area", "prec", "segment", "lat", "lon",
                            "st_lat", "st_lon", metric="great_circle")
    return out.select("segment", _r("average_distance"), "n_incidents")


SQL_WEAPON_AREA = f"""WITH {INC_CTE}, {NATION_CTE},
j AS (SELECT CASE WHEN segment <> 'BUILDING' THEN segment END AS segment,
             {gc_sql('lat', 'lon', 'st_lat', 'st_lon')} AS d
      FROM inc JOIN nst ON inc.area = nst.prec WHERE inc.lat <> 0 AND area * 10 BETWEEN 100 AND 199)
SELECT segment, ROUND(AVG(d), {KM_DIGITS}) AS average_distance, COUNT(segment) AS n_incidents
FROM j GROUP BY segment"""


# ----------------------------------------------------------- Q4-2 (nearest station)

def _nearest(keep_ties: bool, metric="great_circle"):
    def run(spark, sf):
        inc = R.weapon_filter(S.customer_incidents(spark, sf), lat="lat", weapon_col=None)
        fac = S.supplier_stations(spark, sf)
        if keep_ties:
            out = R.nearest_report(inc, fac, ["incident_id"], "division", True, "lat", "lon",
                                   "st_lat", "st_lon", metric=metric, order="count")
            return out.select("division", _r("average_distance"), "n_incidents")
        out = R.nearest_report(inc, fac, ["incident_id", "segment"], "segment", False, "lat", "lon",
                               "st_lat", "st_lon", metric=metric)
        return out.select("segment", _r("average_distance"), "n_incidents")
    return run


def _sql_nearest(keep_ties: bool, metric="great_circle") -> str:
    if metric == "great_circle":
        pairs = f"""d AS (SELECT inc.incident_id, inc.segment, sst.division,
             {gc_sql('lat', 'lon', 'st_lat', 'st_lon')} AS dist
      FROM inc CROSS JOIN sst WHERE inc.lat <> 0)"""
        head = f"WITH {INC_CTE}, {SUPP_CTE}, {pairs}"
    else:
        ctes, final = vincenty_sql("lat", "lon", "st_lat", "st_lon", "pairs0",
                                   keep="incident_id, segment, division")
        head = f"""WITH {INC_CTE}, {SUPP_CTE},
pairs0 AS (SELECT inc.incident_id, inc.segment, sst.division, lat, lon, st_lat, st_lon
           FROM inc CROSS JOIN sst WHERE inc.lat <> 0),
{ctes},
d AS (SELECT incident_id, segment, division, geodesic_km AS dist FROM {final})"""
    if keep_ties:
        return f"""{head},
m AS (SELECT incident_id, MIN(dist) AS md FROM d GROUP BY incident_id)
SELECT division, ROUND(AVG(dist), {KM_DIGITS}) AS average_distance, COUNT(division) AS n_incidents
FROM d JOIN m USING (incident_id) WHERE dist = md GROUP BY division"""
    return f"""{head},
m AS (SELECT incident_id, segment, MIN(dist) AS md FROM d GROUP BY incident_id, segment)
SELECT segment, ROUND(AVG(md), {KM_DIGITS}) AS average_distance, COUNT(segment) AS n_incidents
FROM m GROUP BY segment"""


# ----------------------------------------------------------- G5 range join

def q_within_distance(spark, sf):
    inc = S.customer_incidents(spark, sf).select("incident_id", "lat", "lon")
    fac = S.supplier_stations(spark, sf).select("station_id", "st_lat", "st_lon")
    pairs = within_distance_join(inc, fac, WITHIN_KM, "lat", "lon", "st_lat", "st_lon")
    return (pairs.groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("n_within"), F.avg("distance_km").alias("avg_km"))
            .select("station_id", "n_within", _r("avg_km")))


def q_within_distance_geodesic(spark, sf):
    inc = S.customer_incidents(spark, sf).select("incident_id", "lat", "lon")
    fac = S.supplier_stations(spark, sf).select("station_id", "st_lat", "st_lon")
    pairs = within_distance_join(inc, fac, WITHIN_KM, "lat", "lon", "st_lat", "st_lon", metric="geodesic")
    return (pairs.groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("n_within"), F.avg("distance_km").alias("avg_km"))
            .select("station_id", "n_within", _r("avg_km")))


def _within_geodesic_sql() -> str:
    ctes, final = vincenty_sql("lat", "lon", "st_lat", "st_lon", "pairs", keep="station_id")
    return f"""WITH {INC_CTE}, {SUPP_CTE},
pairs AS (SELECT station_id, lat, lon, st_lat, st_lon FROM inc CROSS JOIN sst),
{ctes}
SELECT station_id, COUNT(*) AS n_within, ROUND(AVG(geodesic_km), {KM_DIGITS}) AS avg_km
FROM {final} WHERE geodesic_km <= {WITHIN_KM!r} GROUP BY station_id"""


SQL_WITHIN_DISTANCE = f"""WITH {INC_CTE}, {SUPP_CTE},
p AS (SELECT station_id, {gc_sql('lat', 'lon', 'st_lat', 'st_lon')} AS d FROM inc CROSS JOIN sst)
SELECT station_id, COUNT(*) AS n_within, ROUND(AVG(d), {KM_DIGITS}) AS avg_km
FROM p WHERE d <= {WITHIN_KM!r} GROUP BY station_id"""


# ----------------------------------------------------------- G6 path length

def q_path_length(spark, sf):
    pts = S.order_points(spark, sf)
    out = path_length(pts, ["o_custkey"], ["o_orderkey"], "lat", "lon")
    return out.select("o_custkey", _r("path_km"), "points")


def q_path_length_geodesic(spark, sf):
    pts = S.order_points(spark, sf)
    out = path_length(pts, ["o_custkey"], ["o_orderkey"], "lat", "lon", metric="geodesic")
    return out.select("o_custkey", _r("path_km"), "points")


def _path_geodesic_sql() -> str:
    ctes, final = vincenty_sql("plat", "plon", "lat", "lon", "seg", keep="o_custkey")
    return f"""WITH pts AS (
  SELECT o_custkey, o_orderkey, {lat_sql('o_orderkey')} AS lat, {lon_sql('o_orderkey')} AS lon FROM orders),
l AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM pts
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
seg AS (SELECT o_custkey, plat, plon, lat, lon FROM l WHERE plat IS NOT NULL),
{ctes},
tot AS (SELECT o_custkey, SUM(geodesic_km) AS s FROM {final} GROUP BY o_custkey),
cnt AS (SELECT o_custkey, COUNT(*) AS points FROM pts GROUP BY o_custkey)
SELECT cnt.o_custkey, ROUND(COALESCE(tot.s, 0), {KM_DIGITS}) AS path_km, cnt.points
FROM cnt LEFT JOIN tot ON cnt.o_custkey = tot.o_custkey"""


SQL_PATH_LENGTH = f"""WITH pts AS (
  SELECT o_custkey, o_orderkey, {lat_sql('o_orderkey')} AS lat, {lon_sql('o_orderkey')} AS lon FROM orders),
l AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM pts
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey,
       ROUND(COALESCE(SUM(CASE WHEN plat IS NOT NULL THEN {gc_sql('plat', 'plon', 'lat', 'lon')} END), 0), {KM_DIGITS}) AS path_km,
       COUNT(*) AS points
FROM l GROUP BY o_custkey"""


# ----------------------------------------------------------- G7 destination

def q_destination(spark, sf):
    inc = S.customer_incidents(spark, sf)
    bearing = ((F.col("incident_id") * 37) % 360).cast("double")
    lat2, lon2 = destination(F.col("lat"), F.col("lon"), bearing, F.lit(DEST_KM))
    return inc.select("incident_id", F.round(lat2, DEG_DIGITS).alias("dest_lat"),
                      F.round(lon2, DEG_DIGITS).alias("dest_lon"))


def _dest_sql() -> str:
    p1, l1 = "radians(lat)", "radians(lon)"
    b = "radians(CAST((incident_id * 37) % 360 AS DOUBLE))"
    d = f"(CAST({DEST_KM!r} AS DOUBLE) * CAST({1.0 / EARTH_RADIUS_KM!r} AS DOUBLE))"
    p2 = f"asin(sin({p1}) * cos({d}) + cos({p1}) * sin({d}) * cos({b}))"
    return f"""WITH {INC_CTE},
q AS (SELECT incident_id, lat, lon, {p2} AS p2 FROM inc)
SELECT incident_id, ROUND(degrees(p2), {DEG_DIGITS}) AS dest_lat,
  ROUND(degrees({l1} + atan2(sin({b}) * sin({d}) * cos({p1}), cos({d}) - sin({p1}) * sin(p2))), {DEG_DIGITS}) AS dest_lon
FROM q"""


# ----------------------------------------------------------- J6 over co-bucketed tables

def q_co_bucketed(spark, sf):
    """Order lines per priority over two tables bucketed alike: a merge join without an exchange of rows."""
    folder, run = ensure_checkpoint_dir(spark), uuid.uuid4().hex
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    names = [f"lines_{run}", f"orders_{run}"]
    li, o = (bucketed_table(t, n, [k], BUCKETS, f"{folder}/{n}")
             for t, n, k in zip((li, o), names, ("l_orderkey", "o_orderkey"), strict=True))
    out = (join_with_strategy(li, o, li["l_orderkey"] == o["o_orderkey"], strategy="merge")
           .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("l_orderkey").alias("n_orders"))
           .checkpoint())
    for name in names:
        spark.sql(f"DROP TABLE {name}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


SQL_CO_BUCKETED = """SELECT o_orderpriority, COUNT(*) AS n_lines, COUNT(DISTINCT l_orderkey) AS n_orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""

# ----------------------------------------------------------- S2 CSV files

def q_csv_stations(spark, sf):
    """Station files of two headers in one folder, read back, with the count of values that were none."""
    folder = f"{ensure_checkpoint_dir(spark)}/stations-{uuid.uuid4().hex}"
    S.write_station_files(spark, sf, folder)
    counted = Observation("station files")
    st = read_facilities(spark, folder, counted)
    out = st.groupBy((F.col("FID") % 2).cast("int").alias("odd")).agg(
        F.count(F.lit(1)).alias("n_stations"), F.count("X").alias("n_x"), F.round(F.avg("X"), DEG_DIGITS).alias("avg_x"),
        F.round(F.avg("Y"), DEG_DIGITS).alias("avg_y")).checkpoint()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out.withColumn("bad_x", F.lit(counted.get["bad_X"]).cast("long"))


SQL_CSV_STATIONS = f"""WITH {SUPP_CTE},
f AS (SELECT CASE WHEN station_id % 50 <> 0 THEN st_lon END AS x, st_lat AS y, CAST(station_id % 2 AS INTEGER) AS odd FROM sst)
SELECT odd, COUNT(*) AS n_stations, COUNT(x) AS n_x, ROUND(AVG(x), {DEG_DIGITS}) AS avg_x, ROUND(AVG(y), {DEG_DIGITS}) AS avg_y,
       (SELECT COUNT(*) FROM f WHERE x IS NULL) AS bad_x
FROM f GROUP BY odd"""

# ----------------------------------------------------------- O4 limit after a total order

def q_first_incidents(spark, sf):
    """The 25 northernmost incidents, ties by id: a limit after a total order."""
    inc = S.customer_incidents(spark, sf)
    return (inc.orderBy(F.col("lat").desc(), "incident_id").limit(25)
            .select("incident_id", F.round("lat", DEG_DIGITS).alias("lat"), "segment"))


SQL_FIRST_INCIDENTS = f"""WITH {INC_CTE}
SELECT incident_id, ROUND(lat, {DEG_DIGITS}) AS lat, segment FROM inc ORDER BY inc.lat DESC, incident_id LIMIT 25"""

# ----------------------------------------------------------- G12 bearings

# fixed values: the 32 compass points from north clockwise
COMPASS_POINTS = ("N NbE NNE NEbN NE NEbE ENE EbN E EbS ESE SEbE SE SEbS SSE SbE "
                  "S SbW SSW SWbS SW SWbW WSW WbS W WbN WNW NWbW NW NWbN NNW NbW").split()


def q_bearing_histogram(spark, sf):
    inc = S.customer_incidents(spark, sf)
    fac = S.nation_stations(spark, sf)
    return R.bearing_histogram(inc, fac, "area", "prec", "lat", "lon", "st_lat", "st_lon")


def q_bearing_histogram_geodesic(spark, sf):
    """Compass points of the geodesics' start azimuths on WGS-84."""
    return R.bearing_histogram(S.customer_incidents(spark, sf), S.nation_stations(spark, sf), "area", "prec", "lat", "lon",
                               "st_lat", "st_lon", metric="geodesic")


def _bearing_geodesic_sql() -> str:
    ctes, final = vincenty_sql("st_lat", "st_lon", "lat", "lon", "pairs", keep="incident_id")
    names = ", ".join(f"'{n}'" for n in COMPASS_POINTS)
    return f"""WITH {INC_CTE}, {NATION_CTE},
pairs AS (SELECT incident_id, lat, lon, st_lat, st_lon FROM inc JOIN nst ON inc.area = nst.prec),
{ctes}
SELECT ([{names}])[CAST(round(azimuth / 11.25) AS INTEGER) % 32 + 1] AS compass_point, COUNT(*) AS n_incidents
FROM {final} GROUP BY 1"""


def _bearing_sql() -> str:
    p1, p2 = "radians(st_lat)", "radians(lat)"
    dl = "(radians(lon) - radians(st_lon))"
    b = f"((degrees(atan2(sin({dl}) * cos({p2}), cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({dl}))) + 360.0) % 360.0)"
    names = ", ".join(f"'{n}'" for n in COMPASS_POINTS)
    return f"""WITH {INC_CTE}, {NATION_CTE},
b AS (SELECT {b} AS bearing FROM inc JOIN nst ON inc.area = nst.prec)
SELECT ([{names}])[CAST(round(bearing / 11.25) AS INTEGER) % 32 + 1] AS compass_point, COUNT(*) AS n_incidents
FROM b GROUP BY 1"""


# ----------------------------------------------------------- G11 units

def q_convert_length(spark, sf):
    inc = S.customer_incidents(spark, sf)
    fac = S.nation_stations(spark, sf)
    j = inc.join(fac, inc["area"] == fac["prec"])
    km = great_circle_km("lat", "lon", "st_lat", "st_lon")
    return j.select("incident_id", km.alias("km")).select(
        "incident_id", F.round("km", KM_DIGITS).alias("km"),
        *[F.round(convert_length("km", "km", u), KM_DIGITS).alias(u) for u in ("mi", "ft", "nm")])


def _units_sql() -> str:
    # fixed values: a statute mile is 1.609344 km of 5280 feet, a nautical mile 1.852 km
    return f"""WITH {INC_CTE}, {NATION_CTE},
j AS (SELECT incident_id, {gc_sql('lat', 'lon', 'st_lat', 'st_lon')} AS km FROM inc JOIN nst ON inc.area = nst.prec),
u AS (SELECT CAST(1 AS DOUBLE) / CAST('1.609344' AS DOUBLE) AS mi,
             CAST(1 AS DOUBLE) / (CAST('1.609344' AS DOUBLE) / CAST(5280 AS DOUBLE)) AS ft,
             CAST(1 AS DOUBLE) / CAST('1.852' AS DOUBLE) AS nm)
SELECT incident_id, ROUND(km, {KM_DIGITS}) AS km, ROUND(km * u.mi, {KM_DIGITS}) AS mi,
       ROUND(km * u.ft, {KM_DIGITS}) AS ft, ROUND(km * u.nm, {KM_DIGITS}) AS nm FROM j CROSS JOIN u"""


def q_convert_angle(spark, sf):
    inc = S.customer_incidents(spark, sf)
    return inc.select("incident_id", F.round(convert_angle("lat", "deg", "rad"), DEG_DIGITS).alias("lat_rad"),
                      F.round(convert_angle("lat", "deg", "arcmin"), KM_DIGITS).alias("lat_arcmin"),
                      F.round(convert_angle("lat", "deg", "arcsec"), KM_DIGITS).alias("lat_arcsec"))


SQL_CONVERT_ANGLE = f"""WITH {INC_CTE}
SELECT incident_id, ROUND(radians(lat), {DEG_DIGITS}) AS lat_rad,
       ROUND(lat * CAST(60 AS DOUBLE), {KM_DIGITS}) AS lat_arcmin,
       ROUND(lat * CAST(3600 AS DOUBLE), {KM_DIGITS}) AS lat_arcsec
FROM inc"""


# ----------------------------------------------------------- G10 altitudes

def q_altitude_conflicts(spark, sf):
    """Incidents per area whose altitude is not that of their station."""
    inc = S.customer_incidents(spark, sf).withColumn("alt", (F.col("incident_id") % 3).cast("double") / 1000.0)
    fac = S.nation_stations(spark, sf).withColumn("st_alt", (F.col("prec") % 2).cast("double") / 1000.0)
    pairs = inc.join(fac, inc["area"] == fac["prec"])
    return altitude_conflicts(pairs, "alt", "st_alt").groupBy("area").agg(F.count(F.lit(1)).alias("n_conflicts"))


SQL_ALTITUDE_CONFLICTS = """SELECT c_nationkey AS area, COUNT(*) AS n_conflicts
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 3 <> n_nationkey % 2 GROUP BY 1"""


# ----------------------------------------------------------- G8 clean

def _dirty_points(spark, sf):
    inc = S.customer_incidents(spark, sf)
    k = F.col("incident_id") % 7
    return inc.select(
        "incident_id",
        F.when(k == 0, F.col("lat") + 100.0).when(k == 2, F.lit(None).cast("double")).otherwise(F.col("lat")).alias("lat"),
        F.when(k == 1, F.col("lon") + 360.0).when(k == 3, F.col("lon") - 720.0).otherwise(F.col("lon")).alias("lon"))


def q_clean_coordinates(spark, sf):
    out = tag_coordinates(_dirty_points(spark, sf), "lat", "lon")
    return out.select("incident_id", F.round("lat", DEG_DIGITS).alias("lat"),
                      F.round("lon", DEG_DIGITS).alias("lon"), REASON_COL)


SQL_CLEAN_COORDINATES = f"""WITH {INC_CTE},
d AS (SELECT incident_id,
        CASE WHEN incident_id % 7 = 0 THEN lat + 100.0 WHEN incident_id % 7 = 2 THEN NULL ELSE lat END AS lat,
        CASE WHEN incident_id % 7 = 1 THEN lon + 360.0 WHEN incident_id % 7 = 3 THEN lon - 720.0 ELSE lon END AS lon
      FROM inc),
r AS (SELECT *, CASE WHEN lat IS NULL OR lon IS NULL THEN 'null_coordinate'
                     WHEN isnan(lat) OR isnan(lon) OR isinf(lat) OR isinf(lon) THEN 'not_finite'
                     WHEN abs(lat) > 90 THEN 'latitude_out_of_range' END AS reject_reason,
             lon % 360.0 AS m FROM d)
SELECT incident_id, ROUND(lat, {DEG_DIGITS}) AS lat,
  ROUND(CASE WHEN reject_reason IS NULL AND abs(lon) > 180
             THEN (CASE WHEN m < -180 THEN m + 360.0 WHEN m >= 180 THEN m - 360.0 ELSE m END) + 0.0
             ELSE lon END, {DEG_DIGITS}) AS lon,
  reject_reason
FROM r"""


# ----------------------------------------------------------- G9 parse

def _coordinate_text(spark, sf):
    """Coordinate text in seven shapes, from integer parts of the stand-in
    place (1e-4 degree units); one shape is garbage, one out of range."""
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    latn = F.lit(337000) + (k * 7919) % 6500           # 1e-4 degrees
    lonn = F.lit(1187000) - (k * 104729) % 6000         # abs(lon), 1e-4 degrees

    def dec(n):
        return F.concat((n / 10000).cast("long").cast("string"), F.lit("."),
                        F.lpad((n % 10000).cast("string"), 4, "0"))

    def dms(n):
        frac = n % 10000
        mins = (frac * 60 / 10000).cast("long")
        secn = (frac * 60) % 10000 * 60                  # 1e-4 arcseconds
        return F.concat((n / 10000).cast("long").cast("string"), F.lit(" "), mins.cast("string"), F.lit("m "),
                        (secn / 10000).cast("long").cast("string"), F.lit("."),
                        F.lpad((secn % 10000).cast("string"), 4, "0"), F.lit("s"))

    shape = k % 7
    text = (F.when(shape == 0, F.concat(dec(latn), F.lit(",-"), dec(lonn)))
            .when(shape == 1, F.concat(dec(latn), F.lit(" N "), dec(lonn), F.lit(" W")))
            .when(shape == 2, F.concat(dec(latn), F.lit(";-"), dec(lonn)))
            .when(shape == 3, F.concat(dms(latn), F.lit(" N "), dms(lonn), F.lit(" W")))
            .when(shape == 4, F.concat(dec(latn), F.lit(", -"), dec(lonn), F.lit(", "),
                                       (k % 1000).cast("string"), F.lit("m")))
            .when(shape == 5, F.lit("somewhere downtown"))
            .otherwise(F.concat(F.lit("95.5, -"), dec(lonn))))
    return c.select(k.alias("incident_id"), text.alias("place_text"))


def q_parse_coordinates(spark, sf):
    out = tag_parsed_coordinates(_coordinate_text(spark, sf), "place_text")
    return out.select("incident_id", F.round("lat", DEG_DIGITS).alias("lat"),
                      F.round("lon", DEG_DIGITS).alias("lon"),
                      F.round("alt_km", DEG_DIGITS).alias("alt_km"), REASON_COL)


SQL_PARSE_COORDINATES = f"""WITH b AS (
  SELECT c_custkey AS incident_id, c_custkey % 7 AS shape,
         337000 + (c_custkey * 7919) % 6500 AS latn, 1187000 - (c_custkey * 104729) % 6000 AS lonn
  FROM customer),
v AS (SELECT *,
  CAST(latn AS DOUBLE) / 10000 AS latd, CAST(lonn AS DOUBLE) / 10000 AS lond,
  CAST(latn // 10000 AS DOUBLE) + (CAST((latn % 10000) * 60 // 10000 AS DOUBLE) / 60.0
      + (CAST((latn % 10000) * 60 % 10000 * 60 AS DOUBLE) / 10000) / 3600.0) AS lat_dms,
  CAST(lonn // 10000 AS DOUBLE) + (CAST((lonn % 10000) * 60 // 10000 AS DOUBLE) / 60.0
      + (CAST((lonn % 10000) * 60 % 10000 * 60 AS DOUBLE) / 10000) / 3600.0) AS lon_dms
  FROM b)
SELECT incident_id,
  ROUND(CASE WHEN shape = 5 THEN NULL WHEN shape = 6 THEN 95.5 WHEN shape = 3 THEN lat_dms ELSE latd END, {DEG_DIGITS}) AS lat,
  ROUND(CASE WHEN shape = 5 THEN NULL WHEN shape = 3 THEN -lon_dms ELSE -lond END, {DEG_DIGITS}) AS lon,
  ROUND(CASE WHEN shape = 5 THEN NULL WHEN shape = 4 THEN CAST(incident_id % 1000 AS DOUBLE) * 0.001 ELSE 0.0 END, {DEG_DIGITS}) AS alt_km,
  CASE WHEN shape = 5 THEN 'unparseable' WHEN shape = 6 THEN 'latitude_out_of_range' END AS reject_reason
FROM v"""


# ----------------------------------------------------------- registry

def queries() -> dict[str, Query]:
    return {
        "top_months": q_top_months,
        "top_months_sql": q_top_months_sql,
        "part_of_day": q_part_of_day,
        "extreme_groups": _extreme_groups(None),
        "extreme_groups_broadcast": _extreme_groups("broadcast"),
        "extreme_groups_merge": _extreme_groups("merge"),
        "extreme_groups_shuffle_hash": _extreme_groups("shuffle_hash"),
        "descent_income": _descent_income(None),
        "descent_income_broadcast": _descent_income("broadcast"),
        "descent_income_merge": _descent_income("merge"),
        "descent_income_shuffle_hash": _descent_income("shuffle_hash"),
        "descent_income_skew": _descent_income("skew"),
        "decode_codes": q_decode_codes,
        "parse_money": q_parse_money,
        "union_aligned": q_union_aligned,
        "profile": q_profile,
        "area_distance": _area("segment", "by"),
        "area_distance_division": _area("division", "count"),
        "area_distance_broadcast": _area("segment", "by", "broadcast"),
        "area_distance_merge": _area("segment", "by", "merge"),
        "area_distance_shuffle_hash": _area("segment", "by", "shuffle_hash"),
        "area_distance_division_broadcast": _area("division", "count", "broadcast"),
        "area_distance_division_merge": _area("division", "count", "merge"),
        "area_distance_division_shuffle_hash": _area("division", "count", "shuffle_hash"),
        "nearest_distance": _nearest(False),
        "nearest_facility": _nearest(True),
        "geodesic_area": _area("segment", "by", metric="geodesic"),
        "geodesic_area_division": _area("division", "count", metric="geodesic"),
        "geodesic_nearest": _nearest(False, "geodesic"),
        "geodesic_nearest_facility": _nearest(True, "geodesic"),
        "within_distance": q_within_distance,
        "within_distance_geodesic": q_within_distance_geodesic,
        "path_length": q_path_length,
        "path_length_geodesic": q_path_length_geodesic,
        "destination": q_destination,
        "bearing_histogram": q_bearing_histogram,
        "bearing_histogram_geodesic": q_bearing_histogram_geodesic,
        "co_bucketed_join": q_co_bucketed,
        "csv_stations": q_csv_stations,
        "first_incidents": q_first_incidents,
        "convert_length": q_convert_length,
        "convert_angle": q_convert_angle,
        "altitude_conflicts": q_altitude_conflicts,
        "weapon_area": q_weapon_area,
        "clean_coordinates": q_clean_coordinates,
        "parse_coordinates": q_parse_coordinates,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "top_months": SQL_TOP_MONTHS,
        "top_months_sql": SQL_TOP_MONTHS,
        "part_of_day": SQL_PART_OF_DAY,
        "extreme_groups": SQL_EXTREME_GROUPS,
        "extreme_groups_broadcast": SQL_EXTREME_GROUPS,
        "extreme_groups_merge": SQL_EXTREME_GROUPS,
        "extreme_groups_shuffle_hash": SQL_EXTREME_GROUPS,
        "descent_income": _descent_income_sql(),
        "descent_income_broadcast": _descent_income_sql(),
        "descent_income_merge": _descent_income_sql(),
        "descent_income_shuffle_hash": _descent_income_sql(),
        "descent_income_skew": _descent_income_sql(),
        "decode_codes": SQL_DECODE_CODES,
        "parse_money": SQL_PARSE_MONEY,
        "union_aligned": SQL_UNION_ALIGNED,
        "profile": SQL_PROFILE,
        "area_distance": _sql_area("segment"),
        "area_distance_division": _sql_area("division"),
        "area_distance_broadcast": _sql_area("segment"),
        "area_distance_merge": _sql_area("segment"),
        "area_distance_shuffle_hash": _sql_area("segment"),
        "area_distance_division_broadcast": _sql_area("division"),
        "area_distance_division_merge": _sql_area("division"),
        "area_distance_division_shuffle_hash": _sql_area("division"),
        "nearest_distance": _sql_nearest(False),
        "nearest_facility": _sql_nearest(True),
        "geodesic_area": _sql_area("segment", "geodesic"),
        "geodesic_area_division": _sql_area("division", "geodesic"),
        "geodesic_nearest": _sql_nearest(False, "geodesic"),
        "geodesic_nearest_facility": _sql_nearest(True, "geodesic"),
        "within_distance": SQL_WITHIN_DISTANCE,
        "within_distance_geodesic": _within_geodesic_sql(),
        "path_length": SQL_PATH_LENGTH,
        "path_length_geodesic": _path_geodesic_sql(),
        "destination": _dest_sql(),
        "bearing_histogram": _bearing_sql(),
        "bearing_histogram_geodesic": _bearing_geodesic_sql(),
        "co_bucketed_join": SQL_CO_BUCKETED,
        "csv_stations": SQL_CSV_STATIONS,
        "first_incidents": SQL_FIRST_INCIDENTS,
        "convert_length": _units_sql(),
        "convert_angle": SQL_CONVERT_ANGLE,
        "altitude_conflicts": SQL_ALTITUDE_CONFLICTS,
        "weapon_area": SQL_WEAPON_AREA,
        "clean_coordinates": SQL_CLEAN_COORDINATES,
        "parse_coordinates": SQL_PARSE_COORDINATES,
    }
