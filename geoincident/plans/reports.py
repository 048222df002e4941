"""The reference's questions (Q0-Q4) as DataFrame → DataFrame reports.

Default column names are the incident file's own spelling; every report
takes the names as parameters so other tables of the same shape fit.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.functions.codes import DESCENT_CODES, decode
from geoincident.functions.daypart import part_of_day
from geoincident.functions.exact import exact_mean
from geoincident.functions.geo import EARTH_RADIUS_KM, altitude_mismatch, compass_point, great_circle_km, initial_bearing
from geoincident.functions.money import parse_money
from geoincident.functions.timeops import in_year, to_date_any
from geoincident.functions.units import length_factor
from geoincident.operators.extremes import count_extreme_groups
from geoincident.operators.geodesic import geodesic_inverse, geodesic_km
from geoincident.operators.joins import join_with_strategy, skew_join
from geoincident.operators.ranking import top_k_per_group
from geoincident.operators.spatial import nearest_facility
from geoincident.sources.files import profile


def load_report(df: DataFrame) -> DataFrame:
    """Q0: row count and per-column type / non-null count of the loaded table."""
    return profile(df)


# ------------------------------------------------------------------ Q1

def top_months(df: DataFrame, date_col: str = "DATE OCC", k: int = 3,
               method: str = "row_number", count_col: str = "crime_total",
               rank_col: str = "rank") -> DataFrame:
    """Q1: for every year the ``k`` months with the most incidents.

    Ties in the count break by month (deterministic row_number). Rows with
    no date form no month. Sorted by year, then count descending."""
    dtype = dict(df.dtypes)[date_col]
    d = to_date_any(F.col(f"`{date_col}`"), dtype)
    months = (df.select(d.alias("__d")).where(F.col("__d").isNotNull())
              .groupBy(F.year("__d").alias("year"), F.month("__d").alias("month"))
              .agg(F.count(F.lit(1)).alias(count_col)))
    ranked = top_k_per_group(months, ["year"], [F.col(count_col).desc(), F.col("month").asc()],
                             k, method, rank_col)
    return ranked.orderBy("year", F.col(count_col).desc(), "month")


def top_months_sql(spark: SparkSession, df: DataFrame, date_col: str = "DATE OCC",
                   k: int = 3, view: str | None = None) -> DataFrame:
    """Q1 through SQL: the table is registered as a view, replaced by its own
    projection, then ranked with ROW_NUMBER over the grouped count in a CTE.
    The view name is unique per call unless given."""
    import uuid
    view = view or f"crimes_{uuid.uuid4().hex[:12]}"
    dtype = dict(df.dtypes)[date_col]
    df.select(to_date_any(F.col(f"`{date_col}`"), dtype).alias("date_occ")).createOrReplaceTempView(view)
    spark.sql(f"SELECT date_occ FROM {view} WHERE date_occ IS NOT NULL").createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH ranked AS (
            SELECT YEAR(date_occ) AS year, MONTH(date_occ) AS month,
                   COUNT(*) AS crime_total,
                   ROW_NUMBER() OVER (PARTITION BY YEAR(date_occ)
                                      ORDER BY COUNT(*) DESC, MONTH(date_occ)) AS rank
            FROM {view}
            GROUP BY YEAR(date_occ), MONTH(date_occ))
        SELECT year, month, crime_total, rank FROM ranked
        WHERE rank <= {int(k)}
        ORDER BY year, rank""")


# ------------------------------------------------------------------ Q2

def part_of_day_counts(df: DataFrame, time_col: str = "TIME OCC", premise_col: str = "Premis Cd",
                       premise: int | None = 101, count_col: str = "crime_total") -> DataFrame:
    """Q2: incidents at one premise type counted per part of day, most first.
    The filter is applied before the (native) part-of-day expression."""
    src = df if premise is None else df.where(F.col(f"`{premise_col}`") == F.lit(premise))
    return (src.select(part_of_day(F.col(f"`{time_col}`")).alias("partofday"))
            .groupBy("partofday").agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), "partofday"))


# ------------------------------------------------------------------ Q3

def extreme_group_counts(df: DataFrame, value_col: str, group_col: str, k: int = 3,
                         out_group: str | None = None, count_col: str = "n_incidents") -> DataFrame:
    """Count rows per group, only among rows whose value is one of the k
    highest or k lowest distinct values (A6). A null group stays a group.
    ``df`` runs once, when the report is built."""
    g = out_group or group_col
    totals = count_extreme_groups(df, value_col, group_col, k, count_col).withColumnRenamed(group_col, g)
    return totals.orderBy(F.col(count_col).desc(), F.col(f"`{g}`").asc_nulls_last())


def descent_income_report(incidents: DataFrame, geocodes: DataFrame, income: DataFrame,
                          year: int = 2015, k: int = 3, strategy: str | None = None,
                          descent_codes: dict[str, str] = DESCENT_CODES) -> DataFrame:
    """Q3: victims of one year by descent, only in the ZIP areas whose income
    is among the k highest or k lowest distinct incomes of the joined rows.

    incidents(DATE OCC date, Vict Descent, LAT, LON) ⋈ geocodes(LAT, LON,
    ZIPcode) on both coordinates; ZIP = first five characters as int;
    ⋈ income(Zip Code, Estimated Median Income[, year]). ``strategy`` picks
    the physical join for both joins (``"skew"``: places and ZIP areas with very
    many incidents are found by a sketch and split). Coordinates are compared as
    doubles: 0.0 equals -0.0, NaN equals NaN, and a null one joins nothing."""
    inc = (incidents
           .where(in_year(F.col("`DATE OCC`"), year))
           .where((F.col("`Vict Descent`") != "X") & F.col("`Vict Descent`").isNotNull())
           .select(F.col("`Vict Descent`").alias("descent"), F.col("LAT").alias("lat"),
                   F.col("LON").alias("lon")))
    geo = geocodes.select(F.col("LAT").alias("g_lat"), F.col("LON").alias("g_lon"),
                          F.substring("ZIPcode", 1, 5).try_cast("int").alias("zip"))
    if strategy == "skew":
        inc_geo = skew_join(inc, geo, ["lat", "lon"], ["g_lat", "g_lon"]).select("descent", "zip")
    else:
        inc_geo = join_with_strategy(inc, geo, (inc["lat"] == geo["g_lat"]) & (inc["lon"] == geo["g_lon"]),
                                     strategy=strategy).select("descent", "zip")
    inc_geo = inc_geo.where(F.col("zip").isNotNull())
    inc_sel = income
    if "year" in income.columns:
        inc_sel = income.where(F.col("year") == F.lit(year))
    inc_sel = inc_sel.select(F.col("`Zip Code`").alias("zip_code"),
                             parse_money("Estimated Median Income").alias("income"))
    if strategy == "skew":
        joined = skew_join(inc_geo, inc_sel.withColumn("zip_code", F.col("zip_code").cast("int")), ["zip"], ["zip_code"])
    else:
        joined = join_with_strategy(inc_geo, inc_sel, inc_geo["zip"] == inc_sel["zip_code"],
                                    strategy=strategy)
    rows = joined.select(decode("descent", descent_codes).alias("Victim Descent"), "income")
    return extreme_group_counts(rows, "income", "Victim Descent", k)


# ------------------------------------------------------------------ Q4

def _distance(metric: str, lat1, lon1, lat2, lon2, radius_km, ellipsoid):
    if metric == "great_circle":
        return great_circle_km(lat1, lon1, lat2, lon2, radius_km)
    if metric == "geodesic":
        return geodesic_km(lat1, lon1, lat2, lon2, ellipsoid)
    raise ValueError("metric must be 'great_circle' or 'geodesic'")


def weapon_filter(df: DataFrame, lat: str = "LAT", weapon_col: str | None = "Weapon Used Cd",
                  weapon_range: tuple[int, int] | None = (100, 199)) -> DataFrame:
    """Drop unknown places (latitude 0 or null) and keep a weapon-code range."""
    out = df.where(F.col(f"`{lat}`") != F.lit(0.0))
    if weapon_col is not None and weapon_range is not None:
        out = out.where(F.col(f"`{weapon_col}`").between(*weapon_range))
    return out


def distance_report(inc: DataFrame, fac: DataFrame, inc_key: str, fac_key: str, by: str,
                    inc_lat: str = "LAT", inc_lon: str = "LON", fac_lat: str = "Y", fac_lon: str = "X",
                    metric: str = "geodesic", strategy: str | None = None,
                    ellipsoid="WGS-84", radius_km: float = EARTH_RADIUS_KM,
                    order: str = "by", count_col: str = "n_incidents",
                    precision: str = "double", unit: str = "km",
                    altitude: tuple[str, str] | None = None) -> DataFrame:
    """Q4-1: join each incident to its responsible facility (key equality,
    unmatched incidents drop), measure the distance, and report the mean
    distance and the count of non-null ``by`` values per ``by`` group.
    ``precision="float"`` averages float32 distances like the original UDF. The
    mean's bits do not depend on partitions; an altitude rule is
    ``altitude`` = (incident column, facility column): pairs whose altitudes
    differ by more than the tolerance can't be measured and are left out."""
    joined = join_with_strategy(inc, fac, inc[f"`{inc_key}`"] == fac[f"`{fac_key}`"], strategy=strategy)
    if altitude is not None:
        joined = joined.where(~F.coalesce(altitude_mismatch(F.col(f"`{altitude[0]}`"), F.col(f"`{altitude[1]}`")), F.lit(False)))
    d = _distance(metric, F.col(f"`{inc_lat}`"), F.col(f"`{inc_lon}`"),
                  F.col(f"`{fac_lat}`"), F.col(f"`{fac_lon}`"), radius_km, ellipsoid)
    d = d if unit == "km" else d * F.lit(length_factor("km", unit))
    out = (joined.select(F.col(f"`{by}`").alias(by), d.cast(precision).alias("__d"))
           .groupBy(by).agg(exact_mean("__d").alias("average_distance"), F.count(F.col(f"`{by}`")).alias(count_col)))
    if order == "by":
        return out.orderBy(F.col(f"`{by}`"))
    return out.orderBy(F.col(count_col).desc(), F.col(f"`{by}`"))


def nearest_report(inc: DataFrame, fac: DataFrame, id_cols: Sequence[str], by: str,
                   keep_ties: bool, inc_lat: str = "LAT", inc_lon: str = "LON",
                   fac_lat: str = "Y", fac_lon: str = "X", metric: str = "geodesic",
                   ellipsoid="WGS-84", radius_km: float = EARTH_RADIUS_KM,
                   cell_km: float | None = None, order: str = "by", count_col: str = "n_incidents",
                   precision: str = "double", unit: str = "km") -> DataFrame:
    """Q4-2: distance from every incident to its nearest facility.

    ``keep_ties=False`` (per-year form): the minimum per ``id_cols`` group
    (``by`` must be one of them), then mean and count per ``by``.
    ``keep_ties=True`` (per-division form): every tied nearest facility and
    every repeated id row counts; ``by`` is a facility column."""
    # project what the report needs first (column pruning; also keeps the two
    # sides' column names apart, e.g. a LOCATION column on both)
    keep_inc = list(dict.fromkeys([*id_cols, inc_lat, inc_lon] + ([by] if by in inc.columns else [])))
    keep_fac = list(dict.fromkeys([fac_lat, fac_lon] + ([by] if by not in keep_inc and by in fac.columns else [])))
    inc = inc.select(*[F.col(f"`{c}`") for c in keep_inc])
    fac = fac.select(*[F.col(f"`{c}`") for c in keep_fac])
    near = nearest_facility(inc, fac, id_cols, inc_lat, inc_lon, fac_lat, fac_lon,
                            keep_ties=keep_ties, metric=metric, ellipsoid=ellipsoid,
                            radius_km=radius_km, cell_km=cell_km, distance_col="__d",
                            precision=precision)
    if unit != "km":
        near = near.withColumn("__d", F.col("__d") * F.lit(length_factor("km", unit)))
    out = near.groupBy(F.col(f"`{by}`").alias(by)).agg(
        exact_mean("__d").alias("average_distance"), F.count(F.col(f"`{by}`")).alias(count_col))
    if order == "by":
        return out.orderBy(F.col(f"`{by}`"))
    return out.orderBy(F.col(count_col).desc(), F.col(f"`{by}`"))


def bearing_histogram(inc: DataFrame, fac: DataFrame, inc_key: str, fac_key: str,
                      inc_lat: str = "LAT", inc_lon: str = "LON", fac_lat: str = "Y",
                      fac_lon: str = "X", count_col: str = "n_incidents",
                      metric: str = "great_circle", ellipsoid="WGS-84") -> DataFrame:
    """Compass direction from each incident's responsible facility to
    the incident, counted per compass point (32 points). ``metric="geodesic"``
    takes the azimuth of the inverse problem on the ellipsoid."""
    joined = inc.join(fac, inc[f"`{inc_key}`"] == fac[f"`{fac_key}`"], "inner")
    ends = [F.col(f"`{c}`") for c in (fac_lat, fac_lon, inc_lat, inc_lon)]
    if metric not in ("great_circle", "geodesic"):
        raise ValueError("metric must be 'great_circle' or 'geodesic'")
    b = initial_bearing(*ends) if metric == "great_circle" else geodesic_inverse(*ends, ellipsoid)["azimuth"]
    return (joined.select(compass_point(b).alias("compass_point"))
            .groupBy("compass_point").agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), "compass_point"))
