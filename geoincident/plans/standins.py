"""Reference-shaped inputs built from the driver's Parquet tables.

These builders only give rows the schema a report expects (a point per
customer, a station per nation, ...). Coordinates do not exist in the
driver tables, so they are derived from a key with integer arithmetic that
an independent SQL engine can repeat exactly. The reports never look at how
these rows were made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.functions.timeops import INCIDENT_DATETIME_PATTERN
from geoincident.sources.files import read_table


#: keys that share one region of 0.65 x 0.6 degrees; tables of more keys fill more
#: regions, so that the number of points near a point does not grow with the tables
CUSTOMERS_PER_REGION = 1500
SUPPLIERS_PER_REGION = 100


def _region(k: Column, per_region: int | None) -> Column:
    return F.lit(0).cast("long") if per_region is None else F.floor(k / F.lit(per_region))


def lat_of(k: Column, per_region: int | None = None) -> Column:
    """Latitude of a key; one region for all keys if ``per_region`` is None.

    Regions lie in rows of 400 from west to east, 75 rows from south to north;
    beyond these 30,000 regions places repeat.
    """
    row = F.floor(_region(k, per_region) / F.lit(400)) % F.lit(75)
    return F.lit(33.7) + ((k * F.lit(7919)) % F.lit(6500) + row * F.lit(7000)).cast("double") / F.lit(10000.0)


def lon_of(k: Column, per_region: int | None = None) -> Column:
    column = _region(k, per_region) % F.lit(400)
    return F.lit(-118.7) + ((k * F.lit(104729)) % F.lit(6000) + column * F.lit(7000)).cast("double") / F.lit(10000.0)


def customer_incidents(spark: SparkSession, sf: str) -> DataFrame:
    """One incident per customer: id, area (nation), a group label, place."""
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("incident_id"), F.col("c_nationkey").alias("area"),
                    F.col("c_mktsegment").alias("segment"),
                    lat_of(k, CUSTOMERS_PER_REGION).alias("lat"), lon_of(k, CUSTOMERS_PER_REGION).alias("lon"))


def nation_stations(spark: SparkSession, sf: str) -> DataFrame:
    """One responsible station per nation (unique key, like a precinct)."""
    n = read_table(spark, sf, "nation")
    k = F.col("n_nationkey")
    return n.select(k.alias("prec"), F.col("n_name").alias("division"),
                    lat_of(k).alias("st_lat"), lon_of(k).alias("st_lon"))


def supplier_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier as a station (the nearest-facility candidates)."""
    s = read_table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.alias("station_id"), F.col("s_name").alias("division"),
                    lat_of(k, SUPPLIERS_PER_REGION).alias("st_lat"), lon_of(k, SUPPLIERS_PER_REGION).alias("st_lon"))


def order_points(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as track points: track = customer, order = order key."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("o_custkey", "o_orderkey", lat_of(k).alias("lat"), lon_of(k).alias("lon"))


def orders_as_text_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders split at 1998 into two 'files' whose date column is text in the
    incident layout; the second spells its columns differently."""
    o = read_table(spark, sf, "orders")
    txt = F.date_format(F.col("o_orderdate"), INCIDENT_DATETIME_PATTERN)
    first = (o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
             .select("o_orderkey", "o_custkey", txt.alias("order_date"), "o_totalprice"))
    second = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .select(F.col("o_orderkey").alias("ORDER_NO"), F.col("o_custkey").alias("CUSTOMER"),
                      txt.alias("DATE OCC"), F.col("o_totalprice").alias("TOTAL")))
    return first, second


def order_incidents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as incidents in the incident file layout: date, a one-letter
    code, and the place of the ordering customer."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_custkey")
    return o.select(F.col("o_orderkey").alias("DR_NO"), F.col("o_orderdate").cast("date").alias("DATE OCC"),
                    F.col("o_orderstatus").alias("Vict Descent"), lat_of(k, CUSTOMERS_PER_REGION).alias("LAT"),
                    lon_of(k, CUSTOMERS_PER_REGION).alias("LON"))


def customer_geocodes(spark: SparkSession, sf: str) -> DataFrame:
    """Reverse geocodes: a customer's place and a ZIP text whose first five
    characters are 90000 + nation key."""
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    zipcode = F.concat((F.col("c_nationkey") + F.lit(90000)).cast("string"), F.lit("-"),
                       F.lpad((k % 10000).cast("string"), 4, "0"))
    return c.select(lat_of(k, CUSTOMERS_PER_REGION).alias("LAT"), lon_of(k, CUSTOMERS_PER_REGION).alias("LON"),
                    zipcode.alias("ZIPcode"))


def nation_income(spark: SparkSession, sf: str) -> DataFrame:
    """Income table: one ZIP per nation, money text, one value unusable."""
    n = read_table(spark, sf, "nation")
    k = F.col("n_nationkey")
    amount = F.lit(20000) + (k * F.lit(7919)) % F.lit(60000)
    text = F.when(k == 7, F.lit("---")).otherwise(F.concat(F.lit("$"), F.format_number(amount, 0)))
    return n.select((k + F.lit(90000)).cast("int").alias("Zip Code"), F.col("n_name").alias("Community"),
                    text.alias("Estimated Median Income"))


def write_station_files(spark: SparkSession, sf: str, folder: str) -> None:
    """Every supplier as a station in CSV files of two headers, X before Y and Y before X, in one folder; every 50th
    station has no usable X."""
    s = supplier_stations(spark, sf)
    k = F.col("station_id")
    rows = s.select(F.when(k % 50 == 0, F.lit("n/a")).otherwise(F.col("st_lon").cast("string")).alias("X"),
                    F.col("st_lat").alias("Y"), k.alias("FID"), F.col("division").alias("DIVISION"),
                    F.lit("").alias("LOCATION"), k.alias("PREC"))
    for odd, order in ((0, ["X", "Y"]), (1, ["Y", "X"])):
        (rows.where(k % 2 == odd).select(*order, "FID", "DIVISION", "LOCATION", "PREC")
         .write.mode("append").option("header", True).csv(folder))
