"""Readers with explicit schemas (S1-S5), union (U1) and table profile.

An explicit schema saves the extra inference pass over every file and keeps
types stable between files; ANSI mode stays on, so bad text becomes null
only where a ``try_`` function is used on purpose.
"""

from __future__ import annotations

import csv
from functools import reduce
from typing import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoincident.functions.timeops import text_to_date

# The incident file layout (public crime-report extract).
INCIDENT_SCHEMA = T.StructType([
    T.StructField("DR_NO", T.LongType()),
    T.StructField("Date Rptd", T.StringType()),
    T.StructField("DATE OCC", T.StringType()),
    T.StructField("TIME OCC", T.IntegerType()),
    T.StructField("AREA ", T.IntegerType()),
    T.StructField("AREA NAME", T.StringType()),
    T.StructField("Rpt Dist No", T.IntegerType()),
    T.StructField("Part 1-2", T.IntegerType()),
    T.StructField("Crm Cd", T.IntegerType()),
    T.StructField("Crm Cd Desc", T.StringType()),
    T.StructField("Mocodes", T.StringType()),
    T.StructField("Vict Age", T.IntegerType()),
    T.StructField("Vict Sex", T.StringType()),
    T.StructField("Vict Descent", T.StringType()),
    T.StructField("Premis Cd", T.IntegerType()),
    T.StructField("Premis Desc", T.StringType()),
    T.StructField("Weapon Used Cd", T.IntegerType()),
    T.StructField("Weapon Desc", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Status Desc", T.StringType()),
    T.StructField("Crm Cd 1", T.IntegerType()),
    T.StructField("Crm Cd 2", T.IntegerType()),
    T.StructField("Crm Cd 3", T.IntegerType()),
    T.StructField("Crm Cd 4", T.IntegerType()),
    T.StructField("LOCATION", T.StringType()),
    T.StructField("Cross Street", T.StringType()),
    T.StructField("LAT", T.DoubleType()),
    T.StructField("LON", T.DoubleType()),
])
INCIDENT_DATE_COLUMNS = ("Date Rptd", "DATE OCC")

FACILITY_SCHEMA = T.StructType([
    T.StructField("X", T.DoubleType()),          # longitude
    T.StructField("Y", T.DoubleType()),          # latitude
    T.StructField("FID", T.IntegerType()),
    T.StructField("DIVISION", T.StringType()),
    T.StructField("LOCATION", T.StringType()),
    T.StructField("PREC", T.IntegerType()),
])

INCOME_SCHEMA = T.StructType([
    T.StructField("Zip Code", T.IntegerType()),
    T.StructField("Community", T.StringType()),
    T.StructField("Estimated Median Income", T.StringType()),
])

GEOCODE_SCHEMA = T.StructType([
    T.StructField("LAT", T.DoubleType()),
    T.StructField("LON", T.DoubleType()),
    T.StructField("ZIPcode", T.StringType()),
])


def _plain(name: str) -> str:
    """Column names are compared without case, blanks at their ends and the byte-order mark."""
    return name.strip("\ufeff \t\r").lower()


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a path (a file, a folder or a pattern) by their header line. Files without any line are left out.

    The lines are found by Spark, one per file: of the first block of each file the line that comes first.
    """
    lines = (spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
             .where("file_block_start = 0").withColumn("nth", F.monotonically_increasing_id())
             .groupBy("file_path").agg(F.min_by("value", "nth").alias("line")))
    out: dict[str, list[str]] = {}
    for line, files in lines.groupBy("line").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect():
        out[line] = [unquote(f) for f in files]
    return dict(sorted(out.items()))


def _fields(header: list[str], schema: T.StructType, path: str) -> list[T.StructField]:
    """The schema's fields in the order of the header's names."""
    fields, names = {_plain(f.name): f for f in schema}, [_plain(c) for c in header]
    if sorted(names) == sorted(fields):
        return [fields[n] for n in names]
    own = list(fields)
    if len(names) != len(own) or any(n in fields and n != o for n, o in zip(names, own)):
        raise ValueError(f"{path}: the header names {names}, expected {own}")
    return list(schema)


def _csv(spark: SparkSession, schema: T.StructType, path: str, counted: Observation | None = None,
         dates: tuple[str, ...] = ()) -> DataFrame:
    """The CSV files of a path under ``schema``, the columns of each file found by its own header.

    A header with all names in another order is followed. A name that the schema does not know stands for the column at
    its place; a known name at another column's place or another number of columns is an error. Files of one header are
    read together. Spark holds every file against the header it was grouped by, so one that changes meanwhile fails.

    ``counted`` gets, once an action has read the table, the ``rows`` and for each column that is no text the number of
    texts there that are no value and became null (``bad_<column>``); it reads all columns for this.
    """
    text = T.StringType()
    parts = []
    for line, files in _headers(spark, path).items():
        header = next(csv.reader([line.lstrip("\ufeff")]))
        found = _fields(header, schema, ", ".join(files[:3]))
        own = T.StructType([T.StructField(h, f.dataType if counted is None else text) for h, f in zip(header, found)])
        read = (spark.read.schema(own).option("header", True).option("mode", "PERMISSIVE").option("multiLine", False)
                .option("enforceSchema", False).csv(files))
        parts.append(read.toDF(*[f.name for f in found]).select([F.col(f"`{f.name}`") for f in schema]))
    if not parts:
        return spark.createDataFrame([], schema)
    df = reduce(DataFrame.unionByName, parts)
    if counted is None:
        for name in dates:
            df = df.withColumn(name, text_to_date(name))
        return df
    values = {f.name: text_to_date(f.name) if f.name in dates else F.col(f"`{f.name}`").try_cast(f.dataType)
              for f in schema if f.dataType != text or f.name in dates}
    both = df.withColumns({f"__value_{n}": v for n, v in values.items()})
    bad = [F.count_if((F.trim(F.col(f"`{n}`")) != "") & F.col(f"`__value_{n}`").isNull()).alias(f"bad_{n.strip()}") for n in values]
    both = both.observe(counted, F.count(F.lit(1)).alias("rows"), *bad)
    return both.select([F.col(f"`__value_{f.name}`").alias(f.name) if f.name in values else F.col(f"`{f.name}`") for f in schema])


def read_incidents(spark: SparkSession, paths: Iterable[str] | str,
                   schema: T.StructType = INCIDENT_SCHEMA, counted: Observation | None = None) -> DataFrame:
    """All incident files under one schema, dates parsed to DateType.

    Paths are files, folders or patterns; every file's columns are found by its
    own header. Unparseable dates and numbers become null; ``counted`` (one path)
    tells how many did, see ``_csv``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if counted is not None and len(paths) != 1:
        raise ValueError("an observation counts one path; use a folder or a pattern")
    dates = tuple(f.name for f in schema if f.name in INCIDENT_DATE_COLUMNS)
    return reduce(DataFrame.unionByName, [_csv(spark, schema, p, counted, dates) for p in paths])


def read_facilities(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    """Station table; the UTF-8 byte-order mark is no part of the first name."""
    return _csv(spark, FACILITY_SCHEMA, path, counted)


def read_income(spark: SparkSession, paths_by_year: Mapping[int, str]) -> DataFrame:
    """Income tables of several vintages, with a ``year`` column."""
    parts = [_csv(spark, INCOME_SCHEMA, p).withColumn("year", F.lit(int(y)))
             for y, p in sorted(paths_by_year.items())]
    return reduce(DataFrame.unionByName, parts)


def read_geocodes(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    return _csv(spark, GEOCODE_SCHEMA, path, counted)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver Parquet table (S5); filters and projections reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def union_aligned(dfs: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by position; the names come from the first input.

    Numbers widen as in Spark's own union. A column that is text in the first
    input is text in the result; any other mismatch is cast to the first
    input's type with ``try_cast`` (a value that does not fit becomes null), so
    ANSI coercion cannot turn a text column into a number."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("union_aligned needs at least one DataFrame")
    out = dfs[0]
    for other in dfs[1:]:
        fields = out.schema.fields
        if len(other.columns) != len(fields):
            raise ValueError(f"column count {len(other.columns)} != {len(fields)}")
        aligned = []
        for theirs, ours in zip(other.schema.fields, fields):
            col = F.col(f"`{theirs.name}`")
            widens = isinstance(theirs.dataType, T.NumericType) and isinstance(ours.dataType, T.NumericType)
            aligned.append((col if widens else col.try_cast(ours.dataType)).alias(ours.name))
        out = out.union(other.select(aligned))
    return out


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, non-null count, and the row count.

    All counts come from ONE aggregation pass (partial counts map-side),
    then a ``stack`` turns the single wide row into one row per column."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"__c{i}") for i, f in enumerate(fields)]
    wide = df.agg(*aggs)
    args = ", ".join(
        f"'{f.name.replace(chr(39), chr(39) * 2)}', '{f.dataType.simpleString()}', __c{i}"
        for i, f in enumerate(fields))
    return wide.selectExpr(
        f"stack({len(fields)}, {args}) AS (column_name, data_type, non_null)",
        "__rows AS row_count")
