"""Incident files as a stream.

The reference has no streaming job. Its per-row steps (date parsing, part of
day, code decoding, money parsing, great-circle distance) are stateless
column expressions, so the same report functions run on a streaming
DataFrame; aggregations then keep their state in Structured Streaming's
state store. This module only provides the source side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from geoincident.functions.timeops import text_to_date
from geoincident.sources.files import INCIDENT_DATE_COLUMNS, INCIDENT_SCHEMA


def incident_stream(spark: SparkSession, directory: str, schema: T.StructType = INCIDENT_SCHEMA,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """New CSV incident files in ``directory`` as a streaming DataFrame with
    the same explicit schema and date parsing as the batch reader. A file whose
    header does not name the schema's columns in their order fails the query."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = reader.csv(directory)
    for name in INCIDENT_DATE_COLUMNS:
        if name in df.columns:
            df = df.withColumn(name, text_to_date(name))
    return df


def parquet_stream(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(directory)
