"""Scans of row text files, and a listing of the files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines, plain or compressed. Without a schema Spark passes over the data once more."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def json_schema(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """Fields found in JSON files, without the column Spark adds for broken lines."""
    broken = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    found = read_json(spark, path).schema
    return T.StructType([f for f in found.fields if f.name != broken])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. Give a schema in production; inferring costs a further pass."""
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of every file below a folder.

    The content column is pruned, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("modificationTime"))
