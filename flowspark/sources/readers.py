"""Readers. Nothing is inferred: CSV columns are strings unless a schema is given."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.sources import published
from flowspark.sources.schemas import NETWORK_COLUMNS


def read_dimension_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("inferSchema", False)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_network(spark: SparkSession, path: str) -> DataFrame:
    """Sensor hierarchy file, reduced to the columns the jobs use."""
    return read_dimension_csv(spark, path).select(*NETWORK_COLUMNS)


def read_config_pair(spark: SparkSession, network_path: str, config_path: str) -> tuple[DataFrame, DataFrame]:
    return read_dimension_csv(spark, network_path), read_dimension_csv(spark, config_path)


def read_log(spark: SparkSession, table: str) -> DataFrame:
    """Raw sighting log from the catalog."""
    return spark.table(table)


def read_counts(
    spark: SparkSession,
    path: str,
    dates: Iterable[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Counts written by ``write_counts``; ``dates`` prunes to those day folders.

    Pass the schema when partition values must keep their text (``001`` would
    otherwise be read back as a number).
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if dates is not None:
        df = df.where(F.col("date").isin([str(day) for day in dates]))
    return df.drop("year", "month").withColumn("date", F.col("date").cast("string"))


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Table of ``writers.replace_partitions`` as last published, with its declared types."""
    return published.read(spark, path, schema)
