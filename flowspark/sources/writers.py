"""Writers. Every write is parallel; ``rebalance`` sizes the files, splitting a heavy day."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.functions.scalars import day_partition_columns
from flowspark.sources import published
from flowspark.sources.schemas import enforce_schema


def _replacing(df: DataFrame, partitions: list[str]) -> DataFrameWriter:
    """Overwrite only the partitions that occur in ``df``; an empty frame touches none."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


def _arranged(df: DataFrame, partitions: list[str], order: list[str] | None) -> DataFrame:
    rest = [name for name in (order or df.columns) if name not in partitions]
    columns = [F.col(f"`{name}`") for name in partitions + rest]
    return df.hint("rebalance", *partitions).sortWithinPartitions(*columns)


def write_counts(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Parquet under ``year=/month=/date=``; days present in ``df`` are replaced."""
    day = ["year", "month", "date"]
    out = df.withColumns(day_partition_columns(F.col("date")))
    _replacing(_arranged(out, day, order), day).option("compression", "snappy").parquet(path)


def write_result(df: DataFrame, path: str, partitions: list[str], order: list[str] | None = None) -> None:
    """CSV with a header, one folder per partition value."""
    _replacing(_arranged(df, partitions, order), partitions).option("header", True).csv(path)


def write_result_by_day(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """CSV with a header under ``year=/month=/date=``."""
    out = df.withColumns(day_partition_columns(F.col("date")))
    write_result(out, path, ["year", "month", "date"], order)


def replace_partitions(df: DataFrame, path: str, schema: T.StructType, partitions: list[str], run: str | None = None) -> None:
    """Write under the schema contract, replacing exactly the partitions present in ``df``, all at once or not at all.

    See ``published``: a failed job changes nothing, and ``run`` lets its repetition go on where it stopped.
    """
    published.publish(enforce_schema(df, schema), path, partitions, run)
