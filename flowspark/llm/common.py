"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
import math
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.session import materialize, release_stages, staged

#: White space between words; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's folder, where they see it; else it must be installed there."""
    root, known = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, ``by`` a column if need be, and go on from the written table.

    Spark deletes the finished job's shuffle files when the driver's collector finds them unreferenced; it is asked to look
    now, so that the rounds of an operator do not add up on the executors' disks.
    """
    written = materialize(df, by)
    written.stage_path = staged()[-1]
    df.sparkSession.sparkContext._jvm.System.gc()
    return written


def release(*tables: DataFrame, part: str | None = None) -> None:
    """Delete stored tables of ``stage``, or of each the rows of ``part`` (``column=value``), that nothing will read any more."""
    for df in tables:
        release_stages(df.sparkSession, [df.stage_path], part)


def give_back() -> None:
    """Return a Python worker's freed memory to the machine: workers live on between tasks and would keep their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: What operators keep in a Python worker between tasks.
_kept: list = []


def kept_in_worker(function: Callable) -> Callable:
    """Keep the last two results of ``function`` in each Python worker until ``forget``."""
    kept = functools.lru_cache(maxsize=2)(function)
    _kept.append(kept)
    return kept


def forget() -> None:
    """Drop what other operators kept in this Python worker: workers go from one operator to the next, and all would add up."""
    if any([kept.cache_info().currsize for kept in _kept]):
        for kept in _kept:
            kept.cache_clear()
        gc.collect()
    give_back()


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    words = F.array_remove(F.split(text, SPACE), "")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words)).cast("long")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Join condition on ``names`` for which two nulls are equal."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def shuffle_key(*columns: Column | str) -> Column:
    """32 hex digits that order rows as if at random, alike in every run."""
    return F.md5(F.concat_ws(":", *columns))


def running_total(
    df: DataFrame, keys: list[str], value: str, key: str, ties: list[str], name: str, rows: int, rows_per_bucket: int = 20_000
) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and with each row, per ``keys`` in the order of ``key``, ``ties``.

    ``key`` is a ``shuffle_key``. Its leading digits deal the rows of one group over
    buckets of about ``rows_per_bucket`` rows; sums of whole buckets come from a small
    table and only a bucket is ever sorted in one task, so a group may hold any share
    of the rows. ``rows`` is the row count of ``df``, which must be a stored table.
    """
    buckets = max(1, math.ceil(rows / rows_per_bucket))
    number = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    df = df.withColumn("_bucket", F.shiftrightunsigned(number * F.lit(buckets).cast("long"), 32))
    before = (
        df.groupBy(*keys, "_bucket")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_sum"))
        .drop("_sum")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_inside", F.sum(value).over(inside))
    names = [*keys, "_bucket"]
    right = before.select(*[F.col(c).alias(f"_r_{c}") for c in names], "_before")
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return (
        out.join(right, on)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_before", "_inside", *[f"_r_{c}" for c in names])
    )
