"""Exact distinct-device counts per sensor and time bucket.

All requested grains and the sensor dimensions come out of one pass over the
sightings and one shuffle of them, by day, sensor and device: there a device's minutes of the day at a
sensor are one small set, and each bucket of a coarser grain is counted where the device is
first seen in it. Duplicates disappear map-side before the shuffle, and the shuffle
key contains the device, so a sensor holding a third of the log still spreads
over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions.scalars import GRAIN_COUNT, as_timestamp, bucket_label, bucket_start, grain_bucket
from flowspark.sources.schemas import DIMENSION_COLUMNS

_DIMENSION_ROW = "dimension"
#: Stands for a sighting without a time inside sets, which hold no nulls.
_NO_TIME = -(2**62)


def footfall_counts(
    sightings: DataFrame,
    grains: Sequence[str],
    unit: str = "unit_id",
    device: str = "aibeaconid",
    dims: Sequence[str] = DIMENSION_COLUMNS,
) -> DataFrame:
    """``date, grain, bucket, <dims>, <unit>, visitors`` for every grain.

    A device is counted once per bucket, and all missing device ids together
    count as one device. Counts of a finer grain do not add up to a coarser one.
    A sensor listed under several dimension rows repeats its count for each of
    them that was seen that day.
    """
    ts = as_timestamp("datetime")
    # every grain follows from the minute; a single one needs no finer buckets than its own
    finest = grain_bucket(ts, grains[0]) if len(grains) == 1 else bucket_start(ts, 60)
    per_device = (
        sightings.select(
            "date",
            F.col(unit).alias("unit"),
            F.col(device).cast("string").alias("device"),
            F.coalesce(finest, F.lit(_NO_TIME)).alias("bucket"),
            F.struct(*dims).alias("dim"),
        )
        .groupBy("date", "unit", "device")
        .agg(F.collect_set("bucket").alias("buckets"), F.collect_set("dim").alias("dims"))
    )
    no_dim = F.lit(None).cast(per_device.schema["dims"].dataType.elementType)

    def row(grain, bucket, dim):
        return F.struct(F.lit(grain).alias("grain"), bucket.cast("long").alias("bucket"), dim.alias("dim"))

    def first_seen(grain):
        """The buckets of a grain in which the device was seen at the sensor, each once."""
        if grain == "day":
            return F.array(row(grain, F.lit(0), no_dim))

        def coarser(bucket):
            found = bucket if len(grains) == 1 else grain_bucket(F.timestamp_seconds(bucket), grain)
            return F.when(bucket != _NO_TIME, found)

        return F.transform(F.array_distinct(F.transform("buckets", coarser)), lambda bucket: row(grain, bucket, no_dim))

    places = F.transform("dims", lambda dim: row(_DIMENSION_ROW, F.lit(None), dim))
    presence = per_device.select("date", "unit", F.explode(F.concat(*map(first_seen, grains), places)).alias("r"))
    presence = presence.select("date", "unit", "r.grain", "r.bucket", "r.dim")
    counts = presence.groupBy("date", "unit", "grain", "bucket", "dim").agg(F.count(F.lit(1)).alias("visitors"))
    seen = Window.partitionBy("date", "unit")
    return (
        counts.withColumn("dim", F.collect_set("dim").over(seen))
        .where(F.col("grain") != _DIMENSION_ROW)
        .withColumn("dim", F.explode("dim"))
        .select("date", "grain", "bucket", "dim.*", F.col("unit").alias(unit), "visitors")
    )


def footfall_table(
    counts: DataFrame,
    grain: str,
    unit: str = "unit_id",
    dims: Sequence[str] = DIMENSION_COLUMNS,
) -> DataFrame:
    """One grain of ``footfall_counts`` in its published shape: strings, and a bigint count."""
    bucket = {"day": [], "hour": [F.col("bucket").cast("string").alias("hour")]}.get(
        grain, [bucket_label(F.col("bucket")).alias("minute")]
    )
    text = [F.col(name).cast("string").alias(name) for name in (*dims, unit)]
    total = F.col("visitors").cast("long").alias(GRAIN_COUNT[grain])
    return counts.where(F.col("grain") == grain).select(F.col("date").cast("string"), *bucket, *text, total)


def footfall(
    sightings: DataFrame,
    grain: str,
    unit: str = "unit_id",
    device: str = "aibeaconid",
    dims: Sequence[str] = DIMENSION_COLUMNS,
) -> DataFrame:
    """Footfall at one grain: ``day``, ``hour``, ``30min``, ``10min`` or ``1min``."""
    if grain not in GRAIN_COUNT:
        raise ValueError(f"grain must be one of {sorted(GRAIN_COUNT)}, got {grain!r}")
    return footfall_table(footfall_counts(sightings, [grain], unit, device, dims), grain, unit, dims)
