"""Time panels: sparse long counts per group, member and time index.

A *group* is one series to be modelled: ``date, place_id`` with ``floor_name``
and/or ``hour`` when asked for. A *member* is a sensor or a sensor group. The
panel stores non-zero counts only; the ``spine`` lists every member of every
group, so silent members and silent groups are not lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions.scalars import as_timestamp, minute_of_day
from flowspark.functions.timegrid import TimeGrid


def place_keys(by_floor: bool) -> list[str]:
    return ["place_id", "floor_name"] if by_floor else ["place_id"]


def group_keys(by_floor: bool, hourly: bool) -> list[str]:
    return ["date", *place_keys(by_floor), *(["hour"] if hourly else [])]


def sensor_members(network: DataFrame, member: str, by_floor: bool) -> DataFrame:
    """``place_id[, floor_name], unit_id, member, i, k``: which member each sensor feeds.

    ``i`` numbers the ``k`` members of a place (or floor) by name, from 0.
    """
    keys = place_keys(by_floor)
    sensors = network.select(*keys, "unit_id", F.col(member).alias("member")).distinct()
    numbered = sensors.withColumn("i", (F.dense_rank().over(Window.partitionBy(*keys).orderBy("member")) - 1).cast("int"))
    return numbered.withColumn("k", F.max("i").over(Window.partitionBy(*keys)) + 1)


def group_spine(runs: DataFrame, sensors: DataFrame, grid: TimeGrid) -> DataFrame:
    """Every member of every group with the number of rows its series has (``nobs``)."""
    keys = [name for name in sensors.columns if name in ("place_id", "floor_name")]
    members = sensors.select(*keys, "member", "i").distinct()
    series = F.array(
        *(
            F.struct(F.lit(hour).cast("int").alias("hour"), F.lit(rows).cast("int").alias("nobs"))
            for hour, _, rows in grid.series()
        )
    )
    spine = runs.select("date", "place_id").distinct().join(members, "place_id")
    spine = spine.withColumn("s", F.explode(series)).select("*", "s.hour", "s.nobs")
    return spine.select(*group_keys("floor_name" in keys, grid.hourly), "member", "i", "nobs")


def minute_counts(by1min: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """``date, unit_id, minute, y`` from a ``by1min`` table, one row per sensor and minute.

    A sensor listed under several dimension rows repeats its count there; it is
    taken once. Joined with the days of ``runs``, a table partitioned by day is read for those only.
    """
    if runs is not None:
        by1min = by1min.join(runs.select("date").distinct(), "date", "left_semi")
    ts = as_timestamp("minute")
    rows = by1min.select("date", "unit_id", minute_of_day(ts).alias("minute"), F.col("1min_count").alias("y"))
    return rows.repartition("date", "unit_id").groupBy("date", "unit_id", "minute").agg(F.max("y").alias("y"))


def clip_time_of_day(minutes: DataFrame, grid: TimeGrid) -> DataFrame:
    """Minutes within ``[start, end)``."""
    return minutes.where(grid.contains(F.col("minute")))


def resample_sum(minutes: DataFrame, grid: TimeGrid) -> DataFrame:
    """Counts summed into the grid's buckets: ``date, unit_id, bucket, y``."""
    bucket = grid.bucket(F.col("minute")).alias("bucket")
    return minutes.groupBy("date", "unit_id", bucket).agg(F.sum("y").alias("y"))


def rollup_units(resampled: DataFrame, sensors: DataFrame) -> DataFrame:
    """Sensor buckets summed into members: ``date, place_id[, floor_name], member, i, k, bucket, y``."""
    keys = [name for name in sensors.columns if name in ("place_id", "floor_name")]
    joined = resampled.join(sensors, "unit_id")
    return joined.groupBy("date", *keys, "member", "i", "k", "bucket").agg(F.sum("y").alias("y"))


def sensor_buckets(by1min: DataFrame, runs: DataFrame, grid: TimeGrid) -> DataFrame:
    """``date, unit_id, bucket, y``: the clipped, resampled counts that every area is rolled up from."""
    return resample_sum(clip_time_of_day(minute_counts(by1min, runs), grid), grid)


def build_panel(by1min: DataFrame, runs: DataFrame, sensors: DataFrame, grid: TimeGrid) -> DataFrame:
    """Sparse panel ``<group keys>, member, i, t, y, nobs, k`` of the requested runs.

    ``nobs`` and ``k`` are the rows and members of the group's complete series.
    """
    return panel_of(sensor_buckets(by1min, runs, grid), runs, sensors, grid)


def panel_of(buckets: DataFrame, runs: DataFrame, sensors: DataFrame, grid: TimeGrid) -> DataFrame:
    """The panel from ``sensor_buckets``."""
    rolled = rollup_units(buckets, sensors)
    wanted = rolled.where("y <> 0").join(runs.select("date", "place_id").distinct(), ["date", "place_id"], "left_semi")
    bucket = F.col("bucket")
    placed = {"hour": grid.hour(bucket), "t": grid.index(bucket), "nobs": grid.series_rows(bucket)}
    return wanted.withColumns(placed).select(
        *group_keys("floor_name" in sensors.columns, grid.hourly), "member", "i", "t", "y", "nobs", "k"
    )


def densify(panel: DataFrame, spine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every time index of every member, 0 where nothing was seen."""
    grid = spine.select(*keys, "member", F.explode(F.sequence(F.lit(0), F.col("nobs") - 1)).alias("t"))
    seen = panel.select(*keys, "member", "t", "y")
    return grid.join(seen, [*keys, "member", "t"], "left").withColumn("y", F.coalesce("y", F.lit(0).cast("long")))


def to_wide(panel: DataFrame, index: Sequence[str], members: Sequence[str]) -> DataFrame:
    """One column per listed member, for export. ``members`` is a driver-side list of names."""
    wide = panel.groupBy(*index).pivot("member", list(members)).agg(F.sum("y"))
    return wide.fillna(0, subset=list(members))


def member_totals(panel: DataFrame, spine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total and mean per member, silent ones included."""
    sums = panel.groupBy(*keys, "member").agg(F.sum("y").alias("total"))
    joined = spine.join(sums, [*keys, "member"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    return joined.withColumn("mean", F.col("total") / F.col("nobs"))


def unit_rank(panel: DataFrame, spine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Members by mean, largest first, names breaking ties. This order shapes the impulse responses."""
    order = Window.partitionBy(*keys).orderBy(F.desc("total"), "member")
    ranked = member_totals(panel, spine, keys).withColumn("rank", F.row_number().over(order))
    return ranked.select(*keys, "member", "total", "mean", "rank")


def lag_features(dense: DataFrame, keys: Sequence[str], lags: int) -> DataFrame:
    """``lag_1 … lag_p`` of every member on a dense panel; rows without a full history are dropped."""
    order = Window.partitionBy(*keys, "member").orderBy("t")
    columns = {f"lag_{lag}": F.lag("y", lag).over(order) for lag in range(1, lags + 1)}
    return dense.withColumns(columns).where(F.col("t") >= lags)
