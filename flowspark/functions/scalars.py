"""Column functions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The footfall grains and their widths in seconds, and the names
# of the count column each grain publishes. Day and hour have no epoch width.
GRAIN_SECONDS = {"30min": 1800, "10min": 600, "1min": 60}
GRAIN_COUNT = {
    "day": "daily_count",
    "hour": "hourly_count",
    "30min": "30min_count",
    "10min": "10min_count",
    "1min": "1min_count",
}


def as_timestamp(col: Column | str) -> Column:
    """Timestamp from a string, timestamp or timestamp_ntz column; malformed text becomes null."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("timestamp")


def iso_day(day: Column) -> Column:
    """The date of ``yyyyMMdd`` or ``yyyy-MM-dd`` text; null if it is neither."""
    return F.coalesce(F.try_to_timestamp(day, F.lit("yyyyMMdd")), F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))).cast("date")


def compact_day(day: Column) -> Column:
    """``yyyyMMdd`` of a date or ``yyyy-MM-dd`` text."""
    return F.date_format(day.cast("date"), "yyyyMMdd")


def bucket_start(ts: Column, seconds: int) -> Column:
    """Epoch second at which the ``seconds``-wide bucket holding ``ts`` starts."""
    epoch = F.unix_timestamp(ts)
    return epoch - F.pmod(epoch, F.lit(seconds))


def bucket_label(epoch: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` label of an epoch second."""
    return F.from_unixtime(epoch)


def grain_bucket(ts: Column, grain: str) -> Column:
    """Integer bucket of ``ts``: 0 for a day, 0-23 for an hour, else an epoch second."""
    if grain == "day":
        return F.lit(0).cast("long")
    if grain == "hour":
        return F.hour(ts).cast("long")
    return bucket_start(ts, GRAIN_SECONDS[grain])


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def hour_label(date: Column, hour: Column) -> Column:
    """``yyyy-MM-dd HH:00:00``."""
    return F.concat(date, F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))


def round4(col: Column) -> Column:
    """Four decimals, halves to even; what rounding errors leave beside a half does not count."""
    return F.bround(F.bround(col, 10), 4)


def influence_amount(response: Column, origin: Column, destination: Column) -> Column:
    """Rounded response where it is positive and not a self loop, else 0."""
    value = round4(response)
    return F.when((value > 0) & (origin != destination), value).otherwise(F.lit(0.0))


def day_partition_columns(date: Column) -> dict[str, Column]:
    """``year`` and ``month`` path parts of a ``yyyy-MM-dd`` date."""
    text = date.cast("string")
    return {"year": F.substring(text, 1, 4), "month": F.substring(text, 1, 7)}
