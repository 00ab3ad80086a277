"""Calendar grid of an analysis: which buckets exist, and which time index each one has."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVAL = re.compile(r"^(\d+)\s*(min|h)$")
_CLOCK = re.compile(r"^(\d{2}):([0-5]\d):([0-5]\d)$")


def interval_minutes(interval: str | int) -> int:
    """Whole minutes of ``5``, ``"5min"`` or ``"2h"``."""
    if isinstance(interval, int):
        minutes = interval
    else:
        match = _INTERVAL.match(interval)
        if not match:
            raise ValueError(f"interval must look like '5min' or '1h', got {interval!r}")
        minutes = int(match[1]) * (60 if match[2] == "h" else 1)
    if minutes < 1:
        raise ValueError("interval must be at least one minute")
    return minutes


def clock_seconds(text: str) -> int:
    match = _CLOCK.match(text)
    seconds = int(match[1]) * 3600 + int(match[2]) * 60 + int(match[3]) if match else -1
    if not 0 <= seconds <= 86400:
        raise ValueError(f"time of day must be HH:MM:SS up to 24:00:00, got {text!r}")
    return seconds


@dataclass(frozen=True)
class TimeGrid:
    """Minutes ``[start, end)`` of a day in left-closed buckets anchored at midnight.

    ``hourly`` splits the day into one series per clock hour of the bucket label.
    """

    interval: str | int = "5min"
    start: str = "00:00:00"
    end: str = "24:00:00"
    hourly: bool = False

    def __post_init__(self):
        interval_minutes(self.interval)
        if self.first_minute > self.last_minute:
            raise ValueError("start must lie before end by at least one minute")

    @property
    def width(self) -> int:
        return interval_minutes(self.interval)

    @property
    def first_minute(self) -> int:
        return math.ceil(clock_seconds(self.start) / 60)

    @property
    def last_minute(self) -> int:
        return math.ceil(clock_seconds(self.end) / 60) - 1

    @property
    def first_bucket(self) -> int:
        return self.first_minute // self.width

    @property
    def last_bucket(self) -> int:
        return self.last_minute // self.width

    def contains(self, minute: Column) -> Column:
        return minute.between(self.first_minute, self.last_minute)

    def bucket(self, minute: Column) -> Column:
        """Bucket number counted from midnight."""
        return F.floor(minute / self.width).cast("int")

    def hour(self, bucket: Column) -> Column:
        """Clock hour of the bucket's label."""
        return F.floor(bucket * self.width / 60).cast("int")

    def series_start(self, bucket: Column) -> Column:
        """First bucket of the series that holds ``bucket``."""
        first = F.lit(self.first_bucket)
        if not self.hourly:
            return first
        return F.greatest(first, F.ceil(self.hour(bucket) * 60 / self.width).cast("int"))

    def index(self, bucket: Column) -> Column:
        """Position of the bucket in its series, from 0."""
        return (bucket - self.series_start(bucket)).cast("int")

    def series_rows(self, bucket: Column) -> Column:
        """Number of rows of the series that holds ``bucket``."""
        if not self.hourly:
            return F.lit(self.max_rows)
        rows = [part for hour, _, n in self.series() for part in (F.lit(hour), F.lit(n))]
        return F.element_at(F.create_map(*rows), self.hour(bucket))

    def series(self) -> list[tuple[int | None, int, int]]:
        """``(hour, first bucket, rows)`` of every series of a day; hour is None for a daily grid."""
        if not self.hourly:
            return [(None, self.first_bucket, self.last_bucket - self.first_bucket + 1)]
        out = []
        for hour in range(24):
            first = max(self.first_bucket, math.ceil(hour * 60 / self.width))
            last = min(self.last_bucket, math.ceil((hour + 1) * 60 / self.width) - 1)
            if first <= last:
                out.append((hour, first, last - first + 1))
        return out

    @property
    def max_rows(self) -> int:
        return max(rows for _, _, rows in self.series())
