"""From the raw log to sightings attached to the sensor hierarchy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the largest sensor hierarchy sent to every executor, some tens of megabytes
BROADCAST_ROWS = 200_000
# log rows of one sensor that one task joins, and sensors the sketch of heavy hitters tells apart
ROWS_PER_TASK = 1_000_000
SKETCH_ITEMS = 1000

SIGHTING_COLUMNS = [
    "date",
    "datetime",
    "folder_name",
    "user_id",
    "place_id",
    "floor_name",
    "network_id",
    "unit_id",
    "aibeaconid",
]


def filter_log(log: DataFrame, dates: Iterable[str] | None = None) -> DataFrame:
    """Requested dates, randomised devices, needed columns. Both filters reach the scan."""
    if dates is not None:
        log = log.where(F.col("date").isin([str(day) for day in dates]))
    return log.where(F.col("randomized") == "1").select("date", "datetime", "unit_id", "aibeaconid", "rssi")


def hot_sensors(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``unit_id, salts``: the sensors with more than ``rows_per_task`` rows, and over how many tasks to deal each.

    A mergeable sketch of heavy hitters counts ``SKETCH_ITEMS`` sensors at most, map-side and exactly while there are no more; the hot ones are
    read from it, so at most that many rows come back. A sensor the sketch underrates only gets fewer salts.
    """
    top = log.select(F.expr(f"approx_top_k(unit_id, {SKETCH_ITEMS}, {2 * SKETCH_ITEMS})").alias("top")).select(F.explode("top").alias("t"))
    found = top.select(F.col("t.item").alias("unit_id"), F.ceil(F.col("t.count") / rows_per_task).cast("int").alias("salts"))
    return found.where("unit_id is not null and salts > 1")


def join_network(log: DataFrame, network: DataFrame, broadcast_rows: int = BROADCAST_ROWS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Log rows of listed sensors at or below the sensor's signal threshold.

    The hierarchy's size is checked first: up to ``broadcast_rows`` sensors are
    broadcast. A larger hierarchy is joined by shuffle on sensor and salt. Only the
    hot sensors of ``hot_sensors`` have more than one salt, each as many as its rows need, and
    only their hierarchy rows are copied.
    """
    within = F.col("rssi").try_cast("double") <= F.col("rssi_fx").try_cast("double")
    if network.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return log.join(F.broadcast(network), "unit_id", "inner").where(within)
    hot = F.broadcast(hot_sensors(log, rows_per_task))  # SKETCH_ITEMS rows at most
    salts = F.coalesce("salts", F.lit(1))
    salt = F.pmod(F.xxhash64("aibeaconid", "datetime"), salts).cast("int")
    dealt = log.join(hot, "unit_id", "left").withColumn("salt", salt).drop("salts")
    copied = network.join(hot, "unit_id", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt.join(copied, ["unit_id", "salt"], "inner").where(within).drop("salt")


def match_sightings(
    log: DataFrame,
    network: DataFrame,
    dates: Iterable[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sightings with their dimensions; ``datetime`` keeps the log's type, so that it is not parsed again."""
    return join_network(filter_log(log, dates), network, broadcast_rows).select(*SIGHTING_COLUMNS)


def build_sightings(
    log: DataFrame,
    network: DataFrame,
    dates: Iterable[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sightings as a table to keep: every column a string."""
    matched = match_sightings(log, network, dates, broadcast_rows)
    return matched.select(*(F.col(name).cast("string").alias(name) for name in SIGHTING_COLUMNS))


def check_network(network: DataFrame) -> DataFrame:
    """Places that list more than one client; empty when the hierarchy is sound."""
    per_place = network.select("place_id", "user_id").distinct().groupBy("place_id")
    return per_place.agg(F.count("user_id").alias("n_users")).where("n_users > 1")


def require_one_client(network: DataFrame) -> None:
    wrong = check_network(network).head(1)
    if wrong:
        raise ValueError(f"place {wrong[0]['place_id']} is listed under {wrong[0]['n_users']} clients")


def attach_floor(df: DataFrame, network: DataFrame, member: str) -> DataFrame:
    """Add ``floor_name`` by a left join.

    A sensor listed on several floors takes the last floor name, a sensor group
    that spans floors takes the first one.
    """
    pick = F.max if member == "unit_id" else F.min
    floors = network.groupBy("place_id", member).agg(pick("floor_name").alias("floor_name"))
    return df.join(floors, ["place_id", member], "left")
