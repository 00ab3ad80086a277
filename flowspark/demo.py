"""The given ``events`` table read as a sighting log, for the registered queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.operators.footfall import footfall
from flowspark.operators.panel import place_keys
from flowspark.operators.sightings import match_sightings
from flowspark.plans.jobs import plan_runs

# Fixed value of the demo mapping: twelve sensors.
SENSORS = 12


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # never null, so that no null check parses the properties a second time
    sensor = F.coalesce(F.get_json_object("props", "$.k").cast("int") % SENSORS, F.lit(-1))
    return events.select(
        F.col("ts").cast("date").cast("string").alias("date"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("datetime"),
        F.concat(F.lit("U"), F.lpad(sensor.cast("string"), 2, "0")).alias("unit_id"),
        F.col("user_id").cast("string").alias("aibeaconid"),
        F.col("value").alias("rssi"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("randomized"),
    )


def network(spark: SparkSession) -> DataFrame:
    u = F.col("id").cast("int")
    place = F.floor(u / 8).cast("string")
    return spark.range(SENSORS).select(
        F.lit("F1").alias("folder_name"),
        F.concat((F.floor((u % 8) / 4) + 1).cast("string"), F.lit("F")).alias("floor_name"),
        F.concat(F.lit("C"), place).alias("user_id"),
        F.concat(F.lit("P"), place).alias("place_id"),
        F.concat(F.lit("N"), (u % 3).cast("string")).alias("network_id"),
        F.concat(F.lit("U"), F.lpad(u.cast("string"), 2, "0")).alias("unit_id"),
        (40 + 5 * (u % 6)).cast("string").alias("rssi_fx"),
    )


def day_range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of the table: two values of the raw column, which a scan of the column's footers can narrow."""
    first, last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.min("ts"), F.max("ts")).first()
    return str(first.date()), str(last.date())


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_runs(network(spark), *day_range(spark, sf_dir))


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_sightings(raw_log(spark, sf_dir), network(spark))


def by1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footfall(sightings(spark, sf_dir), "1min")


def gps_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sightings seen as GPS fixes: the sensor is the place, the device an advertising id."""
    return sightings(spark, sf_dir).select(
        "date", "datetime", "user_id", "network_id", F.col("unit_id").alias("place_id"), F.col("aibeaconid").alias("adid")
    )


def arrival_edges(spark: SparkSession, sf_dir: str, by_floor: bool = False, hourly: bool = False) -> DataFrame:
    """An edge table counted from the log, independent of any model.

    A→B weighs the devices first seen at A strictly before B that day (or hour), over 100,
    on the complete sensor grid of each date and place (or floor).
    """
    place, hour = place_keys(by_floor), ["hour"] if hourly else []
    seen = sightings(spark, sf_dir).withColumn("hour", F.hour("datetime"))
    first = seen.groupBy("date", *hour, *place, "aibeaconid", "unit_id").agg(F.min("datetime").alias("seen"))
    start = first.withColumnsRenamed({"unit_id": "ORIGIN", "seen": "left"})
    end = first.withColumnsRenamed({"unit_id": "DESTINATION", "seen": "reached"})
    moved = (
        start.join(end, ["date", *hour, *place, "aibeaconid"])
        .where(F.col("left") < F.col("reached"))
        .groupBy("date", *hour, *place, "ORIGIN", "DESTINATION")
        .agg(F.count(F.lit(1)).alias("devices"))
    )
    sensors = network(spark).select(*place, "unit_id")
    wanted = runs(spark, sf_dir)
    if hourly:
        wanted = wanted.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    grid = (
        wanted.join(sensors.withColumnRenamed("unit_id", "ORIGIN"), "place_id")
        .join(sensors.withColumnRenamed("unit_id", "DESTINATION"), place)
    )
    amount = F.coalesce(F.col("devices") / 100, F.lit(0.0)).alias("MOVEMENT_INFLUENCE_AMOUNT")
    keys = ["date", *place, *hour]
    return grid.join(moved, [*keys, "ORIGIN", "DESTINATION"], "left").select(*keys, "ORIGIN", "DESTINATION", amount)
