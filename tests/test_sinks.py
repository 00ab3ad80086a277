import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.functions.scalars import compact_day, iso_day
from flowspark.plans import jobs
from flowspark.session import ensure_checkpoint_dir
from flowspark.sources import published as sources_published
from flowspark.sources import readers, schemas, writers

NETWORK = "folder_name string, floor_name string, user_id string, place_id string, network_id string, unit_id string, rssi_fx string"
DAYS = ("2024-01-01", "2024-01-02")


@pytest.fixture(scope="module")
def network(spark):
    rows = [("F1", "1F", "007", "P0", "N0", "A", "-60"), ("F1", "10F", "007", "P0", "N0", "B", "-60")]
    return spark.createDataFrame(rows, NETWORK)


def popularity(spark, value, days=DAYS):
    rows = [(day, "P0", unit, value) for day in days for unit in "AB"]
    return spark.createDataFrame(rows, "date string, place_id string, unique_id string, popular_area double")


def published(spark, path):
    back = readers.read_published(spark, f"{path}/daily/ALL/popular_area", schemas.popularity_schema("day", "unit_id"))
    return {(str(r["date"]), r["user_id"], r["floor_name"], r["unit_id"]): r["popular_area"] for r in back.collect()}


def test_publishing_replaces_only_its_partitions(spark, network, tmp_path):
    path = str(tmp_path / "popular")
    jobs.publish_popularity(popularity(spark, 0.5), network, path)
    jobs.publish_popularity(popularity(spark, 0.9, DAYS[1:]), network, path)
    # floors 1F and 10F both survive, ids keep their text
    assert published(spark, path) == {
        (day, "007", floor, unit): value
        for day, value in zip(DAYS, (0.5, 0.9))
        for floor, unit in (("1F", "A"), ("10F", "B"))
    }
    jobs.publish_popularity(popularity(spark, 0.1).limit(0), network, path)
    assert len(published(spark, path)) == 4


def test_hourly_publication(spark, network, tmp_path):
    path = str(tmp_path / "popular")
    hourly = popularity(spark, 0.5).withColumn("hour", F.lit(7)).withColumn("floor_name", F.lit("10F"))
    jobs.publish_popularity(hourly, network, path)
    back = readers.read_published(spark, f"{path}/hourly/SEPARATE/popular_area", schemas.popularity_schema("hour", "unit_id"))
    assert {(r["hour"], r["floor_name"]) for r in back.collect()} == {(7, "10F")}


def test_contract(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("s", T.StringType())])
    good = spark.createDataFrame([("x", "3")], "s string, n string")
    out = schemas.enforce_schema(good, schema)
    assert out.columns == ["n", "s"] and [tuple(r) for r in out.collect()] == [(3, "x")]
    bad = spark.createDataFrame([("x", None)], "s string, n string")
    with pytest.raises(Exception, match="column n must not be null"):
        schemas.enforce_schema(bad, schema).collect()
    nested = T.StructType([T.StructField("a", T.ArrayType(T.IntegerType()))])
    with pytest.raises(TypeError, match="cannot be stored"):
        schemas.enforce_schema(spark.range(1), nested)


def test_counts_round_trip_and_replacement(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = [(day, "001", n) for n, day in enumerate(DAYS)]
    schema = "date string, unit_id string, daily_count bigint"
    writers.write_counts(spark.createDataFrame(rows, schema), path)
    assert os.path.isdir(f"{path}/year=2024/month=2024-01/date=2024-01-02")
    writers.write_counts(spark.createDataFrame([(DAYS[1], "001", 9)], schema), path)
    full = T.StructType.fromDDL(schema)
    assert sorted(tuple(r) for r in readers.read_counts(spark, path, schema=full).select("date", "unit_id", "daily_count").collect()) == [
        (DAYS[0], "001", 0),
        (DAYS[1], "001", 9),
    ]
    pruned = readers.read_counts(spark, path, dates=DAYS[:1])
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(date" in pruned._jdf.queryExecution().toString()


def test_csv(spark, network, tmp_path):
    path = str(tmp_path / "network")
    network.write.option("header", True).csv(path)
    back = readers.read_network(spark, path)
    assert back.columns == schemas.NETWORK_COLUMNS
    assert {r["user_id"] for r in back.collect()} == {"007"}
    both = readers.read_config_pair(spark, path, path)
    assert [df.count() for df in both] == [2, 2]
    result = str(tmp_path / "result")
    writers.write_result(popularity(spark, 0.25), result, ["place_id"], ["place_id", "date", "unique_id"])
    typed = readers.read_dimension_csv(spark, result, T.StructType.fromDDL("date string, unique_id string, popular_area double, place_id string"))
    assert {r["popular_area"] for r in typed.collect()} == {0.25}
    network.createOrReplaceTempView("network_view")
    assert readers.read_log(spark, "network_view").count() == 2


def test_checkpoint_folder_follows_the_session(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_publication_refuses_runs_with_groups_without_a_model(spark, network, tmp_path):
    status = spark.createDataFrame([(DAYS[0], "P0", "fitted"), (DAYS[1], "P0", "too few rows")], "date string, place_id string, status string")
    path = str(tmp_path / "popular")
    with pytest.raises(ValueError, match="2024-01-02, P0, too few rows"):
        jobs.publish_popularity(popularity(spark, 0.5), network, path, status=status)
    assert not (tmp_path / "popular").exists()
    jobs.publish_popularity(popularity(spark, 0.5), network, path, status=status.limit(1))
    assert len(published(spark, path)) == 4


def test_grains_and_areas_do_not_replace_each_other(spark, network, tmp_path):
    path = str(tmp_path / "popular")
    by_floor = popularity(spark, 0.7).withColumn("floor_name", F.when(F.col("unique_id") == "A", "1F").otherwise("10F"))
    jobs.publish_popularity(popularity(spark, 0.5), network, path)
    jobs.publish_popularity(by_floor, network, path)
    jobs.publish_popularity(popularity(spark, 0.9).withColumn("hour", F.lit(3)), network, path)
    assert set(published(spark, path).values()) == {0.5}
    back = readers.read_published(spark, f"{path}/daily/SEPARATE/popular_area", schemas.popularity_schema("day", "unit_id"))
    assert {r["popular_area"] for r in back.collect()} == {0.7}


def test_stages_are_released(spark):
    from flowspark.session import materialize, release_stages

    kept = materialize(spark.range(5).toDF("n"))
    assert kept.count() == 5 and release_stages(spark) >= 1
    assert release_stages(spark) == 0


def rows_aside(path):
    return {os.path.join(at, name) for at, _, names in os.walk(path / "daily/ALL/popular_area/data") for name in names if name.endswith(".parquet")}


def test_a_job_that_fails_half_way_changes_nothing(spark, network, tmp_path):
    path = str(tmp_path / "popular")
    jobs.publish_popularity(popularity(spark, 0.5), network, path)
    before = published(spark, path)
    broken = popularity(spark, 0.9).repartition(4, "date").withColumn("popular_area", F.when((F.col("date") == DAYS[0]) | (F.col("unique_id") == "A"), F.col("popular_area")))
    with pytest.raises(Exception, match="popular_area must not be null"):
        jobs.publish_popularity(broken, network, path, run="second")
    assert published(spark, path) == before
    jobs.publish_popularity(popularity(spark, 0.9), network, path, run="second")
    assert set(published(spark, path).values()) == {0.9} and len(published(spark, path)) == 4


def test_a_repeated_publication_goes_on_where_it_stopped(spark, network, tmp_path, monkeypatch):
    path, table = str(tmp_path / "popular"), str(tmp_path / "popular/daily/ALL/popular_area")
    jobs.publish_popularity(popularity(spark, 0.5), network, path, run="first")
    switch = sources_published._manifest_path

    def lost(*_):
        raise RuntimeError("the driver is lost before the switch")

    monkeypatch.setattr(sources_published, "_manifest", lost)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.publish_popularity(popularity(spark, 0.9, DAYS[1:]), network, path, run="second")
    monkeypatch.undo()
    assert set(published(spark, path).values()) == {0.5}
    aside = rows_aside(tmp_path / "popular")
    # a manifest that was begun and not completed does not count
    os.makedirs(switch(table, 2, "second"))
    assert set(published(spark, path).values()) == {0.5}
    jobs.publish_popularity(popularity(spark, 0.9, DAYS[1:]), network, path, run="second")
    assert sorted(published(spark, path).values()) == [0.5, 0.5, 0.9, 0.9]
    for _ in range(2):  # complete: nothing is repeated, not even with other rows
        jobs.publish_popularity(popularity(spark, 0.1), network, path, run="second")
    assert rows_aside(tmp_path / "popular") == aside and len(sources_published.publications(spark, table)) == 2
    assert sorted(published(spark, path).values()) == [0.5, 0.5, 0.9, 0.9]


def test_vacuum_keeps_what_is_read(spark, network, tmp_path):
    path, table = str(tmp_path / "popular"), str(tmp_path / "popular/daily/ALL/popular_area")
    assert sources_published.vacuum(spark, table) == 0
    assert readers.read_published(spark, table, schemas.popularity_schema("day", "unit_id")).count() == 0
    for value, days in ((0.1, DAYS), (0.2, DAYS), (0.3, DAYS[1:]), (0.4, DAYS[1:])):
        jobs.publish_popularity(popularity(spark, value, days), network, path)
    want = published(spark, path)
    assert sorted(want.values()) == [0.2, 0.2, 0.4, 0.4]
    assert sources_published.vacuum(spark, table, keep=1) == 3 + 2 and published(spark, path) == want
    assert sources_published.vacuum(spark, table, keep=1) == 0


def test_reading_a_day_prunes_the_others(spark, network, tmp_path):
    path = str(tmp_path / "popular")
    jobs.publish_popularity(popularity(spark, 0.5), network, path)
    back = readers.read_published(spark, f"{path}/daily/ALL/popular_area", schemas.popularity_schema("day", "unit_id"))
    assert "PartitionFilters: [isnotnull(date" in back.where("date = '2024-01-01'")._jdf.queryExecution().toString()


def test_days_in_either_form(spark):
    days = spark.createDataFrame([("20240229",), ("2024-02-29",), ("29.02.2024",), ("",), (None,)], "d string")
    found = days.select(iso_day(F.col("d")).alias("iso"), compact_day(iso_day(F.col("d"))).alias("compact")).collect()
    assert [(str(r["iso"]), r["compact"]) for r in found] == [("2024-02-29", "20240229")] * 2 + [("None", None)] * 3
    network = spark.createDataFrame([("P0",)], "place_id string")
    assert [r["date"] for r in jobs.plan_runs(network, "20240228", "2024-03-01").orderBy("date").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
