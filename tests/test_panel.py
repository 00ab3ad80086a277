import pytest
from pyspark.sql import functions as F

from flowspark.functions.scalars import hour_label, round4
from flowspark.functions.timegrid import TimeGrid
from flowspark.operators import panel as pn
from flowspark.plans.jobs import plan_runs, plan_yesterday

DAY = "2024-01-01"


@pytest.fixture(scope="module")
def network(spark):
    rows = [("P0", "1F", "N0", "A"), ("P0", "1F", "N1", "B"), ("P0", "2F", "N0", "C"), ("P0", "2F", "N0", "S"), ("P1", "1F", "N9", "Z")]
    return spark.createDataFrame(rows, "place_id string, floor_name string, network_id string, unit_id string")


@pytest.fixture(scope="module")
def runs(spark, network):
    return plan_runs(network, DAY, DAY)


def by1min(spark, *rows):
    data = [(DAY, f"{DAY} {time}", unit, n) for time, unit, n in rows]
    return spark.createDataFrame(data, "date string, minute string, unit_id string, `1min_count` bigint")


def cells(panel, *names):
    return {tuple(row[n] for n in names): row["y"] for row in panel.collect()}


def test_buckets_are_left_closed_and_anchored_at_midnight(spark, network, runs):
    counts = by1min(spark, ("15:04:00", "A", 1), ("15:05:00", "A", 2), ("15:09:00", "A", 4))
    sensors = pn.sensor_members(network, "unit_id", False)
    assert cells(pn.build_panel(counts, runs, sensors, TimeGrid("5min")), "t") == {(180,): 1, (181,): 6}
    assert cells(pn.build_panel(counts, runs, sensors, TimeGrid("50min")), "t") == {(18,): 7}
    assert TimeGrid("50min").max_rows == 29


def test_clip_is_half_open(spark, network, runs):
    counts = by1min(spark, ("09:59:00", "A", 1), ("10:00:00", "A", 2), ("10:59:00", "A", 3), ("11:00:00", "A", 4))
    sensors = pn.sensor_members(network, "unit_id", False)
    grid = TimeGrid("1min", "10:00:00", "11:00:00")
    assert cells(pn.build_panel(counts, runs, sensors, grid), "t") == {(0,): 2, (59,): 3}
    assert grid.max_rows == 60
    # a start inside a bucket keeps the bucket and its midnight anchor
    late = TimeGrid("5min", "10:02:00", "11:00:00")
    assert late.series() == [(None, 120, 12)]


def test_hours_follow_the_bucket_label():
    assert TimeGrid("5min", hourly=True).series()[1] == (1, 12, 12)
    assert TimeGrid("50min", hourly=True).series()[:3] == [(0, 0, 2), (1, 2, 1), (2, 3, 1)]
    assert TimeGrid("1min", "10:30:00", "12:00:00", hourly=True).series() == [(10, 630, 30), (11, 660, 60)]
    assert sum(rows for _, _, rows in TimeGrid("7min", hourly=True).series()) == TimeGrid("7min").max_rows


def test_hourly_index_matches_series(spark):
    for interval in ("1min", "5min", "7min", "50min"):
        grid = TimeGrid(interval, "00:03:00", "23:30:00", hourly=True)
        minutes = spark.range(grid.first_minute, grid.last_minute + 1).select(grid.bucket(F.col("id")).alias("b"))
        got = minutes.select(grid.hour(F.col("b")).alias("h"), grid.index(F.col("b")).alias("t")).distinct()
        assert sorted(tuple(r) for r in got.collect()) == [(h, t) for h, _, rows in grid.series() for t in range(rows)]


def test_bad_settings():
    for settings in ({"interval": "5 parsecs"}, {"interval": 0}, {"start": "25:00:00"}, {"start": "11:00:00", "end": "10:00:00"}):
        with pytest.raises(ValueError):
            TimeGrid(**settings)


def test_silent_members_are_dense_zeros(spark, network, runs):
    sensors = pn.sensor_members(network, "unit_id", False)
    grid = TimeGrid("10min")
    panel = pn.build_panel(by1min(spark, ("00:05:00", "A", 3)), runs, sensors, grid)
    spine = pn.group_spine(runs, sensors, grid)
    keys = pn.group_keys(False, False)
    dense = pn.densify(panel, spine, keys)
    totals = {r["member"]: (r["n"], r["s"]) for r in dense.groupBy("member").agg(F.count("*").alias("n"), F.sum("y").alias("s")).collect()}
    assert totals == {"A": (144, 3), "B": (144, 0), "C": (144, 0), "S": (144, 0), "Z": (144, 0)}
    ranks = {r["member"]: r["rank"] for r in pn.unit_rank(panel, spine, keys).where("place_id = 'P0'").collect()}
    assert ranks == {"A": 1, "B": 2, "C": 3, "S": 4}
    wide = pn.to_wide(panel, ["date", "t"], ["A", "B"]).collect()
    assert [tuple(r) for r in wide] == [(DAY, 0, 3, 0)]


def test_rollup_all_and_by_floor(spark, network, runs):
    counts = by1min(spark, ("00:00:00", "A", 1), ("00:00:00", "B", 2), ("00:01:00", "C", 4), ("00:02:00", "S", 8))
    grid = TimeGrid("5min")
    whole = pn.build_panel(counts, runs, pn.sensor_members(network, "network_id", False), grid)
    assert cells(whole, "member") == {("N0",): 13, ("N1",): 2}
    floors = pn.build_panel(counts, runs, pn.sensor_members(network, "network_id", True), grid)
    assert cells(floors, "floor_name", "member") == {("1F", "N0"): 1, ("1F", "N1"): 2, ("2F", "N0"): 12}


def test_repeated_dimension_rows_are_taken_once(spark, network, runs):
    counts = by1min(spark, ("00:00:00", "A", 5), ("00:00:00", "A", 5), ("00:01:00", "A", 1))
    sensors = pn.sensor_members(network, "unit_id", False)
    assert cells(pn.build_panel(counts, runs, sensors, TimeGrid("5min")), "t") == {(0,): 6}


def test_lag_features(spark):
    rows = [("g", "A", t, t * t) for t in range(6)]
    dense = spark.createDataFrame(rows, "date string, member string, t int, y bigint")
    out = pn.lag_features(dense, ["date"], 2).orderBy("t").collect()
    assert [(r["t"], r["y"], r["lag_1"], r["lag_2"]) for r in out] == [(t, t * t, (t - 1) ** 2, (t - 2) ** 2) for t in range(2, 6)]


def test_runs(spark, network):
    runs = plan_runs(network, "2024-02-28", "2024-03-01")
    assert runs.count() == 6
    assert {r["date"] for r in runs.collect()} == {"2024-02-28", "2024-02-29", "2024-03-01"}
    assert plan_yesterday(network).count() == 2


def test_scalar_functions(spark):
    row = spark.range(1).select(
        round4(F.lit(0.00005)).alias("even"),
        hour_label(F.lit(DAY), F.lit(7)).alias("label"),
    ).first()
    assert tuple(row) == (0.0, f"{DAY} 07:00:00")
