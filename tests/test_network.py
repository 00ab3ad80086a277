import itertools

import pytest
from pyspark.sql import functions as F

from flowspark.functions.timegrid import TimeGrid
from flowspark.operators import network as nw
from flowspark.operators.footfall import footfall
from flowspark.plans import jobs

AMOUNT = "MOVEMENT_INFLUENCE_AMOUNT"
DAY = "2024-01-01"


def edge_table(spark, weights, members, date=DAY):
    rows = [(date, a, b, float(weights.get((a, b), 0.0))) for a, b in itertools.product(members, repeat=2)]
    return spark.createDataFrame(rows, f"date string, ORIGIN string, DESTINATION string, {AMOUNT} double")


@pytest.fixture(scope="module")
def edges(spark):
    first = {("A", "B"): 0.5, ("B", "A"): 0.25, ("B", "C"): 0.2, ("C", "B"): 0.1}
    return edge_table(spark, first, "ABCD").union(edge_table(spark, {("A", "B"): 1.0}, "AB", "2024-01-02"))


def test_paths(edges):
    weights = {(r["date"], r["ORIGIN"], r["DESTINATION"]): r[AMOUNT] for r in edges.collect() if r[AMOUNT]}
    three, four = {}, {}
    for (d, a, b), w in weights.items():
        for (d2, b2, c), w2 in weights.items():
            if (d, b) == (d2, b2):
                three[d, a, b, c] = w * w2
    for (d, a, b, c), w in three.items():
        for (d2, c2, e), w2 in weights.items():
            if (d, c) == (d2, c2):
                four[d, a, b, c, e] = w * w2
    got = {(r["date"], r["ORIGIN"], r["VIA_1"], r["DESTINATION"]): r[f"{AMOUNT}_VIA_1"] for r in nw.paths3(edges, ["date"]).collect()}
    assert got == pytest.approx(three) and (DAY, "A", "B", "A") in got
    got = {
        (r["date"], r["ORIGIN"], r["VIA_1"], r["VIA_2"], r["DESTINATION"]): r[f"{AMOUNT}_VIA_2"]
        for r in nw.paths4(edges, ["date"]).collect()
    }
    assert got == pytest.approx(four)
    # every three-stop path passes its middle: in-weight times out-weight
    total = sum(three.values())
    assert total == pytest.approx(
        sum(w * w2 for (d, _, b), w in weights.items() for (d2, b2, _), w2 in weights.items() if (d, b) == (d2, b2))
    )


def test_popularity(edges):
    got = {(r["date"], r["unique_id"]): r["popular_area"] for r in nw.popularity(edges, ["date"]).collect()}
    assert got == {
        (DAY, "A"): 0.6667,
        (DAY, "B"): 1.3333,
        (DAY, "C"): 0.6667,
        (DAY, "D"): 0.0,
        ("2024-01-02", "A"): 1.0,
        ("2024-01-02", "B"): 1.0,
    }


def test_single_member_is_fully_popular(spark):
    assert [r["popular_area"] for r in nw.popularity(edge_table(spark, {}, "A"), ["date"]).collect()] == [1.0]


def test_circulation_depth(edges):
    assert list(nw.circulation(edges, ["date"], 2)) == ["migration_2"]
    assert list(nw.circulation(edges, ["date"], 4)) == ["migration_2", "migration_3", "migration_4"]
    for depth in (1, 5):
        with pytest.raises(ValueError, match="depth"):
            nw.circulation(edges, ["date"], depth)


@pytest.fixture(scope="module")
def site(spark):
    rows = [("F1", f, "C0", "P0", n, u, "0") for f, n, u in (("1F", "N0", "A"), ("1F", "N1", "B"), ("10F", "N0", "C"), ("10F", "N1", "D"))]
    network = spark.createDataFrame(
        rows, "folder_name string, floor_name string, user_id string, place_id string, network_id string, unit_id string, rssi_fx string"
    )
    sightings = [
        (DAY, f"{DAY} {(m // 60) % 24:02d}:{m % 60:02d}:00", "F1", "C0", "P0", "-", "-", "ABC"[(m * m + m // 7) % 3], f"d{m % 5}")
        for m in range(0, 1440, 3)
    ]
    columns = "date string, datetime string, folder_name string, user_id string, place_id string, floor_name string, network_id string, unit_id string, aibeaconid string"
    by1min = footfall(spark.createDataFrame(sightings, columns), "1min").cache()
    return by1min, network, jobs.plan_runs(network, DAY, "2024-01-02")


@pytest.mark.parametrize(
    "areas,hourly,keys,groups",
    [
        (("all", "all"), False, ["date", "place_id"], (1, 1)),
        (("all", "floor"), False, ["date", "place_id", "floor_name"], (1, 2)),
        (("floor", "floor"), True, ["date", "place_id", "floor_name", "hour"], (48, 48)),
    ],
)
def test_analysis_is_complete(site, areas, hourly, keys, groups):
    by1min, network, runs = site
    grid = TimeGrid("1min", hourly=True) if hourly else TimeGrid("10min")
    result = jobs.analyze(by1min, network, runs, grid, *areas, depth=4)
    assert result.keys == keys
    popular_groups, edge_groups = groups
    members = 4 if areas[1] == "all" else 2
    # two dates, the second without any sighting: still complete, all zero
    assert result.edges.count() == 2 * edge_groups * members**2
    assert result.popularity.count() == (2 * popular_groups * (4 if areas[0] == "all" else 2))
    empty = result.edges.where("date = '2024-01-02'")
    assert empty.where(f"{AMOUNT} <> 0").count() == 0
    assert set(result.migrations) == {"migration_2", "migration_3", "migration_4"}
    assert result.migrations["migration_4"].columns[: len(keys)] == keys
    if hourly:
        assert jobs.labelled_edges(result.edges).where("date = '2024-01-01 07:00:00'").count() == 8


def test_analysis_tables_are_written(site, spark, tmp_path):
    by1min, network, runs = site
    result = jobs.analyze(by1min, network, runs, TimeGrid("1min", "08:00:00", "10:00:00", hourly=True), influence_area="floor", depth=3)
    jobs.write_analysis(result, str(tmp_path))
    by_floor, by_place = tmp_path / "hourly" / "SEPARATE", tmp_path / "hourly" / "ALL"
    assert {entry.name for entry in by_floor.iterdir()} == {"input_data", "model_status", "var_model_coefficient", "causality", "migration_2", "migration_3"}
    assert [entry.name for entry in by_place.iterdir()] == ["centrality"]
    status = spark.read.option("header", True).csv(str(by_floor / "model_status"))
    assert status.count() == 2 * 2 * 2 and {r["status"] for r in status.collect()} == {"fitted"}
    edges = spark.read.option("header", True).csv(str(by_floor / "causality"))
    assert {r["date"] for r in edges.where("day = '2024-01-01'").collect()} == {f"{DAY} 08:00:00", f"{DAY} 09:00:00"}
    assert edges.count() == 2 * 2 * 2 * 4
    centrality = spark.read.option("header", True).csv(str(by_place / "centrality"))
    assert set(centrality.columns) == {"date", "hour", "unique_id", "popular_area", "place_id", "day"}


def test_analysis_of_sensor_groups(site):
    by1min, network, runs = site
    result = jobs.analyze(by1min, network, runs, TimeGrid("10min"), member="network_id")
    assert {r["ORIGIN"] for r in result.edges.collect()} == {"N0", "N1"}
    table = jobs.popularity_table(result.popularity, network, "network_id")
    assert table.columns == ["date", "user_id", "place_id", "floor_name", "network_id", "popular_area"]
    assert {r["floor_name"] for r in table.collect()} == {"10F"}


def test_unsupported_settings(site):
    by1min, network, runs = site
    grid = TimeGrid("10min")
    for settings in ({"popularity_area": "floor"}, {"influence_area": "none"}, {"depth": 5}, {"member": "floor_name"}):
        with pytest.raises(ValueError):
            jobs.analyze(by1min, network, runs, grid, **settings)


def test_hubs_are_split(spark):
    """A hub that all paths pass: many tasks make them, and they are the paths of the plain join."""
    ends = [f"M{n:03d}" for n in range(80)]
    rows = [("d", e, "HUB", 0.5 + n) for n, e in enumerate(ends)] + [("d", "HUB", e, 1.5 + n) for n, e in enumerate(ends)] + [("d", "M001", "M002", 2.0), ("e", "x", "y", 1.0), ("e", "y", "x", 3.0)]
    edges = spark.createDataFrame(rows, f"date string, ORIGIN string, DESTINATION string, {AMOUNT} double")
    want = {(a[0], a[1], a[2], b[2]): a[3] * b[3] for a in rows for b in rows if a[0] == b[0] and a[2] == b[1]}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = nw.paths3(edges, ["date"], per_task=400)
        got = {(r["date"], r["ORIGIN"], r["VIA_1"], r["DESTINATION"]): r[f"{AMOUNT}_VIA_1"] for r in paths.collect()}
        assert got == want
        four = {(a[0], a[1], a[2], a[3], b[2]): w * b[3] for a, w in want.items() for b in rows if a[0] == b[0] and a[3] == b[1]}
        paths = nw.paths4(edges, ["date"], per_task=40_000)
        got = {(r["date"], r["ORIGIN"], r["VIA_1"], r["VIA_2"], r["DESTINATION"]): r[f"{AMOUNT}_VIA_2"] for r in paths.collect()}
        assert got == four
        # the joined rows before names: no task makes most of them
        real, _ = nw._numbered(edges, ["date"])
        for per_task, bound in ((10**9, None), (400, 0.5)):
            made = nw._numbered_paths3(real, ["date"], per_task).groupBy(F.spark_partition_id().alias("p")).count().collect()
            largest = max(r["count"] for r in made) / len(want)
            assert largest > 0.9 if bound is None else largest < bound
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
