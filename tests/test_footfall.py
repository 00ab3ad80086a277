import pytest
from pyspark.sql import functions as F

from flowspark.operators.footfall import footfall, footfall_counts, footfall_table
from flowspark.operators.sightings import (
    attach_floor,
    build_sightings,
    check_network,
    hot_sensors,
    join_network,
    require_one_client,
)

NETWORK = "folder_name string, floor_name string, user_id string, place_id string, network_id string, unit_id string, rssi_fx string"
LOG = "date string, datetime string, unit_id string, aibeaconid string, rssi string, randomized string"
DAY = "2024-01-01"


@pytest.fixture(scope="module")
def network(spark):
    rows = [
        ("F1", "1F", "C0", "P0", "N0", "A", "-60"),
        ("F1", "2F", "C0", "P0", "N0", "B", "-60"),
        ("F1", "1F", "C0", "P0", "N0", "D", "-60"),
        ("F1", "2F", "C0", "P0", "N0", "D", "-80"),
    ]
    return spark.createDataFrame(rows, NETWORK)


def log(spark, *rows):
    return spark.createDataFrame([(DAY, f"{DAY} {time}", unit, device, rssi, flag) for time, unit, device, rssi, flag in rows], LOG)


def counts(df, grain, name):
    bucket = {"day": [], "hour": ["hour"]}.get(grain, ["minute"])
    return {tuple(row[c] for c in ["unit_id", *bucket]): row[name] for row in df.collect()}


def test_filters_compare_signal_as_numbers(spark, network):
    raw = log(
        spark,
        ("10:00:00", "A", "d1", "-70", "1"),  # text order would drop it
        ("10:00:00", "A", "d2", "-50", "1"),  # above the threshold
        ("10:00:00", "A", "d3", "-70", "0"),  # not randomised
        ("10:00:00", "Z", "d4", "-70", "1"),  # unknown sensor
        ("10:00:00", "A", "d5", "weak", "1"),  # not a number
    )
    out = build_sightings(raw, network, [DAY])
    assert [row["aibeaconid"] for row in out.collect()] == ["d1"]
    assert {field.dataType.simpleString() for field in out.schema} == {"string"}
    assert build_sightings(raw, network, ["2024-01-02"]).count() == 0


def test_grains_are_distinct_per_bucket_and_not_additive(spark, network):
    raw = log(
        spark,
        ("10:00:01", "A", "d1", "-70", "1"),
        ("10:00:40", "A", "d1", "-70", "1"),  # same minute
        ("10:05:00", "A", "d1", "-70", "1"),  # same hour
        ("11:00:00", "A", "d1", "-70", "1"),
    )
    seen = build_sightings(raw, network)
    assert counts(footfall(seen, "1min"), "1min", "1min_count") == {
        ("A", f"{DAY} 10:00:00"): 1,
        ("A", f"{DAY} 10:05:00"): 1,
        ("A", f"{DAY} 11:00:00"): 1,
    }
    assert counts(footfall(seen, "10min"), "10min", "10min_count") == {
        ("A", f"{DAY} 10:00:00"): 1,
        ("A", f"{DAY} 11:00:00"): 1,
    }
    assert counts(footfall(seen, "30min"), "30min", "30min_count") == {
        ("A", f"{DAY} 10:00:00"): 1,
        ("A", f"{DAY} 11:00:00"): 1,
    }
    assert counts(footfall(seen, "hour"), "hour", "hourly_count") == {("A", "10"): 1, ("A", "11"): 1}
    assert counts(footfall(seen, "day"), "day", "daily_count") == {("A",): 1}


def test_missing_devices_count_once(spark, network):
    raw = log(spark, ("10:00:01", "A", None, "-70", "1"), ("10:00:02", "A", None, "-70", "1"), ("10:00:03", "A", "d", "-70", "1"))
    assert counts(footfall(build_sightings(raw, network), "day"), "day", "daily_count") == {("A",): 2}


def test_sensor_on_two_floors_repeats_its_count(spark, network):
    raw = log(spark, ("10:00:00", "D", "d1", "-90", "1"), ("11:00:00", "D", "d2", "-70", "1"))
    rows = footfall(build_sightings(raw, network), "hour").collect()
    # d2 passes only the first floor's threshold, but both floors were seen that day
    assert {(r["floor_name"], r["hour"], r["hourly_count"]) for r in rows} == {
        (floor, hour, 1) for floor in ("1F", "2F") for hour in ("10", "11")
    }
    weak = log(spark, ("11:00:00", "D", "d2", "-70", "1"))
    assert {r["floor_name"] for r in footfall(build_sightings(weak, network), "day").collect()} == {"1F"}


def test_all_grains_in_one_pass_match_single_grains(spark, network):
    raw = log(spark, *((f"{h:02d}:{m:02d}:00", u, f"d{h}", "-70", "1") for h in range(8, 12) for m in (1, 31) for u in "ABD"))
    seen = build_sightings(raw, network)
    together = footfall_counts(seen, ["day", "hour", "1min"])
    for grain in ("day", "hour", "1min"):
        assert sorted(footfall_table(together, grain).collect()) == sorted(footfall(seen, grain).collect())


def test_gps_form(spark):
    rows = [(DAY, f"{DAY} 10:00:00", "C0", "N0", "P1", device) for device in ("x", "x", "y")]
    fixes = spark.createDataFrame(rows, "date string, datetime string, user_id string, network_id string, place_id string, adid string")
    out = footfall(fixes, "day", "place_id", "adid", ["user_id", "network_id"])
    assert out.columns == ["date", "user_id", "network_id", "place_id", "daily_count"]
    assert [tuple(row) for row in out.collect()] == [(DAY, "C0", "N0", "P1", 2)]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_hot_sensor_is_spread(spark, network, capsys, broadcast_rows):
    """Whichever join is used, no shuffle of sightings is by sensor alone."""
    raw = log(spark, *((f"10:{m:02d}:00", "A", f"d{m}", "-70", "1") for m in range(30)), ("10:00:00", "D", "x", "-90", "1"))
    seen = build_sightings(raw, network, broadcast_rows=broadcast_rows)
    out = footfall(seen, "hour")
    out.explain()
    shuffles = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line]
    assert any("device#" in line for line in shuffles)
    joins = [line for line in shuffles if "unit_id#" in line]
    assert len(joins) == (0 if broadcast_rows else 2) and all("salt#" in line for line in joins)
    assert {(r["unit_id"], r["floor_name"]): r["hourly_count"] for r in out.collect()} == {
        ("A", "1F"): 30,
        ("D", "1F"): 1,
        ("D", "2F"): 1,
    }


def test_network_check(spark, network):
    assert check_network(network).count() == 0
    require_one_client(network)
    broken = network.union(network.limit(1).withColumn("user_id", F.lit("C9")))
    assert [tuple(row) for row in check_network(broken).collect()] == [("P0", 2)]
    with pytest.raises(ValueError, match="P0"):
        require_one_client(broken)


def test_attach_floor(spark, network):
    units = network.select("place_id", "unit_id").distinct()
    assert {(r["unit_id"], r["floor_name"]) for r in attach_floor(units, network, "unit_id").collect()} == {
        ("A", "1F"),
        ("B", "2F"),
        ("D", "2F"),
    }
    groups = network.select("place_id", "network_id").distinct()
    assert [r["floor_name"] for r in attach_floor(groups, network, "network_id").collect()] == ["1F"]


def test_unknown_grain(spark, network):
    with pytest.raises(ValueError, match="grain"):
        footfall(spark.range(1), "5min")


def test_one_shuffle_of_sightings_for_all_grains(spark, network, capsys):
    raw = log(spark, *((f"{h:02d}:{m:02d}:00", u, f"d{h % 3}", "-70", "1") for h in range(8, 12) for m in range(0, 60, 7) for u in "AB"), ("08:00:00", "A", None, "-70", "1"))
    seen = build_sightings(raw, network)
    grains = ["day", "hour", "30min", "10min", "1min"]
    together = footfall_counts(seen, grains)
    together.explain()
    shuffles = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line]
    assert len([line for line in shuffles if "device#" in line]) == 1
    rows = seen.select("unit_id", "aibeaconid", "datetime").collect()
    cut = {"day": 0, "hour": 13, "30min": 14, "10min": 15, "1min": 16}
    for grain in grains:
        def bucket(r):
            return r["datetime"][: cut[grain]] + (str(int(r["datetime"][14]) // 3) if grain == "30min" else "")
        want = sorted(len({r["aibeaconid"] for r in group}) for group in by(rows, lambda r: (r["unit_id"], bucket(r))).values())
        assert sorted(r["visitors"] for r in together.where(F.col("grain") == grain).collect()) == want


def by(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out


def test_sightings_without_a_time_keep_their_day(spark, network):
    raw = log(spark, ("10:00:00", "A", "d1", "-70", "1")).unionByName(
        spark.createDataFrame([(DAY, None, "A", "d2", "-70", "1"), (DAY, "junk", "A", "d2", "-70", "1"), (DAY, None, "A", "d1", "-70", "1")], LOG)
    )
    seen = build_sightings(raw, network)
    for together in (footfall_counts(seen, ["day", "hour"]), footfall_counts(seen, ["day"]).unionByName(footfall_counts(seen, ["hour"]))):
        got = {(r["grain"], r["bucket"]): r["visitors"] for r in together.collect()}
        assert got == {("day", 0): 2, ("hour", 10): 1, ("hour", None): 2}


def test_only_hot_sensors_are_salted(spark, network, capsys):
    raw = log(spark, *((f"10:{m % 60:02d}:{m // 60:02d}", "A", f"d{m}", "-70", "1") for m in range(500)), *((f"10:{m:02d}:00", u, "x", "-90", "1") for m in range(20) for u in ("B", "D", None)))
    assert {r["unit_id"]: r["salts"] for r in hot_sensors(raw, rows_per_task=100).collect()} == {"A": 5}
    assert hot_sensors(raw, rows_per_task=500).count() == 0 and hot_sensors(raw.limit(0)).count() == 0
    want = sorted(join_network(raw, network).collect(), key=str)
    salted = join_network(raw, network, broadcast_rows=0, rows_per_task=100)
    assert sorted(salted.collect(), key=str) == want
    dealt = join_network(raw, network.where("unit_id <> 'A'"), broadcast_rows=0, rows_per_task=100)
    assert sorted(dealt.collect(), key=str) == [r for r in want if r["unit_id"] != "A"]
