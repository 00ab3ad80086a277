"""Registered queries: every operator applied to the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark import demo
from flowspark.functions.timegrid import TimeGrid
from flowspark.operators import footfall as ff
from flowspark.operators import moments, network, panel, var
from flowspark.operators.sightings import build_sightings, check_network
from flowspark.plans import jobs
from flowspark.session import materialize, shared_path
from flowspark.sources import readers, schemas, writers

Query = Callable[[SparkSession, str], DataFrame]

DAY = TimeGrid("10min")
HOUR = TimeGrid("1min", hourly=True)


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    """Rounded columns; adding 0.0 turns a negative zero into zero."""
    return df.withColumns({name: F.bround(name, places) + F.lit(0.0) for name in names})


# ------------------------------------------------------------- sightings, footfall


def _sightings(spark, sf_dir):
    return build_sightings(demo.raw_log(spark, sf_dir), demo.network(spark))


def _network_check(spark, sf_dir):
    # the sensor groups span both places, hence both clients: read as places, they are reported
    seen = demo.sightings(spark, sf_dir).select(F.col("network_id").alias("place_id"), "user_id")
    return check_network(seen)


def _footfall(grain: str) -> Query:
    return lambda spark, sf_dir: ff.footfall(demo.sightings(spark, sf_dir), grain)


def _footfall_gps(grain: str) -> Query:
    def query(spark, sf_dir):
        return ff.footfall(demo.gps_log(spark, sf_dir), grain, "place_id", "adid", ["user_id", "network_id"])

    return query


def _footfall_job(spark, sf_dir):
    path = shared_path(spark, "footfall")
    jobs.footfall_job(demo.raw_log(spark, sf_dir), demo.network(spark), path)
    return _all_counts(spark, path)


def _all_counts(spark, path, dates=None):
    """The three tables of a footfall job as one: ``grain, date, bucket, <dimensions>, unit_id, devices``."""
    found = None
    for grain, (folder, bucket, count) in {
        "day": ("daily", F.lit(None).cast("string"), "daily_count"),
        "hour": ("hourly", F.col("hour").cast("string"), "hourly_count"),
        "1min": ("by1min", F.col("minute").cast("string"), "1min_count"),
    }.items():
        table = readers.read_counts(spark, f"{path}/{folder}", dates=dates)
        columns = ["folder_name", "user_id", "place_id", "floor_name", "network_id", "unit_id"]
        part = table.select(F.lit(grain).alias("grain"), F.col("date").cast("string").alias("date"), bucket.alias("bucket"), *columns, F.col(count).alias("devices"))
        found = part if found is None else found.unionByName(part)
    return found


def _days(spark, sf_dir, step):
    """Every ``step``-th day of the table."""
    first, last = demo.day_range(spark, sf_dir)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {step} days"))))
    return [str(r[0]) for r in days.collect()]  # bounded by the calendar


def _footfall_days(spark, sf_dir):
    """A job for every second day, of which every fourth is read: days pass from the log's scan to the tables' folders."""
    path = shared_path(spark, "footfall")
    jobs.footfall_job(demo.raw_log(spark, sf_dir), demo.network(spark), path, dates=_days(spark, sf_dir, 2))
    return _all_counts(spark, path, _days(spark, sf_dir, 4))


def _sightings_salted(spark, sf_dir):
    return build_sightings(demo.raw_log(spark, sf_dir), demo.network(spark), broadcast_rows=0)


def _model_status(spark, sf_dir):
    """Ten rows per series: places with eight sensors have too few for any lag."""
    grid = TimeGrid("10min", "09:00:00", "10:40:00")
    built, spine, keys = _panel_parts(spark, sf_dir, grid)
    return var.model_status(var.var_fit(materialize(built), spine, keys), keys).fillna(0, ["lag"])


# -------------------------------------------------------------------------- panels


def _panel_parts(spark, sf_dir, grid, member="unit_id", by_floor=False):
    sensors, runs = panel.sensor_members(demo.network(spark), member, by_floor), demo.runs(spark, sf_dir)
    built = panel.build_panel(demo.by1min(spark, sf_dir), runs, sensors, grid)
    return built, panel.group_spine(runs, sensors, grid), panel.group_keys(by_floor, grid.hourly)


def _dense(grid, member="unit_id", by_floor=False) -> Query:
    def query(spark, sf_dir):
        built, spine, keys = _panel_parts(spark, sf_dir, grid, member, by_floor)
        return panel.densify(built, spine, keys)

    return query


def _sparse_rows(grid) -> Query:
    return lambda spark, sf_dir: _panel_parts(spark, sf_dir, grid)[0].drop("i", "nobs", "k")


def _panel_dense(spark, sf_dir):
    dense = _dense(TimeGrid("1min"))(spark, sf_dir)
    sums = (F.count(F.lit(1)).alias("n_rows"), F.sum("y").alias("total"), F.sum(F.col("y") * F.col("t")).alias("moment"))
    return dense.groupBy("date", "place_id", "member").agg(*sums)


def _panel_wide(spark, sf_dir):
    built = _panel_parts(spark, sf_dir, DAY)[0]
    return panel.to_wide(built, ["date", "t"], [f"U{u:02d}" for u in range(demo.SENSORS)])


def _unit_rank(spark, sf_dir):
    return panel.unit_rank(*_panel_parts(spark, sf_dir, DAY))


def _lag_features(spark, sf_dir):
    built, spine, keys = _panel_parts(spark, sf_dir, DAY)
    return panel.lag_features(panel.densify(built, spine, keys), keys, 3)


def _lag_moments(spark, sf_dir):
    built, _, keys = _panel_parts(spark, sf_dir, DAY)
    return moments.lag_moments(built, keys, var.MAX_LAG)


# -------------------------------------------------------------- edges, paths, sinks

_PLACE = ["date", "place_id"]


def _paths3(spark, sf_dir):
    return _rounded(network.paths3(demo.arrival_edges(spark, sf_dir), _PLACE), 6, "MOVEMENT_INFLUENCE_AMOUNT_VIA_1")


def _paths4(spark, sf_dir):
    return _rounded(network.paths4(demo.arrival_edges(spark, sf_dir), _PLACE), 8, "MOVEMENT_INFLUENCE_AMOUNT_VIA_2")


def _degree_popularity(spark, sf_dir):
    return network.popularity(demo.arrival_edges(spark, sf_dir), _PLACE)


def _publish_popularity(spark, sf_dir):
    """Publish all days, then publish the first day again: the other days stay as they are."""
    path = shared_path(spark, "popular_area")
    popular = materialize(_degree_popularity(spark, sf_dir))
    jobs.publish_popularity(popular, demo.network(spark), path)
    jobs.publish_popularity(popular.where(F.col("date") == demo.day_range(spark, sf_dir)[0]), demo.network(spark), path)
    back = readers.read_published(spark, jobs.published_path(popular, path), schemas.popularity_schema("day", "unit_id"))
    return back.withColumn("date", F.col("date").cast("string"))


def _publish_all(spark, sf_dir):
    """Daily and hourly, place and floor popularity under one root; all of it read back.

    Of each, all days are published, then the first day once more: the other days stay as they are.
    """
    path, found = shared_path(spark, "popular_area"), None
    first, listed = demo.day_range(spark, sf_dir)[0], demo.network(spark)
    for hourly in (False, True):
        for by_floor in (False, True):
            keys = panel.group_keys(by_floor, hourly)
            popular = materialize(network.popularity(demo.arrival_edges(spark, sf_dir, by_floor, hourly), keys))
            jobs.publish_popularity(popular, listed, path)
            jobs.publish_popularity(popular.where(F.col("date") == first), listed, path)
            grain = "hour" if hourly else "day"
            back = readers.read_published(spark, jobs.published_path(popular, path), schemas.popularity_schema(grain, "unit_id"))
            back = back.select(
                F.lit(grain).alias("grain"),
                F.lit("floor" if by_floor else "all").alias("area"),
                F.col("date").cast("string").alias("date"),
                (F.col("hour").cast("int") if hourly else F.lit(-1)).alias("hour"),
                *("user_id", "place_id", "floor_name", "unit_id", "popular_area"),
            )
            found = back if found is None else found.unionByName(back)
    return found


def _result_csv(spark, sf_dir):
    path = shared_path(spark, "centrality")
    writers.write_result_by_day(_degree_popularity(spark, sf_dir), path, ["date", "place_id", "unique_id"])
    schema = schemas.strings("year", "month", "date", "place_id", "unique_id", "popular_area")
    back = readers.read_dimension_csv(spark, path, schema)
    return back.select("date", "place_id", "unique_id", F.col("popular_area").cast("double"))


def _plan_runs(spark, sf_dir):
    return jobs.plan_runs(demo.sightings(spark, sf_dir), *demo.day_range(spark, sf_dir))


def _plan_runs_compact(spark, sf_dir):
    """Days given without hyphens."""
    first, last = (day.replace("-", "") for day in demo.day_range(spark, sf_dir))
    return jobs.plan_runs(demo.sightings(spark, sf_dir), first, last)


# ------------------------------------------- two-member systems with a closed form


def _site_parts(spark, sf_dir, member):
    """The whole site as one place; its members are the places (or the site itself)."""
    listed = demo.network(spark)
    site = listed.withColumns({"place_id": F.col("folder_name"), "network_id": F.col(member)})
    runs = jobs.plan_runs(site, *demo.day_range(spark, sf_dir))
    sensors = panel.sensor_members(site, "network_id", False)
    built = panel.build_panel(demo.by1min(spark, sf_dir), runs, sensors, DAY).drop("place_id")
    return materialize(built), panel.group_spine(runs, sensors, DAY).drop("place_id"), ["date"]


def _pair(derive: Callable, places: int, *names: str, **settings) -> Query:
    """``derive(panel, spine, models, keys)`` on the two places, lag 1."""

    def query(spark, sf_dir):
        built, spine, keys = _site_parts(spark, sf_dir, "place_id")
        models = materialize(var.var_fit(built, spine, keys, **(settings or {"lags": 1})))
        return _rounded(derive(built, spine, models, keys), places, *names)

    return query


def _var_ic_pair(spark, sf_dir):
    out = _pair(lambda p, s, m, k: var.var_ic(m, k), 8, "aic", "bic", "hqic", maxlag=1)(spark, sf_dir)
    return _rounded(out, 6, "loglik")


def _granger_pair(spark, sf_dir):
    built, spine, keys = _site_parts(spark, sf_dir, "place_id")
    return _rounded(_rounded(var.granger_pairs(built, spine, keys, lags=1), 6, "chi2"), 8, "p_value")


def _site_model(spark, sf_dir):
    built, spine, keys = _site_parts(spark, sf_dir, "folder_name")
    return built, spine, materialize(var.sparse_var_fit(built, spine, keys, lags=1)), keys


def _sparse_var_site(spark, sf_dir):
    _, _, models, keys = _site_model(spark, sf_dir)
    return _rounded(var.var_coefficients(models, keys).where("lag > 0"), 7, "coef")


def _sparse_predict_site(spark, sf_dir):
    return _rounded(var.var_rss(*_site_model(spark, sf_dir)).drop("member"), 4, "rss")


# ----------------------------------------------------------------- models at large


def _stored_parts(spark, sf_dir):
    built, spine, keys = _panel_parts(spark, sf_dir, DAY)
    return materialize(built), spine, keys


def _models(derive: Callable, **settings) -> Query:
    """``derive(models, keys)`` on every date and place, lag chosen per group."""

    def query(spark, sf_dir):
        built, spine, keys = _stored_parts(spark, sf_dir)
        return derive(var.var_fit(built, spine, keys, **settings), keys)

    return query


def _granger_pairs(spark, sf_dir):
    out = var.granger_pairs(*_stored_parts(spark, sf_dir), lags=1)
    return _rounded(_rounded(out, 5, "chi2"), 7, "p_value")


def _var_predict_selected(spark, sf_dir):
    built, spine, keys = _stored_parts(spark, sf_dir)
    models = materialize(var.var_fit(built, spine, keys))
    return _rounded(var.var_predict(built, spine, models, keys), 6, "predicted")


def _var_rss_selected(spark, sf_dir):
    """Fits and residual sums from the same stored sums; the series is read once, for these."""
    built, spine, keys = _stored_parts(spark, sf_dir)
    parts = materialize(var.solver_parts(built, spine, keys))
    models = materialize(var.var_fit(built, spine, keys, parts=parts))
    return _rounded(var.var_rss_moments(models, parts, keys), 4, "rss")


def _granger_selected(spark, sf_dir):
    built, spine, keys = _panel_parts(spark, sf_dir, HOUR)
    out = var.granger_pairs(materialize(built), spine, keys)
    # first to nine decimals: few counts make exact halves, beside which rounding errors decide
    return _rounded(_rounded(_rounded(out, 9, "chi2"), 4, "chi2"), 6, "p_value")


#: Largest excess per row at which a coefficient counts as optimal; the solver stops at moves of 1e-9.
_OPTIMAL = 1e-6


def _sparse_certificate(spark, sf_dir):
    """Whether every equation of the sparse models, at their chosen lags, meets the conditions of the optimum."""
    built, spine, keys = _stored_parts(spark, sf_dir)
    models = materialize(var.sparse_var_fit(built, spine, keys))
    gaps = var.sparse_certificate(built, spine, models, keys)
    return gaps.select(*keys, "target", (F.col("gap") <= _OPTIMAL).alias("optimal"))


def _analysis(pick: Callable, grid: TimeGrid, popularity_area: str, influence_area: str, **settings) -> Query:
    def query(spark, sf_dir):
        by1min, listed, runs = demo.by1min(spark, sf_dir), demo.network(spark), demo.runs(spark, sf_dir)
        return pick(jobs.analyze(by1min, listed, runs, grid, popularity_area, influence_area, **settings), listed)

    return query


def _analysis_tables(spark, sf_dir):
    """Every table ``write_analysis`` writes, read back from its CSV folders as one: ``name, date, place_id, first … fourth, value``."""
    by1min, runs = demo.by1min(spark, sf_dir), demo.runs(spark, sf_dir)
    path = shared_path(spark, "analysis")
    jobs.write_analysis(jobs.analyze(by1min, demo.network(spark), runs, DAY, depth=4), path)
    edge = ["ORIGIN", "DESTINATION"]
    amount = "MOVEMENT_INFLUENCE_AMOUNT"
    shapes = {
        "input_data": (["member", "t"], "y", 0),
        "model_status": (["status", "nobs", "n_members"], "lag", 0),
        "var_model_coefficient": (["target", "source", "lag"], "coef", 7),
        "causality": (edge, amount, 4),
        "centrality": (["unique_id"], "popular_area", 4),
        "migration_2": (edge, amount, 4),
        "migration_3": (["ORIGIN", "VIA_1", "DESTINATION"], f"{amount}_VIA_1", 12),
        "migration_4": (["ORIGIN", "VIA_1", "VIA_2", "DESTINATION"], f"{amount}_VIA_2", 12),
    }
    found = None
    for name, (stops, value, places) in shapes.items():
        back = readers.read_dimension_csv(spark, f"{path}/daily/ALL/{name}")
        named = [F.col(stop).cast("string") for stop in stops] + [F.lit(None).cast("string")] * (4 - len(stops))
        columns = [column.alias(label) for column, label in zip(named, ("first", "second", "third", "fourth"))]
        part = back.select(F.lit(name).alias("name"), "date", F.col("place_id").cast("string").alias("place_id"), *columns, F.col(value).cast("double").alias("value"))
        part = _rounded(part, places, "value")
        found = part if found is None else found.unionByName(part)
    return found


def _edges(result, _):
    return jobs.labelled_edges(result.edges)


def _popular(result, listed):
    return jobs.popularity_table(result.popularity, listed)


def _four_stops(result, _):
    return _rounded(jobs.labelled_edges(result.migrations["migration_4"]), 12, "MOVEMENT_INFLUENCE_AMOUNT_VIA_2")


def _three_stops(result, _):
    return _rounded(jobs.labelled_edges(result.migrations["migration_3"]), 12, "MOVEMENT_INFLUENCE_AMOUNT_VIA_1")


def registered() -> dict[str, Query]:
    out: dict[str, Query] = {
        "sightings": _sightings,
        "network_check": _network_check,
        **{f"footfall_{grain}": _footfall(grain) for grain in ("day", "hour", "30min", "10min", "1min")},
        "footfall_job": _footfall_job,
        "footfall_days": _footfall_days,
        "sightings_salted": _sightings_salted,
        "model_status": _model_status,
        "publish_all": _publish_all,
        **{f"footfall_gps_{grain}": _footfall_gps(grain) for grain in ("day", "hour", "1min")},
        "panel_dense": _panel_dense,
        "panel_clipped": _sparse_rows(TimeGrid("1min", "09:30:00", "18:00:00")),
        "panel_clipped_dense": _dense(TimeGrid("10min", "09:30:00", "18:00:00")),
        "panel_resampled": _dense(TimeGrid("50min")),
        "panel_grouped_all": _dense(DAY, "network_id"),
        "panel_grouped_floor": _dense(DAY, "network_id", by_floor=True),
        "panel_hourly": _sparse_rows(HOUR),
        "panel_wide": _panel_wide,
        "unit_rank": _unit_rank,
        "lag_features": _lag_features,
        "lag_moments": _lag_moments,
        "arrival_edges": demo.arrival_edges,
        "paths3": _paths3,
        "paths4": _paths4,
        "degree_popularity": _degree_popularity,
        "publish_popularity": _publish_popularity,
        "result_csv": _result_csv,
        "plan_runs": _plan_runs,
        "var_fit_pair": _pair(lambda p, s, m, k: var.var_coefficients(m, k), 8, "coef"),
        "var_sigma_pair": _pair(lambda p, s, m, k: var.var_sigma(m, k), 8, "sigma"),
        "var_predict_pair": _pair(var.var_predict, 8, "predicted"),
        "var_rss_pair": _pair(var.var_rss, 6, "rss"),
        "var_ic_pair": _var_ic_pair,
        "influence_edges_pair": _pair(lambda p, s, m, k: network.influence_edges(m, k), 4),
        "impulse_response_pair": _pair(
            lambda p, s, m, k: var.impulse_response(m, k, 6, orth=True, shock="unit"), 8, "value"
        ),
        "impulse_response_sd_pair": _pair(lambda p, s, m, k: var.impulse_response(m, k, 6, orth=True), 8, "value"),
        "ma_coefficients_pair": _pair(lambda p, s, m, k: var.ma_coefficients(m, k, 6), 8, "value"),
        "fevd_pair": _pair(lambda p, s, m, k: var.fevd(m, k, 6), 8, "share"),
        "granger_pair": _granger_pair,
        "sparse_var_site": _sparse_var_site,
        "sparse_predict_site": _sparse_predict_site,
        "var_coefficients": _models(lambda m, k: _rounded(var.var_coefficients(m, k), 7, "coef")),
        "var_sigma": _models(lambda m, k: _rounded(var.var_sigma(m, k), 7, "sigma")),
        "var_loglik": _models(lambda m, k: _rounded(var.var_loglik(m, k), 5, "loglik")),
        "var_ic": _models(lambda m, k: _rounded(_rounded(var.var_ic(m, k), 7, "aic", "bic", "hqic"), 5, "loglik")),
        "var_select_order": _models(lambda m, k: _rounded(var.var_select_order(m, k), 7, "hqic")),
        "var_select_aic": _models(lambda m, k: _rounded(var.var_select_order(m, k, "aic"), 7, "aic")),
        "var_select_bic": _models(lambda m, k: _rounded(var.var_select_order(m, k, "bic"), 7, "bic")),
        "impulse_response_selected": _models(lambda m, k: _rounded(var.impulse_response(m, k, 10, orth=True), 7, "value")),
        "fevd_selected": _models(lambda m, k: _rounded(var.fevd(m, k, 10), 7, "share")),
        "sparse_var_fit": _models(
            lambda m, k: _rounded(var.var_coefficients(m, k).where("lag > 0"), 6, "coef"), sparse=True, lags=1
        ),
        "impulse_response": _models(lambda m, k: _rounded(var.impulse_response(m, k, 10, orth=True), 7, "value"), lags=1),
        "ma_coefficients": _models(lambda m, k: _rounded(var.ma_coefficients(m, k), 7, "value"), lags=1),
        "fevd": _models(lambda m, k: _rounded(var.fevd(m, k, 10), 7, "share"), lags=1),
        "granger_pairs": _granger_pairs,
        "granger_pairs_selected": _granger_selected,
        "var_predict_selected": _var_predict_selected,
        "var_rss_selected": _var_rss_selected,
        "sparse_certificate": _sparse_certificate,
        "analysis_tables": _analysis_tables,
        "plan_runs_compact": _plan_runs_compact,
    }
    areas = {"all": ("all", "all"), "all_floor": ("all", "floor"), "floor": ("floor", "floor")}
    for grain, grid in (("day", DAY), ("hour", HOUR)):
        for name, (popularity_area, influence_area) in areas.items():
            out[f"influence_{grain}_{name}"] = _analysis(_edges, grid, popularity_area, influence_area)
            out[f"popularity_{grain}_{name}"] = _analysis(_popular, grid, popularity_area, influence_area)
            out[f"circulation_{grain}_{name}"] = _analysis(_four_stops, grid, popularity_area, influence_area, depth=4)
    out["circulation3_day_all"] = _analysis(_three_stops, DAY, "all", "all", depth=3)
    out["influence_day_network"] = _analysis(_edges, DAY, "all", "all", member="network_id")
    out["influence_day_sparse"] = _analysis(_edges, DAY, "all", "all", sparse=True)
    return out
