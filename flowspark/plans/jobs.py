"""End-to-end jobs: footfall tables, network analysis of all runs at once, publication."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.functions.scalars import hour_label, iso_day
from flowspark.functions.timegrid import TimeGrid
from flowspark.operators.footfall import footfall_counts, footfall_table
from flowspark.operators.network import circulation, influence_edges, popularity
from flowspark.operators.panel import group_keys, group_spine, panel_of, sensor_buckets, sensor_members
from flowspark.operators.sightings import attach_floor, match_sightings, require_one_client
from flowspark.operators.var import model_status, var_coefficients, var_fit
from flowspark.session import materialize
from flowspark.sources.schemas import DIMENSION_COLUMNS, popularity_schema
from flowspark.sources.writers import replace_partitions, write_counts, write_result

# The grains a footfall job publishes and the folder of each.
FOOTFALL_FOLDERS = {"day": "daily", "hour": "hourly", "1min": "by1min"}


def plan_runs(network: DataFrame, start: str, end: str) -> DataFrame:
    """One row per date and place to analyse, both ends included: ``date, place_id``. Days are ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    days = F.sequence(iso_day(F.lit(start)), iso_day(F.lit(end)))
    runs = network.select("place_id").distinct().withColumn("date", F.explode(days))
    return runs.select(F.col("date").cast("string").alias("date"), "place_id")


def plan_yesterday(network: DataFrame) -> DataFrame:
    """The run of the day before today in the session's time zone."""
    yesterday = F.date_sub(F.current_date(), 1).cast("string")
    return network.select(yesterday.alias("date"), "place_id").distinct()


def footfall_job(
    log: DataFrame,
    network: DataFrame,
    path: str,
    dates: Iterable[str] | None = None,
    grains: Sequence[str] = tuple(FOOTFALL_FOLDERS),
) -> None:
    """Count every grain in one pass over the log, then write one table per grain."""
    counts = materialize(footfall_counts(match_sightings(log, network, dates), grains))
    for grain in grains:
        bucket = {"day": [], "hour": ["hour"]}.get(grain, ["minute"])
        order = ["date", *bucket, *DIMENSION_COLUMNS, "unit_id"]
        write_counts(footfall_table(counts, grain), f"{path}/{FOOTFALL_FOLDERS.get(grain, 'by' + grain)}", order)


class Analysis:
    """Results of one analysis, each computed when first asked for and then kept.

    ``keys`` name the groups of the influence tables. The panel, the models, and edges that
    feed path joins, are written to the checkpoint folder once. ``status`` has a row
    for every group of the run, fitted or not.
    """

    def __init__(self, panel: Callable[[bool], DataFrame], fit: Callable[[DataFrame, bool], DataFrame], hourly: bool, areas: tuple[str, str], depth: int):
        self._panel, self._fit_panel, self._hourly, self._depth = panel, fit, hourly, depth
        self._popularity_by_floor, self._influence_by_floor = (area == "floor" for area in areas)
        self.keys = group_keys(self._influence_by_floor, hourly)

    def _fit(self, by_floor: bool) -> DataFrame:
        return self._fit_panel(self.panel if by_floor == self._influence_by_floor else materialize(self._panel(by_floor)), by_floor)

    @property
    def grain(self) -> str:
        return "hourly" if self._hourly else "daily"

    @cached_property
    def panel(self) -> DataFrame:
        """The analysed counts of the influence groups: ``<keys>, member, i, t, y, nobs, k``, silent minutes left out."""
        return materialize(self._panel(self._influence_by_floor))

    @cached_property
    def models(self) -> DataFrame:
        return materialize(self._fit(self._influence_by_floor))

    @cached_property
    def popularity_models(self) -> DataFrame:
        """The models behind the popularity: those of the influence where both are by the same area."""
        same = self._popularity_by_floor == self._influence_by_floor
        return self.models if same else materialize(self._fit(self._popularity_by_floor))

    @cached_property
    def status(self) -> DataFrame:
        return model_status(self.models, self.keys)

    @cached_property
    def popularity_status(self) -> DataFrame:
        return model_status(self.popularity_models, group_keys(self._popularity_by_floor, self._hourly))

    @cached_property
    def edges(self) -> DataFrame:
        edges = influence_edges(self.models, self.keys)
        return materialize(edges) if self._depth > 2 else edges

    @cached_property
    def popularity(self) -> DataFrame:
        if self._popularity_by_floor == self._influence_by_floor:
            return popularity(self.edges, self.keys)
        keys = group_keys(self._popularity_by_floor, self._hourly)
        return popularity(influence_edges(self.popularity_models, keys), keys)

    @cached_property
    def migrations(self) -> dict[str, DataFrame]:
        return circulation(self.edges, self.keys, self._depth, stored=self._depth > 2)


def analyze(
    by1min: DataFrame,
    network: DataFrame,
    runs: DataFrame,
    grid: TimeGrid,
    popularity_area: str = "all",
    influence_area: str = "all",
    member: str = "unit_id",
    depth: int = 2,
    **model,
) -> Analysis:
    """Fit every group of every run and derive edges, popularity and circulation.

    ``popularity_area`` and ``influence_area`` are ``all`` (one model per place)
    or ``floor`` (one per floor); popularity by floor needs influence by floor.
    ``member="network_id"`` analyses sensor groups. An hourly grid gives one
    model per clock hour. Further settings go to ``var_fit``.
    """
    areas = (popularity_area, influence_area)
    if areas not in (("all", "all"), ("all", "floor"), ("floor", "floor")):
        raise ValueError(f"unsupported areas: popularity {popularity_area!r} with influence {influence_area!r}")
    if depth not in (2, 3, 4):
        raise ValueError(f"circulation depth must be 2, 3 or 4, got {depth}")
    if member not in ("unit_id", "network_id"):
        raise ValueError(f"member must be unit_id or network_id, got {member!r}")

    stored: list[DataFrame] = []

    def buckets() -> DataFrame:
        """Counts by sensor and bucket; stored when two areas are rolled up from them."""
        if areas[0] == areas[1]:
            return sensor_buckets(by1min, runs, grid)
        if not stored:
            stored.append(materialize(sensor_buckets(by1min, runs, grid)))
        return stored[0]

    def panel(by_floor: bool) -> DataFrame:
        return panel_of(buckets(), runs, sensor_members(network, member, by_floor), grid)

    def fit(counts: DataFrame, by_floor: bool) -> DataFrame:
        spine = group_spine(runs, sensor_members(network, member, by_floor), grid)
        return var_fit(counts, spine, group_keys(by_floor, grid.hourly), **model)

    return Analysis(panel, fit, grid.hourly, areas, depth)


def labelled_edges(edges: DataFrame) -> DataFrame:
    """Edges or paths with the hour folded into ``date`` as ``yyyy-MM-dd HH:00:00``."""
    if "hour" not in edges.columns:
        return edges
    return edges.withColumn("date", hour_label(F.col("date"), F.col("hour"))).drop("hour")


def result_path(path: str, grain: str, table: DataFrame, name: str) -> str:
    """``path/<daily|hourly>/<ALL|SEPARATE>/<name>``: results of another grain or area never share a folder."""
    area = "SEPARATE" if "floor_name" in table.columns else "ALL"
    return f"{path}/{grain}/{area}/{name}"


def write_analysis(result: Analysis, path: str) -> None:
    """CSV of every table of an analysis: input panel, model status, coefficients, causality, centrality and the migrations.

    Each goes to ``path/<daily|hourly>/<ALL|SEPARATE>/<table>`` under ``place_id=[/floor_name=]/day=``; the
    folders of the places and days in the result are replaced. ``model_status`` lists
    every group of the run, so that one without a model is not taken for one without influence.
    """
    tables = {
        "input_data": result.panel.select(*result.keys, "member", "t", "y"),
        "model_status": result.status,
        "var_model_coefficient": var_coefficients(result.models, result.keys),
        "causality": result.edges,
        "centrality": result.popularity,
        **result.migrations,
    }
    as_it_is = {"input_data", "model_status", "centrality"}
    for name, table in tables.items():
        floor = ["floor_name"] if "floor_name" in table.columns else []
        out = table.withColumn("day", F.col("date"))
        out = out if name in as_it_is else labelled_edges(out)
        write_result(out, result_path(path, result.grain, table, name), ["place_id", *floor, "day"])


def popularity_table(popular: DataFrame, network: DataFrame, member: str = "unit_id") -> DataFrame:
    """Popularity with client, place and floor: the published columns, still unwritten."""
    named = popular.withColumnRenamed("unique_id", member)
    if "floor_name" not in named.columns:
        named = attach_floor(named, network, member)
    clients = network.select("place_id", "user_id").distinct()
    hour = ["hour"] if "hour" in popular.columns else []
    columns = ["date", *hour, "user_id", "place_id", "floor_name", member, "popular_area"]
    return named.join(clients, "place_id", "left").select(*columns)


def require_models(status: DataFrame) -> None:
    """Refuse a run in which a group has no model; the message names the first ones."""
    missing = status.where("status <> 'fitted'")
    first = missing.limit(5).collect()
    if first:
        named = "; ".join(", ".join(str(v) for v in row) for row in first)
        raise ValueError(f"groups without a model: {named}")


def published_path(popular: DataFrame, path: str) -> str:
    """Where ``publish_popularity`` writes a table of this grain and area."""
    return result_path(path, "hourly" if "hour" in popular.columns else "daily", popular, "popular_area")


def publish_popularity(
    popular: DataFrame, network: DataFrame, path: str, member: str = "unit_id", status: DataFrame | None = None, run: str | None = None
) -> None:
    """Write popularity, replacing exactly the date/hour/client/place/floor partitions it contains.

    Daily and hourly results, and those of whole places and of floors, have folders of
    their own below ``path`` (``published_path``). With the models' ``status`` nothing is published when a
    group of the run has no model. A failed publication changes nothing; repeated under the same ``run`` it goes on where it stopped.
    """
    require_one_client(network)
    if status is not None:
        require_models(status)
    path = published_path(popular, path)
    grain = "hour" if "hour" in popular.columns else "day"
    schema = popularity_schema(grain, member)
    partitions = [name for name in schema.names if name not in (member, "popular_area")]
    replace_partitions(popularity_table(popular, network, member), path, schema, partitions, run)
