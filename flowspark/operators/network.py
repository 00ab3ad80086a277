"""Influence edges, popularity and multi-stop circulation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.functions.scalars import influence_amount, round4
from flowspark.operators.var import impulse_response
from flowspark.session import materialize

AMOUNT = "MOVEMENT_INFLUENCE_AMOUNT"
#: Paths through one stop that one task makes.
PATHS_PER_TASK = 4_000_000


def influence_edges(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Directed influence ``<keys>, ORIGIN, DESTINATION, MOVEMENT_INFLUENCE_AMOUNT``.

    The response one step after an orthogonal unit shock, rounded, kept where
    positive. Every ordered pair of a group has a row, 0 meaning no edge.
    """
    steps = impulse_response(models, keys, horizon=1, orth=True, shock="unit", first_step=1)
    amount = influence_amount(F.col("value"), F.col("src"), F.col("dst"))
    return steps.select(*keys, F.col("src").alias("ORIGIN"), F.col("dst").alias("DESTINATION"), amount.alias(AMOUNT))


def popularity(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Degree centrality ``(in + out) / (n - 1)`` of every member, edges unweighted.

    ``edges`` is the complete table, in which each member occurs 2n times; one
    aggregation therefore gives both the degree and n, silent members included.
    """
    linked = (F.col(AMOUNT) > 0).cast("int")
    ends = edges.select(*keys, F.explode(F.array("ORIGIN", "DESTINATION")).alias("unique_id"), linked.alias("linked"))
    others = F.col("ends") / 2 - 1
    centrality = F.when(others > 0, F.col("degree") / others).otherwise(F.lit(1.0))
    return (
        ends.groupBy(*keys, "unique_id")
        .agg(F.sum("linked").alias("degree"), F.count(F.lit(1)).alias("ends"))
        .select(*keys, "unique_id", round4(centrality).alias("popular_area"))
    )


def _numbered(edges: DataFrame, keys: Sequence[str], stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """The real edges ``<keys>, o, d, w`` with members as numbers, and the ``names`` they stand for: an array per group.

    The real edges are stored: path joins read them several times, and their known size lets small ones be broadcast.
    ``stored`` edges are a written table already.
    """
    real = edges.where(F.col(AMOUNT) != 0).select(*keys, "ORIGIN", "DESTINATION", F.col(AMOUNT).alias("w"))
    real = real if stored else materialize(real)
    ends = real.select(*keys, F.explode(F.array("ORIGIN", "DESTINATION")).alias("name"))
    names = ends.groupBy(*keys).agg(F.sort_array(F.collect_set("name")).alias("names"))

    def number(name: str):
        return (F.array_position("names", F.col(name)) - 1).cast("int")

    numbered = real.join(names, list(keys)).select(*keys, number("ORIGIN").alias("o"), number("DESTINATION").alias("d"), "w")
    return materialize(numbered), names


def _named(paths: DataFrame, names: DataFrame, keys: Sequence[str], stops: dict[str, str], weight: str) -> DataFrame:
    columns = [F.get("names", F.col(stop)).alias(name) for stop, name in stops.items()]
    return paths.join(names, list(keys)).select(*keys, *columns, F.col("w").alias(weight))


def _through(heads: DataFrame, tails: DataFrame, arriving: DataFrame, keys: Sequence[str], per_task: int) -> DataFrame:
    """Join ``heads`` (ending at ``via``) with the edges ``tails`` that leave it; weights are multiplied.

    A stop at which a heads arrive and b edges leave makes a * b paths, known beforehand from ``arriving`` (``<keys>, via, n``) and the
    edges' counts. Where that is more than ``per_task``, the heads are dealt over so many tasks and the leaving edges, b of them,
    copied to each; all other stops stay whole.
    """
    keys = list(keys)
    leaving = tails.groupBy(*keys, "via").agg(F.count(F.lit(1)).alias("m"))
    parts = F.ceil(F.col("n") * F.col("m") / F.lit(per_task)).cast("int")
    hubs = arriving.join(leaving, [*keys, "via"]).select(*keys, "via", parts.alias("parts")).where("parts > 1")
    split = F.coalesce("parts", F.lit(1))
    own = [name for name in heads.columns if name not in (*keys, "via", "w")]
    dealt = heads.join(hubs, [*keys, "via"], "left").withColumn("part", F.pmod(F.xxhash64(*own), split).cast("int")).drop("parts")
    copied = tails.join(hubs, [*keys, "via"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), split - 1))).drop("parts")
    joined = dealt.join(copied.withColumnRenamed("w", "w_next"), [*keys, "via", "part"])
    return joined.withColumn("w", F.col("w") * F.col("w_next")).drop("w_next", "part")


def _numbered_paths3(real: DataFrame, keys: Sequence[str], per_task: int) -> DataFrame:
    """``<keys>, o, via, d, w``."""
    heads = real.select(*keys, "o", F.col("d").alias("via"), "w")
    arriving = heads.groupBy(*keys, "via").agg(F.count(F.lit(1)).alias("n"))
    return _through(heads, real.withColumnRenamed("o", "via"), arriving, keys, per_task)


def paths3(edges: DataFrame, keys: Sequence[str], per_task: int = PATHS_PER_TASK, numbered: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Three-stop paths A→B→C within a group, weight the product of both edges; A = C is allowed.

    ``per_task`` paths through one stop at most are made in one task.
    """
    real, names = numbered or _numbered(edges, keys)
    paths = _numbered_paths3(real, keys, per_task)
    return _named(paths, names, keys, {"o": "ORIGIN", "via": "VIA_1", "d": "DESTINATION"}, f"{AMOUNT}_VIA_1")


def paths4(edges: DataFrame, keys: Sequence[str], per_task: int = PATHS_PER_TASK, numbered: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Four-stop paths A→B→C→D: three-stop paths extended by one edge. Members are numbers until the end."""
    real, names = numbered or _numbered(edges, keys)
    three = _numbered_paths3(real, keys, per_task).where("w <> 0")
    heads = three.select(*keys, "o", F.col("via").alias("first"), F.col("d").alias("via"), "w")
    # how many three-stop paths end at a stop, from the edges alone
    entering = real.groupBy(*keys, F.col("d").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    arriving = real.join(entering, [*keys, "o"]).groupBy(*keys, F.col("d").alias("via")).agg(F.sum("n").alias("n"))
    paths = _through(heads, real.withColumnRenamed("o", "via"), arriving, keys, per_task)
    stops = {"o": "ORIGIN", "first": "VIA_1", "via": "VIA_2", "d": "DESTINATION"}
    return _named(paths, names, keys, stops, f"{AMOUNT}_VIA_2")


def circulation(edges: DataFrame, keys: Sequence[str], depth: int, stored: bool = False) -> dict[str, DataFrame]:
    """``migration_2`` … ``migration_<depth>``; depth is 2, 3 or 4. ``stored`` edges are a written table."""
    if depth not in (2, 3, 4):
        raise ValueError(f"circulation depth must be 2, 3 or 4, got {depth}")
    out = {"migration_2": edges}
    numbered = _numbered(edges, keys, stored) if depth >= 3 else None
    if depth >= 3:
        out["migration_3"] = paths3(edges, keys, numbered=numbered)
    if depth == 4:
        out["migration_4"] = paths4(edges, keys, numbered=numbered)
    return out
