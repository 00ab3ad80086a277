"""Shards of even row counts that keep linked documents together."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import running_total, shuffle_key, stage


def _slices(rank, rows: int, shards: int):
    """Even slices of the ranks 0 to rows - 1: their sizes differ by one at most."""
    return F.floor(rank * shards / F.lit(max(rows, 1))).cast("int")


def _capacity(rows: int, shards: int) -> list[int]:
    # rank r lies in slice floor(r * shards / rows)
    edges = [math.ceil(s * rows / shards) for s in range(shards + 1)]
    return [b - a for a, b in zip(edges, edges[1:])]


def _loads(labels: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}  # one row per shard
    return [found.get(s, 0) for s in range(shards)]


def _pick(values: list, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def propagate(linked: DataFrame, capacity: list[int], rounds: int, slack: float, rows_per_bucket: int) -> DataFrame:
    """Balanced label propagation over ``linked`` (rid, group, key, shard); returns it with new shards.

    A document's neighbours are the members of its group, so votes are counted per group and
    shard. A group prefers the shard with most of its members among those with room;
    a document there or in a shard with more members stays. Movers enter a shard in shuffled
    order up to its quota. ``slack`` widens quotas while labels move; at the end the shards
    over capacity pass their surplus on, members of the smallest part of a group first.
    """
    shards = len(capacity)
    rows = linked.count()
    wide = [math.ceil(c * (1 + slack)) for c in capacity]
    for _ in range(rounds):
        loads = _loads(linked, shards)
        room = [max(0, w - n) for w, n in zip(wide, loads)]
        votes = linked.groupBy("group", "shard").agg(F.count("*").alias("votes"))
        open_ = votes.filter(_pick(room, F.col("shard")) > 0)
        wanted = open_.groupBy("group").agg(F.max(F.struct("votes", F.xxhash64("group", "shard"), "shard")).alias("to"))
        moving = (
            votes.join(wanted, "group")
            .filter((F.col("to.shard") != F.col("shard")) & (F.col("to.votes") >= F.col("votes")))
            .select("group", "shard", F.col("to.shard").alias("to"))
        )
        movers = stage(linked.join(moving, ["group", "shard"]))
        n = movers.count()
        if n == 0:
            break
        ranked = running_total(movers.withColumn("one", F.lit(1)), ["to"], "one", "key", ["rid"], "place", n, rows_per_bucket)
        accepted = ranked.filter(F.col("place") <= _pick(room, F.col("to"))).select("rid", "to")
        linked = stage(linked.join(accepted, "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"))
    # what is over capacity goes where room is left
    loads = _loads(linked, shards)
    over = [max(0, n - c) for n, c in zip(loads, capacity)]
    if not any(over):
        return linked
    votes = linked.groupBy("group", "shard").agg(F.count("*").alias("votes"))
    surplus = linked.filter(_pick(over, F.col("shard")) > 0).join(votes, ["group", "shard"])
    counts = surplus.groupBy("shard", "votes").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("votes")) - F.col("n")).drop("n")
    surplus = stage(surplus.join(counts, ["shard", "votes"]).filter(F.col("before") < _pick(over, F.col("shard"))).withColumn("one", F.lit(1)))
    ranked = running_total(surplus, ["shard", "votes"], "one", "key", ["rid"], "place", rows, rows_per_bucket)
    out = stage(ranked.filter(F.col("before") + F.col("place") <= _pick(over, F.col("shard"))).select("rid", "group", "key", "one"))
    # whole groups side by side, so that their members meet again
    out = running_total(
        out.withColumn("order", shuffle_key(F.col("group"))), ["one"], "one", "order", ["rid"], "place", rows, rows_per_bucket
    )
    free = [max(0, c - n) for n, c in zip(loads, capacity)]
    moved = out.select("rid", _fill(F.col("place"), free).alias("to"))
    return linked.join(moved, "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")


def _fill(place, room: list[int]):
    """The shard in which the place-th (from 1) newcomer ends when shards fill in turn."""
    upto, case = 0, None
    for shard, n in enumerate(room):
        upto += n
        if n:
            test = place <= upto
            case = F.when(test, F.lit(shard)) if case is None else case.when(test, F.lit(shard))
    return case if case is not None else F.lit(0)


def shard_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = 16,
    rounds: int = 8,
    slack: float = 0.1,
    rows_per_bucket: int = 20_000,
) -> DataFrame:
    """Shard and slot of every document; documents of equal text are linked and kept together as far as shards stay even.

    Law ``rows``: row counts of the shards differ by one at most. Documents start in even
    slices of a shuffled order. Linked documents then follow their neighbours
    (``propagate``), the others fill up every shard to its exact count. A group larger
    than a shard spans as few as the quotas allow. Returns ``doc_id``, ``size`` (UTF-8
    bytes and one), ``text_crc32``, ``law``, ``shard``, ``slot`` (from 0 in a shard) and
    ``grown_shard`` (null under this law), one row per row of ``docs``. A null text has no
    bytes and no links; an empty text is linked to others; null and repeated ids are ordinary
    rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).cast("long").alias("text_crc32"),
        F.md5(F.encode(F.col(text), "UTF-8")).alias("group"),
        shuffle_key(F.lit("shard"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).alias("key"),
        F.monotonically_increasing_id().alias("rid"),
        F.lit(1).alias("one"),
    )
    base = stage(base)  # rid is fixed from here on
    rows = base.count()
    capacity = _capacity(rows, shards)
    ranked = running_total(base, ["one"], "one", "key", ["rid"], "rank", rows, rows_per_bucket)
    ranked = ranked.withColumn("shard", _slices(F.col("rank") - 1, rows, shards)).drop("rank")
    repeated = base.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1 and group is not null").select("group")
    linked = stage(ranked.select("rid", "group", "key", "shard").join(repeated, "group", "left_semi"))
    linked = stage(propagate(linked, capacity, rounds, slack, rows_per_bucket).select("rid", "shard"))
    room = [c - n for c, n in zip(capacity, _loads(linked, shards))]
    alone = stage(base.select("rid", "key", "one").join(linked, "rid", "left_anti"))
    alone = running_total(alone, ["one"], "one", "key", ["rid"], "place", rows, rows_per_bucket)
    chosen = linked.unionByName(alone.select("rid", _fill(F.col("place"), room).alias("shard")))
    placed = stage(base.join(chosen, "rid"))
    slots = running_total(placed, ["shard"], "one", "key", ["rid"], "slot", rows, rows_per_bucket)
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("slot") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
