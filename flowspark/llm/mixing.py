"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import running_total, shuffle_key, stage, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Words each source should give: ``source``, ``source_size``, ``rank``, ``target``.

    ``sizes`` has one row per source. Sources in code point order, null last, take
    ``weights`` in turn and share the sum of all sizes. A source stops at ``most`` times its
    own size; what it leaves goes to the others by weight. In the order of size per weight
    a source is full when the level at its turn, what is left per weight that is left,
    reaches its limit; the first that is not full fixes the level of all behind it.
    """
    df = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    df = df.withColumn("weight", weight).withColumn("full", F.col("source_size") * most)
    order = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0)))
    df = df.withColumn("weights_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    df = df.withColumn("level", F.col("left") / F.col("weights_left"))
    df = df.withColumn("open", F.col("full") > F.col("level") * F.col("weight"))
    df = df.withColumn("fixed", F.min(F.when(F.col("open"), F.struct(F.col("full") / F.col("weight"), "rank", "level"))).over(whole)["level"])
    target = F.when(F.col("open"), F.col("fixed") * F.col("weight")).otherwise(F.col("full").cast("double"))
    return df.select("source", "source_size", "rank", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = "mix",
    size=None,
    rows_per_bucket: int = 20_000,
) -> DataFrame:
    """How often the mix takes each document: one row per row of ``docs``.

    Returns ``doc_id``, ``source``, ``size`` (words, or the column ``size``), ``source_size``,
    ``target``, ``copies`` (0 to ``most``) and ``taken``. Within a source documents queue in
    a shuffled order that is the same in every run, once per pass and ``most`` passes at
    most. A copy's virtual finish time is the words queued up to its end divided by the
    source's target. All copies are served by finish time until the budget, the sum of all
    sizes, is used up. The global order is cut into ranges of finish time: their sums
    find the one range in which the budget ends, and only that one is put in order.
    Rows of equal id and size share a place; null texts have size 0; null ids and sources are ordinary values;
    no rows give no rows.
    """
    size = word_count(F.col(text)) if size is None else size
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.cast("long").alias("size"))
    base = stage(base.withColumn("key", shuffle_key(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    sources = stage(source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size"))))
    rows = base.count()
    queued = running_total(base, ["source"], "size", "key", ["size"], "queued", rows, rows_per_bucket)
    right = sources.withColumnRenamed("source", "_source")
    queued = stage(queued.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))

    some = F.nullif(F.col("source_size"), F.lit(0))  # a source without words has no copies
    passes = F.ceil(F.col("target") / some)

    def finish(turn):
        return (F.col("source_size") * turn + F.col("queued")).cast("double") / F.nullif(F.col("target"), F.lit(0.0))

    def place(turn):
        return F.struct(finish(turn).alias("time"), F.col("rank").alias("rank"), F.col("key").alias("key"), F.col("size").alias("size"))

    ranges = max(1, math.ceil(rows * 2 / rows_per_bucket))
    turns = F.explode(F.sequence(F.lit(0), F.least(passes, F.lit(most)).cast("int") - 1))
    served = queued.filter("size > 0 and target > 0").withColumn("turn", turns)
    served = served.withColumn("place", place(F.col("turn"))).withColumn(
        "range", F.least(F.floor(F.col("place.time") * ranges), F.lit(4 * ranges)).cast("long")
    )
    totals = served.groupBy("range").agg(F.sum("size").alias("words"))
    totals = stage(totals.withColumn("upto", F.sum("words").over(Window.orderBy("range"))))
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    last = totals.filter(F.col("upto") > budget).agg(F.min(F.struct("range", F.col("upto") - F.col("words")))).first()[0]
    if last is None:
        end = F.lit(True)
        taken = lambda turn: F.lit(True)
    else:
        inside = served.filter(F.col("range") == last[0]).groupBy("place").agg(F.sum("size").alias("words"))
        inside = inside.withColumn("upto", F.sum("words").over(Window.orderBy("place")) + last[1])
        end = inside.filter(F.col("upto") <= budget).agg(F.max("place")).first()[0]
        if end is None:  # nothing of that range fits
            taken = lambda turn: finish(turn) < last[0] / ranges
        else:
            until = F.struct(*[F.lit(end[n]).alias(n) for n in ("time", "rank", "key", "size")])
            taken = lambda turn: place(turn) <= until
    copies = F.lit(0)
    for turn in range(most):
        copies = copies + F.when((F.col("size") > 0) & (F.col("target") > 0) & (passes > turn) & taken(F.lit(turn)), 1).otherwise(0)
    return queued.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it; rows without words stay once.

    Every row has the plan of its own id, source and size; rows alike in all three share their place in the mix, and so their number.
    """
    size = options.get("size")
    own_size = (word_count(F.col(text)) if size is None else size).cast("long")
    plan = mix_plan(docs, doc_id, text, source, **options)
    plan = plan.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(F.max("copies").alias("_copies"))
    own = F.col(doc_id).eqNullSafe(F.col("_id")) & F.col(source).eqNullSafe(F.col("_source")) & (own_size == F.col("_size"))
    times = F.when(F.col("_size") == 0, F.lit(1)).otherwise(F.col("_copies"))
    return docs.join(plan, own).withColumn("_turn", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)))).select(*docs.columns)
