"""Quality rules whose limits follow the data: quantile sketches per language and source.

Everything is DataFrame work. A sketch is a table of counts over log-linear cells (exact
below 64, then 32 cells to each doubling, so a quantile is off by 1/32 at most); sketches
of two groups merge by adding counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import SPACE, SPACE_CHARS, stage

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Least distance of a limit from the upper quartile: two of the widest cells of values up to 1,023, so that the quartile range decides.
LEAST = 32
#: Metric: (counted column, column that divides it, scale, least distance of the limit from the upper quartile).
METRICS = {
    "symbols": ("n_symbols", "word_chars", 1000, LEAST),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, LEAST),
    "repeat_words": ("n_repeat_words", "n_words", 1000, LEAST),
    "word_length": ("word_chars", "n_words", 100, LEAST),
}


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows found twice or more, from the windows' hashes in order."""
    cells = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    pairs = F.zip_with(cells, F.slice(cells, 2, F.size(cells)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    equal = F.filter(pairs, lambda z: z["a"]["h"] == z["b"]["h"])
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda z: F.array(z["a"]["p"], z["b"]["p"])))))
    reach = F.zip_with(
        places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
    )
    total = F.aggregate(reach, F.lit(0), lambda s, x: s + x)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total)


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by counts: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    A null text has no words. Lines count when they hold a word. Windows are compared by
    a 64-bit hash of their eight words, within one text.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    whole = F.coalesce(F.col("_text"), F.lit(""))
    kept = [c for c in docs.columns if c not in {text, *names}]
    df = docs.select(*kept, F.col(text).alias("_text"))
    df = df.select(
        *kept,
        "_text",
        F.array_remove(F.split(whole, SPACE), "").alias("_words"),
        F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )

    def next_to(h: Column, step: int) -> Column:
        return F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    # hashes of 1, 2, 4 and 8 words; each is used twice, so every step is a column of its own
    df = df.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_h2", F.when(F.size("_words") >= WINDOW, next_to(F.col("_h1"), 1)))
    df = df.withColumn("_h4", next_to(F.col("_h2"), 2))
    df = df.withColumn("_h8", F.slice(next_to(F.col("_h4"), 4), 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(1))))
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate(whole, SPACE_CHARS, "")),
        "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.size("_words") >= WINDOW, _repeat_words(F.col("_h8"))).otherwise(F.lit(0)),
    }
    return df.select(*kept, *[c.cast("long").alias(n) for n, c in measures.items()])


def _value(metric: str) -> Column:
    top, bottom, scale, _ = METRICS[metric]
    return F.when(F.col(bottom) > 0, F.floor(F.col(top) * scale / F.col(bottom))).otherwise(F.lit(0)).cast("long")


def _cell(value: Column) -> Column:
    """Lower end of the sketch cell of a non-negative whole number."""
    low_bits = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low_bits), low_bits)


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Counts per group, metric and cell: the mergeable sketch."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), _cell(_value(m)).alias("cell")) for m in METRICS])
    return (
        measured.select(*groups, F.explode(values).alias("v"))
        .groupBy(*groups, F.col("v.metric").alias("metric"), F.col("v.cell").alias("cell"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of coarser ``groups`` from those of finer ones."""
    return sketches.groupBy(*groups, "metric", "cell").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, groups: list[str], spread: int = 3) -> DataFrame:
    """Per group and metric: ``rows`` and ``high``, the upper quartile plus ``spread`` times the quartile range.

    The distance from the upper quartile is at least the metric's least distance.
    """
    over = Window.partitionBy(*groups, "metric")
    ranked = sketches.withColumn("upto", F.sum("n").over(over.orderBy("cell"))).withColumn("rows", F.sum("n").over(over))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("cell")))
    least = F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[3]))])
    high = F.col("q3") + F.greatest((F.col("q3") - F.col("q1")) * spread, least[F.col("metric")])
    return (
        ranked.groupBy(*groups, "metric")
        .agg(F.max("rows").alias("rows"), quartile(1).alias("q1"), quartile(3).alias("q3"))
        .groupBy(*groups)
        .agg(F.max("rows").alias("rows"), *[F.max(F.when(F.col("metric") == m, high)).alias(m) for m in METRICS])
    )


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_rows: int = 30) -> DataFrame:
    """Counts of every document, ``base_failed`` and ``kept``; the text itself is dropped.

    Base rule: under 20 words, or over 30 % of the words in repeated windows. The other
    limits come from the documents that pass it: a sketch per language and source, merged
    into one per language. A group under ``min_rows`` takes the limits of its
    language; if that is small too, only the base rule counts. ``kept`` is false above any
    limit. Null languages and sources are groups of their own; an empty table gives no rows.
    """
    df = docs.withColumns({"_lang": F.col(lang), "_source": F.col(source)})
    measured = text_measures(df, text).drop("base_failed", "kept")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    measured = stage(measured.withColumn("base_failed", failed))
    fine = stage(sketch(measured.filter("not base_failed"), ["_lang", "_source"]))
    limits = fences(fine, ["_lang", "_source"])
    coarse = fences(merge(fine, ["_lang"]), ["_lang"])
    c = {m: f"c_{m}" for m in [*METRICS, "rows"]} | {"_lang": "c_lang"}
    coarse = coarse.withColumnsRenamed(c)
    chosen = limits.join(coarse, F.col("_lang").eqNullSafe(F.col("c_lang")), "left").select(
        F.col("_lang").alias("l_lang"),
        F.col("_source").alias("l_source"),
        *[
            F.when(F.col("rows") >= min_rows, F.col(m)).when(F.col("c_rows") >= min_rows, F.col(f"c_{m}")).alias(f"max_{m}")
            for m in METRICS
        ],
    )
    above = F.lit(False)
    for m in METRICS:
        above = above | F.coalesce(_value(m) > F.col(f"max_{m}"), F.lit(False))
    on = F.col("_lang").eqNullSafe(F.col("l_lang")) & F.col("_source").eqNullSafe(F.col("l_source"))
    return (
        measured.join(chosen, on, "left")
        .withColumn("kept", ~F.col("base_failed") & ~above)
        .drop("_lang", "_source", "l_lang", "l_source", *[f"max_{m}" for m in METRICS])
    )
