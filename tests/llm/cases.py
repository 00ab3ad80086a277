"""Small tables with the awkward cases, for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, shard int"


def words(rng, n, size=300):
    return " ".join("w" + str(rng.randrange(size)) + rng.choice("abcdef") for _ in range(n))


def documents(spark, seed=5, n=60):
    """Nulls in every column, empty and long texts, exact and near copies, a shared passage, repeated rows, clashing columns."""
    rng = random.Random(seed)
    passage = words(rng, 30)
    rows = []
    for i in range(n):
        text = words(rng, rng.randrange(1, 120))
        if i % 7 == 3:
            text = text + " " + passage + " " + words(rng, 5)
        if i % 9 == 4 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 11 == 5 and rows and rows[-1][1]:
            text = rows[-1][1] + " tail"
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "b", "b", None]), 1, 0.5, "k", 3))
    rows += [
        (100, None, "en", "a", None, None, None, None),
        (101, "", None, "a", 0, 0.1, "x", 1),
        (102, " \t\n\x0b\x0c\r ", "en", None, 0, 0.1, "x", 1),
        (103, "é" * 70 + " ñandú\u00a0漢字", "es", "b", 0, 0.1, "x", 1),
        (104, words(rng, 4000), "en", "b", 0, 0.1, "x", 1),
        (105, "x" * 30000, "en", "c", 0, 0.1, "x", 1),
        (None, "an id that is null and a text of some words", "en", "c", 0, 0.1, "x", 1),
        (106, "One two THREE", "en", "c", 0, 0.1, "x", 1),
        (106, "One two THREE", "en", "c", 0, 0.1, "x", 1),
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
