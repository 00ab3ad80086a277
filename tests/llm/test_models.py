"""Rule ensemble, conversation repair, whitening: against brute force, held-out accuracy and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, empty, rows_of
from pyspark.sql import functions as F

from flowspark.llm import conversations, rules, whitening

# ------------------------------------------------------------------ rule ensemble


def plain_measure(text):
    """The statistics written out one by one."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    if not words:
        return dict.fromkeys(rules.STATISTICS, 0.0)
    n, letters = len(words), len("".join(words))
    return {
        "words": n,
        "word_length": letters / n,
        "longest": max(len(w) for w in words),
        "symbols": len(re.findall(r"[#*$%&|<>]", text)) / letters,
        "shouts": len(re.findall(r"[!?]", text)) / n,
        "stops": len(re.findall(r"[.,;:]", text)) / n,
        "capitals": len([w for w in words if w.isupper()]) / n,
        "digits": len(re.findall(r"[0-9]", text)) / letters,
        "distinct": len(Counter(words)) / n,
        "short": len([w for w in words if len(w) < 4]) / n,
        "repeats": len([1 for a, b in zip(words, words[1:]) if a == b]) / n,
        "line_words": n / len(lines),
        "dup_lines": (len(lines) - len(set(lines))) / len(lines),
    }


def junk_and_prose(spark, n=400, seed=7):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(15, 60))]
        if not good:
            words = {0: [words[0]] * len(words), 1: [w + "##" for w in words], 2: [w.upper() + "!!" for w in words]}[i % 3]
        rows.append((i, " ".join(words), "en" if good else "fr", "s", 1, 0.5, "k", 3))
        marks.append((i, int(good), 0))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, rules int"
    return spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_rules_score_by_their_conditions(spark):
    docs, labels = junk_and_prose(spark)
    model = rules.fit(docs, labels, ~rules.held_out(F.col("doc_id")))
    assert 0 < len(model.rules) < 100
    awkward = documents(spark).withColumn("predicted", F.lit("clash"))
    found = rules.score(awkward, model)
    assert found.columns == ["doc_id", "score", "predicted", "rules"]
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    want = []
    for doc_id, text in texts:
        s = plain_measure(text)
        held = [all(s[n] > v for n, v in r.above) and all(s[n] <= v for n, v in r.below) for r, _ in model.rules]
        total = model.intercept + sum(w for (_, w), h in zip(model.rules, held) if h)
        want.append((doc_id, round(1 / (1 + np.exp(-total)), 9), sum(held)))
    got = [(r.doc_id, round(r.score, 9), r.rules) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found.collect())
    assert rules.score(empty(spark), model).count() == 0


def test_rules_on_rows_held_out(spark):
    docs, labels = junk_and_prose(spark)
    model = rules.fit(docs, labels, ~rules.held_out(F.col("doc_id")))
    judged = rules.score(docs, model).join(labels, "doc_id").where(rules.held_out(F.col("doc_id"))).collect()
    assert len(judged) > 100 and sum(r.predicted == r.quality for r in judged) >= 0.97 * len(judged)
    hidden = {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert {r.doc_id for r in judged} == hidden
    # what is held out teaches nothing: other labels there change no weight
    turned = labels.withColumn("quality", F.when(rules.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = rules.fit(docs, turned, ~rules.held_out(F.col("doc_id")))
    assert again.intercept == model.intercept and again.rules == model.rules


def test_rules_from_awkward_labels(spark):
    docs = documents(spark)
    kind = "doc_id long, quality int, toxic int"
    nobody = rules.fit(docs, spark.createDataFrame([], kind), F.lit(True))
    assert {r.score for r in rules.score(docs, nobody).collect()} == {0.5}
    alike = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 0, 0), (3, None, 0), (4, 7, 0)], kind)
    assert all(r.score > 0.99 for r in rules.score(docs, rules.fit(docs, alike, F.lit(True))).collect())
    twice = spark.createDataFrame([(106, 0, 0), (106, 1, 0), (1, 0, 0), (1, 0, 0)], kind)
    table, target, weight = rules.labelled_statistics(docs, twice, F.lit(True), "doc_id", "text", "quality")
    assert sorted(target) == [0.0, 1.0] and list(weight) == [1.0, 1.0]


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(2)
    design = np.column_stack([np.ones(300), rng.random((300, 6)) < 0.4]).astype(float)
    label = (rng.random(300) < 1 / (1 + np.exp(1 - 2 * design[:, 1] + design[:, 2]))).astype(float)
    weight = rng.uniform(0.5, 2, 300)
    beta = rules.lasso_logistic(design, label, weight, 0.02, np.zeros(7), steps=20_000)
    slope = design.T @ (weight / weight.sum() * (1 / (1 + np.exp(-design @ beta)) - label))
    assert abs(slope[0]) < 1e-4
    for b, g in zip(beta[1:], slope[1:]):
        assert abs(g + 0.02 * np.sign(b)) < 1e-4 if b else abs(g) < 0.02 + 1e-4


# ------------------------------------------------------------ conversation repair


def after_damage(rows):
    out = []
    for c, t, r, x in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if hit:
            x = "" if hit == 1 else re.sub("[.!?]", "", x) if hit == 2 else x
            out += [(t, "user" if hit == 4 else r, x)] * (2 if hit == 3 else 1)
    return sorted(out, key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))


def faults(rows):
    seen, out = set(), []
    for _, r, x in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", x)
        out.append("blank" if not shown else "duplicate" if (r, x) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def every_repair(rows, marks):
    """All edit sequences with two insertions at most in a place."""
    inserts = [[]] + [[("I", 2, (x, ""))] for x in ("user", "assistant")]
    inserts += [[("I", 2, (x, "")), ("I", 2, (y, ""))] for x, y in itertools.product(("user", "assistant"), repeat=2)]
    choices = []
    for (_, r, x), m in zip(rows, marks):
        extra = int(m == "truncated")
        own = [[("D", 3, None)]]
        if m not in ("blank", "duplicate"):
            own += [[("K", extra, (r, x))], [("R", 2 + extra, ("user", x))], [("R", 2 + extra, ("assistant", x))]]
        choices += [inserts, own]
    for picked in itertools.product(*choices, inserts):
        edits = [e for part in picked for e in part]
        lines = [e[2] for e in edits if e[2]]
        if all(r for r, _ in lines) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines)):
            yield sum(e[1] for e in edits), "".join(e[0] for e in edits), lines


def cheapest_repair(rows, marks):
    """Least (cost, audit) by trying states in order of weight."""
    legal = lambda q: re.fullmatch("s?(ua)*u?", q)
    layer = {"": (0, "", ())}  # by role initials, cut to what matters

    def keep(layer, q, entry):
        q = q if len(q) < 4 else q[-4:] if legal(q[-4:]) else q[-3:]
        if q not in layer or entry[:2] < layer[q][:2]:
            layer[q] = entry

    def insert(layer):
        for _ in range(3):
            for q, (cost, audit, lines) in list(layer.items()):
                for role in ("user", "assistant"):
                    if legal(q + role[0]):
                        keep(layer, q + role[0], (cost + 2, audit + "I", (*lines, (role, ""))))

    for (_, r, x), m in zip(rows, marks):
        insert(layer)
        after, extra = {}, int(m == "truncated")
        for q, (cost, audit, lines) in layer.items():
            keep(after, q, (cost + 3, audit + "D", lines))
            if m not in ("blank", "duplicate"):
                for role, c, letter in ((r, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if role and legal(q + role[0]):
                        keep(after, q + role[0], (cost + c + extra, audit + letter, (*lines, (role, x))))
        layer = after
    insert(layer)
    return min((e for q, e in layer.items() if q == "" or q[-1] == "a"), key=lambda e: e[:2])


def brute(rows):
    rows = after_damage(rows)
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest_repair(rows, marks)
    if len(rows) <= 2:
        assert (cost, audit) == min(e[:2] for e in every_repair(rows, marks))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
    return gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit, digest


def talk(spark, seed=4, long=300):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["Hi.", "yes!", "no", "", " \t\n", None, "Well?"]
    rows = []
    for c in [*range(60), None]:
        n = rng.randrange(1, 4) if c is None or c % 2 else rng.randrange(1, 9)
        rows += [(c, None if rng.random() < 0.1 else t * rng.choice([1, 1, 3]), rng.choice(roles), rng.choice([*texts, f"text {t}.", f"x{t}"])) for t in range(n)]
    rows += [(777, t, ["user", "assistant"][t % 2], rng.choice([*texts, f"text {t}.", f"x{t}"])) for t in range(long)]
    rows += [(778, 3, "user", "Hello.")] * long + [(779, t, "user", "same.") for t in range(long // 2)]
    rows += [(780, 0, "user", "long " * 20_000 + "."), (781, -5, "assistant", "é漢.")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, first int")
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return df.repartition(5), by


@pytest.mark.parametrize("most,adaptive", [(256, "true"), (3, "true"), (7, "false"), (1, "false")])
def test_repair_equals_brute_force(spark, most, adaptive):
    df, by = talk(spark)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        fixed = conversations.repair(df, most=most)
        got = {r[0]: tuple(r)[1:] for r in conversations.report(fixed).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
        assert got == {c: brute(rows) for c, rows in by.items()}
        lines = defaultdict(list)
        for r in conversations.messages(fixed).orderBy("conv_id", "part", "block", "at").collect():
            lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in by} == {c: row[-1] for c, row in got.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_repair_of_nothing(spark):
    df, by = talk(spark)
    assert conversations.report(conversations.repair(df.limit(0))).count() == 0
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    lost = spark.createDataFrame([(c, 0, "user", "Hi.") for c in gone], "conv_id long, turn long, role string, text string")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = conversations.report(conversations.repair(lost)).select("conv_id", *columns).collect()
    assert gone and {r[0]: tuple(r)[1:] for r in found} == dict.fromkeys(gone, nothing)


@pytest.mark.parametrize("seed", range(5))
def test_linked_blocks_equal_one_block(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.randrange(4)) for _ in range(60)]
    cost, pieces = conversations.link_paths([conversations.least_paths(rows, [0])])
    for size in (1, 7, 25):
        cut = [conversations.least_paths(rows[at : at + size], range(4)) for at in range(0, 60, size)]
        assert (conversations.link_paths(cut)[0], "".join(conversations.link_paths(cut)[1])) == (cost, "".join(pieces))


# ---------------------------------------------------------------------- whitening


def vectors(spark, seed=1, n=300, width=20):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(size=width) * np.linspace(2, 0.1, width)], i % 3) for i in range(n)]
    rows += [(1000 + i, rows[0][1], None) for i in range(200)] + [(None, rows[1][1], 1), (5, rows[2][1], 1)]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 1), (2001, [], 1), (2002, [1.0, None] * (width // 2), 1), (2003, [nan] * width, 1), (2004, [inf] * width, 1), (2005, [1e30] * width, 1), (2006, [1.0, 2.0], 1)]
    schema = "vec_id long, embedding array<double>, label int"
    return spark.createDataFrame(rows, schema).withColumn("n", F.lit("clash")).withColumn("component", F.lit(9)).repartition(4)


def test_whitening_equals_brute_force(spark):
    df = vectors(spark)
    found = whitening.whitened_components(df).toPandas()
    sound = [(r.vec_id, r.embedding) for r in df.collect() if r.embedding and len(r.embedding) == 20 and None not in r.embedding and max(map(abs, r.embedding)) < 1e20 and r.embedding[0] == r.embedding[0]]
    x = np.floor(np.array([e for _, e in sound]) * 64).astype(int) + 1000000
    fit = np.unique(x, axis=0)
    n, mean = len(fit), (fit - 1000000).mean(axis=0) + 1000000
    values, components = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    want = (x - mean) @ components[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    assert len(found) == 16 * len(sound) and set(found.n) == {n} and sorted(set(found.component)) == list(range(1, 17))
    assert np.allclose(found[found.component == 1].explained, values[-1] / values.sum(), rtol=1e-10)
    deviation = ((n * x - fit.sum(axis=0)).astype(object) ** 2).sum(axis=1)
    key = lambda v: (v[0] is None, v[0] or 0)
    got = defaultdict(list)
    for r in found.sort_values("component").itertuples():
        got[None if np.isnan(r.vec_id) else int(r.vec_id), r.deviation].append(r.whitened)
    assert found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-10
    signs = None
    for (vec_id, _), row, d in sorted(zip(sound, want, deviation), key=lambda v: key(v[0])):
        mine = np.array(got[vec_id, d])
        mine = mine.reshape(-1, 16) if mine.size == 16 else np.array(got[vec_id, d]).reshape(16, -1).T
        signs = np.sign(mine[0] * row) if signs is None else signs
        assert np.allclose(mine[0] * signs, row, atol=1e-7)


def test_whitening_of_degenerate_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert whitening.whitened_components(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened_components(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 5, schema)).count() == 0
    # rank one: one component, whatever the dimension
    line = spark.createDataFrame([(i, [i / 4, i / 2, 0.0], 0) for i in range(9)], schema)
    found = whitening.whitened_components(line).toPandas()
    assert len(found) == 9 and set(found.component) == {1} and np.allclose(found.explained, 1.0)
    assert np.isclose((found.whitened**2).mean(), 1.0) and found.identity_error.max() < 1e-12


def test_whitening_of_large_entries_is_exact(spark):
    big = float(2**38)
    df = spark.createDataFrame([(i, [big + i * 64.0, -big * (i % 2), i / 64], 0) for i in range(40)], "vec_id long, embedding array<double>, label int")
    found = {(r.vec_id, r.component): r for r in whitening.whitened_components(df).collect()}
    x = [[int(c * 64) + 1000000 for c in (big + i * 64.0, -big * (i % 2), i / 64)] for i in range(40)]
    sums = [sum(c) for c in zip(*x)]
    for i in range(40):
        exact = sum((40 * a - s) ** 2 for a, s in zip(x[i], sums))
        assert found[i, 1].deviation == (exact if exact < 2**63 else None)
    assert found[0, 1].identity_error < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_factor_and_rotations(seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(12, 9 if seed % 2 else 30))
    matrix = a @ a.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (12, 9 if seed % 2 else 12) and np.allclose(factor @ factor.T, matrix)
    rotated = whitening.one_sided_jacobi(factor)
    products = rotated.T @ rotated
    assert np.allclose(products, np.diag(np.diag(products)), atol=1e-12 * products.max())
    assert np.allclose(rotated @ rotated.T, matrix)
    assert np.allclose(sorted(np.diag(products)), np.linalg.eigvalsh(matrix)[-factor.shape[1] :])


def test_rows_are_kept(spark):
    df = vectors(spark)
    assert sorted(Counter(r[0] for r in rows_of(whitening.whitened_components(df).select("vec_id")) if r[0] is not None)[i] for i in (1000, 1001)) == [16, 16]
