"""Url filter, quality rules, toxicity: against brute force and on awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, empty, rows_of
from pyspark.sql import functions as F

from flowspark.llm import quality, queries, toxicity, url_filter

URLS = [
    None, "", "no scheme", "http://", "https://Example.com", "https://example.com/", "https://www.EXAMPLE.com/en/1?x=/fr/", "http://a.example.com/en/2#top",
    "http://example.com/en", "https://m.site.net/es/", "https://m.site.net/ES/", "https://net/fr/x", "x://notexample.com/en/", "x://a://b.com/en/",
    "http://com/", "http://com?x", "http://.com/", "http://example.com./en/", "http://example.com:80/en/", "http://" + "a." * 500 + "com/" + "p/" * 4000,
]


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), a, h + p) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


@pytest.mark.parametrize("rules", [queries.URL_RULES, [], [("block", "example.com", ""), ("allow", "example.com", "/e"), ("block", "com", "/en/"), ("allow", "com", "/en/")]])
def test_urls(spark, rules):
    pages = spark.createDataFrame([(i, u, "clash", None) for i, u in enumerate(URLS * 2)], "page_id int, url string, host string, rule string")
    found = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules))
    assert sorted(found.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(URLS * 2)}
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark, rules)).count() == 0


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_quality_measures(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60))) for _ in range(80)]
    texts += ["a b c d e f g h " * 5, "l\nl\n\n \nm\nl\r\nl", "#*$%&|<> é漢", None, "", " \t", "x " * 7, "x " * 8, "x " * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.text_measures(docs).collect()}
    assert got == {i: measures(t) for i, t in enumerate(texts)}


def test_quality_filter(spark):
    docs = documents(spark).withColumn("kept", F.lit("clash"))
    found = quality.quality_filter(docs, min_rows=10)
    rows = found.collect()
    assert len(rows) == docs.count() and all(r.kept is not None for r in rows)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality.quality_filter(empty(spark)).count() == 0


def test_quality_limits_follow_their_group(spark):
    rng = random.Random(1)
    text = lambda marks: " ".join(f"w{rng.randrange(10**6)}" + "#" * (rng.random() < marks) for _ in range(60))
    rows = [(i, text(0.02), "en", "plain") for i in range(150)] + [(1000 + i, text(0.9), "en", "marked") for i in range(150)]
    rows += [(5000, "### $$$ " + text(1.0).replace("#", "####"), "en", "plain"), (6000, text(0.9), "en", "marked")]
    found = {r.doc_id: r.kept for r in quality.quality_filter(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert not found.pop(5000) and all(found.values())


def test_each_quality_metric_rejects_by_its_group(spark):
    rng = random.Random(2)
    some = lambda n, digits=6: [f"w{rng.randrange(10 ** (digits - 1), 10**digits)}" for _ in range(n)]
    lines = lambda parts, n: "\n".join(" ".join(parts[i : i + n]) for i in range(0, len(parts), n))
    rows = [(i, lines(some(60), 12)) for i in range(60)]
    parts = some(100)
    rows.append((100, " ".join(parts + parts[:8])))  # 16 of 108 words in repeated windows
    pairs = [" ".join(some(2)) for _ in range(17)]
    rows.append((101, "\n".join(pairs + pairs[5:8:2] + pairs[9:10])))  # 3 of 20 lines again
    rows.append((102, lines(some(60, 8), 12)))  # words of nine characters where others have seven
    rows.append((103, lines([w.replace("w", "#") if i < 24 else w for i, w in enumerate(some(60))], 12)))  # 24 of 420 characters
    docs = spark.createDataFrame([(*r, "en", "plain") for r in rows], "doc_id int, text string, lang string, source string")
    found = quality.quality_filter(docs).collect()
    assert not any(r.base_failed for r in found)
    assert {r.doc_id for r in found if not r.kept} == {100, 101, 102, 103}


@pytest.mark.parametrize("frequent,first", [(1024, 8), (5, 1), (0, 2)])
def test_index_finds_the_exact_nearest(monkeypatch, frequent, first):
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", first)
    rng = np.random.default_rng(2)
    vectors, labels = [], []
    for _ in range(300):
        terms = rng.choice(40, rng.integers(1, 8), replace=False)
        w = rng.random(terms.size) + 0.1
        vectors.append(dict(zip(terms.tolist(), (w / np.sqrt((w * w).sum())).tolist())))
        labels.append(int(rng.integers(0, 2)))
    arrays = [(np.array(list(v)), np.array(list(v.values()))) for v in vectors]
    index = toxicity.BlockMaxIndex(arrays, labels, 40)
    for q, (place, cosine) in zip(vectors[:60], index.nearest(arrays[:60], 15)):
        truth = sorted((round(sum(w * v.get(t, 0.0) for t, w in q.items()), 9) for v in vectors), reverse=True)[:15]
        assert np.allclose(cosine, [x for x in truth if x > 0][:15])
        assert [index.labels[p] for p in place] == [labels[index.ids[p]] for p in place]


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    rng = random.Random(9)
    bad = ["scumbag", "nitwit", "blockhead"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = [f"w{rng.randrange(200)}" for _ in range(30)] + (rng.sample(bad, 2) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 2:
            marks.append((i, int(toxic)))
    marks += [(None, 1), (7, None), (1, 5)]
    docs = spark.createDataFrame(rows + [(700, None), (701, ""), (None, "nitwit scumbag")], "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    train = ~toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels, train)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == int(i % 5 == 0) for i in range(600))
    assert got[None].predicted == 1 and got[700].score == got[701].score < 0.5
    assert all(0 <= r.score <= 1 for r in got.values()) and got[0].examples
    assert {zlib.crc32(str(i).encode()) % 5 != 0 for i in model.example_ids} == {True}
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, turned, train)).collect()}
    assert again == {i: r.score for i, r in got.items()}
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_toxicity_equals_brute_force(spark):
    """Every word of every text counts: frequencies, leanings, cosines and votes written out."""
    rng = random.Random(3)
    bad = ["scumbag", "nitwit"]
    rows = [(i, " ".join([f"w{rng.randrange(150)}" for _ in range(rng.randrange(3, 40))] + rng.choices(bad, k=2 * (i % 4 == 0)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "--- ..."), (303, "only strange words"), (304, "w1 " * 20_000 + "nitwit"), (None, "NITWIT w2"), (7, rows[9][1]), (305, rows[0][1])]
    marks = [(i, int(i % 4 == 0)) for i in range(200) if i % 3]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(docs, model).collect()

    bags = {i: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for i, t in reversed(rows)}
    frequency = Counter(w for _, t in rows for w in set(re.findall(r"[^\W_]+", (t or "").lower())))
    taught = [(i, label) for i, label in marks if bags[i]]
    for i, _ in taught:  # of two texts of one id the first in order teaches
        bags[i] = Counter(re.findall(r"[^\W_]+", min(t for j, t in rows if j == i).lower()))
    n, rate = len(marks), sum(label for _, label in marks) / len(marks)

    def weight(w):
        holders = [label for i, label in taught if bags[i][w]]
        if not holders:
            return (np.log((1 + len(rows)) / 2) + 1) * 0.2
        expected = len(holders) * rate
        chance = expected * (1 - rate) * (1 - len(holders) / n)
        chi = (sum(holders) - expected) ** 2 / chance if sum(holders) > expected and chance > 0 else 0
        return (np.log((1 + len(rows)) / (1 + frequency[w])) + 1) * (0.2 + 0.8 * min(chi / 25, 1))

    weights = {w: weight(w) for w in frequency}

    def vector(bag):
        raw = {w: (1 + np.log(c)) * weights[w] for w, c in bag.items()}
        norm = np.sqrt(sum(v * v for v in raw.values()))
        return {w: v / norm for w, v in raw.items()}

    examples = [(vector(bags[i]), label) for i, label in taught]
    for (_, text), r in zip([(r.doc_id, r.text) for r in docs.collect()], got):
        bag = Counter(re.findall(r"[^\W_]+", (text or "").lower()))
        if not bag:
            assert r.score == pytest.approx(rate) and not r.examples
            continue
        own = vector(bag)
        near = sorted(((sum(v * e.get(w, 0) for w, v in own.items()), label) for e, label in examples), key=lambda x: -x[0])[:15]
        near = [x for x in near if x[0] > 0]
        assert np.allclose(r.cosines, [c for c, _ in near])
        if len({round(c, 9) for c, _ in near}) == len(near):  # no ties to choose between
            votes, ones = sum(c * c for c, _ in near), sum(c * c for c, label in near if label)
            assert r.score == pytest.approx((ones + 0.05 * rate) / (votes + 0.05))


def test_a_listed_word_in_a_long_clean_text_is_no_verdict(spark):
    rng = random.Random(5)
    prose = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    rows = [(i, " ".join(prose(60) + (["scumbag", "nitwit"] if i % 5 == 0 else []))) for i in range(400)]
    rows += [(900, " ".join(prose(800) + ["scumbag"])), (901, "scumbag nitwit " + " ".join(prose(40)))]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id int, toxic int"), F.lit(True))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert found[900].score < 0.5 <= found[901].score and len(found[900].examples) == 15
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    by_name = toxicity.fit(named, named.select("doc_id", F.when(F.col("text").contains("nitwit"), 1).otherwise(0).alias("toxic")), F.lit(True))
    assert all(x.startswith("d") for r in toxicity.score(named, by_name).collect() for x in r.examples)


def test_toxicity_without_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none, F.lit(True))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.drop_toxic(empty(spark), model).count() == 0
    assert sorted(rows_of(toxicity.drop_toxic(docs, model)), key=str) == sorted(rows_of(docs), key=str)
