"""SimHash, vector graphs, suffix arrays: against brute force and on awkward rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import SCHEMA, documents, empty, words
from pyspark.sql import functions as F

from flowspark.llm import components, hnsw, simhash, suffix


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    n = 120
    pairs = {
        "path": [(i, i + 1) for i in range(n - 1)],
        "star": [(77, i) for i in range(n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(70)],
        "none": [(3, 3)],
    }[shape]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(range(n), pairs)
    assert got == {i: want[i] for i in {x for p in pairs if p[0] != p[1] for x in p}}


def plain_fingerprint(text, size=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(parts[i : i + size]) for i in range(len(parts) - size + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    docs = documents(spark, n=120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(((d, f) for d, f, _ in got), key=str) == sorted(((d, format(plain_fingerprint(t), "016x")) for d, t in rows), key=str)
    prints = [(d, int(f, 16)) for d, f, _ in got]
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i][1] ^ prints[j][1]).bit_count() <= 2]
    root = roots(range(len(prints)), pairs)
    for i, (_, _, component) in enumerate(got):
        ids = [prints[j][0] for j in root if root[j] == root[i] and prints[j][0] is not None]
        assert component == min(ids, default=None)
    assert any(a != b for a, _, b in got)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_ball_links_find_every_close_pair(spark):
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        for flips in (1, 2, 3):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    prints = sorted(set(prints))
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    links = simhash.ball_links(spark.createDataFrame([(signed(p),) for p in prints], "fp long")).collect()
    got = roots([signed(p) for p in prints], [(r.a, r.b) for r in links])
    want = roots([signed(p) for p in prints], [(signed(a), signed(b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    assert got == want


def jaccard(a, b, size=5):
    def shingles(t):
        p = t.lower().split()
        return {" ".join(p[i : i + size]) for i in range(max(1, len(p) - size + 1))}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_similar_groups(spark):
    rng = random.Random(12)
    rows = []
    for i in range(30):
        text = words(rng, 150, 5000)
        rows.append((3 * i, text))
        parts = text.split()
        parts[rng.randrange(150)] = "changed"
        rows.append((3 * i + 1, " ".join(parts)))
        rows.append((3 * i + 2, text if i % 2 else words(rng, 40, 5000)))
    rows += [(500, None), (501, ""), (502, " "), (None, "lonely words without an id"), (503, "One two"), (504, "one  TWO")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bands string")
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    pairs = [(a, c) for a, b in rows for c, d in rows if b and d and b.strip() and None not in (a, c) and jaccard(b, d) >= 0.8] + [(500, 501)]
    want = roots([a for a, _ in rows if a is not None], pairs)
    assert {k: v for k, v in found.items() if k is not None} == want
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {d for d, c in found.items() if d == c}
    assert simhash.similar_groups(docs.limit(0)).count() == 0


def test_vector_links(spark):
    rng = np.random.default_rng(3)
    rows, vectors = [], []
    for i in range(300):
        x = rng.normal(size=16)
        if i % 3 == 1:
            x = vectors[-1] + rng.normal(size=16) * 0.1
        if i % 10 == 7:
            x = vectors[-1]
        vectors.append(x)
        rows.append((i, [float(np.float32(v)) for v in x], i % 2 if i % 20 else None))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [1e30] * 16, [2e30] * 16, [1.0] * 15, [1.0] * 16]
    rows += [(400 + i, v, 1) for i, v in enumerate(odd)] + [(None, [1.0] * 16, 1)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.vector_links(frame).collect()}
    good = {v: np.array(x) / np.max(np.abs(x)) for v, x, k in rows if v is not None and k is not None and x and None not in x and np.isfinite(x).all() and any(x)}
    label = {v: k for v, _, k in rows}
    close = [
        (a, b) for a in good for b in good
        if a < b and label[a] == label[b] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.93
    ]
    want = roots([v for v, _, _ in rows if v is not None], close)
    for v in want:
        assert got[v] == (sum(v in p for p in close), want[v], v == want[v]), v
    assert got[None][0] == 0
    assert hnsw.vector_links(frame.limit(0)).count() == 0


def test_vectors_over_several_shards(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24))
    x[1::2] = x[::2] + rng.normal(size=(200, 24)) * 0.12
    x[300:] = x[0] + rng.normal(size=(100, 24)) * 0.15
    monkeypatch.setattr(hnsw, "SHARD", 150)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in hnsw.vector_links(frame).collect()}
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    truth = (unit @ unit.T >= 0.93).sum(1) - 1
    assert sum(got.values()) >= 0.99 * truth.sum() and all(got[i] <= truth[i] for i in got)


def test_beams_reach_the_recall():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 32))
    x[:600] = x[600:1200] + rng.normal(size=(600, 32)) * 0.1
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    graph = hnsw.Graph.build(x)
    truth = x @ x.T >= 0.93
    found = graph.links_of(x, 0.93)
    assert not (found & ~truth).any() and (found & truth).sum() >= 0.99 * truth.sum()
    ids, _ = graph.search(x[:200], 32)
    near = [len(set(ids[i].tolist()) & set(np.argsort(-(x @ x[i]))[:10].tolist())) for i in range(200)]
    assert np.mean(near) >= 9.0


def plain_repeats(rows):
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            g, own = b[i : i + 50], d if d is not None else float("inf")
            first[g] = min(first.get(g, own), own)
    for d, t in rows:
        b, own = (t or "").encode(), d if d is not None else float("inf")
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < own:
                gone[i : i + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = len(re.findall("1+", "".join("1" if g else "0" for g in gone)))
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("common", [512, 2])
def test_repeats(spark, monkeypatch, common):
    monkeypatch.setattr(suffix, "COMMON", common)
    monkeypatch.setattr(suffix, "TEXT_SHARD", 20_000)
    docs = documents(spark, n=90)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted([tuple(r) for r in suffix.repeats(docs).collect()], key=str)
    assert got == plain_repeats(rows)
    assert sum(r[2] for r in got) > 1000
    assert suffix.repeats(empty(spark)).count() == 0


def test_few_symbols_and_periods(spark):
    rng = random.Random(2)
    texts = ["ab" * rng.randrange(20, 90) + "".join(rng.choice("ab") for _ in range(rng.randrange(200))) for _ in range(25)]
    rows = list(enumerate(texts)) + [(3, "ab" * 100), (90, "é" * 100), (91, "\x00" * 70), (92, "\x00" * 60 + "\xff")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in suffix.repeats(frame).collect()], key=str) == plain_repeats(rows)


def test_drop_repeats_keeps_clean_rows(spark):
    docs = documents(spark, n=90).filter("doc_id is not null").dropDuplicates(["doc_id"])
    wanted = {r[0]: r for r in plain_repeats([(r.doc_id, r.text) for r in docs.collect()])}
    got = suffix.drop_repeats(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    whole = {r.doc_id: r for r in docs.collect()}
    assert set(texts) == {d for d, r in wanted.items() if not (r[2] and r[2] == r[1])}
    assert all(texts[d] == whole[d].text for d in texts if wanted[d][2] == 0)
    assert got.filter(F.col("n_chars") == F.length("text")).count() >= sum(wanted[d][2] > 0 for d in texts)
    assert suffix.drop_repeats(empty(spark)).columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" double", "").replace(" int", "").split(", ")


def test_suffix_array_and_prefixes(monkeypatch):
    monkeypatch.setattr(suffix, "LANES", 5)
    rng = np.random.default_rng(1)
    for _ in range(60):
        texts = [bytes(rng.integers(97, 99 + rng.integers(0, 4), rng.integers(1, 120)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes = raw.astype(np.uint16) + 1
        codes[ends] = 0
        whole = [bytes(raw[i : ends[np.searchsorted(ends, i)]]) for i in range(codes.size)]
        order = suffix.suffix_array(codes, 300)
        assert [whole[i] for i in order] == sorted(whole)
        prefix = suffix.common_prefixes(codes, order, 50)
        for k in range(1, len(order)):
            a, b = whole[order[k - 1]], whole[order[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == min(same, 50)


@pytest.mark.parametrize("room", [100, 300, 1 << 20])
def test_masks_whatever_the_shards(room):
    rng = np.random.default_rng(room)
    keys, contexts, ids = [], [], []
    for k in range(5):
        base = bytes(rng.integers(97 + 9 * k, 100 + 9 * k, 90).astype(np.uint8))
        for _ in range(12):
            start = rng.integers(0, 10)
            c = bytearray(base[start : start + rng.integers(50, 81)])
            if rng.random() < 0.3:
                c[rng.integers(0, len(c))] = 97 + 9 * k
            keys.append(k), contexts.append(bytes(c)), ids.append(int(rng.integers(0, 9)))
    masks = suffix.repeated_masks(np.array(keys), contexts, np.array(ids), room)
    for i, c in enumerate(contexts):
        want = sum(1 << s for s in range(len(c) - 49) if any(keys[j] == keys[i] and ids[j] < ids[i] and c[s : s + 50] in contexts[j] for j in range(60)))
        assert masks[i] == want


def test_similar_groups_at_the_border_and_in_crowds(spark):
    """Every pair at 0.8 or more links: pairs just above and below it, families that share most of their words."""
    rng = random.Random(21)
    texts = []
    for i in range(120):  # a few changed words apart: around 0.75 to 0.9
        parts = words(rng, 100, 5000).split()
        texts.append(" ".join(parts))
        for p in rng.sample(range(5, 95), rng.choice((1, 2, 2, 3))):
            parts[p] = f"changed{i}_{p}"
        texts.append(" ".join(parts))
    for f in range(2):  # a template with room for two words, so a bucket holds texts that are not alike
        frame = words(rng, 60, 5000).split()
        for i in range(60):
            parts, k = list(frame), rng.choice((0, 1, 2, 3, 4, 5))
            for p in rng.sample(range(60), k):
                parts[p] = f"w{f}_{i}_{p}" if rng.random() < 0.7 else f"t{p % 3}"
            texts.append(" ".join(parts))
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = list(zip(order, texts))
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    scores = {(a, c): jaccard(b, d) for a, b in rows for c, d in rows if a < c}
    assert sum(0.8 <= s < 0.85 for s in scores.values()) > 50 and sum(0.75 <= s < 0.8 for s in scores.values()) > 50
    assert found == roots(order, [p for p, s in scores.items() if s >= 0.8])


def test_drop_repeats_by_row(spark):
    """Rows that share an id, or have none, are cut each by its own text."""
    rng = random.Random(8)
    passage = words(rng, 20)
    clean, other = words(rng, 30), words(rng, 25)
    rows = [(1, "start " + passage), (2, clean), (2, other + " " + passage), (2, clean), (None, passage + " end"), (None, words(rng, 12)), (None, passage + " end"), (3, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", None) for i, t in rows], "doc_id long, text string, lang string, n_chars long")
    ids = [2**62 if i is None else i for i, _ in rows]
    raws = [(t or "").encode() for _, t in rows]
    want = []
    for (i, t), own, raw in zip(rows, ids, raws):
        seen = {r[at : at + 50] for j, r in zip(ids, raws) if j < own for at in range(len(r) - 49)}
        gone = {at + k for at in range(len(raw) - 49) if raw[at : at + 50] in seen for k in range(50)}
        if len(gone) < len(raw) or not raw:
            left = bytes(b for at, b in enumerate(raw) if at not in gone).decode(errors="ignore")
            want.append((i, t if not gone else left, len(left) if gone else None))
    got = [(r.doc_id, r.text, r.n_chars) for r in suffix.drop_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("kind", ["string", "double"])
def test_labels_of_any_type(spark, kind):
    labels = ["cat", "cats", "cat", None] if kind == "string" else [1.2, 1.7, 1.2, None]
    frame = spark.createDataFrame([(i, [1.0, 2.0, 3.0], label) for i, label in enumerate(labels)] + [(None, [1.0, 2.0, 3.0], labels[0])], f"vec_id long, embedding array<double>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.vector_links(frame).collect()}
    assert got == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3), None: (0, None)}


def test_recall_on_planted_links(spark, monkeypatch):
    """Few links, spread over many pairs of shards, among vectors that are otherwise far apart."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 32))
    at = rng.permutation(6000)
    a, b = at[:400], at[400:800]
    x[b] = x[a] + rng.normal(size=(400, 32)) * 0.2
    monkeypatch.setattr(hnsw, "SHARD", 1500)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    truth = sum((unit[i] @ unit.T >= 0.93).sum() - 1 for i in range(6000))
    found = hnsw.vector_links(frame).agg(F.sum("n_links")).first()[0]
    assert truth >= 700 and 0.99 * truth <= found <= truth


def test_fingerprints_decide_in_the_pipeline_step(spark):
    """The pipeline's step drops what SimHash links, and what only shingle sets link; wordless texts are linked to equal ones alone."""
    rng = random.Random(31)
    refrain = " ".join(f"r{i}" for i in range(9)) + " "
    tails = [words(rng, 40, 5000) for _ in range(2)]
    far = words(rng, 60, 5000).split()
    changed = [*far[:-1], "changed"]
    rows = [(1, refrain * 60 + tails[0]), (2, refrain * 60 + tails[1]), (3, " ".join(far)), (4, " ".join(changed)), (5, words(rng, 60, 5000)), (6, ""), (7, " ")]
    bits = lambda i, j: (simhash.fingerprint(rows[i][1]) ^ simhash.fingerprint(rows[j][1])).bit_count()
    assert bits(0, 1) <= 2 and jaccard(rows[0][1], rows[1][1]) < 0.8
    assert bits(2, 3) > 2 and jaccard(rows[2][1], rows[3][1]) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()} == {1, 3, 5, 6, 7}
    assert {r.doc_id for r in simhash.drop_near_duplicates(docs, half=None).collect()} == {1, 2, 3, 5, 6, 7}


def test_packed_rows_and_sorted_suffixes():
    """Packed numbers come back whatever their order and take few bytes; equal suffixes are in the order of their places."""
    rng = np.random.default_rng(5)
    arrays = [rng.integers(0, 1 << 48, 5000), np.arange(5000) * 3, rng.integers(-(1 << 63), 1 << 63, 7), np.zeros(0, np.int64), rng.integers(0, 256, 5000)]
    strings = [b"", b"some text", bytes(range(256))]
    for a, s in ((arrays, strings), ([np.zeros(0, np.int64)], []), ([np.array([5])], [b"x"])):
        blob = suffix._pack(a, s)
        got, texts = suffix._unpack(pa.scalar(blob, pa.binary()))
        assert texts == s and all(np.array_equal(x, y) for x, y in zip(got, a)) and len(got) == len(a)
    assert len(suffix._pack(arrays, strings)) < 5000 * 7.3  # six bytes, next to none and one of each row
    codes = np.array([*(list(rng.integers(1, 4, 40)) * 30), 0] * 3, np.uint16)
    order = suffix.suffix_array(codes, codes.size)
    key = lambda i: (codes[i : i + list(codes[i:]).index(0)].tolist(), i)
    assert order.tolist() == sorted(range(codes.size), key=key)
