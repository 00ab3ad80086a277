"""Token file, BPE, mixing, sharding, pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import documents, empty, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flowspark.llm import bpe, common, mixing, sharding, simhash, suffix, token_file, toxicity

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(
    "documents",
    [
        [], [[]], [[5]], [[2**32 - 1, 0, 7], [], list(range(9000))], [[3] * 20000], [[1, 2, 3, 1, 2, 4] * 2000, [9]],
        [np.random.default_rng(0).integers(0, 2**17, 12345).tolist()], [[i] for i in range(4096)], [[7] * 4097],
    ],
)
def test_frames_round_trip(documents):
    arrays = [np.array(d, np.uint32) for d in documents]
    payload = token_file.encode_frame(arrays)
    assert [d.tolist() for d in token_file.decode_frame(payload)] == documents


def test_frames_compress_and_notice_damage():
    rng = random.Random(1)
    ids = np.array([rng.choice([11, 12, 13, 14]) if rng.random() < 0.9 else rng.randrange(50000) for _ in range(30000)], np.uint32)
    payload = token_file.encode_frame([ids])
    assert len(payload) < 30000 * 2 * 0.5
    for place in (len(payload) // 2, len(payload) - 40):
        broken = payload[:place] + bytes([payload[place] ^ 1]) + payload[place + 1 :]
        with pytest.raises(ValueError):
            token_file.decode_frame(broken)


def test_token_file(spark, monkeypatch):
    monkeypatch.setattr(token_file, "FRAME", 2000)
    monkeypatch.setattr(token_file, "FRAME_TEXT", 10_000)
    docs = documents(spark)
    library = Tokenizer.from_file(BYTE)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, want = 0, []
    for d, t in rows:
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_file.token_file(docs, BYTE)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == want
    assert token_file.token_file(empty(spark), BYTE).count() == 0


def test_pieces_encode_like_the_library():
    rng = random.Random(3)
    own, library = token_file.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for i in range(400):
        text = "".join(rng.choice("ab 's't  \n\t漢é́\x85 <>|1٣\x1c.") for _ in range(rng.randrange(0, 40)))
        text += "<|endoftext|>" * (i % 9 == 0)
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


ALPHABET = "aabcdeinotrst'’éÉßİΣσ ςñÑ0123٣४\x1c\x1f\x85᠎\u200b\ufeff \t\n\r　漢字́̈ẹ😀_-—ﬁ"


def test_transducer_equals_the_library():
    rng = random.Random(1)
    own, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    for i in range(600):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 40)))
        if i % 10 == 0:
            text = text[:10] + "<|endoftext|>" + text[10:] + "<|STARToftext|>"
        if i % 7 == 0:
            text = "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 700)))
        if i % 11 == 0:
            text = rng.choice(["a", "ab", "the", "in", "aaab"]) * rng.randrange(1, 700)
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_transducer_memory_is_bounded():
    own = bpe.WordBpe(WORD)
    merges = own.merges
    encoder, held, rng = bpe.Encoder(merges), 0, random.Random(4)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(20000))
    for c in range(0, len(text), 50):
        encoder.feed(text[c : c + 50])
        held = max(held, len(encoder.text))
    assert held <= merges.lookahead + 4 * merges.longest and encoder.farthest <= merges.lookahead


def test_transducer_with_random_merges():
    rng = random.Random(7)
    for _ in range(40):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        for _ in range(rng.randrange(1, 14)):
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        known = bpe.Merges(vocab, merges)
        for _ in range(60):
            symbols = [rng.choice("abc") for _ in range(rng.randrange(1, 120))]
            parts = list(symbols)
            while True:  # the lowest rank first, the leftmost of it
                found = min(((known.rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in known.rank), default=None)
                if found is None:
                    break
                i = found[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            encoder = bpe.Encoder(known)
            assert encoder.feed("".join(symbols[:-1])) + encoder.finish(symbols[-1]) == parts


def test_decoder_waits_for_whole_characters():
    table = bpe.byte_symbols()
    tokens = [table[b] for b in "é漢😀a".encode()]
    machine = bpe.Decoder(tokens, byte_level=True)
    pieces = [machine.feed(i) for i in range(len(tokens))]
    assert "".join(pieces) + machine.finish() == "é漢😀a" and pieces[0] == "" and pieces[1] == "é"


def test_long_texts_are_cut_without_effect(monkeypatch):
    monkeypatch.setattr(bpe, "RUN", 16)
    own, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    for text in ("a b ́c " * 30, "word " * 50 + "É ΑΣ " * 20, "x" * 500, " " * 100, "a  b\n\nc " * 20):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    docs = documents(spark)
    library = Tokenizer.from_file(WORD)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(docs, WORD).collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(empty(spark), WORD).count() == 0
    decoded = bpe.decode_documents(bpe.encode_documents(docs, WORD), WORD)
    assert Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in decoded.collect()) == Counter(w[3] for w in want)


def plain_targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_mixing(spark, bucket):
    docs = documents(spark, n=300)
    plan = mixing.mix_plan(docs, rows_per_bucket=bucket).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in plan:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
    want = plain_targets(sizes)
    largest = max(r.size for r in plan)
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)
    assert sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix_plan(docs.repartition(5), rows_per_bucket=bucket).collect()
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, again), key=str)


def test_mixing_reshares_what_small_sources_leave(spark):
    rows = [(i, "w " * 10, "big") for i in range(300)] + [(1000 + i, "w " * 10, "a") for i in range(4)] + [(2000, None, "zero"), (2001, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs).collect()
    target = {r.source: r.target for r in plan}
    assert target == plain_targets({"big": 3000, "a": 40, "zero": 0, None: 0}) and target["a"] == 120.0
    mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert all(mixed[r.doc_id] == (1 if r.size == 0 else r.copies) for r in plan)
    assert mixing.mix_plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_sharding(spark, bucket):
    rng = random.Random(6)
    hot = "the hot text"
    rows = [(i, hot if i % 3 == 0 else words(rng, 4) if i % 5 else f"pair {i // 10}") for i in range(700)] + [(None, None), (1, ""), (1, ""), (900, None)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, shard int").repartition(4)
    found = sharding.shard_documents(docs, rows_per_bucket=bucket).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    shards = defaultdict(set)
    for r in found:
        shards[r.text_crc32].add(r.shard)
    assert len(shards[zlib.crc32(hot.encode())]) <= 9  # 234 rows over shards of 44
    pairs = [shards[zlib.crc32(f"pair {i}".encode())] for i in range(70)]
    assert sum(len(p) <= 1 for p in pairs) >= 60
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17])
def test_few_documents(spark, n):
    docs = spark.createDataFrame([(i, "same") for i in range(n)], "doc_id long, text string")
    sizes = Counter(r.shard for r in sharding.shard_documents(docs).collect())
    assert sum(sizes.values()) == n and max(sizes.values(), default=0) <= -(-n // 16)


def test_pipeline(spark, tmp_path):
    rng = random.Random(20)
    bad = ["scumbag", "nitwit", "blockhead"]
    passage = words(rng, 25, 4000)
    rows, marks = [], []
    for i in range(200):
        text = words(rng, 60, 4000)
        if i % 10 == 0:
            text += " " + " ".join(bad)
        elif i % 10 == 1:
            text = rows[-9][1] if i > 10 else text  # a copy of a clean one
        elif i % 10 == 2:
            text += " " + passage + " end" + str(i)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        marks.append((i, 0, int(i % 10 == 0)))
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out, steps = {}, corpus_pipeline.STAGES
    for name, function in steps[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs.collect()
    ids = lambda name: {r.doc_id for r in out[name]}
    assert ids("toxicity") == {r[0] for r in rows if r[0] >= 900 or r[0] % 10}
    copies = {i for i in range(11, 200, 10)}
    assert ids("simhash") == ids("toxicity") - copies - {901}
    cut = {r.doc_id: r.text for r in out["suffix_array"]}
    whole = {r.doc_id: r.text for r in out["simhash"]}
    assert set(cut) == set(whole) and [d for d in sorted(cut) if cut[d] != whole[d]] == list(range(12, 200, 10))
    assert not any(passage in (cut[d] or "") for d in cut if d != 2)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(WORD)
    want = Counter((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in out["mixing"])
    assert Counter((r.doc_id, r.n_tokens) for r in final) == want


def test_stages_on_no_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], schema)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_operators_are_called_by_the_stages():
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert all(callable(x) for x in (toxicity.drop_toxic, simhash.drop_near_duplicates, suffix.drop_repeats, mixing.mix, F.col))


def test_mix_by_row(spark):
    """Rows that share an id but differ in source or size have a plan each."""
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, 3, None]), " ".join("w" for _ in range(rng.randrange(0, 30))), rng.choice(["a", "b", None])) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {(r.doc_id, r.source, r.size): r.copies for r in mixing.mix_plan(docs).collect()}
    want = Counter()
    for doc_id, text, source in rows:
        size = len(text.split())
        want[doc_id, text, source] += 1 if size == 0 else plan[doc_id, source, size]
    assert Counter(tuple(r) for r in mixing.mix(docs).collect()) == +want


def test_other_operators_let_go_of_tokenizers():
    """A worker that goes on with another operator keeps no tokenizer and none of its words."""
    bpe.tokenizer(WORD).digests("some words")
    token_file.tokenizer(BYTE).encode("some words")
    assert common.kept_in_worker(len)("abc") == 3
    common.forget()
    assert bpe.tokenizer.cache_info().currsize == token_file.tokenizer.cache_info().currsize == 0
