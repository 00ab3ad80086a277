"""What is sent and remembered for large inputs."""

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, words
from pyspark.sql import functions as F
from test_duplicates import plain_repeats

from flowspark.llm import bpe, simhash, suffix
from flowspark.session import staged


def test_sketches_never_rule_out_too_much():
    rng = np.random.default_rng(3)
    for size, other in [(0, 5), (1, 1), (40, 45), (300, 260), (3000, 5000), (70000, 60000)]:
        pool = np.unique(rng.integers(0, 2**64, 2 * (size + other), np.uint64))
        x, y = (np.sort(rng.choice(pool, n, replace=False)) for n in (size, other))
        common = np.intersect1d(x, y).size
        bound = simhash.most_common(simhash.sketch(x), simhash.sketch(y))
        assert common <= bound <= min(size, other) and bound == simhash.most_common(simhash.sketch(y), simhash.sketch(x))
    assert simhash.most_common(simhash.sketch(x), simhash.sketch(x)) == x.size


def test_sets_of_texts_that_are_not_alike_stay_where_they_are(spark, monkeypatch):
    rng, rows = random.Random(5), []
    for i in range(40):  # pairs that share half of their words, then pairs that share nearly all
        half = words(rng, 100 if i < 20 else 190, 10**6)
        rows += [(4 * i + k, half + " " + words(rng, 100 if i < 20 else 10, 10**6)) for k in range(2)]
    sent, stage = [], simhash.stage

    def spy(df):
        out = stage(df)
        sent.extend([len(r[0]) for r in out.select(out.columns[-1]).collect()] if dict(out.dtypes).get(out.columns[-1]) == "binary" else [])
        return out

    monkeypatch.setattr(simhash, "stage", spy)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: (i if i < 80 else i // 4 * 4) for i, _ in rows}
    assert sum(n > 1000 for n in sent) == 40  # whole sets, 8 bytes for each shingle: of the similar texts only


def test_automaton_reads_each_symbol_once():
    own = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    state, read = own.merges.state(""), ""
    for symbol in "internationalizations" * 3:
        state, read = state[symbol], read + symbol
        for found, table in ((state.inner, own.merges.inner), (state.final, own.merges.final)):
            want = [(table[read[i:]], len(read) - i) for i in range(len(read)) if read[i:] in table]
            assert [(token, size) for token, size, _ in found] == want


def passages(spark):
    rng = random.Random(12)
    passage = words(rng, 20)
    rows = [(i, words(rng, 20) + (" " + passage if i % 3 else "")) for i in range(30)]
    return spark.createDataFrame([*rows, (40, rows[0][1]), (41, rows[0][1])], "doc_id long, text string"), passage


def stored_since(spark, before):
    """Columns of the stored tables that are new and hold rows, and the values of their stored parts."""
    paths = [Path(p.split(":")[-1]) for p in staged() if p not in before]
    files = [f for p in paths for f in p.rglob("*.parquet")]
    found = {tuple(spark.read.parquet(str(f)).columns) for f in files if spark.read.parquet(str(f)).count()}
    return found, {f.parent.name for f in files if "=" in f.parent.name}


def test_contexts_go_before_the_texts_are_cut(spark):
    docs, _ = passages(spark)
    before = staged()
    found = suffix.repeats(docs)
    columns, parts = stored_since(spark, before)
    assert ("shard", "number", "mask") in columns and parts == {"kind=1"}
    assert found.filter("n_removed > 0").count() == 19 + 2


def test_shards_grow_before_their_number_does():
    for size in (1 << 20, 1 << 30, 10 << 30, 50 << 30):
        shards, buckets = suffix._shards(size)
        assert size / shards <= 6 << 20 and size / buckets <= 16 << 20
        assert size / (shards * buckets) > (1500 if size > 1 << 20 else 0)  # text behind what a shard sends to a bucket


def test_only_keys_that_fill_a_shard_are_merged(monkeypatch):
    rng = np.random.default_rng(4)
    keys, contexts = np.repeat(np.arange(60), 5), [bytes(rng.integers(97, 99, 60).astype(np.uint8)) for _ in range(300)]
    ids, merged, merge = rng.integers(0, 9, 300), [], suffix.merge_shards
    monkeypatch.setattr(suffix, "merge_shards", lambda shards: merged.append(len(shards)) or merge(shards))
    whole = suffix.repeated_masks(keys, contexts, ids)
    assert np.array_equal(suffix.repeated_masks(keys, contexts, ids, 1000), whole) and not merged
    assert np.array_equal(suffix.repeated_masks(keys, contexts, ids, 200), whole) and set(merged) == {2}


def test_keys_of_pieces_are_spread_evenly():
    raw = np.random.default_rng(2).integers(97, 123, 1 << 20).astype(np.uint8).tobytes()
    keys = suffix._piece_key(suffix.owned_runs([raw])[3])
    shares = np.bincount((keys >> 16) * 16 >> 32, minlength=16) / keys.size
    assert keys.min() >= 0 and shares.max() < 1.1 / 16 and shares.size == 16


def test_pieces_of_the_same_few_shards_meet_in_one_bucket():
    held = {0: (0, 1), 1: (2, 3), 2: tuple(range(20))}  # shards that hold a piece
    rows = [(1000 * group + i, 1, 1 + (i == 7) * 8, s) for group, shards in held.items() for i in range(100) for s in shards] + [(9999, 1, 20, 5)]
    blob = suffix._pack(list(np.array(rows).T), [])
    got = suffix._shared(50, 15)(pa.table({"bucket": pa.array([0], pa.int32()), "blob": pa.array([blob], pa.binary())}))
    found = {s: dict(zip(k.tolist(), zip(p.tolist(), c.tolist()))) for s, (k, p, c) in zip(got["shard"].to_pylist(), (suffix._unpack(b)[0] for b in got["keys"]))}
    assert {(k, s) for s in found for k in found[s]} == {(k, s) for k, _, _, s in rows if k != 9999}  # 20 times in one text: not shared
    place = [[{found[s][1000 * group + i] for s in shards} for i in range(100)] for group, shards in held.items()]
    assert all(len(x) == 1 for group in place for x in group)  # all shards send a piece to one bucket
    place = [{at for x in group for at, _ in x} for group in place]
    assert len(place[0]) == len(place[1]) == 1 and len(place[2]) > 30
    assert {k for s in found for k, (_, c) in found[s].items() if k < 2000 and c} == {7, 1007} and {c for k, (_, c) in found[19].items()} == {1}  # by occurrences


@pytest.mark.parametrize("common", [3, 1 << 13])
def test_repeats_over_many_small_shards(spark, monkeypatch, common):
    docs = documents(spark, seed=8, n=120)
    for name, value in {"COMMON": common, "LEAST_SHARD": 1000, "TEXT_SHARD": 1500, "CONTEXT_SHARD": 3000, "SEED_SHARD": 10_000}.items():
        monkeypatch.setattr(suffix, name, value)
    lots, release = set(), suffix.release
    monkeypatch.setattr(suffix, "release", lambda *tables, part=None: lots.add(part) or release(*tables, part=part))
    got = sorted([tuple(r) for r in suffix.repeats(docs).collect()], key=str)
    assert got == plain_repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {"kind=2", "kind=3"} <= lots  # each lot of contexts goes as soon as it is decided


def test_only_the_cut_texts_are_stored_when_rows_travel(spark):
    docs, passage = passages(spark)
    before = staged()
    out = suffix.drop_repeats(docs)
    assert stored_since(spark, before) == ({("tid", "first_id"), ("_tid", "_text", "_gone")}, set())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "Aggregate" not in plan and "MapInArrow" not in plan  # texts meet rows, nothing is dealt again
    got = {r.doc_id: r.text for r in out.collect()}
    assert set(got) == set(range(30)) and passage in got[1]
    assert out.filter(F.col("text").contains(passage)).count() == 1


def test_a_task_of_the_cut_keeps_one_python_worker(spark, monkeypatch):
    docs, _ = passages(spark)
    plans, stage = [], suffix.stage
    monkeypatch.setattr(suffix, "stage", lambda df, *by: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stage(df, *by))
    suffix.drop_repeats(docs).count()
    assert [plan.count("InArrow") for plan in plans[-1:]] == [1]
