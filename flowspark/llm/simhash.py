"""Near duplicates by SimHash fingerprints and ball hashing, and beyond a few bits by similar shingle sets."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import give_back, release, stage
from flowspark.llm.components import components

BITS = 64
SEED = 42
#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 16
#: Texts from which the order of shingles is taken, holders among them that make a shingle common, and common shingles known.
SAMPLED = 10_000
LEAST_HELD = 4
MOST_COMMON = 1 << 18
#: Texts of a bucket that are compared with the others of the bucket in one block.
CROWD = 512
#: Lots in which shingles are dealt over the executors: their disks hold the shuffle of one.
LOTS = 4
#: A sketch has 2 to one of these powers counts, one for 4 to 8 shingles.
SKETCH_BITS = (4, 16)


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of one text: the majority of each bit over the XXH64 of all its shingles, repeats included.

    Words are runs without ASCII white space, A-Z in lower case. Fewer words than a shingle
    has are one shingle; no words give 0.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    else:
        spans = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        block = hashes[i : i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, fp long")


def ball_links(nodes: DataFrame, half: int = 1) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) that connect all within 2 * ``half`` bits.

    Every fingerprint emits all variants within ``half`` bits of it; two fingerprints within
    2 * ``half`` bits share one, and two that share one are that close. So the members
    of a variant form a clique, for which links to its least member are enough. A variant has
    no more members than a ball has points (65 for one bit), whatever the data.
    """
    if half not in (0, 1):
        raise ValueError("half must be 0 or 1")
    masks = [0] + [1 << b for b in range(BITS)] * half
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    variants = nodes.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    variants = variants.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))
    pairs = variants.withColumn("a", least).filter("a != fp").select("a", F.col("fp").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2 * half)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, half: int = 1) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Documents link at ``2 * half`` differing bits or fewer; a component is named after its
    smallest id. Equal fingerprints become one node first, so a group of copies of any size
    costs one node. Texts without words have fingerprint 0 and are linked like any other.
    A null id is never a component's name unless all its members' ids are null.
    """
    prints = stage(fingerprints(docs, doc_id, text, words))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(ball_links(nodes, half)).withColumnsRenamed({"node": "fp", "component": "root"})
    nodes = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- similarity beyond a few bits: shingle sets, an exact prefix join ---


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Hashes of the distinct shingles of one text; fewer words than a shingle has are one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    else:
        spans = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))


def prefix_size(size: int, similarity: float) -> int:
    """How many of a set's elements, in an order common to all sets, must hold the first one shared with any set so similar."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def sketch(hashes: np.ndarray) -> np.ndarray:
    """How many of distinct hashes have each leading digit; the more hashes, the more digits."""
    bits = min(max(int(hashes.size).bit_length() - 3, SKETCH_BITS[0]), SKETCH_BITS[1])
    return np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint32)


def most_common(x: np.ndarray, y: np.ndarray) -> int:
    """No two sets with these sketches have more elements in common."""
    few = min(x.size, y.size)
    return int(np.minimum(x.reshape(few, -1).sum(axis=1), y.reshape(few, -1).sum(axis=1)).sum())


class Order:
    """An order of shingles: those that many texts hold come last, the others by their hash."""

    def __init__(self, common: np.ndarray, holders: np.ndarray):
        at = np.argsort(common)
        self.common, self.holders = common[at], holders[at]

    def first(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` of distinct hashes."""
        held = np.zeros(hashes.size, np.int64)
        if self.common.size:
            at = np.minimum(np.searchsorted(self.common, hashes), self.common.size - 1)
            held = np.where(self.common[at] == hashes, self.holders[at], 0)
        return hashes[np.lexsort((hashes, held))[:n]]


def _shingle_order(base: DataFrame, texts: int, words: int) -> Order:
    """Shingles that several of ``SAMPLED`` texts hold go to the end; any order gives the same groups, this one small buckets."""

    def run(batches):
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(t.as_py(), words).view(np.int64))], names=["shingle"])
            give_back()

    sample = base.filter(F.pmod(F.col("tid"), F.lit(max(1, texts // SAMPLED))) == 0).dropDuplicates(["tid"]).select("text")
    held = sample.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_HELD)
    rows = held.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).collect()  # MOST_COMMON rows
    return Order(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64))


def _print_links(prints: DataFrame, half: int) -> DataFrame:
    """Pairs ``a``, ``b`` of texts that connect all whose fingerprints (``tid``, ``fp``) link; equal fingerprints are one node."""
    nodes = stage(prints.groupBy("fp").agg(F.min("tid").alias("least")))
    name = lambda side: nodes.select(F.col("fp").alias(side), F.col("least").alias(f"_{side}"))
    near = ball_links(nodes, half).join(name("a"), "a").join(name("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    alike = prints.join(nodes, "fp").filter("tid != least").select(F.col("least").alias("a"), F.col("tid").alias("b"))
    return near.union(alike)


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, half: int | None = None, print_words: int = 3
) -> DataFrame:
    """``doc_id`` and ``component_id`` of every row: documents linked by equal texts or shingle sets with a Jaccard of ``similarity`` or more.

    With ``half``, texts with words also link where the SimHash of their shingles of ``print_words`` words differs in ``2 * half`` bits
    or fewer (``ball_links``). These links come first; the sets are then compared for texts that fingerprints have not put into one group.

    Exact: in an order common to all texts, the first shingle that two so similar sets share is among the first
    ``prefix_size`` of both, so texts meet in the buckets of these shingles. In each bucket all are first
    compared with the least one; then those of a bucket that are not yet in one group are compared all with all, in blocks, but for
    pairs that their sizes and places in the order rule out. A pair counts when its whole shingle sets (64-bit hashes) are that similar; only pairs
    whose sketches, counts of hashes by leading digits, leave that possible have their sets sent (``most_common`` is never too low). Equal
    texts are one node from the start. Texts without words are linked to equal texts only, and so are texts of which no row has
    an id. An id names one text; texts with one id are one node.
    """
    body = F.col(text)
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("tid"), body.alias("text"))
    prints = stage(base.select("doc_id", "tid"))
    nodes = stage(prints.groupBy("tid").agg(F.min("doc_id").alias("node")))  # a text is known by its smallest id
    named = base.filter("doc_id is not null")
    shared = docs.sparkSession.sparkContext.broadcast(_shingle_order(named, nodes.count(), words))  # MOST_COMMON shingles

    def prefixes(batches):
        order = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            found = [shingle_hashes(t, words) for t in texts]
            heads = [order.first(h, prefix_size(h.size, similarity)).view(np.int64) for h in found]
            heads = [h if f.size else h[:0] for h, f in zip(heads, found)]
            bits = np.array([0 if half is None else fingerprint(t, print_words) for t in texts], np.uint64).view(np.int64)
            columns = [batch.column(0), pa.array([h.size for h in found], pa.int32()), pa.array(heads, pa.list_(pa.int64())), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(columns, names=["tid", "size", "head", "fp"])
            give_back()

    heads = named.select("tid", "text").mapInArrow(prefixes, "tid long, size int, head array<long>, fp long").filter("size > 0")
    heads = stage(heads.groupBy("tid").agg(F.first(F.struct("size", "head", "fp")).alias("x")).select("tid", "x.size", "x.head", "x.fp"))
    near = None if half is None else stage(components(_print_links(heads.select("tid", "fp"), half)))
    met = heads.select("tid", "size", F.posexplode("head").alias("pos", "shingle"))
    lots = []
    for lot in range(LOTS):
        part = met.filter(F.pmod("shingle", F.lit(LOTS)) == lot)
        tally = part.groupBy("shingle").agg(F.count("*").alias("n"), F.min(F.struct("tid", "size", "pos")).alias("least"))
        often = stage(tally.filter("n > 1"))
        lots.append(stage(part.join(often, "shingle")))
        release(often)
    met = functools.reduce(DataFrame.union, lots)
    release(heads)

    def possible(x: str, y: str) -> Column:
        """Whether sets of these sizes whose first common shingle has these places can be similar."""
        size = lambda s: F.col(f"{s}.size")
        most = 1 + F.least(*[size(s) - F.col(f"{s}.pos") - 1 for s in (x, y)])
        return (F.least(size(x), size(y)) + 1e-6 >= F.greatest(size(x), size(y)) * similarity) & (most + 1e-6 >= (size(x) + size(y)) * (similarity / (1 + similarity)))

    def described(describe):
        """Bytes that describe the shingles of each text."""

        def run(batches):
            for batch in batches:
                found = [describe(shingle_hashes(t.as_py(), words)).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["tid", "about"])
                give_back()

        return run

    def agreeing(kind, sizes):
        """Pairs that are similar as ``sizes`` (of both and what they share) says of what describes them."""

        def run(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    in_x, in_y, common = sizes(np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind))
                    keep.append(common + 1e-9 >= similarity * (in_x + in_y - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return run

    def whole(x, y):
        return x.size, y.size, np.intersect1d(x, y, assume_unique=True).size

    def at_most(x, y):
        return int(x.sum()), int(y.sum()), most_common(x, y)

    def apart(pairs: DataFrame) -> DataFrame:
        """The pairs that fingerprints have not put into one group."""
        for side in ("a", "b"):
            part = near.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
            pairs = pairs.join(part, side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
        return pairs.filter("_a != _b").select("a", "b")

    def filtered(pairs: DataFrame, describe, kind, sizes) -> DataFrame:
        """The stored ``pairs`` that ``sizes`` leaves of what ``describe`` says of their texts."""
        wanted = nodes.join(pairs.select(F.col("a").alias("tid")).union(pairs.select("b")).distinct(), "tid", "left_semi")
        wanted = wanted.select(F.col("tid").alias("_tid"), "node")
        texts = named.join(wanted, (F.col("tid") == F.col("_tid")) & (F.col("doc_id") == F.col("node")), "left_semi")
        about = stage(texts.select("tid", "text").mapInArrow(described(describe), "tid long, about binary").dropDuplicates(["tid"]))
        both = pairs.join(about.select(F.col("tid").alias("a"), F.col("about").alias("x")), "a")
        both = both.join(about.select(F.col("tid").alias("b"), F.col("about").alias("y")), "b").select("a", "b", "x", "y")
        found = stage(both.mapInArrow(agreeing(kind, sizes), "a long, b long"))
        release(pairs, about)
        return found

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs ``a``, ``b`` of texts whose whole sets are similar."""
        return filtered(filtered(stage(pairs.distinct()), sketch, np.uint32, at_most), lambda hashes: hashes, np.uint64, whole)

    one = met.select("least", F.struct("tid", "size", "pos").alias("other")).filter("least.tid != other.tid").filter(possible("least", "other"))
    one = one.select(F.col("least.tid").alias("a"), F.col("other.tid").alias("b"))
    links = similar(one) if near is None else similar(apart(one.distinct())).union(near.select(F.col("node").alias("a"), F.col("component").alias("b")))
    grouped = components(links).withColumnsRenamed({"node": "tid", "component": "part"})
    rest = met.filter("n > 2 and least.tid != tid").join(grouped, "tid", "left").withColumn("part", F.coalesce("part", "tid"))
    unlinked = stage(rest.select("shingle", "tid", "size", "pos", "part"))
    release(*lots)
    mixed = unlinked.groupBy("shingle").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high")
    rest = stage(unlinked.join(mixed.select("shingle", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks")), "shingle"))
    release(unlinked)
    x = rest.select("shingle", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int").alias("block"), F.struct("tid", "size", "pos", "part").alias("x"))
    y = rest.select("shingle", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.struct("tid", "size", "pos", "part").alias("y"))
    on = (x["shingle"] == y["shingle"]) & (x["block"] == y["block"]) & (F.col("x.tid") < F.col("y.tid")) & (F.col("x.part") != F.col("y.part"))
    more = similar(x.join(y, on & possible("x", "y")).select(F.col("x.tid").alias("a"), F.col("y.tid").alias("b")))
    release(rest)

    name = lambda side: nodes.select(F.col("tid").alias(side), F.col("node").alias(f"_{side}"))
    links = links.union(more).join(name("a"), "a").join(name("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    rooted = nodes.join(components(links), "node", "left").select("tid", F.coalesce("component", "node").alias("component_id"))
    return prints.join(rooted, "tid").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", half: int | None = 1, **options) -> DataFrame:
    """The rows of ``docs`` whose id names their group: one document of each. Repeats of an id count as one document.

    Texts link by SimHash fingerprints within ``2 * half`` bits, and those further apart by shingle sets (``similar_groups``).
    """
    found = similar_groups(docs, doc_id, text, half=half, **options)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col("_id")), "left_semi")
