"""Removal of repeated passages: suffix arrays per shard, common prefixes, merging by binary search.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id. The work on all documents is in three rounds:

1. *Candidates.* Every string of ``LENGTH`` bytes is owned by its least ``SEED`` bytes long piece (by
   hash, leftmost first). Equal strings own equal pieces, so a piece that occurs in one text only rules
   out all the strings it owns. This says where to look and decides nothing.
2. *Contexts.* For each shared piece a text gives the bytes of the strings the piece owns (16
   strings on average, 65 bytes), once per shard of texts. Pieces that the same few shards hold are decided
   together, so that contexts which overlap in a text are packed side by side.
3. *Suffix shards.* Contexts meet by piece. Different contexts of a piece are joined in shards of
   bounded size; each shard gets its suffix array and common prefixes, which group equal
   strings and find the smallest id of each. Where the contexts of one piece fill several shards, their sorted
   strings are merged by binary search.

Pieces that occur very often (a common line) are not sent as contexts but string by string,
so that no key gathers an unbounded number of different contexts.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import give_back, release, stage

LENGTH = 50
SEED = 20
WINDOW = LENGTH - SEED + 1
#: Bytes hashed at once, bytes in a suffix shard.
CHUNK = 1 << 18
SUFFIX_SHARD = 1 << 19
#: Bytes of text at most in a shard of texts and for a bucket of contexts. Every shard sends to every bucket, so from ``ENOUGH`` on
#: they grow before their number does, from ``LEAST_SHARD`` on.
TEXT_SHARD = 6 << 20
CONTEXT_SHARD = 16 << 20
LEAST_SHARD = 4 << 20
ENOUGH = 64
#: Bytes of text whose pieces are compared by one task, half a million pieces or so; lots in which contexts are decided.
SEED_SHARD = 8 << 20
LOTS = 2
#: Shards that are few holders of a piece.
FEW = 8
#: Occurrences from which a piece counts as very common: contexts of fewer fit a suffix shard.
COMMON = 1 << 13
NO_ID = np.iinfo(np.int64).max
#: Bytes of text that a task gathers before it sends them or their pieces, packed by shard or bucket.
GATHERED = 16 << 20
LANES = 4096
_HASH = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MIX = [np.uint64(x | 1) for x in np.random.default_rng(11).integers(1, 1 << 63, 8, dtype=np.int64).tolist()]


# --- suffix arrays ---


def packed(codes: np.ndarray) -> np.ndarray:
    """Seven characters (9 bits each) from every position on; ``codes`` are followed by zeros."""
    n = codes.size
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = codes
    two = wide[:-1] << np.uint64(9) | wide[1:]
    four = two[:-2] << np.uint64(18) | two[2:]
    out = four[: n + 1] << np.uint64(27)
    out[: n + 1] |= (two[4 : n + 5] << np.uint64(9)) | wide[6 : n + 7]
    return out[:n]


def suffix_array(codes: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` characters at least, by Larsson-Sadakane refinement.

    ``codes`` are 1 to 256 with 0 at each text's end; a suffix ends at the 0, so
    suffixes compare within their text. Ranks start from seven characters; each round sorts the members of
    groups that are still equal by the rank of the suffix as many characters on as are known, which doubles them.
    """
    n = codes.size
    words = packed(codes) if words is None else words
    # characters behind a text's end do not count
    clean = words.copy()
    ended = np.zeros(n, bool)
    for k in range(7):
        place = np.uint64(9 * (6 - k))
        ended |= (words >> place & np.uint64(511)) == 0
        clean[ended] &= ~(np.uint64(511) << place)
    order = np.argsort(clean)
    value = clean[order]
    heads = np.concatenate(([True], value[1:] != value[:-1]))
    number = np.cumsum(heads) - 1
    bits = int(n).bit_length()
    if 3 * bits <= 63:  # equal suffixes by place: number and place in one integer sort faster than by two keys
        order = np.sort(number << bits | order) & ((1 << bits) - 1)
    else:
        order = order[np.lexsort((order, number))]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    end_of = np.flatnonzero(codes == 0)
    left = end_of[np.searchsorted(end_of, np.arange(n))] - np.arange(n)
    known = 7
    while known < depth:
        single = heads & np.concatenate((heads[1:], [True]))
        slots = np.flatnonzero(~single)
        if not slots.size:
            break
        members = order[slots]
        after = np.where(left[members] > known, rank[np.minimum(members + known, n - 1)] + 1, 0)
        own = rank[members]
        if 3 * bits <= 63:
            packs = np.sort((own << bits | after) << bits | members)
            members, after, own = packs & ((1 << bits) - 1), packs >> bits & ((1 << bits) - 1), packs >> 2 * bits
        else:
            by = np.lexsort((members, after, own))
            members, after, own = members[by], after[by], own[by]
        order[slots] = members
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])))
        heads[slots] = new
        rank[members] = np.maximum.accumulate(np.where(new, slots, 0))
        known *= 2
    return order


def common_prefixes(codes: np.ndarray, order: np.ndarray, cap: int, words: np.ndarray | None = None) -> np.ndarray:
    """Kasai's common prefix of each suffix with the one before it in ``order``, up to about ``cap``.

    Going through the text, the prefix shrinks by one at most from a suffix to the next, for
    which ``order`` must be complete (equal suffixes by place);
    ``LANES`` stretches of the text advance together, seven characters at a time.
    """
    n = codes.size
    words = packed(codes) if words is None else words
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    end_of = np.flatnonzero(codes == 0)
    left = end_of[np.searchsorted(end_of, np.arange(n))] - np.arange(n)
    prefix = np.zeros(n, np.int64)
    step = max(1, math.ceil(n / LANES))
    starts = np.arange(0, n, step)
    h = np.zeros(starts.size, np.int64)
    for t in range(step):
        here = starts + t
        if here[-1] >= n:
            here = here[:-1]
            h = h[: here.size]
            starts = starts[: here.size]
        other = before[here]
        limit = np.minimum(np.minimum(left[here], np.where(other >= 0, left[other], 0)), cap)
        h = np.minimum(np.maximum(h - 1, 0), limit)
        open_ = np.flatnonzero(h < limit)
        while open_.size:
            differ = words[here[open_] + h[open_]] ^ words[other[open_] + h[open_]]
            top = differ & ~(differ >> np.uint64(1))
            bits = np.frexp(top.astype(np.float64))[1]
            same = np.where(differ == 0, 7, (63 - bits) // 9)
            h[open_] = np.minimum(h[open_] + same, limit[open_])
            open_ = open_[(differ == 0) & (h[open_] < limit[open_])]
        prefix[here] = h
    return prefix[order]


class SuffixShard:
    """Contexts of one shard: their strings of ``LENGTH`` bytes in order, and the smallest id of each."""

    def __init__(self, contexts: list[bytes], ids: np.ndarray):
        sizes = np.array([len(c) for c in contexts], np.int64)
        raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        codes = raw.astype(np.uint16) + 1
        codes[ends] = 0
        words = packed(codes)
        order = suffix_array(codes, int(sizes.max(initial=0)) + 1, words)
        prefix = common_prefixes(codes, order, LENGTH, words)
        owner = np.repeat(np.arange(sizes.size), sizes + 1)
        whole = ends[owner[order]] - order >= LENGTH
        group = np.cumsum(prefix < LENGTH)[whole] - 1
        self.place = order[whole]
        self.owner = owner[self.place]
        self.offset = self.place - (ends[self.owner] - sizes[self.owner])
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if group.size else np.zeros(0, np.int64)
        self.group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1]))) if group.size else group
        self.least = np.minimum.reduceat(ids[self.owner], heads) if heads.size else np.zeros(0, np.int64)
        self.raw, self.heads = raw, self.place[heads]

    def sorted_strings(self) -> np.ndarray:
        """The different strings in order, for merging with other shards."""
        return _comparable(np.lib.stride_tricks.sliding_window_view(self.raw, LENGTH)[self.heads])

    def masks(self, ids: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each context a bit per string that is in a smaller document."""
        out = np.zeros(ids.size, np.uint32)
        hit = least[self.group] < ids[self.owner]
        np.bitwise_or.at(out, self.owner[hit], np.uint32(1) << self.offset[hit].astype(np.uint32))
        return out


def _comparable(strings: np.ndarray) -> np.ndarray:
    """Rows of bytes as records whose order is the order of the bytes: 7 big-endian words."""
    wide = np.zeros((strings.shape[0], 56), np.uint8)
    wide[:, :LENGTH] = strings
    words = wide.view(">u8").astype(np.uint64)
    return np.rec.fromarrays([words[:, i] for i in range(7)])


def _search(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Binary search of sorted rows ``wanted`` in sorted rows ``table``: first place not less."""
    low, high = np.zeros(wanted.size, np.int64), np.full(wanted.size, table.size)
    while True:
        open_ = np.flatnonzero(low < high)
        if not open_.size:
            return low
        middle = (low[open_] + high[open_]) // 2
        less, tied = np.zeros(open_.size, bool), np.ones(open_.size, bool)
        for name in table.dtype.names:
            a, b = table[name][middle], wanted[name][open_]
            less |= tied & (a < b)
            tied &= a == b
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)


def merge_shards(shards: list[SuffixShard]) -> list[np.ndarray]:
    """The smallest id of every shard's strings over all shards: each shard's strings are searched in the others' merged list."""
    table, least = shards[0].sorted_strings(), shards[0].least.copy()
    for shard in shards[1:]:
        strings = shard.sorted_strings()
        at = _search(table, strings)
        inside = at < table.size
        equal = inside.copy()
        equal[inside] = table[at[inside]] == strings[inside]
        np.minimum.at(least, at[equal], shard.least[equal])
        new = ~equal
        table = np.insert(table, at[new], strings[new])
        least = np.insert(least, at[new], shard.least[new])
    return [least[_search(table, s.sorted_strings())] for s in shards]


def repeated_masks(keys: np.ndarray, contexts: list[bytes], ids: np.ndarray, room: int = SUFFIX_SHARD) -> np.ndarray:
    """For each context the strings that a context of its key with a smaller id holds too; ``keys`` are sorted.

    Equal contexts of a key are one context with the smallest id. A key that has one
    context left needs no suffix array: only its later holders have repeats, all of them.
    """
    n = len(contexts)
    numbers: dict[tuple[int, bytes], int] = {}
    which = np.array([numbers.setdefault(kc, len(numbers)) for kc in zip(keys.tolist(), contexts)], np.int64)
    distinct = list(numbers)
    least = np.full(len(distinct), NO_ID)
    np.minimum.at(least, which, ids)
    starts = np.array([min(len(c) - LENGTH + 1, 32) for _, c in distinct], np.uint64)
    full = ((np.uint64(1) << starts) - np.uint64(1)).astype(np.uint32)
    masks = np.zeros(len(distinct), np.uint32)
    own = np.array([k for k, _ in distinct], np.int64)
    first = np.concatenate(([True], own[1:] != own[:-1])) if own.size else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1) if own.size else np.zeros(0, np.int64)
    # shards of bounded size; a series of shards that one key runs through is merged
    series: list[tuple[np.ndarray, SuffixShard]] = []

    def settle():
        shards = [s for _, s in series]
        found = merge_shards(shards) if len(shards) > 1 else [shards[0].least]
        for (at, shard), smallest in zip(series, found):
            masks[at] = shard.masks(least[at], smallest)
        series.clear()

    total = np.cumsum([len(distinct[i][1]) + 1 for i in several], dtype=np.int64)
    ends = np.append(np.flatnonzero(own[several[1:]] != own[several[:-1]]) + 1, several.size)
    at = 0
    while at < several.size:
        upto = max(at + 1, int(np.searchsorted(total, room + (total[at - 1] if at else 0), side="right")))
        end = int(ends[np.searchsorted(ends, upto, side="right") - 1]) if upto >= ends[0] else 0
        upto = end if end > at else upto  # only a key that fills a shard is cut
        part = several[at:upto]
        series.append((part, SuffixShard([distinct[i][1] for i in part], least[part])))
        if upto >= several.size or own[several[upto]] != own[several[upto - 1]]:
            settle()
        at = upto
    return np.where(ids > least[which], full[which], masks[which]) if n else masks


# --- candidates ---


def owned_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all strings of ``LENGTH`` bytes of the texts, by owning piece: text, first start, last start, hash of the piece."""
    out = []
    held, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text) - LENGTH + 1, 0), 1 << 22):  # long texts in stretches of starts
            part = text[begin : begin + (1 << 22) + LENGTH - 1]
            held.append((i, begin, part))
            size += len(part)
            if size >= CHUNK:
                out.append(_runs(held))
                held, size = [], 0
    if held:
        out.append(_runs(held))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _runs(parts):
    raw = np.frombuffer(b"".join([p for _, _, p in parts]), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts], np.int64)
    begins = np.cumsum(sizes) - sizes
    one = _HASH[raw]
    two = one[:-1] * _MIX[0] + one[1:]
    four = two[:-2] * _MIX[1] + two[2:]
    eight = four[:-4] * _MIX[2] + four[4:]
    sixteen = eight[:-8] * _MIX[3] + eight[8:]
    n = raw.size - SEED + 1
    hashes = sixteen[:n] * _MIX[4] + four[16 : 16 + n]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX[5]
    hashes ^= hashes >> np.uint64(32)
    # the low 24 bits hold the place, so the least value is the leftmost of equal pieces
    least = hashes & ~np.uint64(0xFFFFFF) | np.arange(n, dtype=np.uint64)
    for shift in (1, 2, 4, 8):
        least = np.minimum(least[:-shift], least[shift:])
    least = np.minimum(least[: n - WINDOW + 1], least[WINDOW - 16 : WINDOW - 16 + n - WINDOW + 1])
    piece = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    # no string reaches over a text's end
    valid = np.ones(piece.size, bool)
    for shift in range(1, LENGTH):
        ends = begins[1:] - shift
        valid[ends[ends >= 0]] = False
    owner = np.repeat(np.arange(len(parts)), sizes)[: piece.size]
    change = np.concatenate(([True], (piece[1:] != piece[:-1]) | (owner[1:] != owner[:-1]) | ~valid[:-1]))
    heads = np.flatnonzero(change & valid)
    # a run ends where the next begins or validity stops
    stop = np.flatnonzero(np.concatenate((change[1:] | ~valid[1:], [True])) & valid)
    which = owner[heads]
    numbers = np.array([i for i, _, _ in parts], np.int64)[which]
    shift = np.array([b for _, b, _ in parts], np.int64)[which] - begins[which]
    return numbers, heads + shift, stop + shift, hashes[piece[heads]]


# --- packed rows: arrays and byte strings in one compressed value ---


def _pack(arrays: list[np.ndarray], strings: list[bytes]) -> bytes:
    """Numbers lie byte by byte (all lowest bytes first), as steps where they mostly rise: so they compress best."""
    columns = [a.astype(np.int64) for a in (*arrays, np.array([len(x) for x in strings], np.int64))]
    steps = [np.diff(a, prepend=0) for a in columns]
    rising = [int(2 * (d[1:] >= 0).sum() > 1.5 * d.size) for d in steps]
    head = np.array([len(columns), *(len(a) for a in columns), *rising], np.int64)
    planes = [(d if up else a).view(np.uint8).reshape(-1, 8).T.tobytes() for a, d, up in zip(columns, steps, rising)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *planes, *strings]))


def _unpack(value) -> tuple[list[np.ndarray], list[bytes]]:
    body = zstandard.ZstdDecompressor().decompress(value.as_buffer())
    count = int(np.frombuffer(body, np.int64, 1)[0])
    lengths, rising = np.frombuffer(body, np.int64, 2 * count, 8).reshape(2, count).tolist()
    at, arrays = 8 * (1 + 2 * count), []
    for length, up in zip(lengths, rising):
        planes = np.frombuffer(body, np.uint8, 8 * length, at).reshape(8, length)
        array = np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)
        arrays.append(np.cumsum(array) if up else array)
        at += 8 * length
    ends = (at + np.cumsum(arrays.pop())).tolist()
    return arrays, [body[a:b] for a, b in zip([at, *ends], ends)]


# --- the rounds ---


def _piece_key(hashes: np.ndarray) -> np.ndarray:
    """48 bits of a piece's hash; that two pieces share a key costs a look and changes nothing. Owners have low hashes, their keys any."""
    return (((hashes >> np.uint64(16)) * _MIX[6]) & np.uint64((1 << 48) - 1)).astype(np.int64)


def _string_key(string: bytes) -> int:
    """A negative key, unlike those of pieces."""
    return -1 - (int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "big") >> 1)


def _pieces(shards: DataFrame, buckets: int) -> DataFrame:
    """Keys of all pieces that own a string, by bucket of keys: for each shard of texts the keys, how many of its texts hold each, and how often."""

    def run(batches):
        held, size = [], 0

        def flush():
            columns = [np.concatenate(x) for x in zip(*held)]
            by = np.argsort(columns[0])
            keys, *_ = columns = [x[by] for x in columns]
            edges = np.searchsorted((keys >> 16) * buckets >> 32, np.arange(buckets + 1))  # by the leading digits
            full = np.flatnonzero(edges[1:] > edges[:-1])
            blobs = [_pack([x[edges[i] : edges[i + 1]] for x in columns], []) for i in full.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts = _unpack(blob)[1]
                which, _, _, hashes = owned_runs(texts)
                keys = _piece_key(hashes)
                by = np.lexsort((which, keys))  # a piece that a text repeats is in one text
                keys, which = keys[by], which[by]
                first = np.concatenate(([True], keys[1:] != keys[:-1]))[: keys.size]
                new = np.flatnonzero(first | np.concatenate(([True], which[1:] != which[:-1]))[: keys.size])
                heads, at = np.flatnonzero(first[new]), np.flatnonzero(first)
                if heads.size:
                    held.append((keys[at], np.diff(np.append(heads, new.size)), np.diff(np.append(at, keys.size)), np.full(at.size, shard)))
                    size += sum(map(len, texts))
                if size >= GATHERED:
                    yield flush()
                    held, size = [], 0
                    give_back()
        if held:
            yield flush()
        give_back()

    return shards.select("shard", "blob").mapInArrow(run, "bucket int, blob binary")


def _shared(buckets: int, very: int):
    """Of a bucket's keys, to each shard those of its own that two texts or more hold, where their contexts meet, and whether they do ``very`` often.

    Keys that the same few shards hold meet in one bucket of ``buckets``: contexts that overlap in a text travel together and compress to little
    more than the text. Where many shards hold a key, and for strings, it is dealt by itself.
    """

    def run(table: pa.Table) -> pa.Table:
        found = [(k, *[x.astype(np.int32) for x in rest]) for k, *rest in (_unpack(blob)[0] for blob in table.column("blob"))]
        keys, texts, times, shards = (np.concatenate(x) for x in zip(*found))
        del found
        by = np.argsort(keys)
        keys, texts, times, shards = keys[by], texts[by], times[by], shards[by]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        holders = np.diff(np.append(heads, keys.size))
        mixed = (shards.astype(np.uint64) + np.uint64(1)) * _MIX[6]
        mixed = (mixed ^ mixed >> np.uint64(31)) * _MIX[7]
        together = np.add.reduceat(mixed, heads) >> np.uint64(16)
        place = (np.where(holders <= FEW, together.astype(np.int64), keys[heads]) % buckets).astype(np.int32)
        hit, common = np.add.reduceat(texts, heads) > 1, np.add.reduceat(times, heads, dtype=np.int64) >= very
        hit, common, place = (np.repeat(x, holders) for x in (hit, common, place))
        keys, shards, place, common = keys[hit], shards[hit], place[hit], common[hit]
        del by, texts, times, mixed, together, holders, hit
        by = np.argsort(shards, kind="stable")
        keys, shards, place, common = keys[by], shards[by], place[by], common[by]
        heads = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))[: shards.size])
        blobs = [_pack([keys[i:j], place[i:j], common[i:j]], []) for i, j in zip(heads.tolist(), [*heads[1:].tolist(), keys.size])]
        give_back()
        return pa.table([pa.array(shards[heads], pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "keys"])

    return run


def _packed_texts(texts: DataFrame, shards: int) -> DataFrame:
    """Texts packed by shard: a task's copies of one text travel once."""

    def run(batches):
        seen, held, size = set(), {}, 0

        def flush():
            blobs = [_pack([np.array([t for t, _ in part], np.int64)], [x for _, x in part]) for part in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

        for batch in batches:
            for tid, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if tid not in seen:
                    seen.add(tid)
                    held.setdefault(tid % shards, []).append((tid, raw.as_buffer().to_pybytes()))
                    size += len(held[tid % shards][-1][1])
                    if size >= GATHERED:
                        yield flush()
                        held, size = {}, 0
                        give_back()
        if held:
            yield flush()

    return texts.select("tid", "raw").mapInArrow(run, "shard int, blob binary")


def _shard(table: pa.Table) -> pa.Table:
    """The texts of a shard in one value, each once."""
    texts: dict[int, bytes] = {}
    for blob in table.column("blob"):
        (tids,), found = _unpack(blob)
        texts.update(zip(tids.tolist(), found))
    blob = _pack([np.array(list(texts), np.int64)], list(texts.values()))
    give_back()
    return pa.table([pa.array(table.column("shard")[:1].to_pylist(), pa.int32()), pa.array([blob], pa.binary())], names=["shard", "blob"])


_PARTS = "kind int, shard int, bucket int, blob binary"


def _contexts(buckets: int, lots: int):
    """A shard's texts and shared pieces to its distinct contexts by bucket (kind 2 and more, by lot) and the runs of its texts that have any (kind 1)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        firsts = right.column("tid").is_valid().to_numpy(zero_copy_only=False)
        known = right.filter(pa.array(firsts))
        least = dict(zip(known.column("tid").to_pylist(), known.column("id").to_pylist()))
        shared = [_unpack(blob)[0] for blob in right.filter(pa.array(~firsts)).column("keys")]
        texts: dict[int, bytes] = {}
        for blob in left.column("blob"):
            (tids,), found = _unpack(blob)
            texts.update(zip(tids.tolist(), found))
        if shared and texts:
            keys, place, common = (np.concatenate(x) for x in zip(*shared))
            by = np.argsort(keys)
            keys, place, common = keys[by], place[by], common[by] > 0
            shard = left.column("shard")[0].as_py()
            tids = sorted(texts, key=lambda t: (least[t], t))  # the first holder of a context has the smallest id
            bodies, owns = [texts[t] for t in tids], [least[t] for t in tids]
            which, first, last, hashes = owned_runs(bodies)
            piece = _piece_key(hashes)
            at = np.minimum(np.searchsorted(keys, piece), keys.size - 1)
            hit = keys[at] == piece
            which, first, last, piece, hot = which[hit], first[hit], last[hit], piece[hit], common[at[hit]]
            by = np.argsort(which, kind="stable")
            # by piece and context; strings of very common pieces by themselves, once their context is new
            numbers: dict[tuple[int, bytes] | bytes, tuple[int, int]] = {}
            held: dict[tuple[int, bytes], int] = {}
            runs: list[tuple[int, int, int, int]] = []
            for w, a, b, k, h in zip(which[by].tolist(), first[by].tolist(), last[by].tolist(), piece[by].tolist(), hot[by].tolist()):
                body, own = bodies[w], owns[w]
                context = body[a : b + LENGTH]
                if not h:
                    number, holder = numbers.setdefault((k, context), (len(numbers), own))
                    runs.append((w, a, b - a + 1, number if holder == own else -1))
                elif held.setdefault((k, context), own) != own:
                    runs.append((w, a, b - a + 1, -1))
                else:
                    for start in range(a, b + 1):
                        number, holder = numbers.setdefault(body[start : start + LENGTH], (len(numbers), own))
                        runs.append((w, start, 1, number if holder == own else -1))
            own_keys = np.array([_string_key(x) if isinstance(x, bytes) else x[0] for x in numbers], np.int64)
            ids = np.array([i for _, i in numbers.values()], np.int64)
            contexts = [x if isinstance(x, bytes) else x[1] for x in numbers]
            bucket = np.where(own_keys < 0, own_keys % buckets, place[np.minimum(np.searchsorted(keys, own_keys), keys.size - 1)])
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                at = int(bucket[part[0]])
                rows.append((2 + at % lots, shard, at, _pack([own_keys[part], part, ids[part]], [contexts[i] for i in part])))
            table = np.array(runs, np.int64).reshape(-1, 4)
            used, table[:, 0] = np.unique(table[:, 0], return_inverse=True)
            rows.append((1, shard, None, _pack([np.array([tids[w] for w in used], np.int64), *table.T], [])))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        columns = list(zip(*rows)) if rows else [[]] * 4
        give_back()
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["kind", "shard", "bucket", "blob"])

    return run


def _decide(table: pa.Table) -> pa.Table:
    """Contexts of a bucket to (shard, number, mask) where something repeats."""
    keys, numbers, ids, shards, contexts = [], [], [], [], []
    for shard, blob in zip(table.column("shard").to_pylist(), table.column("blob")):
        (k, n, i), found = _unpack(blob)
        keys.append(k), numbers.append(n), ids.append(i), shards.append(np.full(k.size, shard))
        contexts += found
    keys, numbers, ids, shards = (np.concatenate(x) for x in (keys, numbers, ids, shards))
    by = np.argsort(keys, kind="stable")
    masks = repeated_masks(keys[by], [contexts[i] for i in by], ids[by])
    hit = masks > 0
    give_back()
    columns = [shards[by][hit].astype(np.int32), numbers[by][hit].astype(np.int32), masks[hit].astype(np.int64)]
    return pa.table(columns, names=["shard", "number", "mask"])


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """Texts of a shard without their repeated bytes; ``right`` has their runs and the masks of contexts."""
    found = right.filter(right.column("number").is_valid())
    masks = dict(zip(found.column("number").to_pylist(), found.column("mask").to_pylist()))
    texts: dict[int, bytes] = {}
    for blob in left.column("blob"):
        (tids,), bodies = _unpack(blob)
        texts.update(zip(tids.tolist(), bodies))
    out: list[tuple] = []
    for blob in right.column("runs").drop_null():
        tids, which, starts, counts, numbers = _unpack(blob)[0]
        bodies = [texts[t] for t in tids.tolist()]
        edges = [None] * len(bodies)
        for w, start, count, number in zip(which.tolist(), starts.tolist(), counts.tolist(), numbers.tolist()):
            mask = (1 << count) - 1 if number < 0 else masks.get(number, 0)
            if mask and edges[w] is None:
                edges[w] = np.zeros(len(bodies[w]) + 1, np.int32)
            while mask:  # stretches of strings that follow each other
                low = (mask & -mask).bit_length() - 1
                run = (~(mask >> low) & -~(mask >> low)).bit_length() - 1
                mask &= ~(((1 << run) - 1) << low)
                edges[w][start + low] += 1
                edges[w][start + low + run - 1 + LENGTH] -= 1
        for tid, body, edge in zip(tids.tolist(), bodies, edges):
            if edge is not None:
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((tid, int(gone.sum()), spans, np.frombuffer(body, np.uint8)[~gone].tobytes()))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*out)) if out else [[], [], [], []]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["tid", "n_removed", "n_spans", "kept"])


def _cut_texts(left: pa.Table, right: pa.Table) -> pa.Table:
    """The same as text, without characters cut in half, and whether nothing is left."""
    cut = _cut(left, right)
    kept = cut.column("kept").to_pylist()
    columns = [cut.column("tid"), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), pa.array([not k for k in kept], pa.bool_())]
    give_back()
    return pa.table(columns, names=["_tid", "_text", "_gone"])


def _rows(docs: DataFrame, doc_id: str, text: str) -> dict[str, Column]:
    """The id (null: the last), the bytes, their hash and their number, of each row of ``docs``."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return {"id": F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NO_ID))), "raw": raw, "tid": F.xxhash64(raw), "n_bytes": F.octet_length(raw).cast("long")}


def _shards(size: int) -> tuple[int, int]:
    """Shards of texts and buckets of contexts for so many bytes of text."""
    wanted = max(size / ENOUGH, LEAST_SHARD)
    return tuple(max(1, math.ceil(size / min(wanted, most))) for most in (TEXT_SHARD, CONTEXT_SHARD))


def _cuts(docs: DataFrame, doc_id: str, text: str, cut: Callable, kinds: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The smallest id of each text (``tid``, ``first_id``), what ``cut`` leaves of texts of which something goes, and the stored tables that the latter is read from."""
    base = docs.select(*[c.alias(name) for name, c in _rows(docs, doc_id, text).items()])
    long_ = base.filter(F.col("n_bytes") >= LENGTH).select("tid", "raw")
    size = base.agg(F.sum("n_bytes")).first()[0] or 0
    shards, buckets = _shards(size)
    shard = F.pmod(F.col("tid"), F.lit(shards)).cast("int").alias("shard")

    # stored, so that each text is there once and the shuffle of all is gone before pieces are dealt; likewise below
    texts = stage(_packed_texts(long_, shards).groupBy("shard").applyInArrow(_shard, "shard int, blob binary"))
    pieces = _pieces(texts, max(1, math.ceil(size / SEED_SHARD)))
    shared = stage(pieces.groupBy("bucket").applyInArrow(_shared(buckets, COMMON), "shard int, keys binary"))
    least = stage(base.groupBy("tid").agg(F.min("id").alias("first_id")))
    firsts = least.select(shard, "tid", F.col("first_id").alias("id"), F.lit(None).cast("binary").alias("keys"))
    about = shared.select("shard", F.lit(None).cast("long").alias("tid"), F.lit(None).cast("long").alias("id"), "keys").unionByName(firsts)
    lots = min(LOTS, buckets)
    parts = texts.groupBy("shard").cogroup(about.groupBy("shard")).applyInArrow(_contexts(buckets, lots), _PARTS)
    parts = stage(parts, "kind")
    release(shared)
    # the disks hold the shuffle of one lot of contexts, and no lot once it is decided
    masks = []
    for kind in range(2, 2 + lots):
        lot = parts.filter(F.col("kind") == kind).select("bucket", "shard", "blob")
        masks.append(stage(lot.groupBy("bucket").applyInArrow(_decide, "shard int, number int, mask long")))
        release(parts, part=f"kind={kind}")
    runs = parts.filter("kind = 1").select("shard", F.lit(None).cast("int").alias("number"), F.lit(None).cast("long").alias("mask"), F.col("blob").alias("runs"))
    found = functools.reduce(DataFrame.union, masks).withColumn("runs", F.lit(None).cast("binary")).union(runs)
    return least, texts.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(cut, kinds), [texts, parts, *masks]


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What of each document repeats earlier ones.

    Returns ``doc_id`` (long), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256`` of
    every row. Earlier means a smaller id; null ids come
    last; rows of one id never remove from each other. Null texts are empty. A later copy of a whole text goes entirely if it
    has ``LENGTH`` bytes. Texts and pieces are told apart by 64-bit hashes, strings by their bytes.
    """
    row = _rows(docs, doc_id, text)
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *[row[c].alias(c) for c in ("tid", "n_bytes", "id")], F.sha2(row["raw"], 256).alias("sha"))
    least, cut, _ = _cuts(docs, doc_id, text, _cut, "tid long, n_removed long, n_spans long, kept binary")
    cut = cut.select("tid", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha"))
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    joined = ids.join(least.join(cut, "tid", "left"), "tid")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; rows of which nothing is left go, ``n_chars`` follows.

    Characters cut in half go with the passage. Every row is cut by its own id and text: rows that share an id, and rows whose id is null,
    keep what is theirs. What is left of a text is one for all rows that hold it, so it meets them by the text's hash: rows and cut texts travel once.
    """
    least, cut, read = _cuts(docs, doc_id, text, _cut_texts, "_tid long, _text string, _gone boolean")
    # stored, so that the packed texts and their shuffle are gone before the rows travel
    cut = stage(cut)
    release(*read)
    row = _rows(docs, doc_id, text)
    found = least.select(F.col("tid").alias("_own"), F.col("first_id").alias("_first")).join(cut, F.col("_own") == F.col("_tid"), "left").drop("_tid")
    copy = (row["id"] > F.col("_first")) & (row["n_bytes"] >= LENGTH)
    out = docs.join(found, row["tid"] == F.col("_own"), "left").filter(~F.coalesce(copy | F.col("_gone"), F.lit(False)))
    columns = {text: F.coalesce("_text", F.col(text))}
    if n_chars in docs.columns:
        columns[n_chars] = F.when(F.col("_text").isNotNull(), F.length("_text").cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars))
    return out.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
