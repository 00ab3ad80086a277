"""Token ids in a compressed binary file: an adaptive context-mixing range coder.

A file is a table of frames. A frame holds the ids of consecutive documents, cut into blocks
of ``BLOCK`` ids that are coded apart: each starts from an empty model and has its own
checksum. All blocks of a frame advance together, one id each, as numpy lanes.

For each id the two ids that followed the same two ids (order 2) and the same id
(order 1) last time are tried first: the chance of a hit is a mix of two adaptive
estimates, one by the confidence of either order, whose weights follow their errors. Ids that
neither predicts are coded by half bytes under adaptive order-0 frequencies.

Payload, little endian: ``MAGIC``, half bytes per id (u32), documents (u32), ids (u64), blocks (u32), ids of each document (u32),
digits (u32) and CRC-32 of the ids (u32) of each block, digits (u16).
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.llm.bpe import Memory
from flowspark.llm.common import give_back, kept_in_worker
from flowspark.session import shared_path

MAGIC = b"IDS1"
BLOCK = 4096
#: Ids in a frame, and the bytes of text that make about as many.
FRAME = 1 << 22
FRAME_TEXT = 12 << 20
ONE = 1 << 15
LOW_P, HIGH_P = 64, ONE - 64
#: Speed of adaptation by half byte: deep contexts are rare and learn fast.
RATES = (5, 4, 3, 2)
CONTEXTS = 4096
_PULL = np.array([[i if i <= s else ONE - 16 + i for i in range(16)] for s in range(16)], np.int16)


class _Writer:
    """Range encoder for many lanes; digits may carry into the ones before until ``finish``."""

    def __init__(self, lanes: int, room: int, ids: np.ndarray):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 1 << 32, np.uint64)
        self.out = np.zeros((lanes, room), np.uint32)
        self.used = np.zeros(lanes, np.int64)
        self.ids = ids

    def _narrow(self, lanes: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        unit = self.range[lanes] >> np.uint64(15)
        low = self.low[lanes] + unit * start.astype(np.uint64)
        wide = unit * width.astype(np.uint64)
        small = np.flatnonzero(wide < 1 << 16)
        if small.size:
            at = lanes[small]
            if self.used.max() + 2 >= self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
            self.out[at, self.used[at]] = low[small] >> np.uint64(16)
            self.used[at] += 1
            low[small] = (low[small] & np.uint64(0xFFFF)) << np.uint64(16)
            wide[small] <<= np.uint64(16)
        self.low[lanes], self.range[lanes] = low, wide

    def bit(self, lanes, chance, value):
        start, width = np.where(value, 0, chance), np.where(value, chance, ONE - chance)
        self._narrow(lanes, start, width)
        return value

    def half(self, lanes, starts, value):
        rows = np.arange(lanes.size)
        start = starts[rows, value].astype(np.int32)
        end = np.where(value == 15, ONE, starts[rows, np.minimum(value + 1, 15)].astype(np.int32))
        self._narrow(lanes, start, end - start)
        return value

    def finish(self) -> list[np.ndarray]:
        lanes = np.arange(self.low.size)
        self.out = np.concatenate([self.out, np.zeros((lanes.size, 2), np.uint32)], axis=1)
        self.out[lanes, self.used] = self.low >> np.uint64(16)
        self.out[lanes, self.used + 1] = self.low & np.uint64(0xFFFF)
        self.used += 2
        for i in range(int(self.used.max(initial=0)) - 1, 0, -1):
            self.out[:, i - 1] += self.out[:, i] >> 16
            self.out[:, i] &= 0xFFFF
        return [self.out[i, : self.used[i]].astype(np.uint16) for i in lanes]


class _Reader:
    """Range decoder for many lanes."""

    def __init__(self, digits: list[np.ndarray]):
        lanes = len(digits)
        self.data = np.zeros((lanes, max(map(len, digits), default=0) + 4), np.uint64)
        for i, d in enumerate(digits):
            self.data[i, : len(d)] = d
        self.code = self.data[:, 0] << np.uint64(16) | self.data[:, 1]
        self.used = np.full(lanes, 2)
        self.range = np.full(lanes, 1 << 32, np.uint64)

    def _narrow(self, lanes, code, unit, start, width):
        code = code - unit * start.astype(np.uint64)
        wide = unit * width.astype(np.uint64)
        small = np.flatnonzero(wide < 1 << 16)
        if small.size:
            at = lanes[small]
            place = np.minimum(self.used[at], self.data.shape[1] - 1)
            code[small] = code[small] << np.uint64(16) | self.data[at, place]
            self.used[at] += 1
            wide[small] <<= np.uint64(16)
        self.code[lanes], self.range[lanes] = code, wide

    def bit(self, lanes, chance, _):
        unit, code = self.range[lanes] >> np.uint64(15), self.code[lanes]
        value = code < unit * chance.astype(np.uint64)
        self._narrow(lanes, code, unit, np.where(value, 0, chance), np.where(value, chance, ONE - chance))
        return value

    def half(self, lanes, starts, _):
        unit, code = self.range[lanes] >> np.uint64(15), self.code[lanes]
        # both are whole numbers below 2^33, so the quotient's floor is exact
        place = np.minimum(code.astype(np.float64) / unit.astype(np.float64), ONE - 1).astype(np.int16)
        below = (starts <= place[:, None]).view(np.uint64) * np.uint64(0x0101010101010101) >> np.uint64(56)  # eight flags each
        value = (below[:, 0] + below[:, 1]).astype(np.int64) - 1
        rows = np.arange(lanes.size)
        start = starts[rows, value].astype(np.int32)
        end = np.where(value == 15, ONE, starts[rows, np.minimum(value + 1, 15)].astype(np.int32))
        self._narrow(lanes, code, unit, start, end - start)
        return value


def _code(coder, lanes: int, ids: int, halves: int, known: np.ndarray | None) -> np.ndarray:
    """Drive ``coder`` through all blocks; ``known`` are the ids when encoding. All blocks but the last are full."""
    out = np.zeros((lanes, BLOCK), np.int64) if known is None else known
    last = ids - (lanes - 1) * BLOCK
    guess2, sure2 = np.full((lanes, 4096), -1, np.int32), np.zeros((lanes, 4096), np.int8)
    guess1, sure1 = np.full((lanes, 1024), -1, np.int32), np.zeros((lanes, 1024), np.int8)
    hit2, hit1, alone1 = (np.full((lanes, 17), ONE // 2, np.int32) for _ in range(3))
    weight = np.full(lanes, 16, np.int32)
    room = [min(16**j, CONTEXTS) for j in range(halves)]
    order0 = [np.tile(np.arange(16, dtype=np.int16) * (ONE // 16), (lanes * r, 1)) for r in room]
    before1, before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    every = np.arange(lanes)
    for t in range(min(ids, BLOCK)):
        lane = every if t < last else every[:-1]
        n = lane.size
        real = None if known is None else known[:n, t]
        b1, b2 = before1[:n], before2[:n]
        slot2 = ((b1 * 40503 + b2 * 60493) >> 4) & 4095
        slot1 = ((b1 * 40503) >> 6) & 1023
        g2, s2 = guess2[lane, slot2], sure2[lane, slot2]
        g1, s1 = guess1[lane, slot1], sure1[lane, slot1]
        found = np.full(n, -1, np.int64)
        # order 2, with the support that order 1 gives it
        asked = np.flatnonzero(g2 >= 0)
        if asked.size:
            who, c2 = lane[asked], s2[asked]
            c1 = np.where(g1[asked] == g2[asked], s1[asked] + 1, 0)
            p2, p1, w = hit2[who, c2], hit1[who, c1], weight[who]
            chance = np.clip((w * p2 + (32 - w) * p1) >> 5, LOW_P, HIGH_P)
            value = coder.bit(who, chance, None if real is None else real[asked] == g2[asked])
            goal = np.where(value, ONE, 0)
            better = np.abs(goal - p2) <= np.abs(goal - p1)
            weight[who] = np.where(better, w + ((32 - w) >> 3), w - (w >> 3))
            hit2[who, c2] = p2 + ((goal - p2) >> 4)
            hit1[who, c1] = p1 + ((goal - p1) >> 4)
            hits = asked[value]
            found[hits] = g2[hits]
        # order 1, where it says something else
        asked = np.flatnonzero((found < 0) & (g1 >= 0) & (g1 != g2))
        if asked.size:
            who, c1 = lane[asked], s1[asked]
            p1 = alone1[who, c1]
            value = coder.bit(who, np.clip(p1, LOW_P, HIGH_P), None if real is None else real[asked] == g1[asked])
            alone1[who, c1] = p1 + ((np.where(value, ONE, 0) - p1) >> 4)
            hits = asked[value]
            found[hits] = g1[hits]
        # order 0, half byte by half byte
        asked = np.flatnonzero(found < 0)
        if asked.size:
            who, path = lane[asked], np.zeros(asked.size, np.int64)
            for j in range(halves):
                at = path if j <= 3 else (path * 40503 >> 3) & (CONTEXTS - 1)
                at = who * room[j] + at
                starts = order0[j].take(at, axis=0)
                value = coder.half(who, starts, None if real is None else (real[asked] >> 4 * (halves - 1 - j)) & 15)
                order0[j][at] = starts + ((_PULL.take(value, axis=0) - starts) >> RATES[min(j, 3)])
                path = path << 4 | value
            found[asked] = path
        out[:n, t] = found
        sure2[lane, slot2] = np.where(g2 == found, np.minimum(s2 + 1, 15), 0)
        sure1[lane, slot1] = np.where(g1 == found, np.minimum(s1 + 1, 15), 0)
        guess2[lane, slot2] = found
        guess1[lane, slot1] = found
        before2[:n] = b1
        before1[:n] = found
    return out


def encode_frame(documents: list[np.ndarray]) -> bytes:
    """Payload of the ids (unsigned 32 bits) of consecutive documents."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    blocks = math.ceil(ids.size / BLOCK)
    halves = max(4, (int(ids.max(initial=0)).bit_length() + 3) // 4)
    padded = np.zeros(blocks * BLOCK, np.int64)
    padded[: ids.size] = ids
    digits: list[np.ndarray] = []
    if blocks:
        writer = _Writer(blocks, BLOCK, padded)
        _code(writer, blocks, ids.size, halves, padded.reshape(blocks, BLOCK))
        digits = writer.finish()
    sums = [zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) for i in range(blocks)]
    head = MAGIC + struct.pack("<IIQI", halves, len(documents), ids.size, blocks)
    parts = [np.array([len(d) for d in documents], "<u4"), np.array([len(d) for d in digits], "<u4"), np.array(sums, "<u4")]
    return head + b"".join(p.tobytes() for p in parts) + b"".join(d.astype("<u2").tobytes() for d in digits)


def decode_frame(payload: bytes) -> list[np.ndarray]:
    """The documents' ids again; a block whose checksum differs is an error."""
    if payload[:4] != MAGIC:
        raise ValueError("not a frame of token ids")
    halves, documents, n, blocks = struct.unpack_from("<IIQI", payload, 4)
    at = 4 + struct.calcsize("<IIQI")
    lengths = np.frombuffer(payload, "<u4", documents, at)
    sizes = np.frombuffer(payload, "<u4", blocks, at + 4 * documents)
    sums = np.frombuffer(payload, "<u4", blocks, at + 4 * (documents + blocks))
    digits = np.frombuffer(payload, "<u2", int(sizes.sum()), at + 4 * (documents + 2 * blocks))
    ids = np.zeros(0, np.uint32)
    if blocks:
        lanes = np.split(digits, np.cumsum(sizes)[:-1].astype(np.int64))
        ids = _code(_Reader(lanes), blocks, n, halves, None).reshape(-1)[:n].astype(np.uint32)
    for i in range(blocks):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) != sums[i]:
            raise ValueError(f"block {i} is damaged")
    return np.split(ids, np.cumsum(lengths)[:-1].astype(np.int64)) if documents else []


class ByteBpe:
    """The library's byte-level encoding, each distinct piece of text encoded once while it is remembered.

    A text is cut at added tokens and by the byte-level pattern, as the library cuts it; no merge
    crosses a cut, so the ids of the pieces are the ids of the text.
    """

    #: Fixed value: the pattern of byte-level pre-tokenizers.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pattern = regex.compile(self.PATTERN)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.memory = Memory(self._piece)

    def _piece(self, piece: str) -> bytes:
        return np.array(self.library.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.added:
                parts.append(self.added[part])
            else:
                parts += map(self.memory.__getitem__, self.pattern.findall(part))
        return np.frombuffer(b"".join(parts), "<u4")


@kept_in_worker
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def write_tokens(docs: DataFrame, path: str, to: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text with the tokenizer file ``path``, add ``end_id`` and write frames in ascending ``doc_id`` order to ``to``.

    One range exchange sorts the documents (nulls first, rows of one id by text); each range becomes frames of
    ``FRAME`` ids or one document more. A null or empty text has the end id alone; no rows
    make a file without frames.
    """
    df = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(size / FRAME_TEXT))
    ordered = df.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())

    def run(batches):
        bpe, end = tokenizer(path), np.array([end_id], "<u4")
        held, names, size, frame, part, kind = [], [], 0, 0, None, None

        def flush():
            columns = [[part], [frame], [sum(map(len, held))], [names], [encode_frame(held)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(kind), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "frame", "n_ids", "doc_ids", "payload"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for name, value, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                held.append(np.concatenate([bpe.encode(value.as_py()), end]))
                names.append(name)
                size += held[-1].size
                if size >= FRAME:
                    yield flush()
                    give_back()
                    held, names, size, frame = [], [], 0, frame + 1
        if held:
            yield flush()

    kind = df.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(run, f"part int, frame int, n_ids long, doc_ids array<{kind}>, payload binary").write.parquet(to)


def read_tokens(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """Documents of a token file in file order: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (or their ``ids_crc32``)."""
    table = spark.read.parquet(path)
    heads = table.select("part", "frame", "n_ids")
    before = F.sum("n_ids").over(Window.orderBy("part", "frame")) - F.col("n_ids")
    frames = table.join(heads.select("part", "frame", before.alias("start")), ["part", "frame"]).select("start", "doc_ids", "payload")

    def run(batches):
        for batch in batches:
            for start, names, payload in zip(*(batch.column(i) for i in range(3))):
                found = decode_frame(payload.as_py())
                sizes = np.array([len(f) for f in found], np.int64)
                starts = start.as_py() + np.cumsum(sizes) - sizes
                if digests:
                    last = pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64())
                else:
                    last = pa.array([f.astype(np.int64) for f in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([names.values, pa.array(starts), pa.array(sizes), last], names=["doc_id", "start", "n_tokens", "last"])
                give_back()

    kind = table.schema["doc_ids"].dataType.elementType.simpleString()
    out = frames.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, last {'long' if digests else 'array<long>'}")
    return out.withColumnRenamed("last", "ids_crc32" if digests else "ids")


def token_file(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write a token file of ``docs`` to the shared folder and return what it holds: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    to = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, to, end_id)
    return read_tokens(docs.sparkSession, to, digests=True)
