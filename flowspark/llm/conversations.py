"""Repair of conversation structure at least cost.

A conversation is damaged rows in the order of their turns; its repair is a path through a small automaton of roles. A path's weight is one
big integer: its high digits are the cost, its low digits, one of fixed width per position, the letters of the edits, with
zeros after the last one. The least integer is therefore the cheapest path, and of those the one whose letters come first.

Rows are dealt over tasks by range of (conversation, turn, role, text) and cut into blocks of bounded length, so a conversation of any
size is worked on by many tasks. A block of a longer conversation keeps the least weight for each pair of states it may be entered and
left in; these small tables are then linked per conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowspark.llm.common import SPACE_CHARS, give_back, stage

#: Rows of a block.
BLOCK = 256

# Costs of the edits, and the edits' letters in ASCII order; a letter's digit is its place from 1.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = "DIKR"
DIGIT = {letter: place for place, letter in enumerate(LETTERS, start=1)}
BITS = 3
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Where a row whose role begins with a letter leads; what may not come is absent.
NEXT = {(START, "s"): SYSTEM} | {(s, "u"): USER for s in (START, SYSTEM, ASSISTANT)} | {(USER, "a"): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The only role an insertion or a rerole can give in a state.
TURN = {s: NEXT.get((s, "u"), ASSISTANT) for s in range(STATES)}
#: Insertions that complete a conversation.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}

SOUND, BLANK, DUPLICATE, CUT = range(4)


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows after damage, equal ones as one with their number.

    What happens to a row follows from the CRC-32 of ``conv_id:turn`` modulo 20, nulls written as one space: 0 drops it, 1
    empties its text, 2 takes ``. ! ?`` out of it, 3 repeats it, 4 makes it a user's. A conversation all of whose rows are dropped
    keeps a row with 0 copies.
    """
    c, t = F.col("conv_id"), F.col("turn")
    named = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    written = F.concat(F.coalesce(c.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(t.cast("string"), F.lit(" ")))
    hit = named.withColumn("_hit", F.crc32(written.cast("binary")) % 20)
    dropped, kind = F.col("_hit") == 0, F.col("_hit")
    rows = hit.select(
        "conv_id",
        F.when(~dropped, t).alias("turn"),
        F.when(dropped, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(dropped | (kind == 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(dropped, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def ordered_rows(damaged: DataFrame) -> DataFrame:
    """Rows of ``damage`` with ``first`` (1 where its role and text were not seen before), dealt and sorted by conversation, turn (nulls first), role, text.

    ``damaged`` is read twice. The least turn of each role and text comes from an aggregation and meets the rows in the sort, so that no
    join gathers the copies of one text.
    """
    firsts = damaged.where("copies > 0").groupBy("conv_id", "role", "text").agg(F.min(F.struct("turn")).alias("at"))
    marks = firsts.select("conv_id", "at.turn", "role", "text", F.lit(0).cast("long").alias("copies"), F.lit(1).alias("first"))
    both = damaged.select("*", F.lit(0).alias("first")).unionByName(marks)
    order = ["conv_id", "turn", "role", "text"]
    return both.repartitionByRange(*order).sortWithinPartitions(*order, "first")


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row: blank, duplicate, truncated."""
    shown = text.rstrip(SPACE_CHARS)
    if not shown:
        return BLANK
    return DUPLICATE if seen else SOUND if shown[-1] in ".!?" else CUT


def least_paths(rows: list[tuple[str, int]], entries: Iterable[int]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and letters of the best edits of ``rows`` (role, fault) for each state entered and left.

    Insertions before a row belong to it; those that end a conversation are left to ``CLOSING``. Two paths of one cost between the
    same states never begin alike to the end of one of them: rows have a letter each, and further insertions would cost
    more. So a comparison at a node holds for whatever follows.
    """
    width = BITS * (len(rows) * STATES + 1)

    def step(node: tuple[int, int], letter: str, cost: int) -> tuple[int, int]:
        weight, length = node
        return weight + (cost << width) + (DIGIT[letter] << (width - BITS * (length + 1))), length + 1

    def keep(nodes: dict[int, tuple[int, int]], state: int, node: tuple[int, int]) -> None:
        if state not in nodes or node[0] < nodes[state][0]:
            nodes[state] = node

    out = {}
    for entry in entries:
        nodes = {entry: (0, 0)}
        for role, fault in rows:
            open_nodes = nodes
            for _ in range(STATES - 1):  # more insertions in a row lead back to a state at a higher cost
                added = {}
                for state, node in open_nodes.items():
                    keep(added, TURN[state], step(node, "I", INSERT))
                fresh = {s: n for s, n in added.items() if s not in nodes or n[0] < nodes[s][0]}
                if not fresh:
                    break
                nodes = nodes | fresh
                open_nodes = fresh
            after: dict[int, tuple[int, int]] = {}
            extra = TRUNCATED if fault == CUT else 0
            for state, node in nodes.items():
                keep(after, state, step(node, "D", DELETE))
                if fault in (SOUND, CUT):
                    kept = NEXT.get((state, role[:1]))
                    if kept is not None:
                        keep(after, kept, step(node, "K", extra))
                    keep(after, TURN[state], step(node, "R", REROLE + extra))
            nodes = after
        for state, (weight, length) in nodes.items():
            digits = [(weight >> (width - BITS * (at + 1))) & (2**BITS - 1) for at in range(length)]
            out[entry, state] = weight >> width, "".join(LETTERS[d - 1] for d in digits)
    return out


def link_paths(tables: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str]]:
    """Cost of a whole conversation and the letters of each of its blocks, from the blocks' tables in order.

    The insertions that complete the conversation follow as letters of their own. Weights are the same big integers as inside a block.
    """
    width = BITS * (sum(max(len(letters) for _, letters in t.values()) for t in tables) + max(CLOSING.values()) + 1)

    def packed(letters: str) -> int:
        return int("".join(str(DIGIT[x]) for x in letters) or "0", 2**BITS)

    def longer(node: tuple[int, int], cost: int, letters: str) -> tuple[int, int]:
        weight, length = node
        length += len(letters)
        return weight + (cost << width) + (packed(letters) << (width - BITS * length)), length

    nodes, came = {START: (0, 0)}, []
    for table in tables:
        after, back = {}, {}
        for (entry, state), (cost, letters) in table.items():
            if entry in nodes:
                node = longer(nodes[entry], cost, letters)
                if state not in after or node[0] < after[state][0]:
                    after[state], back[state] = node, entry
        nodes = after
        came.append(back)
    closed = {s: longer(n, INSERT * CLOSING[s], "I" * CLOSING[s]) for s, n in nodes.items()}
    state = min(closed, key=lambda s: closed[s][0])
    cost, pieces = closed[state][0] >> width, ["I" * CLOSING[state]]
    for table, back in zip(reversed(tables), reversed(came)):
        pieces.append(table[back[state], state][1])
        state = back[state]
    return cost, pieces[::-1]


def repaired(roles: list[str], texts: list[str], letters: str, state: int = START) -> tuple[list[tuple[str, str, str]], int]:
    """The messages (role, text, edit) that ``letters`` make of the rows, entered in ``state``, and the state they leave."""
    out, at = [], 0
    for letter in letters:
        if letter == "I":
            state = TURN[state]
            out.append((ROLE[state], "", letter))
            continue
        role, text = roles[at], texts[at]
        at += 1
        if letter == "K":
            state = NEXT[state, role[:1]]
            out.append((role, text, letter))
        elif letter == "R":
            state = TURN[state]
            out.append((ROLE[state], text, letter))
    return out, state


_PATHS = "array<struct<entry:int,exit:int,cost:long,letters:string>>"
_BLOCK = (
    "part int, block int, whole boolean, roles array<string>, texts array<string>, first_turn long, last_turn long, turns long, "
    f"blank long, duplicate long, truncated long, illegal long, paths {_PATHS}, chosen string, entry int, closing string, cost long"
)


class _Segment:
    """Rows of one conversation as a task meets them, cut into blocks."""

    def __init__(self, conv, at_edge: bool, most: int):
        self.conv, self.at_edge, self.most = conv, at_edge, most
        self.blocks: list[dict] = []
        self.number = 0
        self.clear()

    def clear(self) -> None:
        self.roles, self.texts, self.faults, self.turns = [], [], [], []

    def add(self, turn, role: str, text: str, fault: int) -> dict | None:
        full = self.close() if len(self.roles) == self.most else None
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.turns.append(turn)
        return full

    def close(self, ends: bool = False) -> dict:
        """The block so far as a record. The only block of a segment off the edges is a whole conversation."""
        known = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        whole = ends and not self.number and not self.at_edge
        found = least_paths(list(zip(self.roles, self.faults)), [START] if whole else range(STATES))
        cost, (chosen, closing) = link_paths([found]) if whole else (None, (None, None))
        record = {
            "conv_id": self.conv,
            "block": self.number,
            "whole": whole,
            "roles": self.roles,
            "texts": self.texts,
            "first_turn": known[0] if known else None,
            "last_turn": known[-1] if known else None,
            "turns": len(set(known)),
            "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE),
            "truncated": self.faults.count(CUT),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "paths": [] if whole else [{"entry": e, "exit": x, "cost": c, "letters": word} for (e, x), (c, word) in found.items()],
            "chosen": chosen,
            "entry": START if whole else None,
            "closing": closing,
            "cost": cost,
        }
        self.number += 1
        self.clear()
        return record


def _by_rows(rows: Iterator[tuple], most: int) -> Iterator[dict]:
    """Block records of one task's sorted rows (conv_id, turn, role, text, copies, first).

    The first and the last conversation of a task may go on in its neighbours; they are known by the edges.
    """
    segment, started = None, False

    def flush(entry, mark):
        """The rows of one (turn, role, text): the first of them is new where the mark says so, the others are duplicates."""
        turn, role, text, copies = entry
        for at in range(copies):
            full = segment.add(turn, role, text, fault_of(text, not (mark and at == 0)))
            if full is not None:
                yield full

    pending, mark = None, False
    for conv, turn, role, text, copies, first in rows:
        if segment is None or conv != segment.conv:
            if segment is not None:
                if pending:
                    yield from flush(pending, mark)
                    pending, mark = None, False
                yield segment.close(ends=True)
            segment = _Segment(conv, not started, most)
            started = True
        if pending and pending[:3] == (turn, role, text):
            pending = (turn, role, text, pending[3] + copies)
            mark = mark or bool(first)
        else:
            if pending:
                yield from flush(pending, mark)
            pending, mark = (turn, role, text, copies), bool(first)
    if segment is not None:
        if pending:
            yield from flush(pending, mark)
        segment.at_edge = True
        yield segment.close(ends=True)


def blocks(conversations: DataFrame, most: int = BLOCK, **names: str) -> DataFrame:
    """Blocks of the damaged conversations, ``most`` rows each at most, with the least paths through them, as a stored table.

    ``whole`` blocks are complete conversations and solved; the others are ordered by ``part``, ``block`` within their conversation.
    """
    rows = ordered_rows(stage(damage(conversations, **names)))
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = rows.sparkSession.createDataFrame([], f"conv_id {kind}, {_BLOCK}").schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        part = TaskContext.get().partitionId()  # parts are ranges, in order
        stream = (tuple(row) for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        ready, size = [], 0
        for record in _by_rows(stream, most):
            ready.append(record | {"part": part})
            size += len(record["roles"]) + 1
            if size > 4096:
                yield pa.RecordBatch.from_pylist(ready, arrow)
                ready, size = [], 0
                give_back()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, arrow)

    return stage(rows.select("conv_id", "turn", "role", "text", "copies", "first").mapInArrow(run, schema))


def _table(paths: list[dict]) -> dict:
    return {(p["entry"], p["exit"]): (p["cost"], p["letters"]) for p in paths}


def _linked(cut: DataFrame) -> DataFrame:
    """``conv_id, part, block, chosen, entry, closing, cost``: the letters chosen for each block of the conversations that have several."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    tables = cut.select("conv_id", "part", "block", "paths")
    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    out = ["conv_id", "part", "block", "chosen", "entry", "closing", "cost"]
    schema = tables.sparkSession.createDataFrame([], f"conv_id {kind}, part int, block int, chosen string, entry int, closing string, cost long").schema
    arrow = to_arrow_schema(schema)

    def solve(conv, at: list, found: list):
        cost, pieces = link_paths(found)
        state = START
        for number, ((part, block), table) in enumerate(zip(at, found)):
            yield dict(zip(out, (conv, part, block, pieces[number], state, pieces[-1] if number == len(at) - 1 else "", cost)))
            state = next(x for (e, x), (_, word) in table.items() if e == state and word == pieces[number])

    def run(batches):
        conv, at, found = None, [], []
        for batch in batches:
            ready = []
            for name, part, block, paths in zip(*(column.to_pylist() for column in batch.columns)):
                if at and name != conv:
                    ready.extend(solve(conv, at, found))
                    at, found = [], []
                conv = name
                at.append((part, block))
                found.append(_table(paths))
            if ready:
                yield pa.RecordBatch.from_pylist(ready, arrow)
        if at:
            yield pa.RecordBatch.from_pylist(list(solve(conv, at, found)), arrow)

    return ordered.mapInArrow(run, schema)


def solved(found: DataFrame) -> DataFrame:
    """``blocks`` with the letters ``chosen`` for each, the state ``entry`` they begin in, and the ``closing`` insertions of a conversation's last block."""
    cut = found.where("not whole").drop("chosen", "entry", "closing", "cost")
    links = _linked(cut)
    right = links.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "part", "block")], "chosen", "entry", "closing", "cost")
    on = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block"))
    joined = cut.join(right, on).drop("_conv_id", "_part", "_block")
    return found.where("whole").unionByName(joined).drop("paths")


def messages(found: DataFrame) -> DataFrame:
    """The repaired messages: ``conv_id, part, block, at, role, text, edit``, in that order within their conversation. ``found`` is ``solved``."""
    kind = found.schema["conv_id"].dataType.simpleString()
    schema = found.sparkSession.createDataFrame([], f"conv_id {kind}, part int, block int, at int, role string, text string, edit string").schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for conv, part, block, roles, texts, chosen, entry, closing in zip(*(c.to_pylist() for c in batch.columns)):
                lines, state = repaired(roles, texts, chosen, entry)
                lines += repaired([], [], closing, state)[0]
                out.extend(dict(zip(schema.names, (conv, part, block, at, *line))) for at, line in enumerate(lines))
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
            give_back()

    return found.select("conv_id", "part", "block", "roles", "texts", "chosen", "entry", "closing").mapInArrow(run, schema)


class _Report:
    """Sums and digest of one conversation, block after block."""

    def __init__(self, conv):
        self.conv = conv
        self.sums = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = self.role = None
        self.audit, self.cost, self.empty, self.digest = [], 0, True, hashlib.sha256()

    def add(self, b: dict) -> None:
        for name in self.sums:
            self.sums[name] += b[name]
        if b["turns"]:
            # a turn that two blocks share is one
            self.sums["turns"] -= self.last == b["first_turn"]
            self.first = b["first_turn"] if self.first is None else self.first
            self.last = b["last_turn"]
        if b["roles"]:
            self.sums["illegal"] += self.role is not None and self.role + b["roles"][0][:1] not in LEGAL
            self.role = b["roles"][-1][:1]
        lines, state = repaired(b["roles"], b["texts"], b["chosen"], b["entry"])
        lines += repaired([], [], b["closing"], state)[0]
        for role, text, _ in lines:
            self.digest.update((b"" if self.empty else b"\n") + f"{role}:{text}".encode())
            self.empty = False
        self.audit += [b["chosen"], b["closing"]]
        self.cost = b["cost"]

    def row(self) -> dict:
        gaps = self.last - self.first + 1 - self.sums["turns"] if self.first is not None else 0
        sums = {name: self.sums[name] for name in ("blank", "duplicate", "truncated", "illegal")}
        fits = gaps < 2**63
        return {"conv_id": self.conv, "gaps": gaps if fits else None, **sums, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def report(found: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, a row per conversation. ``found`` is ``solved``.

    Conversations in one block are reported where they are. The blocks of the others are sorted by conversation and read one after the
    other: a digest has an order, but no more than a batch of blocks is held at a time.
    """
    columns = ["conv_id", "roles", "texts", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "chosen", "entry", "closing", "cost"]
    kind = found.schema["conv_id"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    schema = found.sparkSession.createDataFrame([], f"conv_id {kind}, {counts}, audit string, repaired_sha256 string").schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        current = None
        for batch in batches:
            ready = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                b = dict(zip(columns, values))
                if current is None or current.conv != b["conv_id"]:
                    if current is not None:
                        ready.append(current.row())
                    current = _Report(b["conv_id"])
                current.add(b)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, arrow)
            give_back()
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.row()], arrow)

    alone = found.where("whole").select(*columns)
    cut = found.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select(*columns)
    return alone.mapInArrow(run, schema).unionByName(cut.mapInArrow(run, schema))


def repair(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = BLOCK
) -> DataFrame:
    """Damage, then repair every conversation; ``report`` and ``messages`` read the result.

    Nulls in role and text are one space; a null conversation is one of its own; rows of one turn are ordered by role and text. Equal
    rows are duplicates of the first of them. A role without letters is legal nowhere, so its row is reroled or deleted. Other
    columns are not read. An empty table gives an empty result.
    """
    return stage(solved(blocks(conversations, most, conv_id=conv_id, turn=turn, role=role, text=text)))
