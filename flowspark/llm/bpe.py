"""BPE as a streaming transducer: tokens leave as soon as no later symbol can change them.

The encoding of a prefix ends in exactly one token, and a token may follow another only
if merging both together gives the same two tokens back. So the last token of every
prefix follows from the last tokens of shorter ones, symbol by symbol. A token is stable
once the encodings of all prefixes that a later token can start from share it. How
far ahead that can be is a property of the merge list (``lookahead``); memory is bounded
by it and not by the length of the input.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import sys
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import give_back, kept_in_worker

#: Bytes of words and their tokens that a Python worker remembers, in each of two generations, and pairs of tokens.
REMEMBERED = 64 << 20
PAIRS = 500_000
#: Texts are normalised and cut into words in runs of about so many characters.
RUN = 1 << 18


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return [table[b] for b in range(256)]


class State(dict):
    """What the longest end of the symbols read that can begin a token tells: tokens that end here, and the state after each next symbol."""

    __slots__ = ("merges", "read", "inner", "final")

    def __init__(self, merges: Merges, read: str):
        super().__init__()
        self.merges, self.read = merges, read
        ends = [read[i:] for i in range(len(read))]  # longest first
        self.inner = tuple([merges.entry(merges.inner[e], len(e)) for e in ends if e in merges.inner])
        self.final = tuple([merges.entry(merges.final[e], len(e)) for e in ends if e in merges.final]) if merges.suffix else self.inner

    def __missing__(self, symbol: str) -> State:
        self[symbol] = found = self.merges.state(self.read + symbol)
        return found


class Merges:
    """A merge list: which tokens may stand side by side, and how far to the right that depends."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank: dict[tuple[str, str], int] = {}
        self.born: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for rank, (a, b) in enumerate(merges):
            if self.born.get(a, -1) >= rank or self.born.get(b, -1) >= rank or a + b in self.born:
                raise ValueError("a merge must follow the merges of its parts and make a new token")
            self.rank[a, b] = rank
            self.born[a + b] = rank
            self.parts[a + b] = (a, b)
        self.longest = max((len(t) - (len(suffix) if suffix and t.endswith(suffix) else 0) for t in vocab), default=1)
        self._spines: tuple[dict, dict] = ({}, {})
        self._side: dict[str, dict[str, bool]] = {}  # for each right token its left ones
        self._sides = 0
        self._states: dict[str, State] = {}
        self._whole: dict[str, bool] = {}

    def spine(self, token: str, side: int) -> list[tuple[str, float, float]]:
        """Tokens at the left (0) or right (1) edge over time: token, birth, end."""
        found = self._spines[side].get(token)
        if found is None:
            found, end, t = [], float("inf"), token
            while True:
                birth = self.born.get(t, -1)
                found.append((t, birth, end))
                if t not in self.parts:
                    break
                t, end = self.parts[t][side], birth
            self._spines[side][token] = found
        return found

    def beside(self, left: str, right: str) -> bool:
        """Whether no merge across the border of two tokens comes before those that make them.

        Of merges of one rank the leftmost goes first: a tie on the left side keeps the
        border, one on the right side breaks it.
        """
        known = self._side.setdefault(right, {})
        found = known.get(left)
        if found is None:
            found = True
            for x, x_birth, x_end in self.spine(left, 1):
                for y, y_birth, y_end in self.spine(right, 0):
                    c = self.rank.get((x, y))
                    if c is not None and x_birth < c < x_end and y_birth < c <= y_end:
                        found = False
            if self._sides >= PAIRS:
                for lefts in self._side.values():  # states hold these
                    lefts.clear()
                self._sides = 0
            known[left] = found
            self._sides += 1
        return found

    def whole(self, token: str) -> bool:
        """Whether a token's own symbols merge into it again."""
        found = self._whole.get(token)
        if found is None:
            if token in self.parts:
                a, b = self.parts[token]
                found = self.whole(a) and self.whole(b) and self._meets(a, b)
            else:
                found = len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0) == 1
            self._whole[token] = found
        return found

    def _meets(self, a: str, b: str) -> bool:
        """Whether two tokens side by side come to be and then merge."""
        own = self.rank[a, b]
        for x, x_birth, x_end in self.spine(a, 1):
            for y, y_birth, y_end in self.spine(b, 0):
                c = self.rank.get((x, y))
                if c is not None and c < own and x_birth < c < x_end and y_birth < c <= y_end:
                    return False
        return True

    @functools.cached_property
    def inner(self) -> dict[str, str]:
        return self._table(False)

    @functools.cached_property
    def final(self) -> dict[str, str]:
        return self._table(True) if self.suffix else self.inner

    def _table(self, ending: bool) -> dict[str, str]:
        """Usable tokens by their symbols."""
        found = {}
        for token in self.vocab:
            if self.suffix and token.endswith(self.suffix) != ending or not self.whole(token):
                continue
            found[token[: -len(self.suffix)] if ending else token] = token
        return found

    @functools.cached_property
    def _begun(self) -> set[str]:
        """What usable tokens begin with, from nothing to all of their symbols."""
        return {symbols[:i] for table in (self.inner, self.final) for symbols in table for i in range(len(symbols) + 1)} | {""}

    def entry(self, token: str, size: int) -> tuple[str, int, dict[str, bool]]:
        """A token, its size and what is known of the tokens to its left."""
        return token, size, self._side.setdefault(token, {})

    def state(self, read: str) -> State:
        """The state after some symbols, of which only the longest end counts that can begin a token; at most one for each such end."""
        while read not in self._begun:
            read = read[1:]
        found = self._states.get(read)
        if found is None:
            found = self._states[read] = State(self, read)
        return found

    @functools.cached_property
    def lookahead(self) -> int:
        """Symbols after a border that can decide whether it stays.

        A merge (a, b) can be undone from the right only by an earlier merge that
        takes a right edge token of b, which in turn can be undone by a still earlier
        one; the reach of a merge is b's length and the farthest reach of those.
        """
        reach_from: dict[str, int] = {}
        most = self.longest
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            reach = self._length(b) + max((reach_from.get(t, 0) for t, _, _ in self.spine(b, 1)), default=0)
            reach_from[a] = max(reach_from.get(a, 0), reach)
            most = max(most, reach)
        return most + self.longest

    def _length(self, token: str) -> int:
        return len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0)


class Encoder:
    """Transducer for one run of symbols (a word): feed symbols, get tokens once stable."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.state = merges.state("")
        self.text = ""  # symbols that are not part of a stable token
        self.last: list[tuple[str, int]] = []  # for each prefix of text: its last token and what is before it
        self.before = ""  # the last stable token
        self.farthest = 0

    def _advance(self, symbols: str, ending: bool) -> None:
        """Find the last token of every prefix that ends in ``symbols``."""
        beside, last, before, state = self.merges.beside, self.last, self.before, self.state
        self.text += symbols
        end, whole = len(last), len(self.text) if ending else 0
        for symbol in symbols:
            end += 1
            state = state[symbol]
            for token, size, lefts in state.final if end == whole else state.inner:
                if size < end:
                    left = last[end - size - 1][0]
                    if left is None:
                        continue
                elif size > end:
                    continue
                else:
                    left = before
                    if not left:
                        break
                fits = lefts.get(left)
                if fits is None:
                    fits = beside(left, token)
                if fits:
                    break
            else:
                token, size = None, 1
            last.append((token, end - size))
        self.state = state

    def _path(self, end: int) -> list[int]:
        ends = []
        while end > 0:
            ends.append(end)
            end = self.last[end - 1][1]
        return ends[::-1]

    def feed(self, symbols: str) -> list[str]:
        """Take symbols that are not the last of the word; return tokens that are stable now."""
        out = []
        step = 2 * self.merges.longest
        for i in range(0, len(symbols), step):
            if len(self.text) >= 2 * step:
                out += self._settle()
            self._advance(symbols[i : i + step], False)
        return out

    def _settle(self) -> list[str]:
        n = len(self.text)
        # a later token starts behind one of the last prefixes; what all their encodings share is stable
        common = None
        for end in range(max(1, n - self.merges.longest), n + 1):
            if self.last[end - 1][0] is None:
                continue
            path = set(self._path(end))
            common = path if common is None else common & path
        cut = max(common or {0})
        if not cut:
            return []
        self.farthest = max(self.farthest, n - cut)
        out = [self.last[end - 1][0] for end in self._path(cut)]
        self.before = out[-1]
        self.text = self.text[cut:]
        self.last = [(t, start - cut) for t, start in self.last[cut:]]
        # a prefix whose last token began before the cut can no longer be part of the encoding
        self.last = [(t if start >= 0 else None, start) for t, start in self.last]
        return out

    def finish(self, symbols: str) -> list[str]:
        """Take the last symbols of the word, one or more, and return the remaining tokens."""
        self._advance(symbols, True)
        out, end = [], len(self.text)
        while end > 0:
            token, end = self.last[end - 1]
            out.append(token)
        return out[::-1]


class Decoder:
    """Incremental decoder: feed ids, one or several, get text up to the last whole character."""

    def __init__(self, tokens: list[str], byte_level: bool):
        self.tokens, self.byte_level = tokens, byte_level
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.bytes = {c: b for b, c in enumerate(byte_symbols())} if byte_level else {}
        self.raw: dict[int, bytes] = {}
        self.first = True

    def _raw(self, token_id: int) -> bytes:
        token = self.tokens[token_id]
        self.raw[token_id] = found = bytes(self.bytes[c] for c in token) if self.byte_level else token.encode()
        return found

    def feed(self, *ids: int) -> str:
        known = self.raw
        raw = [known[i] if i in known else self._raw(i) for i in ids]
        if self.byte_level:
            return self.machine.decode(b"".join(raw))
        if ids and not self.first:  # tokens as they are, parted by spaces
            raw.insert(0, b"")
        self.first = self.first and not ids
        return self.machine.decode(b" ".join(raw))

    def finish(self) -> str:
        """The rest; another sequence may follow."""
        self.first = True
        return self.machine.decode(b"", True)


class Memory(dict):
    """What was computed for a key lately; two generations of ``size`` bytes each bound it."""

    def __init__(self, compute, size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size, self.older, self.held = compute, size, {}, 0

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.compute(key)
        if self.held >= self.size:
            self.older, self.held = dict(self), 0
            self.clear()
        # the entry, its key and what it holds
        self.held += 100 + sys.getsizeof(key) + sys.getsizeof(found) + (sum(map(sys.getsizeof, found)) if isinstance(found, tuple) else 0)
        self[key] = found
        return found


class WordBpe:
    """A tokenizer file with word ends: NFC, lower case, words by pattern, bytes, merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.vocab = dict(vocab)
        self.merges = Merges(vocab, [tuple(m) for m in model["merges"]], model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.symbols = byte_symbols()
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.tokens = [""] * size
        for token, number in [*vocab.items(), *self.added.items()]:
            self.tokens[number] = token
        self.byte_level = spec["decoder"] is not None
        self.decoder = Decoder(self.tokens, self.byte_level)
        self.memory = Memory(self._digest)

    def word_ids(self, word: str) -> list[int]:
        raw = "".join([self.symbols[b] for b in word.encode("utf-8", "surrogatepass")])
        encoder = Encoder(self.merges)
        short = 2 * self.merges.longest
        found = encoder.finish(raw) if len(raw) <= short else encoder.feed(raw[:-1]) + encoder.finish(raw[-1])
        return [self.vocab[t] for t in found]

    def _digest(self, word: str) -> tuple[int, bytes, bytes]:
        ids = [self.added[word]] if word in self.added else self.word_ids(word)
        return len(ids), " ".join(map(str, ids)).encode(), self.decode(ids).encode()

    def runs(self, text: str):
        """Words and added tokens of a text, run by run."""
        for part in self.split.split(text) if self.split else [text]:
            if part in self.added:
                yield [part]
                continue
            start = 0
            while start < len(part):
                end = start + RUN
                while end < len(part):  # cut where neither case nor composition looks across
                    end = part.find(" ", end)
                    if end < 0:
                        end = len(part)
                    elif part[end + 1 : end + 2].isascii():
                        break
                    else:
                        end += 1
                plain = unicodedata.normalize("NFC", part[start:end]).replace("Σ", "σ").lower()
                yield self.pattern.findall(plain)
                start = max(end, start + 1)

    def encode(self, text: str | None) -> list[int]:
        out = []
        for words in self.runs(text or ""):
            for word in words:
                out += [self.added[word]] if word in self.added else self.word_ids(word)
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decoder.feed(*ids) + self.decoder.finish()

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as text and SHA-256 of the decoded text, run by run."""
        count, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        between = b"" if self.byte_level else b" "  # what the decoder puts between words
        for words in self.runs(text or ""):
            if not words:
                continue
            found = list(map(self.memory.__getitem__, words))
            if count:
                ids.update(b" ")
                decoded.update(between)
            count += sum([f[0] for f in found])
            ids.update(b" ".join([f[1] for f in found]))
            decoded.update(between.join([f[2] for f in found]))
        return count, ids.hexdigest(), decoded.hexdigest()


@kept_in_worker
def tokenizer(path: str) -> WordBpe:
    """One tokenizer per Python worker; its word memory lasts as long as the worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text; a null or empty text has no ids."""

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            ids = [bpe.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``text``, the tokens of every row's ids put together again; null ids give an empty text."""

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    df = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text; return ``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Ids and decoded text exist only run by run. Null and empty texts have no tokens; rows
    repeat as they come; ids may be null. ``path`` must be readable on every executor.
    """

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            found = [bpe.digests(t.as_py()) for t in batch.column(1)]
            give_back()
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate([pa.int64(), pa.string(), pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
