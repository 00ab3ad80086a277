"""Toxicity by the nearest labelled examples under TF-IDF cosine.

The vectors hold every word of a text. Document frequencies of the examples' words are counted over all documents; a word's weight is
its inverse document frequency, up to five times as large for words that go with label 1. The examples'
vectors form a block-max inverted index; a text is scored by its exact nearest examples.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowspark.llm.common import forget, give_back, stage

#: Labelled rows that the words' leanings are learned from, and examples in the index, half of either label.
MOST_LABELLED = 20_000
MOST_EXAMPLES = 4_000
#: Chi-square with one degree of freedom from which a word that goes with label 1 has its full weight; a word without
#: any leaning has this share of it.
CHI_SQUARE = 25.0
LEAST_WEIGHT = 0.2
NEAREST = 15
BLOCK = 32
#: Terms kept as rows of a matrix at most, of those that more than this share of the examples hold; queries in a product,
#: and texts whose words are counted together.
FREQUENT = 1024
FREQUENT_SHARE = 1 / 32
LOT = 64
TOGETHER = 512
#: Blocks scored before the others' limits are compared with what they hold.
FIRST_BLOCKS = 8
#: Weight of the base rate beside the votes.
PRIOR = 0.05
_EDGES = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    """Words in lower case: runs of letters and digits."""
    return _EDGES.findall((text or "").lower())


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``first`` … ``last`` - 1, one range after the other."""
    sizes = last - first
    starts = np.cumsum(sizes) - sizes
    return np.repeat(first - starts, sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Examples by term in blocks with the largest weight of each block; finds exact nearest examples by cosine.

    Entries are the (term, block) pairs that hold an example, by term; each has its block's largest weight and its postings. The
    ``FREQUENT`` terms that most examples hold are rows of a matrix instead, so that their part of all cosines is a matrix product.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], terms: int):
        # examples that look alike share blocks, which makes the blocks' limits tight
        heaviest = [t[np.lexsort((t, -w))[:3]].tolist() for t, w in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (heaviest[i], i))
        self.ids = np.array(order, np.int64)
        self.labels = np.array([labels[i] for i in order], np.int64)
        self.blocks = math.ceil(len(order) / BLOCK)
        term = np.concatenate([vectors[i][0] for i in order]) if order else np.zeros(0, np.int64)
        weight = np.concatenate([vectors[i][1] for i in order]) if order else np.zeros(0)
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        held = np.bincount(term, minlength=terms)
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        often = often[held[often] > FREQUENT_SHARE * len(order)]
        self.row = np.full(terms, -1, np.int64)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), self.blocks * BLOCK))
        dense = self.row[term] >= 0
        self.matrix[self.row[term[dense]], place[dense]] = weight[dense]
        term, place, weight = term[~dense], place[~dense], weight[~dense]
        by_term = np.argsort(term, kind="stable")
        term, self.place, self.weight = term[by_term], place[by_term].astype(np.int32), weight[by_term]
        pair = term * max(self.blocks, 1) + self.place // BLOCK
        self.first = np.flatnonzero(np.diff(pair, prepend=-1))
        self.last = np.append(self.first[1:], len(pair))
        self.block = (pair[self.first] % max(self.blocks, 1)).astype(np.int32)
        self.limit = np.maximum.reduceat(self.weight, self.first) if len(pair) else np.zeros(0)
        self.of_term = np.searchsorted(term[self.first], np.arange(terms + 1))

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the ``k`` nearest examples that share a term with each query; ties by place."""
        out = []
        for lot in range(0, len(queries), LOT):
            some = queries[lot : lot + LOT]
            dense = np.zeros((len(some), len(self.matrix)))
            for at, (terms, weights) in enumerate(some):
                row = self.row[terms]
                dense[at, row[row >= 0]] = weights[row >= 0]
            begun = dense @ self.matrix
            out += [self._nearest(*query, scores, k) for query, scores in zip(some, begun)]
        return out

    def _nearest(self, terms: np.ndarray, weights: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Complete the ``scores`` of the frequent terms by those of the others.

        A block can hold no more than its best score so far and the limits of its entries. The blocks with the most are
        completed first; then those left that can hold an example as near as the k-th of these.
        """
        rare = self.row[terms] < 0
        first, last = self.of_term[terms[rare]], self.of_term[terms[rare] + 1]
        entries = _ranges(first, last)
        factor, block = np.repeat(weights[rare], last - first), self.block[entries]
        limits = np.bincount(block, self.limit[entries] * factor, self.blocks) + scores.reshape(-1, BLOCK).max(axis=1, initial=0.0)

        def complete(picked: np.ndarray) -> None:
            use = np.flatnonzero(picked[block])
            start, end = self.first[entries[use]], self.last[entries[use]]
            postings = _ranges(start, end)
            scores[:] += np.bincount(self.place[postings], self.weight[postings] * np.repeat(factor[use], end - start), len(scores))

        if len(entries):
            begun = np.zeros(self.blocks, bool)
            begun[np.argpartition(-limits, min(FIRST_BLOCKS, self.blocks - 1))[:FIRST_BLOCKS]] = True
            complete(begun)
        least = max(np.partition(scores, len(scores) - k)[len(scores) - k], 0.0) if len(scores) > k else 0.0
        if len(entries):
            left = ~begun & (limits > 0) & (limits >= least - 1e-9)
            if left.any():
                complete(left)
                least = max(np.partition(scores, len(scores) - k)[len(scores) - k], 0.0) if len(scores) > k else 0.0
        place = np.flatnonzero((scores > 0) & (scores >= least - 1e-9))
        near = np.round(scores[place], 12)  # alike whatever else was in the lot
        best = np.lexsort((place, -np.round(near, 9)))[:k]
        return place[best], near[best]


class Model:
    """Words of the examples with their weights, and the indexed examples; scores texts."""

    def __init__(self, numbers: dict[str, int], frequency: np.ndarray, leaning: np.ndarray, documents: int, examples: list[tuple], rates: dict):
        """``numbers`` of the words; ``leaning`` is from 0 to 1 per word; ``examples`` are (id, label, numbers of the words, counts)."""
        self.numbers = numbers
        self.weights = (np.log((1 + documents) / (1 + frequency)) + 1) * (LEAST_WEIGHT + (1 - LEAST_WEIGHT) * leaning)
        # a word of no example is as rare as can be, and leans to nothing
        self.other = (math.log((1 + documents) / 2) + 1) * LEAST_WEIGHT
        self.example_ids = [x[0] for x in examples]
        self.index = BlockMaxIndex([self.unit(number, count) for _, _, number, count in examples], [x[1] for x in examples], len(numbers))
        self.rates = rates
        # a vote counts as many rows as its example stands for
        self.weight = np.array([rates["weight"][label] for label in (0, 1)])

    def unit(self, number: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of the words known (not -1), at the length 1 of the whole text's vector: the others count for it too."""
        often = 1 + np.log(count)
        known = number >= 0
        terms, own, other = number[known], often[known] * self.weights[number[known]], often[~known] * self.other
        norm = math.sqrt((own * own).sum() + (other * other).sum())
        return terms, own / norm if norm else own

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        get = self.numbers.get
        return self.unit(np.array([get(w, -1) for w in counts], np.int64), np.fromiter(counts.values(), np.int64, len(counts)))

    def scores(self, texts: list[str | None]) -> list[tuple[float, list, list[float]]]:
        """Chance of label 1, the nearest examples' ids and cosines of each text; copies are scored once.

        A text without words has the rate of such texts among the labelled, one without any word of an example that of all.
        """
        bags = {text: Counter(terms(text)) for text in dict.fromkeys(texts)}
        found = {text: (self.rates["empty"], [], []) for text in bags}
        worded = [text for text, bag in bags.items() if bag]
        for text, (place, cosine) in zip(worded, self.index.nearest([self.vector(bags[text]) for text in worded], NEAREST)):
            found[text] = self.vote(place, cosine)
        return [found[text] for text in texts]

    def vote(self, place: np.ndarray, cosine: np.ndarray) -> tuple[float, list, list[float]]:
        if not place.size:
            return self.rates["all"], [], []
        label = self.index.labels[place]
        vote = cosine**2 * self.weight[label]
        score = (float(vote[label == 1].sum()) + PRIOR * self.rates["all"]) / (float(vote.sum()) + PRIOR)
        return min(max(score, 0.0), 1.0), [self.example_ids[i] for i in self.index.ids[place]], cosine.tolist()


def _document_frequency(docs: DataFrame, vocabulary: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each word occurs; one row of counts per task comes back summed."""
    numbers = {w: i for i, w in enumerate(vocabulary)}

    def run(batches):
        forget()
        count, rows = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                rows += 1
                found = [n for n in map(numbers.get, set(terms(text.as_py()))) if n is not None]
                count[found] += 1  # each word once
            give_back()
        hit = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1)), pa.array(np.append(count[hit], rows))], names=["term", "n"])

    found = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row per word of the examples
    term, n = (found.column(name).to_numpy() for name in ("term", "n"))
    frequency, words = np.zeros(len(vocabulary), np.int64), term >= 0
    frequency[term[words]] = n[words]
    return frequency, int(n[~words].sum())


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the labelled rows where ``train`` (a condition on ``doc_id``) holds.

    Of them ``MOST_LABELLED`` at most, half of either label and the first by the MD5 of their ids,
    teach how words lean; the first ``MOST_EXAMPLES`` of these, half of either label, form the index with all their words. Rows whose label is not 0 or 1 or
    whose id is null teach nothing; an id that is labelled twice takes the larger label, one with several texts the first of them in order. Without
    examples every score is the base rate.
    """
    marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).filter("doc_id is not null and label in (0, 1)").filter(train)
    marked = stage(marked.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = None
    for value in (0, 1):  # a bounded number of rows: top-n, not a sort of all
        part = marked.filter(F.col("label") == value).orderBy(order, "doc_id").limit(MOST_LABELLED // 2)
        chosen = part if chosen is None else chosen.unionByName(part)

    def words(batches):
        forget()
        for batch in batches:
            for lot in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lot, TOGETHER)
                found = [sorted(Counter(terms(t.as_py())).items()) for t in part.column(2)]
                lists = [pa.array([[w for w, _ in f] for f in found], pa.list_(pa.string())), pa.array([[c for _, c in f] for f in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=["doc_id", "label", "words", "counts"])
            del found, lists
            give_back()

    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    # MOST_LABELLED rows; rows that share an id teach once, whatever their number
    joined = named.join(F.broadcast(stage(chosen)), F.col("_id") == F.col("doc_id")).groupBy("doc_id", "label").agg(F.min("_text").alias("_text"))
    kind = labels.schema[doc_id].dataType.simpleString()
    bags = stage(joined.mapInArrow(words, f"doc_id {kind}, label int, words array<string>, counts array<int>"))
    filled = F.size("words") > 0
    shape = {(r["label"], r["empty"]): r["n"] for r in bags.groupBy("label", (~filled).alias("empty")).agg(F.count("*").alias("n")).collect()}
    parts = [bags.where((F.col("label") == v) & filled).orderBy(order, "doc_id").limit(MOST_EXAMPLES // 2) for v in (0, 1)]
    indexed = stage(parts[0].unionByName(parts[1]))
    # how the examples' words lean, counted over all rows that teach
    n, positive = (sum(c for (label, _), c in shape.items() if label in some) for some in ((0, 1), (1,)))
    own = indexed.select(F.explode("words").alias("w")).distinct()
    held = bags.select("label", F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    counted = held.join(own, "w", "left_semi").orderBy("w").toArrow()  # a row per word of the examples
    vocabulary = counted.column("w").to_pylist()
    holders, ones = (counted.column(c).to_numpy().astype(float) for c in ("n", "p"))
    rate = positive / n if n else 0.0
    expected = holders * rate
    chance = expected * (1 - rate) * (1 - holders / max(n, 1))
    chi = np.where((ones > expected) & (chance > 0), (ones - expected) ** 2 / np.where(chance > 0, chance, 1.0), 0.0)
    frequency, rows = _document_frequency(docs.select(text), vocabulary)

    numbers = {w: i for i, w in enumerate(vocabulary)}
    examples = []
    for r in indexed.orderBy("label", order, "doc_id").toLocalIterator():  # MOST_EXAMPLES rows, kept as numbers
        examples.append((r["doc_id"], r["label"], np.array([numbers[w] for w in r["words"]], np.int64), np.array(r["counts"], np.int64)))
    return Model(numbers, frequency, np.minimum(chi / CHI_SQUARE, 1.0), rows, examples, _rates(totals, shape, [x[1] for x in examples]))


def _rates(totals: dict[int, int], shape: dict, indexed_labels: list[int]) -> dict:
    """Base rates from all labelled rows, and how many of them an example of either label stands for."""
    in_sample = {v: shape.get((v, True), 0) + shape.get((v, False), 0) for v in (0, 1)}
    scale = {v: totals.get(v, 0) / in_sample[v] if in_sample[v] else 0.0 for v in (0, 1)}
    empty = {v: shape.get((v, True), 0) * scale[v] for v in (0, 1)}
    indexed = {v: indexed_labels.count(v) for v in (0, 1)}
    stands = {v: shape.get((v, False), 0) * scale[v] / indexed[v] if indexed[v] else 0.0 for v in (0, 1)}
    share = lambda x: x[1] / (x[0] + x[1]) if x[0] + x[1] else 0.0
    whole = {v: totals.get(v, 0) for v in (0, 1)}
    return {"all": share(whole), "empty": share(empty) if sum(empty.values()) else share(whole), "weight": [stands[0], stands[1]]}


def _scores(model: Model, texts: pa.Array) -> list[tuple]:
    """The texts' scores, some hundred at a time: their word counts are held together."""
    out = []
    for lot in range(0, len(texts), TOGETHER):
        out += model.scores(texts.slice(lot, TOGETHER).to_pylist())
    return out


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and the evidence: ``examples`` and their ``cosines``.

    Every row is scored by its text alone; null and empty texts have the rate of texts without known words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_EXAMPLES examples with their words
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = df.schema["doc_id"].dataType.simpleString()
    ids = pa.list_(to_arrow_type(df.schema["doc_id"].dataType))

    def run(batches):
        forget()
        own = shared.value
        for batch in batches:
            found = _scores(own, batch.column(1))
            values = np.array([f[0] for f in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(values),
                    pa.array((values >= 0.5).astype(np.int32)),
                    pa.array([f[1] for f in found], ids),
                    pa.array([f[2] for f in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "score", "predicted", "examples", "cosines"],
            )

    return df.mapInArrow(run, f"doc_id {kind}, score double, predicted int, examples array<{kind}>, cosines array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: a fifth by CRC-32 of the id as text; null ids count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def drop_toxic(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, as they are: a row is judged by its own text in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        forget()
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([f[0] < 0.5 for f in _scores(own, batch.column(place))], pa.bool_()))
            give_back()

    return docs.mapInArrow(run, docs.schema)
