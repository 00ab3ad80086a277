"""Text quality by a sparse ensemble of rules.

Shallow boosted trees over text statistics propose rules: each path from a root to a node is a conjunction of limits. A logistic
model with a lasso penalty keeps few of them and weighs them. The kept rules are compiled into one column
expression over the statistics, which Spark evaluates in the pass that measures the texts. Trees and weights are learned
on the driver from a bounded sample of labelled rows, as numbers only.
"""

from __future__ import annotations

import itertools
import operator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import give_back, stage

#: Labelled rows that the rules are learned from, half of either label.
MOST_LABELLED = 20_000
TREES = 40
DEPTH = 3
#: Limits tried per statistic: this many quantiles of the sample.
LIMITS = 32
#: Least share of the sample on either side of a split.
LEAST_SHARE = 0.002
LEARNING_RATE = 0.3
#: Penalties tried, as shares of the one at which no rule is left; the best on the rows set aside wins, larger first within one standard error.
PENALTIES = (0.3, 0.15, 0.08, 0.04, 0.02, 0.01, 0.005, 0.0025)
FOLDS = 4

STATISTICS = (
    "words", "word_length", "longest", "symbols", "shouts", "stops", "capitals", "digits", "distinct", "short", "repeats", "line_words", "dup_lines"
)


def measure(text: str | None) -> list[float]:
    """The ``STATISTICS`` of a whole text; a null text is an empty one, which has 0 everywhere. Words are separated by white space."""
    text = text or ""
    words = text.split()
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    lengths = list(map(len, words))
    n, letters = len(words), sum(lengths)
    if not n:
        return [0.0] * len(STATISTICS)

    def count(chars: str) -> int:
        return sum(map(text.count, chars))

    return [
        float(n),
        letters / n,
        float(max(lengths)),
        count("#*$%&|<>") / letters,
        count("!?") / n,
        count(".,;:") / n,
        sum(map(str.isupper, words)) / n,
        count("0123456789") / letters,
        len(set(words)) / n,
        sum(length <= 3 for length in lengths) / n,
        sum(map(operator.eq, words, itertools.islice(words, 1, None))) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
    ]


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the statistics of each text, a double column each."""
    df = docs.select(*keep, text)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column(len(keep))]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, found.T)], names=[*keep, *STATISTICS])
            give_back()

    return df.mapInArrow(run, ", ".join([types, *(f"{name} double" for name in STATISTICS)]))


@dataclass(frozen=True)
class Rule:
    """A conjunction: ``above`` and ``below`` hold a limit per statistic (``value > limit``, ``value <= limit``)."""

    above: tuple[tuple[str, float], ...]
    below: tuple[tuple[str, float], ...]

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        size = len(next(iter(table.values())))
        out = np.ones(size, bool)
        for name, limit in self.above:
            out &= table[name] > limit
        for name, limit in self.below:
            out &= table[name] <= limit
        return out

    def column(self) -> Column:
        out = None
        for name, limit in self.above:
            out = F.col(name) > limit if out is None else out & (F.col(name) > limit)
        for name, limit in self.below:
            out = F.col(name) <= limit if out is None else out & (F.col(name) <= limit)
        return out

    def __str__(self) -> str:
        return " and ".join([f"{n} > {v:g}" for n, v in self.above] + [f"{n} <= {v:g}" for n, v in self.below])


@dataclass
class Ensemble:
    """``chance = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))``."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def chances(self, table: dict[str, np.ndarray]) -> np.ndarray:
        total = np.full(len(next(iter(table.values()))), self.intercept)
        for rule, weight in self.rules:
            total += np.where(rule.holds(table), weight, 0.0)
        return 1 / (1 + np.exp(-total))

    def column(self) -> Column:
        """The chance as an expression over columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _path_rule(path: list[tuple[str, bool, float]]) -> Rule:
    """The limits of a path; of several on one side of a statistic the tightest."""
    above, below = {}, {}
    for name, is_above, limit in path:
        if is_above:
            above[name] = max(limit, above.get(name, limit))
        else:
            below[name] = min(limit, below.get(name, limit))
    return Rule(tuple(sorted(above.items())), tuple(sorted(below.items())))


def grow_rules(table: dict[str, np.ndarray], label: np.ndarray, weight: np.ndarray, trees: int = TREES, seed: int = 0) -> list[Rule]:
    """Rules of boosted trees: each tree fits the gradient that the ones before it left, on half of the rows and statistics."""
    rng = np.random.default_rng(seed)
    names, rows = list(table), len(label)
    limits, place = {}, {}
    for name in names:
        limits[name] = np.unique(np.quantile(table[name], np.linspace(0, 1, LIMITS + 1)[1:-1], method="lower"))
        place[name] = np.searchsorted(limits[name], table[name], side="left")  # how many limits lie below the value
    score = np.zeros(rows)
    found: dict[Rule, None] = {}
    least = max(2.0, LEAST_SHARE * rows)

    def split(at: np.ndarray, gradient: np.ndarray, curve: np.ndarray, names: list[str]):
        best = (1e-9, None, None)
        total, mass = gradient[at].sum(), curve[at].sum()
        for name in names:
            size = len(limits[name]) + 1
            places = place[name][at]
            count = np.cumsum(np.bincount(places, minlength=size))[:-1]
            g = np.cumsum(np.bincount(places, gradient[at], size))[:-1]
            h = np.cumsum(np.bincount(places, curve[at], size))[:-1]
            gain = g**2 / (h + 1) + (total - g) ** 2 / (mass - h + 1) - total**2 / (mass + 1)
            gain[(count < least) | (len(at) - count < least)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), name, float(limits[name][gain.argmax()]))
        return best[1:]

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        gradient, curve = weight * (label - chance), weight * chance * (1 - chance)
        used = sorted(rng.choice(len(names), max(1, (len(names) + 1) // 2), replace=False))
        sample = np.flatnonzero(rng.random(rows) < 0.5)
        nodes = [([], sample, np.arange(rows))]
        for _ in range(DEPTH):
            grown = []
            for path, at, everyone in nodes:
                name, limit = split(at, gradient, curve, [names[u] for u in used]) if len(at) else (None, None)
                if name is None:
                    if path:
                        grown.append((path, at, everyone))
                    continue
                for side in (False, True):
                    below = [*path, (name, side, limit)]
                    found.setdefault(_path_rule(below))
                    inside, outside = (table[name][at] > limit) == side, (table[name][everyone] > limit) == side
                    grown.append((below, at[inside], everyone[outside]))
            nodes = grown
        for _, at, everyone in nodes:
            score[everyone] += LEARNING_RATE * gradient[at].sum() / (curve[at].sum() + 1)
    return list(found)


def lasso_logistic(design: np.ndarray, label: np.ndarray, weight: np.ndarray, penalty: float, start: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights that minimise the mean logistic loss plus ``penalty`` times their absolute sum; the first column is a constant and free.

    Accelerated proximal gradient, momentum dropped whenever it points uphill.
    """
    share = weight / weight.sum()
    step = 4 / np.linalg.eigvalsh((design * share[:, None]).T @ design)[-1]
    beta = point = start
    pace = 1.0
    for _ in range(steps):
        gradient = design.T @ (share * (1 / (1 + np.exp(-(design @ point))) - label))
        moved = point - step * gradient
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new[0] = moved[0]
        change = new - beta
        if np.abs(change).max() < 1e-6:
            return new
        if (point - new) @ change > 0:
            pace = 1.0
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        point, beta, pace = new + (pace - 1) / following * change, new, following
    return beta


def weigh_rules(rules: list[Rule], table: dict[str, np.ndarray], label: np.ndarray, weight: np.ndarray, seed: int = 0) -> Ensemble:
    """The lasso's choice among ``rules``; its penalty is the largest whose loss on rows set aside is within one error of the least."""
    base = np.clip(weight @ label / weight.sum(), 1e-6, 1 - 1e-6)
    alone = Ensemble(float(np.log(base / (1 - base))))
    held = {}
    for rule in rules:  # rules that hold for the same rows are one
        held.setdefault(rule.holds(table).tobytes(), rule)
    rules = [r for r in held.values() if 0 < r.holds(table).sum() < len(label)]
    if not rules:
        return alone
    # rows on which the same rules hold are one weighted row of either label
    signs = np.column_stack([np.ones(len(label)), *[r.holds(table) for r in rules]])
    fold = np.random.default_rng(seed).integers(0, FOLDS, len(label))

    def packed(rows: np.ndarray):
        _, first, back = np.unique(np.packbits(signs[rows] > 0, axis=1), axis=0, return_index=True, return_inverse=True)
        bits = signs[rows[first]]
        mass = np.bincount(back.ravel(), weight[rows], len(bits))
        ones = np.bincount(back.ravel(), weight[rows] * label[rows], len(bits))
        return bits, ones / mass, mass

    def path(rows: np.ndarray) -> list[np.ndarray]:
        design, share, mass = packed(rows)
        mean = (mass @ share) / mass.sum()
        most = np.abs(design[:, 1:].T @ (mass / mass.sum() * (share - mean))).max()
        beta = np.zeros(design.shape[1])
        beta[0] = np.log(max(mean, 1e-6) / max(1 - mean, 1e-6))
        out = []
        for p in PENALTIES:
            beta = lasso_logistic(design, share, mass, p * most, beta)
            out.append(beta)
        return out

    losses = []
    for f in range(FOLDS):
        inside, aside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        if not len(inside) or not len(aside):
            continue
        row = []
        for beta in path(inside):
            z = signs[aside] @ beta
            loss = np.logaddexp(0, z) - label[aside] * z
            row.append(weight[aside] @ loss / weight[aside].sum())
        losses.append(row)
    mean = np.mean(losses, axis=0)
    error = np.std(losses, axis=0)[mean.argmin()] / np.sqrt(len(losses))
    chosen = int(np.flatnonzero(mean <= mean.min() + error)[0])
    beta = path(np.arange(len(label)))[chosen]
    kept = [(rule, float(b)) for rule, b in zip(rules, beta[1:]) if b != 0]
    return Ensemble(float(beta[0]), kept)


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: a third by CRC-32 of the id as text; null ids count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def labelled_statistics(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str, text: str, label: str) -> tuple[dict, np.ndarray, np.ndarray]:
    """Statistics, labels and weights of ``MOST_LABELLED`` labelled rows at most: numbers only, one row per id."""
    marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).where("doc_id is not null and label in (0, 1)").where(train)
    marked = stage(marked.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    order = F.md5(F.col("doc_id").cast("string"))
    parts = [marked.where(F.col("label") == v).orderBy(order, "doc_id").limit(MOST_LABELLED // 2) for v in (0, 1)]
    chosen = stage(parts[0].unionByName(parts[1]))
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    joined = named.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id"))  # MOST_LABELLED rows
    measured = text_statistics(joined, ["doc_id", "label"], "_text").select("doc_id", "label", F.struct(*STATISTICS).alias("s"))
    # rows that share an id teach once, whatever their number
    rows = measured.groupBy("doc_id", "label").agg(F.min("s").alias("s")).orderBy("doc_id").select("label", "s.*").collect()
    target = np.array([r["label"] for r in rows], float)
    table = {name: np.array([r[name] for r in rows], float) for name in STATISTICS}
    present = np.bincount(target.astype(int), minlength=2)
    # a row counts for as many labelled rows as the sample left out
    weight = np.array([totals.get(v, 0) / max(present[v], 1) for v in (0, 1)])
    return table, target, weight[target.astype(int)] if len(target) else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", seed: int = 0) -> Ensemble:
    """Learn from the labelled rows where ``train`` (a condition on ``doc_id``) holds.

    Of either label the first ``MOST_LABELLED`` / 2 by the MD5 of their ids teach, weighted back to the labels' shares. Rows whose
    label is not 0 or 1 or whose id is null teach nothing; an id labelled twice takes the larger label, an id with several texts
    the one with the least statistics. Without rows of both labels every score is the base rate (0.5 without any).
    """
    table, target, weight = labelled_statistics(docs, labels, train, doc_id, text, label)
    if not len(target):
        return Ensemble()
    rules = grow_rules(table, target, weight, seed=seed) if 0 < target.sum() < len(target) else []
    return weigh_rules(rules, table, target, weight, seed)


def score(docs: DataFrame, model: Ensemble, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``rules``, the number of rules that hold.

    Every row is scored by its own whole text; null and empty texts by the rules that hold for zeros. Repeated rows and
    null ids stay as they are.
    """
    measured = text_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), ["doc_id"], "_text")
    held = F.lit(0)
    for rule, _ in model.rules:
        held = held + F.when(rule.column(), F.lit(1)).otherwise(F.lit(0))
    scored = measured.select("doc_id", model.column().alias("score"), held.alias("rules"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "rules")
