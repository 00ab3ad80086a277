"""Near-duplicate vectors by navigable small-world graphs: one hierarchical graph per shard, every shard queried."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import stage
from flowspark.llm.components import components

#: Distinct vectors in a shard at most, about.
SHARD = 4096
DEGREE = 16
BUILD_BEAM = 48
FIRST_BEAM = 32
#: Beam from which a query compares with the whole shard.
WIDEST_BEAM = 256
#: Queries of a shard that are compared with brute force, and the recall they must show.
AUDITED = 1024
RECALL = 0.99
STEP = 512


class Graph:
    """Hierarchical small world over the rows of ``x`` (unit vectors): layers from the sparsest to all nodes."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers  # a layer: its nodes, and for every row of x its neighbours or -1

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        n = len(x)
        draw = np.random.default_rng(n).random(n)  # the same levels in every run
        levels = np.minimum((-np.log(1 - draw) / np.log(DEGREE)).astype(int), 8)
        graph = cls(x, [])
        done = np.zeros(0, np.int64)
        for level in range(int(levels.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(levels >= level)
            degree = 2 * DEGREE
            links = np.full((n, degree), -1, np.int32)
            graph.layers.append((nodes, links))
            fresh = nodes[~np.isin(nodes, done)]
            order = np.concatenate((done, fresh))
            start = min(order.size, BUILD_BEAM)
            graph._connect(links, order[:start], order[:start], None)
            while start < order.size:
                batch = order[start : start + min(start, STEP)]
                found, _ = graph.search(x[batch], BUILD_BEAM, order[0])
                graph._connect(links, batch, None, found)
                start += batch.size
            done = nodes
        return graph

    def _connect(self, links: np.ndarray, batch: np.ndarray, pool: np.ndarray | None, found: np.ndarray | None) -> None:
        """Link ``batch`` to diverse near nodes among ``found`` and each other, both ways."""
        near = self.x[batch] @ self.x[batch].T
        np.fill_diagonal(near, -2)
        k = min(BUILD_BEAM, max(batch.size - 1, 0))
        own = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.zeros((batch.size, 0), np.int64)
        candidates = batch[own]
        if found is not None:
            candidates = np.concatenate((candidates, found), axis=1)
        chosen = self._diverse(batch, candidates, DEGREE)
        links[batch, : chosen.shape[1]] = chosen
        # back links: with those a node has already, pruned by the same rule
        target, source = chosen.ravel(), np.repeat(batch, chosen.shape[1])
        target, source = target[chosen.ravel() >= 0], source[chosen.ravel() >= 0]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        touched, first, counts = np.unique(target, return_index=True, return_counts=True)
        for lot in range(0, touched.size, STEP):
            nodes = touched[lot : lot + STEP]
            most = int(counts[lot : lot + STEP].max())
            added = np.full((nodes.size, most), -1, np.int64)
            for i, (f, c) in enumerate(zip(first[lot : lot + STEP], counts[lot : lot + STEP])):
                added[i, :c] = source[f : f + c]
            both = np.concatenate((links[nodes], added), axis=1)
            full = (both >= 0).sum(axis=1) > links.shape[1]
            loose = ~full
            if loose.any():
                packed = np.sort(both[loose], axis=1)[:, ::-1][:, : links.shape[1]]
                links[nodes[loose]] = packed
            if full.any():
                links[nodes[full]] = -1
                kept = self._diverse(nodes[full], both[full], links.shape[1])
                links[nodes[full], : kept.shape[1]] = kept

    def _diverse(self, nodes: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
        """Of each node's candidates the near ones that are nearer to it than to one already taken; then the nearest."""
        out = np.full((nodes.size, degree), -1, np.int64)
        for lot in range(0, nodes.size, 128):
            some, ids = nodes[lot : lot + 128], np.sort(candidates[lot : lot + 128], axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            ids[ids == some[:, None]] = -1
            vectors = self.x[np.maximum(ids, 0)]
            near = np.einsum("nkd,nd->nk", vectors, self.x[some])
            near[ids < 0] = -2
            order = np.argsort(-near, axis=1, kind="stable")[:, : max(BUILD_BEAM, degree)]
            rows = np.arange(some.size)[:, None]
            ids, near, vectors = ids[rows, order], near[rows, order], vectors[rows, order]
            between = vectors @ vectors.transpose(0, 2, 1)
            taken = np.zeros(ids.shape, bool)
            for i in range(ids.shape[1]):
                clash = (taken & (between[:, i] > near[:, i : i + 1])).any(axis=1)
                taken[:, i] = ~clash & (ids[:, i] >= 0) & (taken.sum(axis=1) < degree)
            rank = np.where(taken, near + 4, near)
            best = np.argsort(-rank, axis=1, kind="stable")[:, :degree]
            out[lot : lot + 128, : best.shape[1]] = ids[rows, best]
        return out

    def search(self, queries: np.ndarray, beam: int, entry: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes found from the top layer down, with their cosines: ``beam`` a query, -1 where there are fewer."""
        if entry is None:
            entry = int(self.layers[0][0][0])
        ids = np.full((len(queries), 1), entry, np.int64)
        near = (self.x[ids[:, 0]] * queries).sum(axis=1)[:, None]
        for i, (_, links) in enumerate(self.layers):
            ids, near = self._beam(queries, ids, near, links, beam if i == len(self.layers) - 1 else 4)
        return ids, near

    def _beam(self, queries, ids, near, links, beam):
        q = len(queries)
        seen = np.zeros((q, len(self.x)), bool)
        rows = np.arange(q)
        seen[rows[:, None], np.maximum(ids, 0)] = True
        pad = max(0, beam - ids.shape[1])
        ids = np.concatenate((ids, np.full((q, pad), -1, np.int64)), axis=1)
        near = np.concatenate((near, np.full((q, pad), -np.inf)), axis=1)
        open_ = ids >= 0
        width = min(4, beam)
        while True:
            live = np.flatnonzero(open_.any(axis=1))
            if not live.size:
                return ids, near
            value = np.where(open_[live], near[live], -np.inf)
            best = np.argpartition(-value, width - 1, axis=1)[:, :width]
            asked = np.where(np.take_along_axis(open_[live], best, axis=1), np.take_along_axis(ids[live], best, axis=1), -1)
            open_[live[:, None], best] = False
            following = np.where(asked[:, :, None] >= 0, links[np.maximum(asked, 0)], -1).reshape(live.size, -1)
            following = np.sort(following, axis=1)
            following[:, 1:][following[:, 1:] == following[:, :-1]] = -1
            fresh = (following >= 0) & ~seen[live[:, None], np.maximum(following, 0)]
            r, c = np.nonzero(fresh)
            node = following[r, c]
            seen[live[r], node] = True
            more = np.full(following.shape, -np.inf)
            more[r, c] = np.einsum("kd,kd->k", self.x[node], queries[live[r]])
            all_ids = np.concatenate((ids[live], np.where(fresh, following, -1)), axis=1)
            all_near = np.concatenate((near[live], more), axis=1)
            all_open = np.concatenate((open_[live], fresh), axis=1)
            top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, top, axis=1)
            near[live] = np.take_along_axis(all_near, top, axis=1)
            open_[live] = np.take_along_axis(all_open, top, axis=1) & (ids[live] >= 0)

    def links_of(self, queries: np.ndarray, least: float, own: bool = False) -> np.ndarray:
        """Boolean table of queries and nodes with a cosine of ``least`` or more, as far as the beams find them.

        A query whose beam is full of links gets a wider one, in the end the whole shard.
        All beams widen until the audited queries find ``RECALL`` of their links. With ``own`` the queries are the shard's
        nodes, whose matches with themselves prove nothing and are left out.
        """
        n, out = len(self.x), np.zeros((len(queries), len(self.x)), bool)
        audited = np.unique(np.linspace(0, len(queries) - 1, AUDITED).astype(int)) if len(queries) else np.zeros(0, int)
        truth = queries[audited] @ self.x.T >= least
        if own:
            truth[np.arange(len(audited)), audited] = False
        beam = min(FIRST_BEAM, n)
        while True:
            waiting, width = np.arange(len(queries)), beam
            while waiting.size:
                if width >= min(WIDEST_BEAM, n):
                    for lot in range(0, waiting.size, STEP):
                        some = waiting[lot : lot + STEP]
                        out[some] = queries[some] @ self.x.T >= least
                    break
                full = []
                for lot in range(0, waiting.size, STEP):
                    some = waiting[lot : lot + STEP]
                    ids, near = self.search(queries[some], width)
                    hit = (near >= least) & (ids >= 0)
                    r, c = np.nonzero(hit)
                    out[some[r], ids[r, c]] = True
                    full.append(some[hit.all(axis=1)])
                waiting, width = np.concatenate(full), width * 2
            if (out[audited] & truth).sum() >= RECALL * truth.sum() or beam >= min(WIDEST_BEAM, n):
                return out
            beam *= 2


_GRAPH = "label string, dim int, shard int, shards int, ids array<long>, copies array<long>, x binary, nodes array<binary>, links array<binary>"


def _build(table: pa.Table) -> pa.Table:
    by = np.argsort(table.column("rep").to_numpy(), kind="stable")
    table = table.take(pa.array(by))
    x = np.stack([np.asarray(v.as_py(), np.float64) for v in table.column("vector")])
    graph = Graph.build(_unit(x))
    first = lambda name: [table.column(name)[0].as_py()]
    values = [
        first("label"), first("dim"), first("shard"), first("shards"),
        [table.column("rep").to_pylist()], [table.column("copies").to_pylist()], [x.tobytes()],
        [[nodes.astype(np.int32).tobytes() for nodes, _ in graph.layers]], [[links.tobytes() for _, links in graph.layers]],
    ]
    many = pa.list_(pa.int64())
    kinds = [pa.string()] + [pa.int32()] * 3 + [many, many, pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
    names = ["label", "dim", "shard", "shards", "ids", "copies", "x", "nodes", "links"]
    return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], names=names)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _load(row: dict) -> tuple[np.ndarray, np.ndarray, Graph]:
    ids, copies = np.array(row["ids"], np.int64), np.array(row["copies"], np.int64)
    x = np.frombuffer(row["x"]).reshape(len(ids), -1)
    layers = [(np.frombuffer(n, np.int32).astype(np.int64), np.frombuffer(k, np.int32).reshape(len(ids), -1)) for n, k in zip(row["nodes"], row["links"])]
    return ids, copies, Graph(_unit(x), layers)


def _forest(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what the table of links between ``a`` and ``b`` connects."""
    names = np.concatenate((a, b))
    label = np.arange(names.size)
    rows, columns = np.flatnonzero(links.any(axis=1)), len(a)
    while True:
        before = label.copy()
        for lot in range(0, rows.size, 256):
            some = rows[lot : lot + 256]
            r, c = np.nonzero(links[some])
            least = np.minimum(label[some[r]], label[columns + c])
            np.minimum.at(label, some[r], least)
            np.minimum.at(label, columns + c, least)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(names.size))
    return [(int(names[i]), int(names[label[i]])) for i in moved]


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["shard"])
        a_ids, a_copies, a = _load(rows[0])
        if len(rows) == 1:
            found = a.links_of(a.x, least, own=True)
            found |= found.T
            np.fill_diagonal(found, False)
            counts = [(a_ids, found @ a_copies)]
            pairs = _forest(found, a_ids, a_ids)
        else:
            b_ids, b_copies, b = _load(rows[1])
            found = b.links_of(a.x, least) | a.links_of(b.x, least).T
            counts = [(a_ids, found @ b_copies), (b_ids, found.T @ a_copies)]
            pairs = _forest(found, a_ids, b_ids)
        node = np.concatenate([i[n > 0] for i, n in counts])
        n = np.concatenate([n[n > 0] for _, n in counts])
        other = [y for _, y in pairs]
        columns = [
            pa.array(np.concatenate([node, np.array([x for x, _ in pairs], np.int64)])),
            pa.array(n.tolist() + [None] * len(pairs), pa.int64()),
            pa.array([None] * len(node) + other, pa.int64()),
        ]
        return pa.table(columns, names=["node", "n", "other"])

    return run


def vector_links(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Rows of one label (not null) and length link when the cosine of their vectors, in double
    precision, is ``least`` or more; vectors that are null, zero or hold nulls or values that are not finite link with
    nothing. Equal vectors of a label become one node that counts for all its rows, so copies cost nothing. The nodes
    of a label are dealt over shards of about ``SHARD``; each gets a graph, and each pair of shards one task in which
    both are queried by the other, so memory is bounded whatever a label holds. Found links are verified by
    their cosine and united; recall follows the audits (``Graph.links_of``). Labels are compared as text, whatever
    their type. A row without an id has no name to link by: it links with nothing, and nothing counts it.
    """
    x, least_id = F.col("embedding"), F.col("vec_id")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).cast("string").alias("label"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0) & least_id.isNotNull()
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    nodes = rows.filter("usable").groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"))
    nodes = stage(nodes.withColumn("dim", F.size("embedding")))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / SHARD).cast("int"))
    dealt = nodes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    dealt = dealt.select("label", "dim", "shard", "shards", "rep", "copies", F.col("embedding").alias("vector"))
    graphs = stage(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, _GRAPH))
    partner = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    pairs = graphs.withColumn("partner", partner).withColumns({"low": F.least("shard", "partner"), "high": F.greatest("shard", "partner")})
    found = stage(pairs.groupBy("label", "dim", "low", "high").applyInArrow(_compare(least), "node long, n long, other long"))
    counts = found.filter("n is not null").groupBy("node").agg(F.sum("n").alias("n"))
    united = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (
        nodes.join(counts, F.col("rep") == F.col("node"), "left")
        .drop("node")
        .join(united, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("_label"),
            F.col("embedding").alias("_embedding"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = rows.join(named, F.col("usable") & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left")
    component = F.coalesce("component_id", F.col("vec_id").cast("long"))
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
