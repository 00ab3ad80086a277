"""Lagged cross-moments of every group, as binary tiles.

With C_d[i, j] = sum over t of y_i(t) * y_j(t-d) for d = 0..maxlag, plus the
first and last ``maxlag`` rows, the normal equations of *every* lag order of a
group follow by a short recursion. That is K*K*(maxlag+1) sums instead of
(K*maxlag)^2, and counts are integers, so the sums are exact whatever the order.

Members are cut into tiles and time into blocks, each block carrying ``maxlag`` rows of
its predecessor. A strip is what one tile of members saw in one block; each pair of strips of
a block meets in some task and gives one tile of sums by matrix products. However many members
a group has, a task holds two strips and a tile, and the tiles of one group are
made by as many tasks as there are pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# executors receive this helper with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Members of a tile, and rows of a time block: a day of minutes.
TILE = 64
BLOCK = 1440

TILE_COLUMNS = "a int, c int, b int, span int, rows int, cols int, data binary, totals binary, edges binary"


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys)


def shuffle_partitions(df: DataFrame) -> int:
    """Their number for stages that are light on bytes and heavy on time: given the number, small partitions are not merged."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _strips(panel: DataFrame, keys: Sequence[str], maxlag: int, block: int, tile: int) -> DataFrame:
    """``<keys>, tile, b, tiles, span, nobs, t, i, y``: one row per tile of members and time block, its cells as arrays."""
    span = F.col("span") if "span" in panel.columns else F.lit(maxlag)
    nobs = F.col("nobs") if "nobs" in panel.columns else F.lit(None)
    if "k" not in panel.columns:
        counted = panel.groupBy(*keys).agg((F.max("i") + 1).alias("k"))
        panel = panel.join(counted, list(keys))
    # each row goes to its own block and, near the end of it, also to the next one
    blocks = F.sequence(F.floor(F.col("t") / block).cast("int"), F.floor((F.col("t") + maxlag) / block).cast("int"))
    placed = panel.select(
        *keys,
        F.floor(F.col("i") / tile).cast("int").alias("tile"),
        F.ceil(F.col("k") / tile).cast("int").alias("tiles"),
        span.cast("int").alias("span"),
        nobs.cast("int").alias("nobs"),
        *(F.col(name).cast(kind).alias(name) for name, kind in (("t", "int"), ("i", "int"), ("y", "long"))),
        F.explode(blocks).alias("b"),
    )
    arrays = [F.collect_list(name).alias(name) for name in ("t", "i", "y")]
    facts = [F.max(name).alias(name) for name in ("tiles", "span", "nobs")]
    return placed.groupBy(*keys, "tile", "b").agg(*facts, *arrays)


def moment_tiles(panel: DataFrame, keys: Sequence[str], maxlag: int, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``<keys>, a, c, b, span, rows, cols, data, totals, edges``: sums of member tile ``a`` with the past of member tile ``c`` in time block ``b``.

    ``data`` holds ``span + 1`` matrices of ``rows`` x ``cols`` 64-bit integers, lag 0 first; at lag 0 only pairs with
    ``i <= j`` are filled (the rest is their mirror image). A group's sums are the totals over ``b``. If the panel
    has a ``span`` column, lags above it are not summed for that row's group, and none at all where it is -1. Tiles off the diagonal
    without any sum are left out; those on it also carry the members' ``totals`` and, if the panel has ``nobs``, as (t, i, y) the cells
    among the first or last ``maxlag`` rows of the series (``edges``), so that the panel is read once for all of them.
    """
    keys = list(keys)
    block = max(block, maxlag, 1)
    strips = _strips(panel, keys, maxlag, block, tile)
    cells = ("span", "nobs", "t", "i", "y")
    order = [*keys, "a", "c", "b"]
    # each strip is the present of the pairs with all tiles of its block, and the past of those with all others
    tile_numbers, own = F.sequence(F.lit(0), F.col("tiles") - 1), F.col("tile")
    present = F.transform(tile_numbers, lambda c: F.struct(own.alias("a"), c.alias("c"), F.lit(0).alias("side")))
    past = F.transform(F.filter(tile_numbers, lambda a: a != own), lambda a: F.struct(a.alias("a"), own.alias("c"), F.lit(1).alias("side")))
    pairs = strips.select(*keys, F.explode(F.concat(present, past)).alias("p"), "b", *cells).select(*keys, "p.*", "b", *cells)
    pairs = pairs.repartition(shuffle_partitions(panel), *order).sortWithinPartitions(*order, "side")
    schema = T.StructType.fromDDL(f"{key_schema(panel, keys)}, {TILE_COLUMNS}")
    arrow = to_arrow_schema(schema)

    def dense_strip(strip, first: int, base: int) -> np.ndarray:
        t, i, y = strip
        out = np.zeros((int(t.max()) - base + 1, int(i.max()) - first + 1))
        out[t - base, i - first] = y
        return out

    def products(a: int, c: int, b: int, span: int, now, past) -> np.ndarray:
        base = b * block - maxlag
        y = dense_strip(now, a * tile, base)
        x = y if a == c else dense_strip(past, c * tile, base)
        out = np.zeros((span + 1, y.shape[1], x.shape[1]), np.int64)
        for lag in range(span + 1):
            height = min(len(y), len(x) + lag) - maxlag
            if height > 0:
                out[lag] = y[maxlag : maxlag + height].T @ x[maxlag - lag : maxlag - lag + height]
        if span >= 0 and a > c:
            out[0] = 0
        elif span >= 0 and a == c:
            out[0] = np.triu(out[0])
        return out

    def own_parts(a: int, b: int, nobs: int | None, strip) -> tuple[bytes, bytes | None]:
        """Totals and edge cells of the block's own rows."""
        t, i, y = (v[strip[0] >= b * block] for v in strip)
        totals = np.bincount(i - a * tile, y, int(strip[1].max()) - a * tile + 1).astype(np.int64)
        if nobs is None:
            return totals.tobytes(), None
        near = (t < maxlag) | (t >= nobs - maxlag)
        return totals.tobytes(), np.array([t[near], i[near], y[near]], np.int64).tobytes()

    def run(batches):
        ready, size = [], 0
        last, strip = None, None
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for at in range(batch.num_rows):
                place = tuple(columns[name][at].as_py() for name in order)
                cut = tuple(columns[name][at].values.to_numpy(zero_copy_only=False) for name in ("t", "i", "y"))
                a, c, b = place[-3:]
                if columns["side"][at].as_py() == 0:
                    last, strip = place, cut
                    if a != c:
                        continue
                elif last != place:
                    continue
                span, nobs = columns["span"][at].as_py(), columns["nobs"][at].as_py()
                found = products(a, c, b, span, strip, cut)
                if a != c and not found.any():
                    continue
                _, rows, cols = found.shape
                own = own_parts(a, b, nobs, strip) if a == c else (None, None)
                ready.append(dict(zip(schema.names, (*place, span, rows, cols, found.tobytes(), *own))))
                size += found.nbytes + 64
                if size > 16 << 20:
                    yield pa.RecordBatch.from_pylist(ready, arrow)
                    ready, size = [], 0
        if ready:
            yield pa.RecordBatch.from_pylist(ready, arrow)

    return pairs.select(*order, "side", *cells).mapInArrow(run, schema)


def tile_sums(data: bytes, span: int, rows: int, cols: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(span + 1, rows, cols)


def cells_of(tiles: DataFrame, keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """The non-zero cells ``<keys>, i, j, lag, s`` of ``moment_tiles``, still per time block."""
    schema = T.StructType.fromDDL(f"{key_schema(tiles, keys)}, i int, j int, lag int, s bigint")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for at in range(batch.num_rows):
                a, c, span, rows, cols, data = (columns[name][at].as_py() for name in ("a", "c", "span", "rows", "cols", "data"))
                sums = tile_sums(data, span, rows, cols)
                lag, i, j = np.nonzero(sums)
                own = [pa.repeat(columns[name][at], len(lag)) for name in keys]
                cells = [pa.array(v.astype(np.int32)) for v in (i + a * tile, j + c * tile, lag)]
                yield pa.RecordBatch.from_arrays([*own, *cells, pa.array(sums[lag, i, j])], schema=arrow)

    return tiles.mapInArrow(run, schema)


def lag_moments(panel: DataFrame, keys: Sequence[str], maxlag: int, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``<keys>, i, j, lag, s`` with ``s = sum_t y_i(t) y_j(t-lag)``; zero sums are left out.

    Tiles keep a group's K*K*lags sums packed; this table has a row for each. Where nothing else asks for rows, use ``moment_tiles``.
    """
    cells = cells_of(moment_tiles(panel, keys, maxlag, block, tile), keys, tile)
    return cells.groupBy(*keys, "i", "j", "lag").agg(F.sum("s").alias("s"))
