"""Vector autoregressions of all groups in one job.

Spark sums the moments (``moments``); the grouped solve then sees, per
group, only those sums, the edge rows and the member list. ``var_fit`` returns
one compact row per group, from which every other operator here starts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowspark.functions import dense
from flowspark.operators import moments
from flowspark.operators.moments import BLOCK, TILE, key_schema, moment_tiles, shuffle_partitions, tile_sums
from flowspark.operators.panel import densify
from flowspark.session import materialize

# executors receive the helper with the job; they need not have this package installed
cloudpickle.register_pickle_by_value(dense)
cloudpickle.register_pickle_by_value(moments)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The settings an analysis uses unless told otherwise.
MAX_LAG = 10
CRITERION = "hqic"
ALPHA = 0.1
L1_RATIO = 0.1
MAX_ITERATIONS = 300_000

#: Targets that one task solves an elastic net for; a group with more members is solved by several.
TARGETS = 64

#: Rows of a group in the order they are read: its members, its moment tiles, coefficients solved elsewhere.
_SMALL, _TILE, _COEF = range(3)

_MODEL = (
    "status string, nobs int, lag int, n int, dof int, members array<string>, "
    "intercept array<double>, coef array<double>, raw_intercept array<double>, raw_coef array<double>, "
    "sigma array<double>, scale array<double>, loglik array<double>, sample int"
)


def solver_parts(
    panel: DataFrame,
    spine: DataFrame,
    keys: Sequence[str],
    maxlag: int = MAX_LAG,
    lags: int | None = None,
    sparse: bool = False,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """All that the solves need of every group, a few rows each: its members, and its moments, totals and edge rows in tiles.

    The panel is read once. Rows of a group are told apart by ``_part``. The table can be stored and read by several operators
    (``var_fit``, ``granger_pairs``, ``var_rss_moments``); ``lags`` and ``sparse`` must then be the same there.
    """
    # widest lag the solve can use: a plain model needs more rows than coefficients
    nobs, k = F.col("nobs"), F.col("k")
    reach = F.least(F.lit(lags or maxlag), nobs - 1)
    if sparse:
        span = reach
    else:
        eligible = F.floor((nobs - reach - 2) / k)
        span = F.when(nobs - 2 - k > 0, F.least(reach, F.greatest(eligible, F.lit(lags or 1)))).otherwise(-1)
    members = spine.groupBy(*keys).agg(
        F.collect_list(F.struct("i", "member")).alias("members"), F.max("nobs").cast("int").alias("nobs"), F.count(F.lit(1)).cast("int").alias("k")
    )
    tiles = moment_tiles(panel.withColumn("span", span.cast("int")), keys, lags or maxlag, block, tile)
    small = members.select(*keys, F.lit(_SMALL).alias("_part"), "members", "nobs", "k")
    return small.unionByName(tiles.select(*keys, F.lit(_TILE).alias("_part"), F.lit(tile).alias("tile"), *tiles.columns[len(keys) :]), allowMissingColumns=True)


class _Group:
    """One group's sums, with members ordered by mean (largest first, then name)."""

    def __init__(self, given: dict, parts: list[dict], maxlag: int):
        tiles = [row for row in parts if row["_part"] == _TILE]
        names, numbers = [m["member"] for m in given["members"]], np.array([m["i"] for m in given["members"]], dtype=np.int64)
        sums = np.zeros(numbers.max() + 1)
        for row in tiles:
            if row["totals"] is not None:
                own = np.frombuffer(row["totals"], np.int64)
                sums[row["a"] * row["tile"] : row["a"] * row["tile"] + len(own)] += own
        totals = sums[numbers]
        order = sorted(range(len(names)), key=lambda at: (-totals[at], names[at]))
        self.given = given
        self.members = [names[at] for at in order]
        self.nobs = int(given["nobs"])
        self.total = totals[order]
        self.k = len(order)
        self.maxlag = min(maxlag, self.nobs - 1)
        self.rank = np.zeros(numbers.max() + 1, dtype=np.int64)
        self.rank[numbers[order]] = np.arange(self.k)
        self.cross = np.zeros((self.maxlag + 1, self.k, self.k))
        # the first and last rows; a short series is held whole
        self.tail = max(self.maxlag, self.nobs - self.maxlag)
        self.rows = np.zeros((self.maxlag + self.nobs - self.tail, self.k))
        for row in tiles:
            self.add_tile(row)
        #: Coefficients other tasks have solved: by lag, a column per target.
        self.solved: dict[int, np.ndarray] = {}
        self.converged = True
        for row in parts:
            if row["_part"] == _COEF:
                self.add_solved(row)

    def add_tile(self, row: dict) -> None:
        sums = tile_sums(row["data"], row["span"], row["rows"], row["cols"])
        i = self.rank[row["a"] * row["tile"] + np.arange(row["rows"])]
        j = self.rank[row["c"] * row["tile"] + np.arange(row["cols"])]
        for lag in range(row["span"] + 1):
            self.cross[lag][np.ix_(i, j)] += sums[lag]
        # at lag 0 a tile has one half; its mirror image is the other
        if row["span"] >= 0:
            once = np.triu(sums[0], 1) if row["a"] == row["c"] else sums[0]
            self.cross[0][np.ix_(j, i)] += once.T
        if row["edges"] is not None:
            t, i, y = np.frombuffer(row["edges"], np.int64).reshape(3, -1)
            t, i, y = (v[(t < self.maxlag) | (t >= self.tail)] for v in (t, i, y))
            self.rows[np.where(t < self.maxlag, t, t - self.tail + self.maxlag), self.rank[i]] = y

    def add_solved(self, row: dict) -> None:
        """Coefficients of the targets ``a`` * TARGETS … at lag ``span``."""
        whole = self.solved.setdefault(row["span"], np.zeros((row["rows"], self.k)))
        whole[:, row["a"] * TARGETS : row["a"] * TARGETS + row["cols"]] = np.frombuffer(row["data"]).reshape(row["rows"], row["cols"])
        self.converged = self.converged and row["b"] == 1

    def edge(self, t: int) -> np.ndarray:
        return self.rows[t if t < self.maxlag else t - self.tail + self.maxlag]

    def sample(self, start: int, width: int):
        """Moments of the rows ``start … nobs-1`` for lags up to ``width``."""
        products = dense.lagged_products(self.cross, self.edge, start, width, self.nobs)
        sums = dense.lagged_sums(self.total, self.edge, start, width, self.nobs)
        return products, sums, self.nobs - start


class _PlainModel:
    """Least squares; a lag is eligible while rows outnumber coefficients."""

    def eligible(self, rows: int, k: int, lag: int) -> bool:
        return rows - lag - k * lag - 1 > 0

    def fit(self, gram, rhs, target, k, lag, warm=None):
        n = int(gram[-1, -1])
        beta = dense.solve_least_squares(gram, rhs)
        dof = n - k * lag - 1
        residual = dense.least_squares_residual(gram, rhs, target)
        return {
            "coef": beta[:-1],
            "intercept": beta[-1],
            "raw_coef": beta[:-1],
            "raw_intercept": beta[-1],
            "residual": residual,
            "raw_rss": np.diag(residual),
            "dof": dof,
            "scale": np.ones(k),
            "converged": True,
        }


class _SparseModel:
    """Elastic net on standardised series."""

    def __init__(self, alpha: float, l1_ratio: float, tol: float, max_iter: int):
        ratio = min(max(l1_ratio, 0.0), 1.0)
        self.l1, self.l2 = abs(alpha) * ratio, abs(alpha) * (1 - ratio)
        self.tol, self.max_iter = tol, max_iter

    def eligible(self, rows: int, k: int, lag: int) -> bool:
        return rows > lag

    def solve(self, gram, rhs, target, warm=None):
        """Standardised coefficients of the targets in ``rhs``, and whether they converged."""
        n = int(gram[-1, -1])
        (xx, xy, _), (_, x_sd), (_, y_sd) = dense.standardise(gram, rhs, target)
        start = np.zeros(xy.shape)
        if warm is not None:
            start[: len(warm)] = warm[: len(start)]
        l1 = self.l1 * n / np.outer(x_sd, y_sd)
        return dense.solve_elastic_net(xx, xy, l1, self.l2 * n / x_sd**2, start, self.tol, self.max_iter)

    def finish(self, gram, rhs, target, beta, converged):
        """The model whose standardised coefficients are ``beta``."""
        (xx, xy, yy), (x_mean, x_sd), (y_mean, y_sd) = dense.standardise(gram, rhs, target)
        residual = dense.residual_products(xx, xy, yy, beta)
        raw = beta * y_sd / x_sd[:, None]
        return {
            "coef": beta,
            "intercept": np.zeros(len(y_sd)),
            "raw_coef": raw,
            "raw_intercept": y_mean - x_mean @ raw,
            "residual": residual,
            "raw_rss": np.diag(residual) * y_sd**2,
            "dof": int(gram[-1, -1]) - 1,
            "scale": y_sd,
            "converged": converged,
        }

    def fit(self, gram, rhs, target, k, lag, warm=None):
        return self.finish(gram, rhs, target, *self.solve(gram, rhs, target, warm))


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], maxlag: int) -> Iterator[tuple[dict, _Group]]:
    """The groups of a task's sorted ``solver_parts``, one after the other."""
    key, small, parts = None, None, []
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            for row in batch.slice(first, 64).to_pylist():
                if row["_part"] == _SMALL:
                    if small is not None:
                        yield key, _Group(small, parts, maxlag)
                    key, small, parts = {name: row[name] for name in keys}, row, []
                else:
                    parts.append(row)
    if small is not None:
        yield key, _Group(small, parts, maxlag)


def _solve_groups(parts: DataFrame, keys: Sequence[str], maxlag: int, solve: Callable, schema: T.StructType, spread: Sequence[str] = ()) -> DataFrame:
    """``solve(group) -> rows`` for every group; a row is a dict without the keys.

    A group arrives as a few rows, sorted and read as a stream: a task holds one group at a time. A solve is heavy on time and
    light on bytes, so the groups keep all shuffle partitions. ``spread`` names further
    columns to deal by, which ``solve(group, values)`` then also gets.
    """
    names, spread, keys = schema.names, list(spread), list(keys)
    dealt = parts.repartition(shuffle_partitions(parts), *keys, *spread).sortWithinPartitions(*keys, *spread, "_part", "a", "c", "b")
    arrow = to_arrow_schema(schema)

    def run(batches):
        out, size = [], 0
        for key, group in _groups(batches, [*keys, *spread], maxlag):
            for row in solve(group, *(key[name] for name in spread)):
                out.append(key | row)
                size += sum(getattr(value, "nbytes", 16) for value in row.values())
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist([{name: row[name] for name in names} for row in out], arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([{name: row[name] for name in names} for row in out], arrow)

    return dealt.mapInArrow(run, schema)


def _model(sparse: bool, alpha: float, l1_ratio: float, tol: float, max_iter: int):
    return _SparseModel(alpha, l1_ratio, tol, max_iter) if sparse else _PlainModel()


def _refit(group: _Group, model, lag: int, without: int | None = None):
    products, sums, n = group.sample(lag, lag)
    if without is not None:
        keep = np.delete(np.arange(group.k), without)
        products, sums = products[np.ix_(range(lag + 1), range(lag + 1), keep, keep)], sums[:, keep]
    gram, rhs, target = dense.normal_equations(products, sums, lag, n)
    if lag in group.solved and without is None:
        return model.finish(gram, rhs, target, group.solved[lag], group.converged), n
    return model.fit(gram, rhs, target, len(rhs[0]), lag), n


def _reduced_rss(group: _Group, lag: int, full: dict) -> list[np.ndarray]:
    """Residual sums of every equation when a member's lags leave the design: a row per member, from one factor."""
    products, sums, n = group.sample(lag, lag)
    gram, rhs, _ = dense.normal_equations(products, sums, lag, n)
    kept = dense.eliminate(gram, len(gram))[1]
    inverse = np.linalg.inv(gram[np.ix_(kept, kept)])
    coef = inverse @ rhs[kept]
    dropped = [np.arange(lag) * group.k + member for member in range(group.k)]
    return [full["raw_rss"] + dense.reduced_residual_gains(gram, coef, kept, inverse, columns.tolist()) for columns in dropped]


def _widest(group: _Group, model) -> int:
    return max((p for p in range(1, group.maxlag + 1) if model.eligible(group.nobs - group.maxlag + p, group.k, p)), default=0)


def _select_lag(group: _Group, model, criterion: str):
    """Smallest lag with the least criterion on the common sample, all log-likelihoods, rows, and whether all fits converged.

    Plain models of all lags come from one elimination. Sparse ones start from the lag before, unless their coefficients were solved elsewhere.
    """
    widest = _widest(group, model)
    loglik = [None] * group.maxlag
    best, chosen, converged = np.finfo(float).max, 1, group.converged
    n = group.nobs - group.maxlag
    if not widest:
        return chosen, loglik, n, converged
    products, sums, n = group.sample(group.maxlag, widest)

    def residuals():
        nonlocal converged
        if isinstance(model, _PlainModel):
            yield from (residual for residual, _ in dense.lag_sweep(products, sums, widest, n))
            return
        warm = None
        for lag in range(1, widest + 1):
            gram, rhs, target = dense.normal_equations(products, sums, lag, n)
            if group.solved:
                fitted = model.finish(gram, rhs, target, group.solved[lag], True)
            else:
                fitted = model.fit(gram, rhs, target, group.k, lag, warm)
                warm = fitted["coef"]
            converged = converged and fitted["converged"]
            yield fitted["residual"]

    for lag, residual in enumerate(residuals(), start=1):
        loglik[lag - 1] = dense.gaussian_loglik(residual / n, n)
        if n > 1:
            value = dense.information_criterion(criterion, loglik[lag - 1], n, group.k * (group.k * lag + 1))
            if value < best:
                best, chosen = value, lag
    return chosen, loglik, n, converged


def _sparse_by_target(parts: DataFrame, keys: list[str], depth: int, lags: int | None, criterion: str, model: _SparseModel) -> DataFrame:
    """``solver_parts`` of wide groups with the coefficients of their sparse models added, each solved by a task per ``TARGETS`` targets.

    Without ``lags`` the coefficients of all lags on the common sample come first, from which the group's lag is chosen;
    then those of the chosen lag on its whole sample. ``parts`` must be a stored table: it is read once for each step.
    """
    spread = [*keys, "_q"]
    schema = T.StructType.fromDDL(f"{key_schema(parts, keys)}, _q int, span int, rows int, cols int, b int, data binary")
    sizes = parts.where(F.col("_part") == _SMALL).select(*keys, "k")

    def per_target(table: DataFrame) -> DataFrame:
        """Every task of a group gets the group's rows."""
        sized = table.drop("k").join(sizes, keys)
        return sized.withColumn("_q", F.explode(F.sequence(F.lit(0), F.ceil(F.col("k") / TARGETS).cast("int") - 1)))

    def coefficients(group: _Group, q: int, lag: int, warm):
        columns = np.arange(q * TARGETS, min((q + 1) * TARGETS, group.k))
        gram, rhs, target = dense.normal_equations(*group.common[:2], lag, group.common[2])
        beta, converged = model.solve(gram, rhs[:, columns], target[np.ix_(columns, columns)], warm)
        return beta, {"span": lag, "rows": len(beta), "cols": len(columns), "b": int(converged), "data": beta.tobytes()}

    def all_lags(group: _Group, q: int):
        widest, warm = _widest(group, model), None
        if widest:
            group.common = group.sample(group.maxlag, widest)
        for lag in range(1, widest + 1):
            warm, row = coefficients(group, q, lag, warm)
            yield row

    def one_lag(group: _Group, q: int, lag: int | None):
        if lag and lag <= group.maxlag and model.eligible(group.nobs, group.k, lag):
            group.common = group.sample(lag, lag)
            yield coefficients(group, q, lag, None)[1]

    def as_parts(found: DataFrame) -> DataFrame:
        return found.select(*keys, F.lit(_COEF).alias("_part"), F.col("_q").alias("a"), F.col("span").alias("c"), "b", "span", "rows", "cols", "data")

    if lags is not None:
        solved = _solve_groups(per_target(parts), keys, depth, lambda group, q: one_lag(group, q, lags), schema, ["_q"])
        return parts.unionByName(as_parts(solved), allowMissingColumns=True).withColumn("_lag", F.lit(lags))
    tried = materialize(as_parts(_solve_groups(per_target(parts), keys, depth, all_lags, schema, ["_q"])))
    choice = T.StructType.fromDDL(f"{key_schema(parts, keys)}, _lag int, loglik array<double>, sample int, _sound boolean")

    def choose(group: _Group):
        if group.maxlag >= 1:
            lag, loglik, sample, converged = _select_lag(group, model, criterion)
            yield {"_lag": lag, "loglik": loglik, "sample": sample, "_sound": bool(converged)}

    chosen = materialize(_solve_groups(parts.unionByName(tried, allowMissingColumns=True), keys, depth, choose, choice))
    with_lag = per_target(parts).join(chosen.select(*keys, "_lag"), keys)
    solved = _solve_groups(with_lag, keys, depth, one_lag, schema, ["_q", "_lag"])
    whole = parts.unionByName(as_parts(solved), allowMissingColumns=True)
    return whole.join(chosen, keys, "left")


def var_fit(
    panel: DataFrame,
    spine: DataFrame,
    keys: Sequence[str],
    maxlag: int = MAX_LAG,
    lags: int | None = None,
    criterion: str = CRITERION,
    sparse: bool = False,
    alpha: float = ALPHA,
    l1_ratio: float = L1_RATIO,
    tol: float = 1e-9,
    max_iter: int = MAX_ITERATIONS,
    block: int = BLOCK,
    parts: DataFrame | None = None,
) -> DataFrame:
    """One model row per group: the lag is chosen by ``criterion`` unless ``lags`` fixes it.

    A group that cannot be fitted keeps its row with a ``status`` other than
    ``fitted`` (``too few rows``, or ``not converged`` after ``max_iter`` steps
    of the sparse solver), so one bad group never fails the batch. The panel is read three
    times; pass a stored one when it is costly to derive, or its stored ``solver_parts`` as ``parts``.
    Sparse models of groups with more than ``TARGETS`` members are solved by several tasks per group, from stored parts.
    """
    if criterion not in ("aic", "bic", "hqic"):
        raise ValueError(f"criterion must be aic, bic or hqic, got {criterion!r}")
    keys = list(keys)
    depth = lags or maxlag
    model = _model(sparse, alpha, l1_ratio, tol, max_iter)
    schema = T.StructType.fromDDL(f"{key_schema(spine, keys)}, {_MODEL}")
    fields = schema.names[len(keys) :]

    def solve(group: _Group) -> list[dict]:
        row = dict.fromkeys(fields) | {"nobs": group.nobs, "members": group.members, "status": "too few rows"}
        lag, loglik, sample, converged = lags, [], 0, group.converged
        if group.maxlag < 1 or (lag or 1) > group.maxlag:
            return [row]
        if lag is None and group.given.get("_lag") is not None:
            lag, loglik, sample, converged = (group.given[name] for name in ("_lag", "loglik", "sample", "_sound"))
            converged = converged and group.converged
        elif lag is None:
            lag, loglik, sample, converged = _select_lag(group, model, criterion)
        if not model.eligible(group.nobs, group.k, lag):
            return [row]
        fitted, n = _refit(group, model, lag)
        if not (converged and fitted["converged"]):
            row |= {"status": "not converged", "lag": lag}
        elif fitted["dof"] > 0:
            row |= {"status": "fitted", "lag": lag, "n": n, "dof": fitted["dof"], "sample": sample, "loglik": loglik}
            row |= {name: fitted[name].ravel() for name in ("coef", "intercept", "raw_coef", "raw_intercept", "scale")}
            row["sigma"] = (fitted["residual"] / fitted["dof"]).ravel()
        return [row]

    if parts is None:
        parts = solver_parts(panel, spine, keys, maxlag, lags, sparse, block)
    if not sparse or spine.groupBy(*keys).count().agg(F.max("count")).first()[0] in (None, *range(TARGETS + 1)):
        return _solve_groups(parts, keys, depth, solve, schema)
    parts = materialize(parts)
    wide = parts.where((F.col("_part") == _SMALL) & (F.col("k") > TARGETS)).select(*keys)
    narrow = _solve_groups(parts.join(wide, keys, "left_anti"), keys, depth, solve, schema)
    by_target = _sparse_by_target(materialize(parts.join(wide, keys, "left_semi")), keys, depth, lags, criterion, model)
    return narrow.unionByName(_solve_groups(by_target, keys, depth, solve, schema))


def sparse_var_fit(panel: DataFrame, spine: DataFrame, keys: Sequence[str], **settings) -> DataFrame:
    """``var_fit`` with the elastic-net model; ``alpha`` and ``l1_ratio`` set its penalties.

    Coefficients and covariance are in standardised units, so unit-shock
    responses are scale-free.
    """
    return var_fit(panel, spine, keys, sparse=True, **settings)


# ---------------------------------------------------------------- model tables


def _fitted(models: DataFrame) -> DataFrame:
    return models.where("status = 'fitted'")


def model_status(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group, fitted or not: ``<keys>, status, lag, nobs, n_members``."""
    return models.select(*keys, "status", "lag", "nobs", F.size("members").alias("n_members"))


def var_coefficients(models: DataFrame, keys: Sequence[str], raw: bool = False) -> DataFrame:
    """``<keys>, target, source, lag, coef``; the intercept is the row with a null source and lag 0."""
    k = F.size("members")
    coef, intercept = ("raw_coef", "raw_intercept") if raw else ("coef", "intercept")

    def member(position):
        return F.get("members", position.cast("int"))

    # slopes and intercepts leave the model row together, so that it is made once
    both = _fitted(models).select(*keys, "members", F.size(coef).alias("slopes"), F.posexplode(F.concat(coef, intercept)).alias("at", "coef"))
    constant = F.col("at") >= F.col("slopes")
    return both.select(
        *keys,
        member(F.when(constant, F.col("at") - F.col("slopes")).otherwise(F.col("at") % k)).alias("target"),
        F.when(~constant, member(F.floor(F.col("at") / k) % k)).alias("source"),
        F.when(constant, F.lit(0)).otherwise((F.floor(F.col("at") / (k * k)) + 1).cast("int")).alias("lag"),
        "coef",
    )


def var_sigma(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Residual covariance ``<keys>, target, source, sigma``."""
    k = F.size("members")
    cells = _fitted(models).select(*keys, "members", F.posexplode("sigma").alias("at", "sigma"))
    return cells.select(
        *keys,
        F.get("members", F.floor(F.col("at") / k).cast("int")).alias("target"),
        F.get("members", (F.col("at") % k).cast("int")).alias("source"),
        "sigma",
    )


def var_loglik(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Log-likelihood of every eligible lag on the common sample."""
    tried = models.where("sample > 0").select(
        *keys, F.size("members").alias("k"), F.col("sample").alias("n"), F.posexplode("loglik").alias("at", "loglik")
    )
    return tried.where("loglik is not null").select(*keys, "k", "n", (F.col("at") + 1).alias("lag"), "loglik")


def var_ic(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AIC, BIC and HQIC of every eligible lag."""
    n = F.col("n")
    params = F.col("k") * (F.col("k") * F.col("lag") + 1)
    fit = -2 * F.col("loglik") / n
    return (
        var_loglik(models, keys)
        .where("n > 1")
        .select(
            *keys,
            "lag",
            "n",
            "loglik",
            (fit + 2 * params / n).alias("aic"),
            (fit + F.ln(n) * params / n).alias("bic"),
            (fit + 2 * F.ln(F.ln(n)) * params / n).alias("hqic"),
        )
    )


def var_select_order(models: DataFrame, keys: Sequence[str], criterion: str = CRITERION) -> DataFrame:
    """Least criterion per group, the smaller lag on a tie."""
    best = F.min_by("lag", F.struct(F.col(criterion), F.col("lag")))
    return var_ic(models, keys).groupBy(*keys).agg(best.alias("lag"), F.min(criterion).alias(criterion))


# ------------------------------------------------------- prediction and residuals


def var_predict(panel: DataFrame, spine: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-step predictions ``<keys>, t, member, predicted`` for every row with a full history."""
    keys = list(keys)
    coefs = var_coefficients(models, keys, raw=True)
    slopes = coefs.where("lag > 0").withColumnsRenamed({"source": "member"})
    past = panel.select(*keys, "member", F.col("t").alias("seen"), "y")
    moved = (
        slopes.join(past, [*keys, "member"])
        .select(*keys, (F.col("seen") + F.col("lag")).alias("t"), F.col("target").alias("member"), (F.col("coef") * F.col("y")).alias("part"))
        .groupBy(*keys, "t", "member")
        .agg(F.sum("part").alias("part"))
    )
    constants = coefs.where("lag = 0").select(*keys, F.col("target").alias("member"), F.col("coef").alias("constant"))
    grid = spine.join(_fitted(models).select(*keys, "lag"), keys).select(
        *keys, "member", F.explode(F.sequence(F.col("lag"), F.col("nobs") - 1)).alias("t")
    )
    total = F.col("constant") + F.coalesce("part", F.lit(0.0))
    return (
        grid.join(constants, [*keys, "member"])
        .join(moved, [*keys, "t", "member"], "left")
        .select(*keys, "t", "member", total.alias("predicted"))
    )


def var_rss(panel: DataFrame, spine: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Residual sum of squares per equation."""
    keys = list(keys)
    actual = densify(panel, spine, keys)
    error = F.col("y") - F.col("predicted")
    joined = var_predict(panel, spine, models, keys).join(actual, [*keys, "t", "member"])
    return joined.groupBy(*keys, "member").agg(F.sum(error * error).alias("rss"))


def var_rss_moments(models: DataFrame, parts: DataFrame, keys: Sequence[str], maxlag: int = MAX_LAG) -> DataFrame:
    """Residual sum of squares per equation from stored ``solver_parts``, without the series: ``<keys>, member, rss``.

    With G the moments of a model's design, h those with a target and b its coefficients, that is ``y'y - 2 b'h + b'G b``. The parts
    may be those of other days than the model was fitted on, under the model's keys; members are matched by name, and a group
    with other members than its model has no row. ``maxlag`` is that of the parts.
    """
    keys = list(keys)
    schema = T.StructType.fromDDL(f"{key_schema(parts, keys)}, member string, rss double")
    fitted = _fitted(models).select(*keys, F.col("members").alias("_names"), F.col("lag").alias("_lag"), "raw_coef", "raw_intercept")
    small = parts.where(F.col("_part") == _SMALL).join(fitted, keys)
    sought = small.unionByName(parts.where(F.col("_part") == _TILE).join(fitted.select(*keys), keys, "left_semi"), allowMissingColumns=True)

    def solve(group: _Group) -> list[dict]:
        lag, names = group.given["_lag"], group.given["_names"]
        if sorted(names) != sorted(group.members) or lag > group.maxlag:
            return []
        place = np.array([names.index(name) for name in group.members])
        k = group.k
        coef = np.reshape(group.given["raw_coef"], (lag, k, k))[:, place][:, :, place].reshape(lag * k, k)
        beta = np.vstack([coef, np.asarray(group.given["raw_intercept"])[place]])
        gram, rhs, target = dense.normal_equations(*group.sample(lag, lag)[:2], lag, group.nobs - lag)
        residual = dense.without_met(dense.residual_products(gram, rhs, target, beta), target)
        return [{"member": name, "rss": float(rss)} for name, rss in zip(group.members, np.diag(residual))]

    return _solve_groups(sought, keys, maxlag, solve, schema)


def sparse_certificate(
    panel: DataFrame, spine: DataFrame, models: DataFrame, keys: Sequence[str], alpha: float = ALPHA, l1_ratio: float = L1_RATIO
) -> DataFrame:
    """How far each equation of a sparse model is from the optimality conditions: ``<keys>, target, gap``, as plain joins and sums.

    Coefficients b of the elastic net are optimal exactly if, for every column x of the standardised design with residuals r,
    ``x'r - l2 b`` equals ``l1 sign(b)`` where b is not 0, and lies within ``l1`` of 0 where it is. ``gap`` is the largest
    excess over these, per row of the sample. Nothing is solved here, and the sums come from the series, not from the
    moments the solver used.
    """
    keys = list(keys)
    ratio = min(max(l1_ratio, 0.0), 1.0)
    fitted = _fitted(models).select(*keys, "lag", F.col("n").cast("double").alias("n"))
    cells = densify(panel, spine, keys).join(fitted, keys).withColumn("y", F.col("y").cast("double"))
    # the columns of the design: each member at each lag, by the row it explains
    shifted = cells.withColumn("l", F.explode(F.sequence(F.lit(1), F.col("lag")))).withColumn("row", F.col("t") + F.col("l"))
    rows = F.col("n") + F.col("lag")
    design = shifted.where(F.col("row").between(F.col("lag"), rows - 1)).select(*keys, F.col("member").alias("source"), "l", "row", F.col("y").alias("x"))
    answer = cells.where(F.col("t") >= F.col("lag")).select(*keys, F.col("member").alias("target"), F.col("t").alias("row"), "y")

    def scale(variance):
        return F.when(F.sqrt(variance) < 1e-32, F.lit(1.0)).otherwise(F.sqrt(variance))

    x_scale = design.groupBy(*keys, "source", "l").agg(F.avg("x").alias("x_mean"), F.var_pop("x").alias("x_var")).withColumn("x_sd", scale(F.col("x_var")))
    y_scale = answer.groupBy(*keys, "target").agg(F.avg("y").alias("y_mean"), F.var_pop("y").alias("y_var")).withColumn("y_sd", scale(F.col("y_var")))
    scaled = design.join(x_scale, [*keys, "source", "l"]).withColumn("x", (F.col("x") - F.col("x_mean")) / F.col("x_sd"))
    scaled = scaled.select(*keys, "source", "l", "row", "x")
    slopes = var_coefficients(models, keys).where("lag > 0").select(*keys, "target", "source", F.col("lag").alias("l"), "coef")
    told = scaled.join(slopes.where("coef <> 0"), [*keys, "source", "l"]).groupBy(*keys, "target", "row").agg(F.sum(F.col("x") * F.col("coef")).alias("told"))
    errors = answer.join(y_scale, [*keys, "target"]).join(told, [*keys, "target", "row"], "left")
    errors = errors.select(*keys, "target", "row", ((F.col("y") - F.col("y_mean")) / F.col("y_sd") - F.coalesce("told", F.lit(0.0))).alias("error"))
    slope_of = scaled.join(errors, [*keys, "row"]).groupBy(*keys, "target", "source", "l").agg(F.sum(F.col("x") * F.col("error")).alias("g"))
    judged = (
        slope_of.join(slopes, [*keys, "target", "source", "l"])
        .join(x_scale.select(*keys, "source", "l", "x_sd"), [*keys, "source", "l"])
        .join(y_scale.select(*keys, "target", "y_sd"), [*keys, "target"])
        .join(fitted.select(*keys, "n"), keys)
    )
    l1 = F.lit(abs(alpha) * ratio) * F.col("n") / (F.col("x_sd") * F.col("y_sd"))
    l2 = F.lit(abs(alpha) * (1 - ratio)) * F.col("n") / (F.col("x_sd") * F.col("x_sd"))
    off = F.when(F.col("coef") != 0, F.abs(F.col("g") - l2 * F.col("coef") - l1 * F.signum("coef"))).otherwise(F.greatest(F.abs("g") - l1, F.lit(0.0)))
    return judged.groupBy(*keys, "target").agg(F.max(off / F.col("n")).alias("gap"))


# ------------------------------------------------- responses and variance shares


def _responses(models: DataFrame, keys: Sequence[str], horizon: int, kind: str, first_step: int = 0) -> DataFrame:
    """Long response rows from ``first_step`` on; ``kind`` is ``plain``, ``unit``, ``sd`` or ``ml`` (ML covariance, with pivots)."""
    keys = list(keys)
    schema = T.StructType.fromDDL(
        f"{key_schema(models, keys)}, horizon int, src string, dst string, value double, pivot double"
    )

    def respond(model) -> dict:
        members = np.asarray(model.members, dtype=object)
        k = len(members)
        coef = np.asarray(model.coef).reshape(model.lag, k, k)
        pivots, first = np.ones(k), np.eye(k)
        if kind != "plain":
            sigma = np.asarray(model.sigma).reshape(k, k)
            first, pivots = dense.unit_lower_factor(sigma * (model.dof / model.n if kind == "ml" else 1.0))
        if kind == "sd":
            first = first * np.sqrt(np.maximum(pivots, 0.0))
        values = dense.propagate(coef, first, horizon)
        if kind == "sd":
            values = values * np.asarray(model.scale)
        values = values[first_step:]
        h, dst, src = (axis.ravel() for axis in np.indices(values.shape))
        h = h + first_step
        columns = {name: np.full(len(h), getattr(model, name), dtype=object) for name in keys}
        return columns | {
            "horizon": h,
            "src": members[src],
            "dst": members[dst],
            "value": values.ravel(),
            "pivot": pivots[src],
        }

    def together(parts: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate([part[name] for part in parts]) for name in schema.names})

    def expand(batches):
        for batch in batches:
            ready, size = [], 0
            for model in batch.itertuples(index=False):
                ready.append(respond(model))
                size += len(ready[-1]["value"])
                if size > 50_000:
                    yield together(ready)
                    ready, size = [], 0
            if ready:
                yield together(ready)

    needed = _fitted(models).select(*keys, "members", "coef", "lag", "sigma", "dof", "n", "scale")
    return needed.mapInPandas(expand, schema)


def ma_coefficients(models: DataFrame, keys: Sequence[str], horizon: int = 10) -> DataFrame:
    """Moving-average coefficients 0…horizon."""
    return _responses(models, keys, horizon, "plain").drop("pivot")


def impulse_response(
    models: DataFrame, keys: Sequence[str], horizon: int = 30, orth: bool = False, shock: str = "sd", first_step: int = 0
) -> DataFrame:
    """Responses ``<keys>, horizon, src, dst, value`` of the steps ``first_step`` to ``horizon``; ``shock`` is ``unit`` or ``sd`` when orthogonalised."""
    if shock not in ("unit", "sd"):
        raise ValueError(f"shock must be unit or sd, got {shock!r}")
    return _responses(models, keys, horizon, shock if orth else "plain", first_step).drop("pivot")


def fevd(models: DataFrame, keys: Sequence[str], horizon: int = 30) -> DataFrame:
    """Share of each member's forecast-error variance owed to each source.

    Null where a member has no error variance at all (nothing above what rounding leaves).
    """
    # dealt by receiver: both windows find their rows together
    partitions = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    responses = _responses(models, keys, horizon, "ml").repartition(partitions, *keys, "dst")
    so_far = Window.partitionBy(*keys, "dst", "src").orderBy("horizon").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys, "dst", "horizon")
    variance = F.sum(F.col("value") * F.col("value")).over(so_far) * F.col("pivot")
    shared = responses.withColumn("variance", variance).withColumn("whole", F.sum("variance").over(whole))
    share = F.when(F.col("whole") > 1e-18, F.col("variance") / F.col("whole"))
    return shared.select(*keys, "horizon", "src", "dst", share.alias("share"))


def granger_pairs(
    panel: DataFrame,
    spine: DataFrame,
    keys: Sequence[str],
    maxlag: int = MAX_LAG,
    lags: int | None = None,
    criterion: str = CRITERION,
    df: str = "members",
    sparse: bool = False,
    alpha: float = ALPHA,
    l1_ratio: float = L1_RATIO,
    tol: float = 1e-9,
    max_iter: int = MAX_ITERATIONS,
    block: int = BLOCK,
    parts: DataFrame | None = None,
) -> DataFrame:
    """Causality test of every ordered pair: ``causing, caused, lag, chi2, p_value``.

    What a residual sum gains without a member follows from one factor of the full design, whatever its rank;
    sparse models are solved again without each causing member, from the same sums. ``parts`` may be stored ``solver_parts``.
    ``df="members"`` takes the number of members as degrees of freedom,
    ``df="lags"`` the number of lags.
    """
    if df not in ("members", "lags"):
        raise ValueError(f"df must be members or lags, got {df!r}")
    keys = list(keys)
    depth = lags or maxlag
    model = _model(sparse, alpha, l1_ratio, tol, max_iter)
    schema = T.StructType.fromDDL(
        f"{key_schema(spine, keys)}, causing string, caused string, lag int, chi2 double, p_value double"
    )

    def solve(group: _Group) -> list[dict]:
        out = []
        lag = lags
        if lag is None and group.maxlag >= 1:
            lag = _select_lag(group, model, criterion)[0]
        if group.k > 1 and lag and lag <= group.maxlag and model.eligible(group.nobs, group.k, lag):
            full, n = _refit(group, model, lag)
            spare = n - group.k * lag - 1
            degrees = group.k if df == "members" else lag
            reduced_by = None if sparse else _reduced_rss(group, lag, full)
            for causing in range(group.k):
                kept = [c for c in range(group.k) if c != causing]
                reduced = _refit(group, model, lag, without=causing)[0]["raw_rss"] if sparse else reduced_by[causing][kept]
                for at, caused in enumerate(kept):
                    rss = full["raw_rss"][caused]
                    known = rss > 0 and spare > 0
                    chi2 = (reduced[at] - rss) * spare / rss if known else None
                    tail = dense.chi2_upper_tail(chi2, degrees) if known else None
                    values = (group.members[causing], group.members[caused], lag, chi2, tail)
                    out.append(dict(zip(fields, values)))
        return out

    if parts is None:
        parts = solver_parts(panel, spine, keys, maxlag, lags, sparse, block)
    fields = schema.names[len(keys) :]
    return _solve_groups(parts, keys, depth, solve, schema)
