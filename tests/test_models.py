"""Distributed moments and grouped solves against direct numpy least squares on the raw series."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.functions import dense
from flowspark.operators import network, var
from flowspark.operators.moments import lag_moments, moment_tiles
from flowspark.operators.panel import densify

KEYS = ["date", "place_id"]


def make(spark, series):
    """``series``: {(date, place): T x K array}. Members are named M00, M01, …"""
    cells, spine = [], []
    for (date, place), y in series.items():
        for k in range(y.shape[1]):
            spine.append((date, place, f"M{k:02d}", k, y.shape[0]))
            cells += [(date, place, f"M{k:02d}", k, t, int(v), *y.shape) for t, v in enumerate(y[:, k]) if v]
    return (
        spark.createDataFrame(cells, "date string, place_id string, member string, i int, t int, y bigint, nobs int, k int"),
        spark.createDataFrame(spine, "date string, place_id string, member string, i int, nobs int"),
    )


def walk(seed, rows, k):
    """Counts with real cross-lag structure."""
    rng = np.random.default_rng(seed)
    y = np.zeros((rows, k))
    pull = rng.uniform(0, 0.5 / k, (k, k))
    for t in range(rows):
        y[t] = rng.poisson(1 + (y[t - 1] @ pull if t else 0) + np.arange(k))
    return y.astype(int)


def design(y, lag, start):
    """Rows t >= start of [y(t-1) … y(t-lag), 1] and their targets."""
    rows = [np.concatenate([y[t - a] for a in range(1, lag + 1)] + [[1.0]]) for t in range(start, len(y))]
    return np.array(rows), y[start:].astype(float)


def ordered(y):
    order = sorted(range(y.shape[1]), key=lambda k: (-y[:, k].sum(), k))
    return y[:, order], [f"M{k:02d}" for k in order]


def direct(y, maxlag, criterion="hqic"):
    """Lag choice and refit straight from the series."""
    k = y.shape[1]
    depth = min(maxlag, len(y) - 1)
    best, chosen, table = np.inf, 1, {}
    for p in range(1, depth + 1):
        if len(y) - depth - k * p - 1 <= 0:
            continue
        x, b = design(y, p, depth)
        beta = np.linalg.pinv(x.T @ x) @ x.T @ b
        n = len(x)
        cov = (b - x @ beta).T @ (b - x @ beta) / n
        ll = -0.5 * n * (k * math.log(2 * math.pi) + math.log(abs(np.linalg.det(cov)) + 1e-256) + np.linalg.matrix_rank(cov))
        params = k * (k * p + 1)
        weight = {"aic": 2, "bic": math.log(n), "hqic": 2 * math.log(math.log(n))}[criterion]
        table[p] = (ll, -2 * ll / n + weight * params / n)
        if table[p][1] < best:
            best, chosen = table[p][1], p
    x, b = design(y, chosen, chosen)
    beta = np.linalg.pinv(x.T @ x) @ x.T @ b
    residual = b - x @ beta
    sigma = residual.T @ residual / (len(x) - k * chosen - 1)
    return chosen, beta, sigma, table, residual


def test_cross_moments_in_blocks(spark):
    y = walk(1, 97, 3)
    panel, _ = make(spark, {("d", "p"): y})
    for block in (1, 13, 500):
        got = {(r["i"], r["j"], r["lag"]): r["s"] for r in lag_moments(panel, KEYS, 4, block).collect()}
        want = {
            (i, j, d): int((y[d:, i] * y[: len(y) - d, j]).sum()) for d in range(5) for i in range(3) for j in range(3) if d or i <= j
        }
        assert got == {key: value for key, value in want.items() if value}


@pytest.mark.parametrize("tile,block", [(1, 1440), (2, 20), (3, 7), (64, 1440)])
def test_tiles_hold_the_cross_moments(spark, tile, block):
    y = walk(1, 50, 5)
    panel, _ = make(spark, {("d", "p"): y, ("d", "q"): y[:, :1], ("e", "p"): np.zeros((9, 2), dtype=int)})
    want = {(i, j, d): int((y[d:, i] * y[: len(y) - d, j]).sum()) for d in range(4) for i in range(5) for j in range(5) if d or i <= j}
    for df in (panel, panel.drop("k", "nobs")):
        rows = lag_moments(df, KEYS, 3, block, tile).collect()
        assert {(r["i"], r["j"], r["lag"]): r["s"] for r in rows if r["place_id"] == "p"} == {key: v for key, v in want.items() if v}
        assert {(r["i"], r["j"]) for r in rows if r["place_id"] == "q"} == {(0, 0)}
    tiles = moment_tiles(panel.where("place_id = 'p'"), KEYS, 3, block, tile)
    assert all(max(r["rows"], r["cols"]) <= tile for r in tiles.collect())
    assert lag_moments(panel.limit(0), KEYS, 3).count() == 0


@pytest.mark.parametrize("start,width", [(3, 3), (6, 4), (6, 6)])
def test_sample_moments(start, width):
    y = walk(2, 40, 3).astype(float)
    cross = np.array([y[d:].T @ y[: len(y) - d] for d in range(7)])
    products = dense.lagged_products(cross, lambda t: y[t], start, width, len(y))
    sums = dense.lagged_sums(y.sum(axis=0), lambda t: y[t], start, width, len(y))
    for a in range(width + 1):
        ya = y[start - a : len(y) - a]
        assert np.allclose(sums[a], ya.sum(axis=0))
        for b in range(width + 1):
            assert np.allclose(products[a, b], ya.T @ y[start - b : len(y) - b])


@pytest.fixture(scope="module")
def series():
    out = {("2024-01-01", "P0"): walk(3, 80, 4), ("2024-01-01", "P1"): walk(4, 60, 2), ("2024-01-02", "P0"): walk(5, 30, 3)}
    silent = walk(6, 70, 3)
    silent[:, 1] = 0
    out["2024-01-02", "P1"] = silent
    out["2024-01-03", "P0"] = np.zeros((50, 3), dtype=int)
    out["2024-01-03", "P1"] = walk(7, 45, 1)
    return out


@pytest.fixture(scope="module")
def fitted(spark, series):
    panel, spine = make(spark, series)
    panel, spine = panel.cache(), spine.cache()
    models = var.var_fit(panel, spine, KEYS, maxlag=6, block=20).cache()
    return panel, spine, models


def by_group(df, series):
    rows = df.collect()
    return {key: [r for r in rows if (r["date"], r["place_id"]) == key] for key in series}


def test_selection_coefficients_and_covariance(fitted, series):
    _, _, models = fitted
    model = {key: rows[0] for key, rows in by_group(models, series).items()}
    ics = by_group(var.var_ic(models, KEYS), series)
    chosen = by_group(var.var_select_order(models, KEYS), series)
    for key, raw in series.items():
        y, names = ordered(raw)
        lag, beta, sigma, table, _ = direct(y, 6)
        got = model[key]
        k = y.shape[1]
        assert got["status"] == "fitted" and got["members"] == names
        assert got["lag"] == lag == chosen[key][0]["lag"]
        assert np.allclose(np.reshape(got["coef"], (lag * k, k)), beta[:-1], atol=1e-8)
        assert np.allclose(got["intercept"], beta[-1], atol=1e-8)
        assert np.allclose(np.reshape(got["sigma"], (k, k)), sigma, atol=1e-8)
        assert {r["lag"] for r in ics[key]} == set(table)
        for r in ics[key]:
            assert r["hqic"] == pytest.approx(table[r["lag"]][1], rel=1e-8)


def test_coefficient_table(fitted, series):
    _, _, models = fitted
    for key, rows in by_group(var.var_coefficients(models, KEYS), series).items():
        y, names = ordered(series[key])
        lag, beta, *_ = direct(y, 6)
        got = {(r["target"], r["source"], r["lag"]): r["coef"] for r in rows}
        assert len(got) == len(names) * (len(names) * lag + 1)
        for d, target in enumerate(names):
            assert got[target, None, 0] == pytest.approx(beta[-1, d], abs=1e-8)
            for a in range(lag):
                for s, source in enumerate(names):
                    assert got[target, source, a + 1] == pytest.approx(beta[a * len(names) + s, d], abs=1e-8)


def test_prediction_and_rss(fitted, series):
    panel, spine, models = fitted
    rss = by_group(var.var_rss(panel, spine, models, KEYS), series)
    for key, raw in series.items():
        y, names = ordered(raw)
        residual = direct(y, 6)[4]
        got = {r["member"]: r["rss"] for r in rss[key]}
        assert [got[name] for name in names] == pytest.approx((residual**2).sum(axis=0).tolist(), abs=1e-6)


def factor(sigma):
    k = len(sigma)
    lower, d = np.eye(k), np.zeros(k)
    for i in range(k):
        d[i] = sigma[i, i] - sum(lower[i, m] ** 2 * d[m] for m in range(i))
        for r in range(i + 1, k):
            gap = sigma[r, i] - sum(lower[r, m] * lower[i, m] * d[m] for m in range(i))
            lower[r, i] = gap / (d[i] or 1e-16)
    return lower, d


def responses(beta, first, lag, horizon):
    k = beta.shape[1]
    out = [first]
    for h in range(1, horizon + 1):
        out.append(sum(beta[a * k : (a + 1) * k].T @ out[h - 1 - a] for a in range(min(lag, h))))
    return np.array(out)


def test_impulse_responses_and_edges(fitted, series):
    _, _, models = fitted
    unit = by_group(var.impulse_response(models, KEYS, 4, orth=True, shock="unit"), series)
    sd = by_group(var.impulse_response(models, KEYS, 4, orth=True, shock="sd"), series)
    plain = by_group(var.ma_coefficients(models, KEYS, 4), series)
    edges = by_group(network.influence_edges(models, KEYS), series)
    for key, raw in series.items():
        y, names = ordered(raw)
        lag, beta, sigma, *_ = direct(y, 6)
        lower, d = factor(sigma)
        for rows, first in ((unit, lower), (sd, lower * np.sqrt(d)), (plain, np.eye(len(names)))):
            want = responses(beta, first, lag, 4)
            for r in rows[key]:
                value = want[r["horizon"], names.index(r["dst"]), names.index(r["src"])]
                assert r["value"] == pytest.approx(value, abs=1e-6)
        one = responses(beta, lower, lag, 1)[1]
        assert len(edges[key]) == len(names) ** 2
        for r in edges[key]:
            value = round(float(one[names.index(r["DESTINATION"]), names.index(r["ORIGIN"])]), 4)
            kept = value if value > 0 and r["ORIGIN"] != r["DESTINATION"] else 0.0
            assert r["MOVEMENT_INFLUENCE_AMOUNT"] == pytest.approx(kept, abs=1e-9)


def test_variance_shares_sum_to_one(fitted, series):
    _, _, models = fitted
    shares = var.fevd(models, KEYS, 3).groupBy(*KEYS, "horizon", "dst").agg(F.sum("share").alias("s"))
    rows = shares.collect()
    assert all(r["s"] is None or r["s"] == pytest.approx(1.0) for r in rows)
    # only a member without any variance has no shares
    assert {(r["date"], r["place_id"], r["dst"]) for r in rows if r["s"] is None} == {
        ("2024-01-02", "P1", "M01"),
        *(("2024-01-03", "P0", f"M{k:02d}") for k in range(3)),
    }


def test_silent_groups_have_zero_edges(fitted):
    _, _, models = fitted
    edges = network.influence_edges(models, KEYS).where("date = '2024-01-03' and place_id = 'P0'")
    assert {r["MOVEMENT_INFLUENCE_AMOUNT"] for r in edges.collect()} == {0.0}
    popular = network.popularity(network.influence_edges(models, KEYS), KEYS)
    quiet = popular.where("date = '2024-01-03'").collect()
    assert {(r["place_id"], r["popular_area"]) for r in quiet} == {("P0", 0.0), ("P1", 1.0)}


def test_factor_rebuilds_the_covariance():
    a = np.random.default_rng(0).normal(size=(6, 6))
    cov = a @ a.T
    lower, d = dense.unit_lower_factor(cov)
    assert np.allclose(lower @ np.diag(d) @ lower.T, cov)
    assert np.allclose(lower, factor(cov)[0])


def test_granger_pairs(spark, fitted, series):
    panel, spine, _ = fitted
    tests = by_group(var.granger_pairs(panel, spine, KEYS, lags=2), series)
    for key in (("2024-01-01", "P0"), ("2024-01-01", "P1")):
        y, names = ordered(series[key])
        k = y.shape[1]

        def rss(columns):
            x, b = design(y[:, columns], 2, 2)
            beta = np.linalg.pinv(x.T @ x) @ x.T @ b
            return ((b - x @ beta) ** 2).sum(axis=0), len(x)

        full, n = rss(list(range(k)))
        assert len(tests[key]) == k * (k - 1)
        for r in tests[key]:
            causing, caused = names.index(r["causing"]), names.index(r["caused"])
            kept = [c for c in range(k) if c != causing]
            less = rss(kept)[0][kept.index(caused)]
            chi2 = (less - full[caused]) / k / (full[caused] / (n - 2 * k - 1)) * k
            assert r["chi2"] == pytest.approx(chi2, rel=1e-7)
            assert r["p_value"] == pytest.approx(dense.chi2_upper_tail(chi2, k), rel=1e-6)


def test_chi2_tail():
    # fixed values: table points with upper tail 0.05
    for df, point in ((1, 3.841459), (2, 5.991465), (3, 7.814728), (8, 15.507313), (15, 24.995790)):
        assert dense.chi2_upper_tail(point, df) == pytest.approx(0.05, abs=1e-6)
    assert dense.chi2_upper_tail(0.0, 4) == 1.0


def test_sparse_model_meets_its_optimality_conditions(spark, series):
    panel, spine = make(spark, series)
    alpha, ratio = 0.1, 0.4
    models = var.sparse_var_fit(panel, spine, KEYS, lags=2, alpha=alpha, l1_ratio=ratio)
    for key, rows in by_group(models, series).items():
        y, names = ordered(series[key])
        k = len(names)
        x, b = design(y, 2, 2)
        n = len(x)
        x = x[:, :-1]
        sx, sy = x.std(axis=0), b.std(axis=0)
        sx, sy = np.where(sx < 1e-32, 1, sx), np.where(sy < 1e-32, 1, sy)
        z, w = (x - x.mean(axis=0)) / sx, (b - b.mean(axis=0)) / sy
        beta = np.reshape(rows[0]["coef"], (2 * k, k))
        gradient = z.T @ (w - z @ beta) - alpha * (1 - ratio) * n * beta / (sx**2)[:, None]
        limit = alpha * ratio * n / np.outer(sx, sy)
        active = np.abs(beta) > 1e-9
        assert np.allclose(gradient[active], (np.sign(beta) * limit)[active], atol=1e-5)
        assert (np.abs(gradient[~active]) <= limit[~active] + 1e-5).all()
        residual = w - z @ beta
        assert np.allclose(np.reshape(rows[0]["sigma"], (k, k)), residual.T @ residual / (n - 1), atol=1e-6)


def test_sparse_prediction_is_in_original_units(spark):
    y = walk(9, 60, 3)
    panel, spine = make(spark, {("d", "p"): y})
    models = var.sparse_var_fit(panel, spine, KEYS, lags=1, alpha=0.0)
    got = {r["member"]: r["rss"] for r in var.var_rss(panel, spine, models, KEYS).collect()}
    y, names = ordered(y)
    x, b = design(y, 1, 1)
    beta = np.linalg.lstsq(x, b, rcond=None)[0]
    assert [got[name] for name in names] == pytest.approx(((b - x @ beta) ** 2).sum(axis=0).tolist(), rel=1e-5)


def test_unfittable_groups_keep_a_status_row(spark):
    series = {("d", "short"): walk(1, 12, 10), ("d", "tiny"): walk(1, 1, 2), ("d", "fine"): walk(1, 12, 3)}
    panel, spine = make(spark, series)
    status = {r["place_id"]: (r["status"], r["lag"]) for r in var.var_fit(panel, spine, KEYS).collect()}
    # twelve rows leave no lag eligible on the common sample, so lag 1 is forced where it fits
    assert status == {"short": ("too few rows", None), "tiny": ("too few rows", None), "fine": ("fitted", 1)}
    assert network.influence_edges(var.var_fit(panel, spine, KEYS), KEYS).select("place_id").distinct().count() == 1


def test_lag_can_differ_between_groups_and_criteria(spark, series):
    panel, spine = make(spark, series)
    for criterion in ("aic", "bic"):
        models = by_group(var.var_fit(panel, spine, KEYS, maxlag=6, criterion=criterion), series)
        for key, raw in series.items():
            assert models[key][0]["lag"] == direct(ordered(raw)[0], 6, criterion)[0]
    with pytest.raises(ValueError, match="criterion"):
        var.var_fit(panel, spine, KEYS, criterion="fpe")


def test_predictions_cover_every_row(fitted, series):
    panel, spine, models = fitted
    predicted = var.var_predict(panel, spine, models, KEYS)
    lags = {(r["date"], r["place_id"]): r["lag"] for r in models.collect()}
    want = sum((len(y) - lags[key]) * y.shape[1] for key, y in series.items())
    assert predicted.count() == want
    assert densify(panel, spine, KEYS).count() == sum(y.size for y in series.values())


def sparse_counts(rng, rows, k):
    """Few counts, some columns equal or silent: systems of low rank."""
    y = (rng.random((rows, k)) < 0.06) * rng.integers(1, 3, (rows, k))
    y[:, k - 1] = y[:, 0]
    if k > 3:
        y[:, k - 2] = 0
    return y.astype(float)


def moments_of(y, lag):
    x, b = design(y, lag, lag)
    return x.T @ x, x.T @ b, b.T @ b, len(x)


@pytest.mark.parametrize("seed", range(12))
def test_singular_models_do_not_depend_on_member_order(seed):
    rng = np.random.default_rng(seed)
    k, lag = int(rng.integers(2, 7)), int(rng.integers(1, 4))
    y = sparse_counts(rng, 60, k)
    gram, rhs, target, n = moments_of(y, lag)
    beta = dense.solve_least_squares(gram, rhs)
    residual = dense.least_squares_residual(gram, rhs, target)
    loglik = dense.gaussian_loglik(residual / n, n)
    assert np.allclose(beta, np.linalg.pinv(gram, rcond=1e-10) @ rhs, atol=1e-8)
    for _ in range(4):
        order = rng.permutation(k)
        g2, r2, t2, _ = moments_of(y[:, order], lag)
        again = dense.solve_least_squares(g2, r2)
        columns = np.concatenate([np.concatenate([a * k + order for a in range(lag)]), [lag * k]])
        assert np.allclose(again, beta[columns][:, order], atol=1e-8)
        left = dense.least_squares_residual(g2, r2, t2)
        assert np.allclose(left, residual[np.ix_(order, order)], atol=1e-9)
        assert math.isclose(dense.gaussian_loglik(left / n, n), loglik, rel_tol=1e-9)


def test_lag_choice_of_singular_groups_ignores_names(spark):
    rng = np.random.default_rng(3)
    series = {(f"d{i}", "p"): sparse_counts(rng, 40, 4).astype(int) for i in range(6)}
    turned = {key: y[:, ::-1] for key, y in series.items()}
    found = []
    for given in (series, turned):
        models = var.var_fit(*make(spark, given), KEYS, maxlag=4)
        found.append({r["date"]: (r["lag"], [None if v is None else round(v, 6) for v in r["loglik"]]) for r in models.collect()})
    assert found[0] == found[1]


def test_unconverged_models_say_so(spark):
    panel, spine = make(spark, {("d", "p"): walk(1, 60, 3)})
    models = var.sparse_var_fit(panel, spine, KEYS, lags=1, max_iter=1)
    assert [r["status"] for r in var.model_status(models, KEYS).collect()] == ["not converged"]
    assert var.var_coefficients(models, KEYS).count() == 0
    assert [r["status"] for r in var.sparse_var_fit(panel, spine, KEYS, lags=1).collect()] == ["fitted"]


def test_causality_from_one_inverse_equals_solving_again(spark, monkeypatch):
    panel, spine = make(spark, {("d", "p"): walk(4, 80, 4)})
    quick = {(r["causing"], r["caused"]): r["chi2"] for r in var.granger_pairs(panel, spine, KEYS, lags=2).collect()}
    y, names = ordered(walk(4, 80, 4))
    x, b = design(y, 2, 2)
    rss = lambda x: ((b - x @ np.linalg.lstsq(x, b, rcond=None)[0]) ** 2).sum(axis=0)
    full, spare = rss(x), len(x) - 4 * 2 - 1
    for c in range(4):
        less = rss(np.delete(x, [c, 4 + c], axis=1))
        for d in range(4):
            if c != d:
                assert quick[names[c], names[d]] == pytest.approx((less[d] - full[d]) * spare / full[d], rel=1e-6)


def test_one_solve_feeds_all_coefficients(spark, capsys):
    panel, spine = make(spark, {("d", "p"): walk(1, 60, 3)})
    var.var_coefficients(var.var_fit(panel, spine, KEYS, lags=1), KEYS).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 2  # the tiles, the solve


def test_shares_take_one_shuffle(spark, capsys):
    from flowspark.session import materialize

    panel, spine = make(spark, {("d", "p"): walk(1, 60, 3)})
    models = materialize(var.var_fit(panel, spine, KEYS, lags=1))
    capsys.readouterr()
    var.fevd(models, KEYS, 3).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


@pytest.mark.parametrize("seed", range(6))
def test_one_sweep_gives_every_lag(seed):
    rng = np.random.default_rng(seed)
    y = walk(seed, 70, 3).astype(float) if seed % 2 else sparse_counts(rng, 70, 5)
    cross = np.array([y[d:].T @ y[: len(y) - d] for d in range(5)])
    products = dense.lagged_products(cross, lambda t: y[t], 4, 4, len(y))
    sums = dense.lagged_sums(y.sum(axis=0), lambda t: y[t], 4, 4, len(y))
    swept = list(dense.lag_sweep(products, sums, 4, len(y) - 4))
    assert len(swept) == 4
    for lag, (residual, rank) in enumerate(swept, start=1):
        gram, rhs, target = dense.normal_equations(products, sums, lag, len(y) - 4)
        assert np.allclose(residual, dense.least_squares_residual(gram, rhs, target), atol=1e-7)
        assert rank == np.linalg.matrix_rank(gram, tol=1e-7 * gram.max())


@pytest.mark.parametrize("panel", [1, 2, 48])
def test_elimination_in_panels(panel):
    a = np.random.default_rng(1).integers(0, 4, (60, 7)).astype(float)
    a[:, 3] = a[:, 0] + a[:, 1]
    gram = a.T @ a
    left, kept = dense.eliminate(gram, 5, panel=panel)
    assert kept == [0, 1, 2, 4]
    rest = a[:, 5:] - a[:, kept] @ np.linalg.lstsq(a[:, kept], a[:, 5:], rcond=None)[0]
    assert np.allclose(left[5:, 5:], rest.T @ rest)


def test_causality_of_singular_groups(spark):
    rng = np.random.default_rng(5)
    series = {("d", f"p{seed}"): sparse_counts(rng, 60, 5).astype(int) for seed in range(4)}
    series["d", "twice"] = np.repeat(walk(2, 60, 2), 2, axis=1)
    series["d", "sum"] = np.column_stack([walk(3, 60, 3), walk(3, 60, 3).sum(axis=1)])
    panel, spine = make(spark, series)
    found = by_group(var.granger_pairs(panel, spine, KEYS, lags=2), series)
    for key, raw in series.items():
        y, names = ordered(raw)
        k = y.shape[1]
        x, b = design(y, 2, 2)
        rss = lambda x: ((b - x @ np.linalg.lstsq(x, b, rcond=1e-10)[0]) ** 2).sum(axis=0)
        full, spare = rss(x), len(x) - 2 * k - 1
        assert len(found[key]) == k * (k - 1)
        for r in found[key]:
            c, d = names.index(r["causing"]), names.index(r["caused"])
            if full[d] <= 1e-9 * (b[:, d] ** 2).sum():
                assert r["chi2"] is None
            else:
                less = rss(np.delete(x, [c, k + c], axis=1))
                assert r["chi2"] == pytest.approx((less[d] - full[d]) * spare / full[d], rel=1e-5, abs=1e-6)


def test_residual_sums_from_stored_sums(spark, fitted, series):
    panel, spine, models = fitted
    parts = var.solver_parts(panel, spine, KEYS, maxlag=6).cache()
    again = var.var_fit(panel, spine, KEYS, maxlag=6, parts=parts)
    assert {(r["date"], r["place_id"]): r["lag"] for r in again.collect()} == {(r["date"], r["place_id"]): r["lag"] for r in models.collect()}
    got = by_group(var.var_rss_moments(models, parts, KEYS, maxlag=6), series)
    for key, raw in series.items():
        y, names = ordered(raw)
        rss = (direct(y, 6)[4] ** 2).sum(axis=0)
        assert {r["member"]: pytest.approx(r["rss"], abs=1e-5) for r in got[key]} == dict(zip(names, rss))


def test_residual_sums_on_another_day(spark):
    first, second = walk(1, 60, 3), walk(8, 60, 3)[:, ::-1]
    models = var.var_fit(*make(spark, {("d", "p"): first}), KEYS, lags=2)
    parts = var.solver_parts(*make(spark, {("d", "p"): second}), KEYS, lags=2)
    got = {r["member"]: r["rss"] for r in var.var_rss_moments(models, parts, KEYS, maxlag=2).collect()}
    x, b = design(first, 2, 2)
    beta = np.linalg.lstsq(x, b, rcond=None)[0]
    x, b = design(second, 2, 2)
    assert [got[f"M{k:02d}"] for k in range(3)] == pytest.approx(((b - x @ beta) ** 2).sum(axis=0).tolist(), rel=1e-8)


@pytest.mark.parametrize("lags", [None, 2])
def test_wide_sparse_groups_by_target(spark, monkeypatch, lags):
    series = {("d", "wide"): walk(3, 60, 5), ("d", "narrow"): walk(4, 50, 2), ("e", "wide"): walk(5, 40, 4)}
    panel, spine = make(spark, series)
    settings = {"maxlag": 3, "lags": lags, "alpha": 0.3, "l1_ratio": 0.5}
    whole = {(r["date"], r["place_id"]): r for r in var.sparse_var_fit(panel, spine, KEYS, **settings).collect()}
    monkeypatch.setattr(var, "TARGETS", 2)
    split = {(r["date"], r["place_id"]): r for r in var.sparse_var_fit(panel, spine, KEYS, **settings).collect()}
    assert whole.keys() == split.keys()
    for key, r in whole.items():
        got = split[key]
        assert (got["status"], got["lag"], got["members"], got["n"], got["sample"]) == ("fitted", r["lag"], r["members"], r["n"], r["sample"])
        for name in ("coef", "raw_coef", "raw_intercept", "sigma", "loglik"):
            assert np.allclose(np.array(got[name], float), np.array(r[name], float), atol=1e-6, equal_nan=True)


def test_certificate_tells_an_optimum(spark, series):
    panel, spine = make(spark, series)
    models = var.sparse_var_fit(panel, spine, KEYS, maxlag=4, alpha=0.3, l1_ratio=0.4).cache()
    sound = var.sparse_certificate(panel, spine, models, KEYS, alpha=0.3, l1_ratio=0.4).collect()
    assert len(sound) == sum(y.shape[1] for y in series.values()) and all(r["gap"] < 1e-7 for r in sound)
    for change in (lambda x: x * 1.01, lambda x: F.when(x == 0, 0.01).otherwise(x), lambda x: F.when(F.abs(x) < 0.2, 0.0).otherwise(x)):
        moved = var.sparse_certificate(panel, spine, models.withColumn("coef", F.transform("coef", change)), KEYS, alpha=0.3, l1_ratio=0.4)
        assert moved.agg(F.max("gap")).first()[0] > 1e-4
