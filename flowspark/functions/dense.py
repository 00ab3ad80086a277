"""Dense algebra for one group's model, called inside the grouped solve.

Everything here works on matrices whose size is set by the number of members of
one place, never on log rows.
"""

from __future__ import annotations

import math

import numpy as np

# A pivot at most this part of the diagonal it started from counts as zero. Counts make exact sums, so
# that true pivots and what rounding leaves of a zero one are many orders of magnitude apart.
RANK_TOLERANCE = 1e-9


def lagged_products(cross, edges, start, width, nobs):
    """Sums over the sample ``t = start … nobs-1`` from the whole-series sums.

    ``cross[d][i, j]`` is the sum over all t of y_i(t) y_j(t-d) and ``edges(t)``
    returns the row at t for the first and last rows. Returns the array
    ``S[a, b] = sum_t y(t-a) y(t-b)'`` for 0 <= a, b <= width and the sums of y(t-a).
    """
    k = cross.shape[1]
    head = np.array([edges(t) for t in range(start)]).reshape(start, k)
    tail = np.array([edges(nobs - 1 - a) for a in range(width)]).reshape(width, k)
    products = np.empty((width + 1, width + 1, k, k))
    for b in range(width + 1):
        products[0, b] = cross[b] - head[b:].T @ head[: start - b]
        products[b, 0] = products[0, b].T
    # moving both rows back by one gains a row before the sample and loses the last one
    before = head[::-1][:width]
    moved = np.einsum("ak,bl->abkl", before, before) - np.einsum("ak,bl->abkl", tail, tail)
    for a in range(width):
        products[a + 1, 1:] = products[a, :width] + moved[a]
    return products


def lagged_sums(total, edges, start, width, nobs):
    k = len(total)
    sums = np.empty((width + 1, k))
    sums[0] = total - sum((edges(t) for t in range(start)), np.zeros(k))
    for a in range(width):
        sums[a + 1] = sums[a] + edges(start - 1 - a) - edges(nobs - 1 - a)
    return sums


def normal_equations(products, sums, lag, n):
    """Gram matrix, right-hand side and target products of the lag-``lag`` design.

    Columns are member within lag, newest lag first, constant last.
    """
    k = products.shape[2]
    width = lag * k
    gram = np.empty((width + 1, width + 1))
    gram[:width, :width] = products[1 : lag + 1, 1 : lag + 1].transpose(0, 2, 1, 3).reshape(width, width)
    gram[:width, width] = gram[width, :width] = sums[1 : lag + 1].reshape(width)
    gram[width, width] = n
    rhs = np.empty((width + 1, k))
    rhs[:width] = products[1 : lag + 1, 0].reshape(width, k)
    rhs[width] = sums[0]
    return gram, rhs, products[0, 0]


def eliminate(matrix, count, start=None, panel=48):
    """Symmetric elimination of the first ``count`` columns in order: what is left, and the columns with a pivot.

    Pivots are measured against ``start``, by default the diagonal as it is. Column by column within a panel of rows; what
    lies beyond the panel is brought up to date by one matrix product.
    """
    left, kept = np.array(matrix, dtype=float), []
    start = np.diag(matrix).copy() if start is None else start
    for first in range(0, count, panel):
        last = min(first + panel, count)
        rows, held = left[first:last], []
        for c in range(first, last):
            at, pivot = c - first, left[c, c]
            if pivot > RANK_TOLERANCE * start[c]:
                held.append(c)
                rows[at + 1 :, c:] -= np.outer(rows[at + 1 :, c] / pivot, rows[at, c:])
        kept += held
        if held:
            upper = left[held, last:]
            left[last:, last:] -= (upper / left[held, held][:, None]).T @ upper
    return left, kept


def lag_sweep(products, sums, widest, n):
    """Residual products and rank of the least-squares fits of lags 1 … ``widest``, from one elimination.

    The design of a lag is the leading part of that of the next one, so the border is moved lag by lag:
    constant, members at lag 1, members at lag 2, …, targets. After the columns of a lag have gone, what is left of the
    targets' block are that lag's residual products. Yields ``(residual, rank)``.
    """
    k = products.shape[2]
    width = 1 + widest * k
    bordered = np.empty((width + k, width + k))
    order = [*range(1, widest + 1), 0]
    inner = products[np.ix_(order, order)].transpose(0, 2, 1, 3).reshape(width - 1 + k, width - 1 + k)
    bordered[1:, 1:], bordered[0, 0] = inner, n
    bordered[0, 1:] = bordered[1:, 0] = sums[order].ravel()
    own, target, rank, done = np.diag(bordered).copy(), products[0, 0], 0, 0
    left = bordered
    for lag in range(1, widest + 1):
        columns = 1 + lag * k - done
        # the pivots' limits are those of the whole matrix: a column is measured against what it started from
        left, kept = eliminate(left, columns, own[done:])
        rank += len(kept)
        left, done = left[columns:, columns:], done + columns
        yield without_met(left[-k:, -k:], target), rank


def without_met(residual, target):
    """Residual products in which an equation that is met exactly is exactly 0."""
    residual = (residual + residual.T) / 2
    met = np.diag(residual) <= RANK_TOLERANCE * np.diag(target)
    residual[met] = 0.0
    residual[:, met] = 0.0
    return residual


def least_squares_residual(gram, rhs, target):
    """Residual products of the least-squares fit; an equation that is met exactly has a residual of exactly 0."""
    width = len(gram)
    left, _ = eliminate(np.block([[gram, rhs], [rhs.T, target]]), width)
    return without_met(left[width:, width:], target)


def residual_products(gram, rhs, target, beta):
    cross = rhs.T @ beta
    return target - cross - cross.T + beta.T @ gram @ beta


def solve_least_squares(gram, rhs):
    """The solution of least norm; columns that others determine are found by the rank rule."""
    kept = eliminate(gram, len(gram))[1]
    if len(kept) == len(gram):
        return np.linalg.solve(gram, rhs)
    rows = gram[kept]
    return rows.T @ np.linalg.solve(rows @ rows.T, rhs[kept]) if kept else np.zeros(rhs.shape)


def standardise(gram, rhs, target):
    """Centre and scale the moments; a constant column keeps scale 1."""
    n = gram[-1, -1]
    x_mean, y_mean = gram[:-1, -1] / n, rhs[-1] / n
    x_cov = gram[:-1, :-1] - n * np.outer(x_mean, x_mean)
    xy_cov = rhs[:-1] - n * np.outer(x_mean, y_mean)
    y_cov = target - n * np.outer(y_mean, y_mean)
    x_sd, y_sd = _scale(np.diag(x_cov) / n), _scale(np.diag(y_cov) / n)
    scaled = (x_cov / np.outer(x_sd, x_sd), xy_cov / np.outer(x_sd, y_sd), y_cov / np.outer(y_sd, y_sd))
    return scaled, (x_mean, x_sd), (y_mean, y_sd)


def _scale(variance):
    sd = np.sqrt(np.maximum(variance, 0.0))
    return np.where(sd < 1e-32, 1.0, sd)


def solve_elastic_net(gram, rhs, l1, l2, start, tol, max_iter):
    """Minimise half the residual sum of squares plus ``l1`` * |b| plus half ``l2`` * b^2.

    Accelerated proximal gradient on the moments, momentum dropped whenever it
    points uphill; stops when no coefficient moves by more than ``tol``. ``l1`` is
    per coefficient, ``l2`` per column. A column without variance stays at 0.
    Also returns whether that happened within ``max_iter`` steps.
    """
    largest = largest_eigenvalue(gram)
    if largest <= 0:
        return np.zeros_like(rhs), True
    step, shrink = 1.0 / largest, 1.0 / (1.0 + l2[:, None] / largest)
    beta = point = start
    weight = 1.0
    for _ in range(max_iter):
        moved = point + step * (rhs - gram @ point)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0.0) * shrink
        change = new - beta
        if np.abs(change).max() <= tol:
            return new, True
        if np.vdot(point - new, change) > 0:
            weight = 1.0
        following = (1.0 + np.sqrt(1.0 + 4.0 * weight * weight)) / 2.0
        point = new + (weight - 1.0) / following * change
        beta, weight = new, following
    return beta, False


def largest_eigenvalue(matrix, exact=600, steps=100):
    """Of a positive semidefinite matrix; beyond ``exact`` rows by power iteration with a margin of a tenth, which only shortens steps."""
    if len(matrix) <= exact:
        return np.linalg.eigvalsh(matrix)[-1]
    vector = np.ones(len(matrix)) + np.arange(len(matrix)) % 7
    value = 0.0
    for _ in range(steps):
        following = matrix @ vector
        value = np.linalg.norm(following)
        if value == 0.0:
            return 0.0
        vector = following / value
    return 1.1 * value


def reduced_residual_gains(gram, coef, kept, inverse, dropped):
    """What each equation's residual sum gains when the columns ``dropped`` leave a design of any rank.

    ``kept`` are the columns with a pivot, ``inverse`` that of their part of ``gram``, ``coef`` the coefficients on them. With V the
    inverse and b the coefficients at the pivots that leave, the loss is b' V^-1 b; columns without a pivot, which the
    others determined, may then stand in for them, and take back what their own part of it explains.
    """
    place = {c: at for at, c in enumerate(kept)}
    leaving = [place[c] for c in dropped if c in place]
    if not leaving:
        return np.zeros(coef.shape[1])
    inner = np.linalg.inv(inverse[np.ix_(leaving, leaving)])
    lost = coef[leaving]
    gain = np.einsum("ij,ik,kj->j", lost, inner, lost)
    gone = set(dropped)
    spare = [c for c in range(len(gram)) if c not in place and c not in gone and gram[c, c] > 0]
    if not spare:
        return gain
    # how the spare columns hang on the pivots that leave
    hung = (inverse @ gram[np.ix_(kept, spare)])[leaving]
    own, shared = hung.T @ inner @ hung, hung.T @ inner @ lost
    width = len(spare)
    bordered = np.block([[own, shared], [shared.T, np.diag(gain)]])
    left, _ = eliminate(bordered, width, np.append(np.diag(gram)[spare], gain))
    return np.maximum(np.diag(left)[width:], 0.0)


def gaussian_loglik(covariance, n):
    """Log-likelihood of n residuals whose ML covariance is ``covariance``, its rank by the rank rule."""
    k = len(covariance)
    left, kept = eliminate(covariance, k)
    det = float(np.prod(np.diag(left))) if len(kept) == k else 0.0
    return -0.5 * n * (k * math.log(2 * math.pi) + math.log(det + 1e-256) + len(kept))


def information_criterion(name, loglik, n, params):
    penalty = {
        "aic": lambda: 2.0,
        "bic": lambda: math.log(n),
        "hqic": lambda: 2.0 * math.log(math.log(n)),
    }[name]()
    return (-2.0 * loglik + penalty * params) / n


def unit_lower_factor(covariance):
    """L and d of ``covariance = L diag(d) L'`` with a unit diagonal in L.

    A pivot that is zero by the rank rule leaves its column zero below the diagonal.
    """
    k = len(covariance)
    lower, pivots = np.eye(k), np.zeros(k)
    for c in range(k):
        done = lower[c:, :c] * pivots[:c]
        column = covariance[c:, c] - done @ lower[c, :c]
        if column[0] > RANK_TOLERANCE * covariance[c, c]:
            pivots[c] = column[0]
            lower[c + 1 :, c] = column[1:] / column[0]
    return lower, pivots


def propagate(coef, first, horizon):
    """Responses 0…horizon of the system started at ``first``; ``coef[l, src, dst]`` is lag l+1."""
    out = [first]
    for h in range(1, horizon + 1):
        out.append(sum(coef[lag].T @ out[h - 1 - lag] for lag in range(min(h, len(coef)))))
    return np.array(out)


def chi2_upper_tail(x, df):
    """Upper tail probability of a chi-squared variable with integer ``df``."""
    if not math.isfinite(x):
        return math.nan if math.isnan(x) or x < 0 else 0.0
    if x <= 0:
        return 1.0
    z = x / 2
    a, q = (1.0, math.exp(-z)) if df % 2 == 0 else (0.5, math.erfc(math.sqrt(z)))
    while a < df / 2:
        q += math.exp(a * math.log(z) - z - math.lgamma(a + 1))
        a += 1
    return min(q, 1.0)
