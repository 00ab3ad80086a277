"""DuckDB statements for whole models: lag choice, refit, responses, edges.

Normal equations are solved by elimination, one recursion step per column, with
every matrix held as one list per row. A pivot at most 1e-9 of the diagonal it
started from is zero; where a design has such pivots the solution of least norm is taken.
"""

from __future__ import annotations

_LAGS = 10


def _matrix(name: str, source: str, group: str, size: str) -> str:
    """``name(g, r, v)``: rows of the moment matrix of ``source(g, var, t, x)``, variables 0 … ``size``."""
    return f"""
{name}_sums AS (
  SELECT a.g, a.var AS r, b.var AS c, sum(a.x * b.x) AS s
  FROM {source} a JOIN {source} b ON a.g = b.g AND a.t = b.t GROUP BY ALL),
{name} AS (
  SELECT q.g, q.r, list(coalesce(m.s, 0.0) ORDER BY q.c) AS v
  FROM (SELECT g, i.r, j.c FROM {group} CROSS JOIN range(120) AS i(r) CROSS JOIN range(120) AS j(c)
        WHERE i.r <= {size} AND j.c <= {size}) q
  LEFT JOIN {name}_sums m ON m.g = q.g AND m.r = q.r AND m.c = q.c GROUP BY q.g, q.r)
"""


_CHOSEN = """chosen AS (
  SELECT g, k, lag AS p, hqic FROM ic QUALIFY row_number() OVER (PARTITION BY g ORDER BY hqic, lag) = 1)"""
_CHOSEN_BY = {name: _CHOSEN.replace("hqic", name) for name in ("aic", "bic")}
_LAG_ONE = "chosen AS (SELECT g, k, 1 AS p FROM grp)"


def model(grid: str, keys: str, chosen: str = _CHOSEN, rows: int = 144) -> str:
    """Common table expressions from a ``grid`` of ``rows`` per group down to ``coef``, ``covariance`` and ``edges``."""
    listed = ", ".join(key.strip() for key in keys.split(","))
    cleared = "CASE WHEN p.v[s.step + 1] > 1e-9 * p.d0 THEN [x - s.v[s.step + 1] / p.v[s.step + 1] * p.v[i] for x, i in s.v] ELSE s.v END"

    def met(name: str, source: str, per: str) -> str:
        """Residual products in which equations that are met exactly are zero; ``d0`` becomes their own diagonal."""
        return f"""
{name}_open AS (SELECT {per}, list(v[r + 1] > 1e-9 * d0 ORDER BY r) AS open FROM {source} GROUP BY {per}),
{name} AS (
  SELECT {per}, r, [CASE WHEN open[r + 1] AND open[i] THEN x ELSE 0 END for x, i in v] AS v,
         CASE WHEN open[r + 1] THEN v[r + 1] ELSE 0 END AS d0
  FROM {source} JOIN {name}_open USING ({per}))"""

    return f"""
{grid},
ranked AS (
  SELECT date, {listed}, member, CAST(row_number() OVER (PARTITION BY date, {listed} ORDER BY sum(y) DESC, member) AS INTEGER) AS r,
         CAST(count(*) OVER (PARTITION BY date, {listed}) AS INTEGER) AS k
  FROM dense GROUP BY date, {listed}, member),
grp AS (
  SELECT CAST(row_number() OVER (ORDER BY date, {listed}) AS INTEGER) AS g, CAST(least({_LAGS}, ({rows} - {_LAGS} - 2) // k) AS INTEGER) AS widest, *
  FROM (SELECT DISTINCT date, {listed}, k FROM ranked)),
named AS (SELECT g, k, date, {listed}, member, r FROM ranked JOIN grp USING (date, {listed}, k)),
cell AS (SELECT g, k, r, CAST(t AS INTEGER) AS t, CAST(y AS DOUBLE) AS y FROM panel JOIN named USING (date, {listed}, member)),

-- common sample: constant, the eligible lags (newest first), targets
vars AS (
  SELECT g, 0 AS var, CAST(n.t AS INTEGER) AS t, CAST(1 AS DOUBLE) AS x FROM grp CROSS JOIN range({_LAGS}, {rows}) AS n(t)
  UNION ALL
  SELECT g, CAST((l.p - 1) * cell.k + r AS INTEGER), CAST(t + l.p AS INTEGER), y FROM cell JOIN grp USING (g) CROSS JOIN range(1, {_LAGS + 1}) AS l(p)
  WHERE l.p <= widest AND t + l.p BETWEEN {_LAGS} AND {rows - 1}
  UNION ALL
  SELECT g, widest * cell.k + r, t, y FROM cell JOIN grp USING (g) WHERE t >= {_LAGS}),
{_matrix('common', 'vars', 'grp', '(widest + 1) * k')},
swept AS (
  SELECT 0 AS step, g, r, v[r + 1] AS d0, v FROM common
  UNION ALL
  SELECT s.step + 1, s.g, s.r, s.d0, {cleared}
  FROM swept s JOIN swept p ON p.g = s.g AND p.r = s.step JOIN grp ON grp.g = s.g
  WHERE s.r > s.step AND s.step <= grp.widest * grp.k),

-- after the columns of lag p, the target block holds that lag's residual products
residual_of_lag AS (
  SELECT s.g, CAST((s.step - 1) // grp.k AS INTEGER) AS lag, CAST(s.r - widest * grp.k - 1 AS INTEGER) AS r,
         d0 / {rows - _LAGS} AS d0, [x / {rows - _LAGS} for x in s.v[widest * grp.k + 2 :]] AS v
  FROM swept s JOIN grp USING (g)
  WHERE s.step > 1 AND (s.step - 1) % grp.k = 0 AND s.r > widest * grp.k),
{met('residual', 'residual_of_lag', 'g, lag')},
factored AS (
  SELECT 0 AS step, g, lag, r, d0, v FROM residual
  UNION ALL
  SELECT s.step + 1, s.g, s.lag, s.r, s.d0, {cleared}
  FROM factored s JOIN factored p ON p.g = s.g AND p.lag = s.lag AND p.r = s.step WHERE s.r > s.step),
pivots AS (SELECT g, lag, CASE WHEN v[r + 1] > 1e-9 * d0 THEN v[r + 1] ELSE 0 END AS d FROM factored WHERE step = r),
likelihood AS (
  SELECT g, grp.k, lag, {rows - _LAGS} AS n,
         -0.5 * {rows - _LAGS} * (grp.k * ln(2 * pi()) + ln(product(d) + 1e-256) + sum(CASE WHEN d > 0 THEN 1 ELSE 0 END)) AS loglik
  FROM pivots JOIN grp USING (g) GROUP BY g, grp.k, lag),
ic AS (
  SELECT *, (-2 * loglik + 2 * k * (k * lag + 1)) / n AS aic, (-2 * loglik + ln(n) * k * (k * lag + 1)) / n AS bic,
         (-2 * loglik + 2 * ln(ln(n)) * k * (k * lag + 1)) / n AS hqic FROM likelihood),
{chosen},

-- refit of the chosen lag on its full sample
vars2 AS (
  SELECT g, 0 AS var, CAST(n.t AS INTEGER) AS t, CAST(1 AS DOUBLE) AS x FROM chosen CROSS JOIN range({rows}) AS n(t) WHERE n.t >= p
  UNION ALL
  SELECT g, CAST((l.p - 1) * cell.k + r AS INTEGER), CAST(t + l.p AS INTEGER), y
  FROM cell JOIN chosen USING (g) CROSS JOIN range(1, {_LAGS + 1}) AS l(p)
  WHERE l.p <= chosen.p AND t + l.p BETWEEN chosen.p AND {rows - 1}
  UNION ALL
  SELECT g, p * cell.k + r, t, y FROM cell JOIN chosen USING (g) WHERE t >= p),
{_matrix('full_sample', 'vars2', 'chosen', '(p + 1) * k')},
solved AS (
  SELECT 0 AS step, g, r, v[r + 1] AS d0, v FROM full_sample
  UNION ALL
  SELECT s.step + 1, s.g, s.r, s.d0, CASE WHEN s.r = s.step THEN s.v ELSE {cleared} END
  FROM solved s JOIN solved p ON p.g = s.g AND p.r = s.step JOIN chosen ON chosen.g = s.g
  WHERE s.step <= chosen.p * chosen.k),
pivot_of AS (SELECT g, r, v[r + 1] > 1e-9 * d0 AS held FROM solved WHERE step = r),
last AS (SELECT s.g, chosen.k, chosen.p, s.r, s.d0, s.v FROM solved s JOIN chosen USING (g) WHERE s.step = chosen.p * chosen.k + 1),

-- full rank: the solution itself; else the solution of least norm, a mix of the rows that have a pivot
kept AS (
  SELECT f.g, f.r, CAST(row_number() OVER (PARTITION BY f.g ORDER BY f.r) AS INTEGER) AS q, f.v[1 : c.p * c.k + 1] AS x, f.v[c.p * c.k + 2 :] AS y,
         count(*) OVER (PARTITION BY f.g) AS held, c.p * c.k + 1 AS width
  FROM full_sample f JOIN chosen c USING (g) JOIN pivot_of i ON i.g = f.g AND i.r = f.r WHERE f.r <= c.p * c.k AND i.held),
short AS (SELECT * FROM kept WHERE held < width),
mixed AS (
  SELECT 0 AS step, g, q, held, v FROM (
    SELECT a.g, a.q, any_value(a.held) AS held, list_concat(list(list_dot_product(a.x, b.x) ORDER BY b.q), any_value(a.y)) AS v
    FROM short a JOIN short b ON a.g = b.g GROUP BY a.g, a.q)
  UNION ALL
  SELECT s.step + 1, s.g, s.q, s.held,
         CASE WHEN s.q = s.step + 1 THEN s.v ELSE [x - s.v[s.step + 1] / p.v[s.step + 1] * p.v[i] for x, i in s.v] END
  FROM mixed s JOIN mixed p ON p.g = s.g AND p.q = s.step + 1 WHERE s.step < s.held),
shares_of AS (SELECT g, q, [y / v[q] for y in v[held + 1 :]] AS w FROM mixed WHERE step = held),
coef AS (
  SELECT last.g, k, p, last.r AS var, CAST(d.dst AS INTEGER) AS dst,
         CASE WHEN n.held = p * k + 1 THEN v[p * k + d.dst + 1] / v[last.r + 1] ELSE coalesce(m.coef, 0) END AS coef
  FROM last CROSS JOIN range(1, 40) AS d(dst)
  JOIN (SELECT g, sum(CASE WHEN held THEN 1 ELSE 0 END) AS held FROM pivot_of JOIN chosen USING (g) WHERE r <= p * k GROUP BY g) n ON n.g = last.g
  LEFT JOIN (
    SELECT s.g, CAST(i.var AS INTEGER) AS var, CAST(e.dst AS INTEGER) AS dst, sum(s.x[i.var + 1] * h.w[e.dst]) AS coef
    FROM short s JOIN shares_of h ON h.g = s.g AND h.q = s.q CROSS JOIN range(120) AS i(var) CROSS JOIN range(1, 40) AS e(dst)
    WHERE i.var < s.width AND e.dst <= len(h.w) GROUP BY ALL) m ON m.g = last.g AND m.var = last.r AND m.dst = d.dst
  WHERE d.dst <= k AND last.r <= p * k),
covariance_raw AS (
  SELECT g, CAST(r - p * k - 1 AS INTEGER) AS r, d0 / ({rows} - p - k * p - 1) AS d0, [x / ({rows} - p - k * p - 1) for x in v[p * k + 2 :]] AS v
  FROM last WHERE r > p * k),
{met('covariance', 'covariance_raw', 'g')},
lower_steps AS (
  SELECT 0 AS step, g, r, d0, v FROM covariance
  UNION ALL
  SELECT s.step + 1, s.g, s.r, s.d0, {cleared}
  FROM lower_steps s JOIN lower_steps p ON p.g = s.g AND p.r = s.step WHERE s.r > s.step),
lower AS (
  SELECT s.g, s.r + 1 AS r, s.step + 1 AS c,
         CASE WHEN s.r = s.step THEN 1 WHEN p.v[s.step + 1] > 1e-9 * p.d0 THEN s.v[s.step + 1] / p.v[s.step + 1] ELSE 0 END AS w
  FROM lower_steps s JOIN lower_steps p ON p.g = s.g AND p.step = s.step AND p.r = s.step),
response AS (
  SELECT a.g, a.dst, l.c AS src, round_even(round_even(sum(a.coef * l.w), 10), 4) AS w
  FROM coef a JOIN lower l ON l.g = a.g AND l.r = a.var WHERE a.var BETWEEN 1 AND a.k GROUP BY ALL),
edges AS (
  SELECT o.date, {', '.join('o.' + key.strip() for key in keys.split(','))}, o.member AS ORIGIN, d.member AS DESTINATION,
         CASE WHEN w > 0 AND src <> dst THEN w ELSE 0.0 END AS w
  FROM response JOIN named o ON o.g = response.g AND o.r = response.src JOIN named d ON d.g = response.g AND d.r = response.dst)
"""


def statements(grid, member: str, keys: str, suffix: str, hourly: bool = False) -> dict[str, str]:
    """Edges, popularity and circulation of one analysis; ``keys`` of an hourly one end in ``hour``."""
    if hourly:
        with_model = f"WITH RECURSIVE {model(grid(member, keys), keys, rows=60)}"
    else:
        with_model = f"WITH RECURSIVE {model(grid(member, keys, 10), keys)}"
    columns = [key.strip() for key in keys.split(",")]
    same = " AND ".join(f"{{0}}.{key} = {{1}}.{key}" for key in ["date", *columns])
    ab, bc = same.format("a", "b"), same.format("b", "c")
    grain, places = ("hour" if hourly else "day"), [c for c in columns if c != "hour"]
    label = "{0}.date || ' ' || lpad(CAST({0}.hour AS VARCHAR), 2, '0') || ':00:00' AS date" if hourly else "{0}.date"
    of_a = ", ".join([label.format("a"), *(f"a.{key}" for key in places)])
    floor = "net.floor_name" if "floor_name" in keys else "(SELECT max(f.floor_name) FROM net f WHERE f.unit_id = net.unit_id)"
    hour = "degree.hour, " if hourly else ""
    of_m = "m.hour, " if hourly else ""
    out = {
        f"influence_{grain}_{suffix}": f"""
{with_model} SELECT {of_a}, ORIGIN, DESTINATION, w AS "MOVEMENT_INFLUENCE_AMOUNT" FROM edges a
"""
    }
    if member == "unit_id":
        out[f"popularity_{grain}_{suffix}"] = f"""
{with_model},
degree AS (
  SELECT m.date, {of_m}m.member, count(*) FILTER (WHERE e.w > 0) AS degree, max(m.k) - 1 AS others
  FROM named m JOIN edges e ON {same.format('e', 'm')} AND (e.ORIGIN = m.member OR e.DESTINATION = m.member) GROUP BY m.date, {of_m}m.member)
SELECT date, {hour}net.user_id, net.place_id, {floor} AS floor_name, net.unit_id,
       round_even(CAST(degree AS DOUBLE) / others, 4) AS popular_area
FROM degree JOIN net ON net.unit_id = degree.member
"""
        out[f"circulation_{grain}_{suffix}"] = f"""
{with_model}
SELECT {of_a}, a.ORIGIN, b.ORIGIN AS "VIA_1", c.ORIGIN AS "VIA_2", c.DESTINATION,
       round_even(a.w * b.w * c.w, 12) AS "MOVEMENT_INFLUENCE_AMOUNT_VIA_2"
FROM edges a JOIN edges b ON {ab} AND a.DESTINATION = b.ORIGIN JOIN edges c ON {bc} AND b.DESTINATION = c.ORIGIN
WHERE a.w <> 0 AND b.w <> 0 AND c.w <> 0
"""
        out[f"circulation3_{grain}_{suffix}"] = f"""
{with_model}
SELECT {of_a}, a.ORIGIN, b.ORIGIN AS "VIA_1", b.DESTINATION, round_even(a.w * b.w, 12) AS "MOVEMENT_INFLUENCE_AMOUNT_VIA_1"
FROM edges a JOIN edges b ON {ab} AND a.DESTINATION = b.ORIGIN WHERE a.w <> 0 AND b.w <> 0
"""
    return out


def responses_sql(whole: str, keys: str) -> dict[str, str]:
    """Responses and variance shares of the model ``whole`` at its lag."""

    def responses(first: str) -> str:
        return f"""
WITH RECURSIVE {whole},
square AS (SELECT a.g, a.r AS dst, b.r AS src, grp.k FROM named a JOIN named b USING (g) JOIN grp USING (g)),
scales AS (SELECT g, r + 1 AS src, CASE WHEN v[r + 1] > 1e-9 * d0 THEN v[r + 1] ELSE 0 END AS d FROM lower_steps WHERE step = r),
resp AS (
  SELECT 0 AS h, q.g, q.k, q.dst, q.src, [CAST({first} AS DOUBLE)] AS ws
  FROM square q LEFT JOIN lower l ON l.g = q.g AND l.r = q.dst AND l.c = q.src JOIN scales ON scales.g = q.g AND scales.src = q.src
  UNION ALL
  -- the newest response first; lag p takes the p-th of the list
  SELECT n.h, n.g, n.k, n.dst, n.src, list_concat([n.w], o.ws)
  FROM (
    SELECT resp.h + 1 AS h, resp.g, resp.k, a.dst, resp.src, sum(a.coef * resp.ws[(a.var - 1) // a.k + 1]) AS w
    FROM resp JOIN coef a ON a.g = resp.g AND a.var > 0 AND (a.var - 1) % a.k + 1 = resp.dst AND (a.var - 1) // a.k < len(resp.ws)
    WHERE resp.h < 10 GROUP BY ALL) n
  JOIN resp o ON o.g = n.g AND o.dst = n.dst AND o.src = n.src),
resp_of AS (SELECT h, g, dst, src, ws[1] AS w FROM resp)
"""

    named = f"s.date, s.{keys}, h AS horizon, s.member AS src, d.member AS dst"
    joined = "JOIN named s ON s.g = {0}.g AND s.r = {0}.src JOIN named d ON d.g = {0}.g AND d.r = {0}.dst"
    return {
        "ma_coefficients": f"""
{responses("CASE WHEN q.src = q.dst THEN 1 ELSE 0 END")}
SELECT {named}, round_even(w, 7) + 0.0 AS value FROM resp_of {joined.format("resp_of")}
""",
        "impulse_response": f"""
{responses("coalesce(l.w, 0) * sqrt(greatest(d, 0))")}
SELECT {named}, round_even(w, 7) + 0.0 AS value FROM resp_of {joined.format("resp_of")}
""",
        "fevd": f"""
{responses("coalesce(l.w, 0)")},
grown AS (
  SELECT resp_of.*, sum(w * w) OVER (PARTITION BY resp_of.g, dst, resp_of.src ORDER BY h) * d AS e
  FROM resp_of JOIN scales ON scales.g = resp_of.g AND scales.src = resp_of.src),
shares AS (SELECT g, h, dst, src, e, sum(e) OVER (PARTITION BY g, h, dst) AS whole FROM grown)
SELECT {named}, CASE WHEN whole > 1e-18 THEN round_even(e / whole, 7) + 0.0 END AS share FROM shares {joined.format("shares")}
""",
    }


def model_tables(grid, member: str, keys: str) -> dict[str, str]:
    """Coefficients, covariance, likelihoods, criteria and chosen lags."""
    with_model = f"WITH RECURSIVE {model(grid(member, keys, 10), keys)}"
    return {
        "var_coefficients": f"""
{with_model}
SELECT d.date, d.{keys}, d.member AS target, s.member AS source,
       CASE WHEN var = 0 THEN 0 ELSE CAST((var - 1) // coef.k + 1 AS INTEGER) END AS lag, round_even(coef, 7) + 0.0 AS coef
FROM coef JOIN named d ON d.g = coef.g AND d.r = coef.dst
LEFT JOIN named s ON s.g = coef.g AND var > 0 AND s.r = (var - 1) % coef.k + 1
""",
        "var_sigma": f"""
{with_model}
SELECT a.date, a.{keys}, a.member AS target, b.member AS source, round_even(v[b.r], 7) + 0.0 AS sigma
FROM covariance JOIN named a ON a.g = covariance.g AND a.r = covariance.r + 1 JOIN named b ON b.g = covariance.g
""",
        "var_loglik": f"""
{with_model}
SELECT date, {keys}, likelihood.k, CAST(n AS INTEGER) AS n, lag, round_even(loglik, 5) AS loglik FROM likelihood JOIN grp USING (g)
""",
        "var_ic": f"""
{with_model}
SELECT date, {keys}, lag, CAST(n AS INTEGER) AS n, round_even(loglik, 5) AS loglik, round_even(aic, 7) AS aic,
       round_even(bic, 7) AS bic, round_even(hqic, 7) AS hqic
FROM ic JOIN grp USING (g)
""",
        "var_select_order": f"""
{with_model} SELECT date, {keys}, p AS lag, round_even(hqic, 7) AS hqic FROM chosen JOIN grp USING (g)
""",
        **{
            f"var_select_{name}": f"""
WITH RECURSIVE {model(grid(member, keys, 10), keys, chosen)} SELECT date, {keys}, p AS lag, round_even({name}, 7) AS {name} FROM chosen JOIN grp USING (g)
"""
            for name, chosen in _CHOSEN_BY.items()
        },
        **{
            f"{name}_selected": responses_sql(model(grid(member, keys, 10), keys), keys)[name] for name in ("impulse_response", "fevd")
        },
    }


def lag_one_tables(grid, member: str, keys: str) -> dict[str, str]:
    """Responses, variance shares and causality tests of the lag-1 model of every group."""
    with_model = f"WITH RECURSIVE {model(grid(member, keys, 10), keys, _LAG_ONE)}"
    cleared = "CASE WHEN s.step = s.out OR p.v[s.step + 1] <= 1e-9 * p.d0 THEN s.v ELSE [x - s.v[s.step + 1] / p.v[s.step + 1] * p.v[i] for x, i in s.v] END"

    return {
        **responses_sql(model(grid(member, keys, 10), keys, _LAG_ONE), keys),
        # standardised moments, then plain proximal steps: their error shrinks by the ridge share each time
        "sparse_var_fit": f"""
{with_model},
moments AS (SELECT f.g, f.r, f.v, z.v AS z, grp.k, 144 - 1.0 AS n FROM full_sample f JOIN full_sample z ON z.g = f.g AND z.r = 0 JOIN grp ON grp.g = f.g),
centred AS (SELECT g, k, n, r, [x - v[1] * z[i] / n for x, i in v] AS v FROM moments WHERE r > 0),
scales_of AS (
  SELECT g, r, CASE WHEN v[r + 1] / n > 1e-64 THEN sqrt(v[r + 1] / n) ELSE 1 END AS sd FROM centred),
sds AS (SELECT g, list(sd ORDER BY r) AS sd FROM scales_of GROUP BY g),
scaled AS (
  SELECT c.g, c.k, c.n, c.r, s.sd, s.sd[c.r] AS own, [x / (s.sd[c.r] * s.sd[i]) for x, i in c.v[2:]] AS v FROM centred c JOIN sds s USING (g)),
design AS (
  SELECT g, k, any_value(n) AS n, any_value(sd) AS sd, list(v[1:k] ORDER BY r) AS xx, max(list_sum([abs(x) for x in v[1:k]])) AS bound
  FROM scaled WHERE r <= k GROUP BY g, k),
targets AS (SELECT g, r - k AS dst, own AS sy, v[1:k] AS xy FROM scaled WHERE r > k),
steps AS (
  SELECT 0 AS step, t.g, dst, [CAST(0 AS DOUBLE) for x in xy] AS b FROM targets t
  UNION ALL
  SELECT step + 1, s.g, s.dst,
         [sign(u) * greatest(abs(u) - 0.01 * n / (sd[i] * sy) / bound, 0) / (1 + 0.09 * n / (sd[i] * sd[i]) / bound)
          for u, i in [s.b[i] + (xy[i] - list_dot_product(row, s.b)) / bound for row, i in xx]]
  FROM steps s JOIN design USING (g) JOIN targets t ON t.g = s.g AND t.dst = s.dst WHERE step < 400 AND bound > 0),
done AS (SELECT g, dst, arg_max(b, step) AS b FROM steps GROUP BY g, dst)
SELECT d.date, d.{keys}, d.member AS target, s.member AS source, CAST(1 AS INTEGER) AS lag, round_even(b[s.r], 6) + 0.0 AS coef
FROM done JOIN named d ON d.g = done.g AND d.r = done.dst JOIN named s ON s.g = done.g
""",
        # one member's column left out at a time; the tail has a closed form for even degrees of freedom
        "granger_pairs": f"""
{with_model},
dropped AS (
  SELECT 0 AS step, f.g, n.r AS out, f.r, f.v[f.r + 1] AS d0, f.v FROM full_sample f JOIN named n ON n.g = f.g
  UNION ALL
  SELECT s.step + 1, s.g, s.out, s.r, s.d0, {cleared}
  FROM dropped s JOIN dropped p ON p.g = s.g AND p.out = s.out AND p.r = s.step JOIN grp ON grp.g = s.g
  WHERE s.r > s.step AND s.step <= grp.k),
less AS (SELECT g, out, r - k AS dst, v[r + 1] AS rss FROM dropped JOIN grp USING (g) WHERE step = k + 1 AND r > k),
tests AS (
  SELECT less.g, grp.k, less.out, less.dst,
         CASE WHEN l.v[l.r + 1] > 1e-9 THEN (less.rss - l.v[l.r + 1]) * (144 - 1 - grp.k - 1) / l.v[l.r + 1] END AS chi2
  FROM less JOIN grp USING (g) JOIN last l ON l.g = less.g AND l.r = less.dst + grp.k WHERE less.out <> less.dst),
tails AS (
  SELECT tests.g, tests.out, dst, chi2, exp(-chi2 / 2) * sum(pow(chi2 / 2, i) / gamma(i + 1.0)) AS p_value
  FROM tests CROSS JOIN range(20) AS n(i) WHERE i < tests.k // 2 GROUP BY tests.g, tests.out, dst, chi2)
SELECT c.date, c.{keys}, c.member AS causing, d.member AS caused, CAST(1 AS INTEGER) AS lag,
       round_even(chi2, 5) + 0.0 AS chi2, round_even(p_value, 7) + 0.0 AS p_value
FROM tails JOIN named c ON c.g = tails.g AND c.r = tails.out JOIN named d ON d.g = tails.g AND d.r = tails.dst
""",
    }


def chosen_lag_tables(day_grid, hour_grid) -> dict[str, str]:
    """Predictions, residual sums and causality tests of the models at their chosen lags."""
    by_day = f"WITH RECURSIVE {model(day_grid('unit_id', 'place_id', 10), 'place_id')}"
    by_hour = f"WITH RECURSIVE {model(hour_grid('unit_id', 'place_id, hour'), 'place_id, hour', rows=60)}"
    cleared = """CASE WHEN (s.step - 1) % c.k + 1 = s.out OR p.v[s.step + 1] <= 1e-9 * p.d0 THEN s.v
              ELSE [x - s.v[s.step + 1] / p.v[s.step + 1] * p.v[i] for x, i in s.v] END"""
    return {
        "var_predict_selected": f"""
{by_day},
told AS (
  SELECT a.g, cell.t + (a.var - 1) // a.k + 1 AS t, a.dst, sum(a.coef * cell.y) AS part
  FROM coef a JOIN cell ON cell.g = a.g AND cell.r = (a.var - 1) % a.k + 1 WHERE a.var > 0 GROUP BY ALL)
SELECT named.date, named.place_id, CAST(n.t AS INTEGER) AS t, named.member, round_even(a.coef + coalesce(told.part, 0), 6) + 0.0 AS predicted
FROM coef a CROSS JOIN range(144) AS n(t) JOIN named ON named.g = a.g AND named.r = a.dst
LEFT JOIN told ON told.g = a.g AND told.t = n.t AND told.dst = a.dst
WHERE a.var = 0 AND n.t >= a.p
""",
        "var_rss_selected": f"""
{by_day}
SELECT date, place_id, member, round_even(CASE WHEN l.v[l.r + 1] > 1e-9 * l.d0 THEN l.v[l.r + 1] ELSE 0 END, 4) + 0.0 AS rss
FROM last l JOIN named ON named.g = l.g AND named.r = l.r - l.p * l.k WHERE l.r > l.p * l.k
""",
        # all lags of one member left out at a time, whatever the rank of what remains
        "granger_pairs_selected": f"""
{by_hour},
dropped AS (
  SELECT 0 AS step, f.g, n.r AS out, f.r, f.v[f.r + 1] AS d0, f.v FROM full_sample f JOIN named n ON n.g = f.g
  UNION ALL
  SELECT s.step + 1, s.g, s.out, s.r, s.d0, {cleared}
  FROM dropped s JOIN dropped p ON p.g = s.g AND p.out = s.out AND p.r = s.step JOIN chosen c ON c.g = s.g
  WHERE s.r > s.step AND s.step <= c.p * c.k),
less AS (SELECT g, c.k, c.p, out, r - c.p * c.k AS dst, v[r + 1] AS rss FROM dropped JOIN chosen c USING (g) WHERE step = c.p * c.k + 1 AND r > c.p * c.k),
tests AS (
  SELECT less.g, less.k, less.p, less.out, less.dst,
         CASE WHEN l.v[l.r + 1] > 1e-9 * l.d0 THEN (less.rss - l.v[l.r + 1]) * (60 - less.p - less.k * less.p - 1) / l.v[l.r + 1] END AS chi2
  FROM less JOIN last l ON l.g = less.g AND l.r = less.dst + less.p * less.k WHERE less.out <> less.dst),
tails AS (
  SELECT tests.g, tests.p, tests.out, dst, chi2, exp(-chi2 / 2) * sum(pow(chi2 / 2, i) / gamma(i + 1.0)) AS p_value
  FROM tests CROSS JOIN range(20) AS n(i) WHERE i < tests.k // 2 GROUP BY tests.g, tests.p, tests.out, dst, chi2)
SELECT c.date, c.place_id, CAST(c.hour AS INTEGER) AS hour, c.member AS causing, d.member AS caused, CAST(p AS INTEGER) AS lag,
       round_even(round_even(chi2, 9), 4) + 0.0 AS chi2, round_even(p_value, 6) + 0.0 AS p_value
FROM tails JOIN named c ON c.g = tails.g AND c.r = tails.out JOIN named d ON d.g = tails.g AND d.r = tails.dst
""",
    }


def analysis_tables(day_grid) -> str:
    """All tables of a daily analysis of whole places as one: ``name, date, place_id, first … fourth, value``."""
    ab, bc = "a.date = b.date AND a.place_id = b.place_id", "b.date = c.date AND b.place_id = c.place_id"

    def part(name: str, value: str, source: str, *stops: str) -> str:
        named = [*stops, *["NULL"] * (4 - len(stops))]
        listed = ", ".join(f"CAST({stop} AS VARCHAR) AS {label}" for stop, label in zip(named, ('"first"', '"second"', '"third"', '"fourth"')))
        return f"SELECT '{name}' AS name, x.date, x.place_id, {listed}, CAST({value} AS DOUBLE) + 0.0 AS value FROM {source}"

    pairs = "edges x"
    threes = f"(SELECT a.*, b.ORIGIN AS via, b.DESTINATION AS last, a.w * b.w AS ww FROM edges a JOIN edges b ON {ab} AND a.DESTINATION = b.ORIGIN WHERE a.w <> 0 AND b.w <> 0) x"
    fours = (
        "(SELECT a.*, b.ORIGIN AS via, c.ORIGIN AS via2, c.DESTINATION AS last, a.w * b.w * c.w AS ww FROM edges a "
        f"JOIN edges b ON {ab} AND a.DESTINATION = b.ORIGIN JOIN edges c ON {bc} AND b.DESTINATION = c.ORIGIN WHERE a.w <> 0 AND b.w <> 0 AND c.w <> 0) x"
    )
    parts = [
        part("input_data", "x.y", "panel x", "x.member", "x.t"),
        part("model_status", "p", "chosen JOIN grp x USING (g)", "'fitted'", "144", "x.k"),
        part(
            "var_model_coefficient",
            "round_even(coef, 7)",
            "coef JOIN named x ON x.g = coef.g AND x.r = coef.dst LEFT JOIN named s ON s.g = coef.g AND var > 0 AND s.r = (var - 1) % coef.k + 1",
            "x.member",
            "s.member",
            "CASE WHEN var = 0 THEN 0 ELSE (var - 1) // coef.k + 1 END",
        ),
        part("causality", "x.w", pairs, "x.ORIGIN", "x.DESTINATION"),
        part("centrality", "round_even(CAST(x.degree AS DOUBLE) / x.others, 4)", "degree x", "x.member"),
        part("migration_2", "x.w", pairs, "x.ORIGIN", "x.DESTINATION"),
        part("migration_3", "round_even(x.ww, 12)", threes, "x.ORIGIN", "x.via", "x.last"),
        part("migration_4", "round_even(x.ww, 12)", fours, "x.ORIGIN", "x.via", "x.via2", "x.last"),
    ]
    return f"""
WITH RECURSIVE {model(day_grid('unit_id', 'place_id', 10), 'place_id')},
degree AS (
  SELECT m.date, m.place_id, m.member, count(*) FILTER (WHERE e.w > 0) AS degree, max(m.k) - 1 AS others
  FROM named m JOIN edges e ON e.date = m.date AND e.place_id = m.place_id AND (e.ORIGIN = m.member OR e.DESTINATION = m.member)
  GROUP BY m.date, m.place_id, m.member)
{" UNION ALL ".join(parts)}
"""
