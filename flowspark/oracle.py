"""DuckDB statements computing the registered queries independently, on the same tables."""

from __future__ import annotations

from flowspark import oracle_models

# ------------------------------------------------------------------ shared parts

_NET = """
net AS (
  SELECT 'F1' AS folder_name, CAST((u % 8) // 4 + 1 AS VARCHAR) || 'F' AS floor_name,
         'C' || CAST(u // 8 AS VARCHAR) AS user_id, 'P' || CAST(u // 8 AS VARCHAR) AS place_id,
         'N' || CAST(u % 3 AS VARCHAR) AS network_id, 'U' || lpad(CAST(u AS VARCHAR), 2, '0') AS unit_id,
         CAST(40 + 5 * (u % 6) AS DOUBLE) AS rssi_fx
  FROM range(12) AS r(u))
"""

_SIGHTINGS = f"""
{_NET},
raw AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, date_trunc('second', ts) AS seen,
         'U' || lpad(CAST(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 12 AS VARCHAR), 2, '0') AS unit_id,
         CAST(user_id AS VARCHAR) AS aibeaconid, value AS rssi, event_type
  FROM events),
sight AS (
  SELECT raw.date, raw.seen, strftime(raw.seen, '%Y-%m-%d %H:%M:%S') AS datetime, folder_name, user_id, place_id,
         floor_name, network_id, unit_id, aibeaconid
  FROM raw JOIN net USING (unit_id)
  WHERE event_type <> 'error' AND rssi <= rssi_fx)
"""

_MINUTES = f"""
{_SIGHTINGS},
mins AS (
  SELECT date, unit_id, CAST(hour(seen) * 60 + minute(seen) AS INTEGER) AS minute,
         count(DISTINCT coalesce(aibeaconid, '<none>')) AS y
  FROM sight GROUP BY ALL),
days AS (
  SELECT strftime(d, '%Y-%m-%d') AS date
  FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM events))
"""


def _grid(member: str, keys: str, width: int, start: int = 0, end: int = 1440) -> str:
    """``panel`` (sparse), ``spine`` and ``dense`` for one member column and bucket width."""
    first, last = start // width, (end - 1) // width
    return f"""
{_MINUTES},
panel AS (
  SELECT date, {keys}, {member} AS member, minute // {width} - {first} AS t, CAST(sum(y) AS BIGINT) AS y
  FROM mins JOIN net USING (unit_id)
  WHERE minute >= {start} AND minute < {end}
  GROUP BY ALL),
members AS (SELECT DISTINCT {keys}, {member} AS member FROM net),
spine AS (SELECT date, {keys}, member, {last - first + 1} AS nobs FROM days CROSS JOIN members),
dense AS (
  SELECT s.date, {', '.join('s.' + k.strip() for k in keys.split(','))}, s.member, CAST(g.t AS INTEGER) AS t,
         coalesce(p.y, 0) AS y
  FROM spine s CROSS JOIN range({last - first + 1}) AS g(t)
  LEFT JOIN panel p ON p.date = s.date AND p.member = s.member AND p.t = g.t
   AND {' AND '.join(f'p.{k.strip()} = s.{k.strip()}' for k in keys.split(','))})
"""


def _hour_grid(member: str, keys: str) -> str:
    """Like ``_grid`` with one-minute buckets and a series per hour; ``keys`` end in ``hour``."""
    places = ", ".join(k.strip() for k in keys.split(",") if k.strip() != "hour")
    same = " AND ".join(f"p.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    return f"""
{_MINUTES},
panel AS (
  SELECT date, {places}, CAST(minute // 60 AS INTEGER) AS hour, {member} AS member, CAST(minute % 60 AS INTEGER) AS t, CAST(sum(y) AS BIGINT) AS y
  FROM mins JOIN net USING (unit_id) GROUP BY ALL),
members AS (SELECT DISTINCT {places}, {member} AS member FROM net),
spine AS (SELECT date, {places}, CAST(h AS INTEGER) AS hour, member FROM days CROSS JOIN members CROSS JOIN range(24) AS r(h)),
dense AS (
  SELECT s.*, coalesce(p.y, 0) AS y FROM spine s LEFT JOIN panel p ON p.date = s.date AND p.member = s.member AND {same})
"""


def _footfall(bucket: str | None, label: str | None, count: str) -> str:
    key = f", {bucket} AS b" if bucket else ""
    join = ", c.b" if bucket else ""
    shown = f", {label}" if label else ""
    return f"""
WITH {_SIGHTINGS},
counts AS (
  SELECT date, unit_id{key}, count(DISTINCT coalesce(aibeaconid, '<none>')) AS n FROM sight GROUP BY ALL),
dims AS (SELECT DISTINCT date, unit_id, folder_name, user_id, place_id, floor_name, network_id FROM sight)
SELECT c.date{shown}, d.folder_name, d.user_id, d.place_id, d.floor_name, d.network_id, c.unit_id,
       CAST(c.n AS BIGINT) AS "{count}"
FROM counts c JOIN dims d ON c.date = d.date AND c.unit_id = d.unit_id
"""


def _gps(bucket: str | None, label: str | None, count: str) -> str:
    key = f", {bucket} AS b" if bucket else ""
    shown = f", {label}" if label else ""
    return f"""
WITH {_SIGHTINGS},
counts AS (SELECT date, unit_id{key}, count(DISTINCT aibeaconid) AS n FROM sight GROUP BY ALL),
dims AS (SELECT DISTINCT date, unit_id, user_id, network_id FROM sight)
SELECT c.date{shown}, d.user_id, d.network_id, c.unit_id AS place_id, CAST(c.n AS BIGINT) AS "{count}"
FROM counts c JOIN dims d ON c.date = d.date AND c.unit_id = d.unit_id
"""


_HOUR = ("hour(seen)", "CAST(c.b AS VARCHAR) AS hour")


def _minute(width: int) -> tuple[str, str]:
    return f"time_bucket(INTERVAL '{width} minutes', seen)", "strftime(c.b, '%Y-%m-%d %H:%M:%S') AS minute"


_ARRIVALS = f"""
{_MINUTES},
firsts AS (SELECT date, place_id, aibeaconid, unit_id, min(datetime) AS seen_at FROM sight GROUP BY ALL),
moved AS (
  SELECT a.date, a.place_id, a.unit_id AS origin, b.unit_id AS destination, count(*) AS devices
  FROM firsts a JOIN firsts b ON a.date = b.date AND a.place_id = b.place_id AND a.aibeaconid = b.aibeaconid
  WHERE a.seen_at < b.seen_at GROUP BY ALL),
edges AS (
  SELECT days.date, o.place_id, o.unit_id AS ORIGIN, d.unit_id AS DESTINATION,
         coalesce(m.devices / 100.0, 0.0) AS w
  FROM days CROSS JOIN net o JOIN net d ON o.place_id = d.place_id
  LEFT JOIN moved m ON m.date = days.date AND m.place_id = o.place_id AND m.origin = o.unit_id AND m.destination = d.unit_id),
degree AS (
  SELECT n.date, n.place_id, n.member, n.others,
         (SELECT count(*) FROM edges e WHERE e.date = n.date AND e.place_id = n.place_id AND e.w > 0
            AND (e.ORIGIN = n.member OR e.DESTINATION = n.member)) AS degree
  FROM (SELECT date, place_id, ORIGIN AS member, count(*) - 1 AS others FROM edges GROUP BY ALL) n)
"""

_PUBLISHED = f"""
WITH {_ARRIVALS}
SELECT degree.date, net.user_id, net.place_id, net.floor_name, net.unit_id,
       round_even(degree / CAST(others AS DOUBLE), 4) AS popular_area
FROM degree JOIN net ON net.unit_id = degree.member
"""

def _published(by_floor: bool, hourly: bool) -> str:
    """Popularity from arrivals of one grain and area, with its names."""
    floor, hour = (", floor_name" if by_floor else ""), (", hour" if hourly else "")
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in ["date", "place_id", *(["floor_name"] if by_floor else []), *(["hour"] if hourly else [])])
    hours = "CROSS JOIN (SELECT CAST(h AS BIGINT) AS hour FROM range(24) AS r(h)) hours" if hourly else ""
    same_floor = "AND o.floor_name = d.floor_name" if by_floor else ""
    of_o = "o.place_id" + (", o.floor_name" if by_floor else "") + (", hours.hour" if hourly else "")
    match = "m.date = days.date AND m.place_id = o.place_id" + (" AND m.floor_name = o.floor_name" if by_floor else "") + (" AND m.hour = hours.hour" if hourly else "")
    return f"""(
WITH {_MINUTES},
firsts AS (SELECT date, place_id{floor}{", hour(seen) AS hour" if hourly else ""}, aibeaconid, unit_id, min(datetime) AS seen_at FROM sight GROUP BY ALL),
moved AS (
  SELECT a.date, a.place_id{floor.replace(", ", ", a.")}{hour.replace(", ", ", a.")}, a.unit_id AS origin, b.unit_id AS destination, count(*) AS devices
  FROM firsts a JOIN firsts b ON {on("a", "b")} AND a.aibeaconid = b.aibeaconid WHERE a.seen_at < b.seen_at GROUP BY ALL),
edges AS (
  SELECT days.date, {of_o}, o.unit_id AS ORIGIN, d.unit_id AS DESTINATION, coalesce(m.devices, 0) AS w
  FROM days {hours} CROSS JOIN net o JOIN net d ON o.place_id = d.place_id {same_floor}
  LEFT JOIN moved m ON {match} AND m.origin = o.unit_id AND m.destination = d.unit_id),
ends AS (
  SELECT date, place_id{floor}{hour}, ORIGIN AS member, w FROM edges UNION ALL SELECT date, place_id{floor}{hour}, DESTINATION, w FROM edges),
degree AS (
  SELECT date{hour}, member, count(*) FILTER (WHERE w > 0) AS degree, count(*) / 2 - 1 AS others FROM ends GROUP BY ALL)
SELECT '{"hour" if hourly else "day"}' AS grain, '{"floor" if by_floor else "all"}' AS area, degree.date, {"CAST(degree.hour AS INTEGER)" if hourly else "CAST(-1 AS INTEGER)"} AS hour,
       net.user_id, net.place_id, net.floor_name, net.unit_id, round_even(degree / CAST(others AS DOUBLE), 4) AS popular_area
FROM degree JOIN net ON net.unit_id = degree.member)"""


# The two places of the site as a two-member system, lag 1, ten-minute buckets:
# everything has a closed form. Members are numbered by total, largest first.
_PAIR = f"""
{_MINUTES},
site AS (
  SELECT days.date, p.member, CAST(g.t AS INTEGER) AS t, coalesce(q.y, 0) AS y
  FROM days CROSS JOIN (SELECT DISTINCT place_id AS member FROM net) p CROSS JOIN range(144) AS g(t)
  LEFT JOIN (SELECT date, place_id AS member, minute // 10 AS t, sum(y) AS y FROM mins JOIN net USING (unit_id) GROUP BY ALL) q
    ON q.date = days.date AND q.member = p.member AND q.t = g.t),
ranked AS (
  SELECT date, member, row_number() OVER (PARTITION BY date ORDER BY sum(y) DESC, member) AS r FROM site GROUP BY date, member),
names AS (
  SELECT date, max(CASE WHEN r = 1 THEN member END) AS m1, max(CASE WHEN r = 2 THEN member END) AS m2 FROM ranked GROUP BY date),
cells AS (
  SELECT s.date, s.t, CAST(max(CASE WHEN r = 1 THEN y END) AS DOUBLE) AS z1, CAST(max(CASE WHEN r = 2 THEN y END) AS DOUBLE) AS z2
  FROM site s JOIN ranked USING (date, member) GROUP BY s.date, s.t),
pairs AS (
  SELECT c.date, c.t, p.z1 AS x1, p.z2 AS x2, c.z1 AS y1, c.z2 AS y2 FROM cells c JOIN cells p ON p.date = c.date AND p.t = c.t - 1),
mom AS (
  SELECT date, CAST(count(*) AS DOUBLE) AS n, avg(x1) AS ax1, avg(x2) AS ax2, avg(y1) AS ay1, avg(y2) AS ay2,
         sum(x1*x1) - sum(x1)*sum(x1)/count(*) AS s11, sum(x1*x2) - sum(x1)*sum(x2)/count(*) AS s12,
         sum(x2*x2) - sum(x2)*sum(x2)/count(*) AS s22,
         sum(x1*y1) - sum(x1)*sum(y1)/count(*) AS c11, sum(x2*y1) - sum(x2)*sum(y1)/count(*) AS c21,
         sum(x1*y2) - sum(x1)*sum(y2)/count(*) AS c12, sum(x2*y2) - sum(x2)*sum(y2)/count(*) AS c22,
         sum(y1*y1) - sum(y1)*sum(y1)/count(*) AS v11, sum(y1*y2) - sum(y1)*sum(y2)/count(*) AS v12,
         sum(y2*y2) - sum(y2)*sum(y2)/count(*) AS v22
  FROM pairs GROUP BY date),
coefs AS (
  SELECT *, (s22*c11 - s12*c21) / (s11*s22 - s12*s12) AS a11, (s11*c21 - s12*c11) / (s11*s22 - s12*s12) AS a12,
            (s22*c12 - s12*c22) / (s11*s22 - s12*s12) AS a21, (s11*c22 - s12*c12) / (s11*s22 - s12*s12) AS a22 FROM mom),
fit AS (
  SELECT *, ay1 - a11*ax1 - a12*ax2 AS k1, ay2 - a21*ax1 - a22*ax2 AS k2,
            v11 - a11*c11 - a12*c21 AS e11, v12 - a11*c12 - a12*c22 AS e12, v22 - a21*c12 - a22*c22 AS e22
  FROM coefs JOIN names USING (date))
"""

# responses[h][to][from] = A^h L with a unit lower factor L
_PAIR_RESPONSE = f"""
WITH RECURSIVE {_PAIR},
resp AS (
  SELECT date, m1, m2, a11, a12, a21, a22, e11, e22 - e12*e12/e11 AS d2, n, 0 AS h,
         CAST(1 AS DOUBLE) AS r11, CAST(0 AS DOUBLE) AS r12, e12/e11 AS r21, CAST(1 AS DOUBLE) AS r22 FROM fit
  UNION ALL
  SELECT date, m1, m2, a11, a12, a21, a22, e11, d2, n, h + 1,
         a11*r11 + a12*r21, a11*r12 + a12*r22, a21*r11 + a22*r21, a21*r12 + a22*r22 FROM resp WHERE h < 6),
long AS (
  SELECT date, h, m1 AS dst, m1 AS src, r11 AS v, e11 AS d, n FROM resp UNION ALL
  SELECT date, h, m1, m2, r12, d2, n FROM resp UNION ALL
  SELECT date, h, m2, m1, r21, e11, n FROM resp UNION ALL
  SELECT date, h, m2, m2, r22, d2, n FROM resp)
"""

_SINGLE = f"""
{_MINUTES},
cells AS (
  SELECT days.date, CAST(g.t AS INTEGER) AS t, CAST(coalesce(q.y, 0) AS DOUBLE) AS z
  FROM days CROSS JOIN range(144) AS g(t)
  LEFT JOIN (SELECT date, minute // 10 AS t, sum(y) AS y FROM mins GROUP BY ALL) q ON q.date = days.date AND q.t = g.t),
pairs AS (SELECT c.date, p.z AS x, c.z AS y FROM cells c JOIN cells p ON p.date = c.date AND p.t = c.t - 1),
mom AS (
  SELECT date, count(*) AS n, avg(x) AS ax, avg(y) AS ay, stddev_pop(x) AS sx, stddev_pop(y) AS sy, covar_pop(x, y) AS cxy
  FROM pairs GROUP BY date),
fit AS (
  SELECT *, sign(cxy/(sx*sy)) * greatest(abs(cxy/(sx*sy)) - 0.01/(sx*sy), 0) / (1 + 0.09/(sx*sx)) AS b FROM mom)
"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    # -------------------------------------------------------- sightings, footfall
    sql["sightings"] = f"""
WITH {_SIGHTINGS}
SELECT date, datetime, folder_name, user_id, place_id, floor_name, network_id, unit_id, aibeaconid FROM sight
"""
    sql["network_check"] = f"""
WITH {_SIGHTINGS}
SELECT network_id AS place_id, count(DISTINCT user_id) AS n_users FROM sight GROUP BY 1 HAVING count(DISTINCT user_id) > 1
"""
    sql["footfall_day"] = _footfall(None, None, "daily_count")
    sql["footfall_hour"] = _footfall(*_HOUR, "hourly_count")
    for width in (30, 10, 1):
        sql[f"footfall_{width}min"] = _footfall(*_minute(width), f"{width}min_count")
    sql["sightings_salted"] = sql["sightings"]
    minute = _minute(1)
    parts = {
        "day": (_footfall(None, None, "devices"), "CAST(NULL AS VARCHAR)"),
        "hour": (_footfall(*_HOUR, "devices"), "hour"),
        "1min": (_footfall(*minute, "devices"), "minute"),
    }
    counts = " UNION ALL ".join(
        f"SELECT '{grain}' AS grain, date, {bucket} AS bucket, folder_name, user_id, place_id, floor_name, network_id, unit_id, devices FROM ({part})"
        for grain, (part, bucket) in parts.items()
    )
    sql["footfall_job"] = counts
    fourth = "date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(date AS DATE)) % 4 = 0"
    sql["footfall_days"] = f"SELECT * FROM ({counts}) WHERE {fourth}"
    sql["footfall_gps_day"] = _gps(None, None, "daily_count")
    sql["footfall_gps_hour"] = _gps(*_HOUR, "hourly_count")
    sql["footfall_gps_1min"] = _gps(*_minute(1), "1min_count")

    # --------------------------------------------------------------------- panels
    by_place = "place_id"
    sql["panel_dense"] = f"""
WITH {_grid('unit_id', by_place, 1)}
SELECT date, place_id, member, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS total, CAST(sum(y * t) AS BIGINT) AS moment
FROM dense GROUP BY ALL
"""
    sql["panel_clipped"] = f"""
WITH {_grid('unit_id', by_place, 1, 570, 1080)}
SELECT date, place_id, member, CAST(t AS INTEGER) AS t, y FROM panel
"""
    sql["panel_clipped_dense"] = f"WITH {_grid('unit_id', by_place, 10, 570, 1080)} SELECT date, place_id, member, t, y FROM dense"
    sql["model_status"] = f"""
WITH {_grid('unit_id', by_place, 10, 540, 640)},
sized AS (SELECT date, place_id, CAST(nobs AS INTEGER) AS nobs, CAST(count(*) AS INTEGER) AS n_members FROM spine GROUP BY ALL)
SELECT date, place_id, CASE WHEN nobs - 1 - n_members - 1 > 0 THEN 'fitted' ELSE 'too few rows' END AS status,
       CAST(CASE WHEN nobs - 1 - n_members - 1 > 0 THEN 1 ELSE 0 END AS INTEGER) AS lag, nobs, n_members FROM sized
"""
    sql["panel_resampled"] = f"WITH {_grid('unit_id', by_place, 50)} SELECT date, place_id, member, t, y FROM dense"
    sql["panel_grouped_all"] = f"WITH {_grid('network_id', by_place, 10)} SELECT date, place_id, member, t, y FROM dense"
    sql["panel_grouped_floor"] = f"""
WITH {_grid('network_id', 'place_id, floor_name', 10)} SELECT date, place_id, floor_name, member, t, y FROM dense
"""
    units = [f"U{u:02d}" for u in range(12)]
    wide = ", ".join(f"CAST(sum(CASE WHEN member = '{u}' THEN y ELSE 0 END) AS BIGINT) AS \"{u}\"" for u in units)
    sql["panel_wide"] = f"WITH {_grid('unit_id', by_place, 10)} SELECT date, CAST(t AS INTEGER) AS t, {wide} FROM panel GROUP BY ALL"
    sql["panel_hourly"] = f"""
WITH {_grid('unit_id', by_place, 1)}
SELECT date, place_id, CAST(t // 60 AS INTEGER) AS hour, member, CAST(t % 60 AS INTEGER) AS t, y FROM panel
"""
    sql["unit_rank"] = f"""
WITH {_grid('unit_id', by_place, 10)}
SELECT date, place_id, member, CAST(sum(y) AS BIGINT) AS total, sum(y) / 144.0 AS mean,
       CAST(row_number() OVER (PARTITION BY date, place_id ORDER BY sum(y) DESC, member) AS INTEGER) AS rank
FROM dense GROUP BY date, place_id, member
"""
    lag = "lag(y, {0}) OVER (PARTITION BY date, place_id, member ORDER BY t) AS lag_{0}"
    sql["lag_features"] = f"""
WITH {_grid('unit_id', by_place, 10)},
lagged AS (SELECT date, place_id, member, t, y, {', '.join(lag.format(p) for p in (1, 2, 3))} FROM dense)
SELECT * FROM lagged WHERE t >= 3
"""
    sql["lag_moments"] = f"""
WITH {_grid('unit_id', by_place, 10)},
numbered AS (SELECT panel.*, CAST(substr(member, 2) AS INTEGER) - CASE WHEN place_id = 'P0' THEN 0 ELSE 8 END AS i FROM panel)
SELECT a.date, a.place_id, a.i, b.i AS j, CAST(a.t - b.t AS INTEGER) AS lag, CAST(sum(a.y * b.y) AS BIGINT) AS s
FROM numbered a JOIN numbered b ON a.date = b.date AND a.place_id = b.place_id AND a.t - b.t BETWEEN 0 AND 10
WHERE a.t > b.t OR a.i <= b.i
GROUP BY a.date, a.place_id, a.i, b.i, a.t - b.t
"""

    # ------------------------------------------------------- paths and popularity
    sql["arrival_edges"] = f"""
WITH {_ARRIVALS} SELECT date, place_id, ORIGIN, DESTINATION, CAST(w AS DOUBLE) AS "MOVEMENT_INFLUENCE_AMOUNT" FROM edges
"""
    sql["paths3"] = f"""
WITH {_ARRIVALS}
SELECT a.date, a.place_id, a.ORIGIN, b.ORIGIN AS "VIA_1", b.DESTINATION,
       round_even(CAST(a.w AS DOUBLE) * CAST(b.w AS DOUBLE), 6) AS "MOVEMENT_INFLUENCE_AMOUNT_VIA_1"
FROM edges a JOIN edges b ON a.date = b.date AND a.place_id = b.place_id AND a.DESTINATION = b.ORIGIN
WHERE a.w <> 0 AND b.w <> 0
"""
    sql["paths4"] = f"""
WITH {_ARRIVALS}
SELECT a.date, a.place_id, a.ORIGIN, b.ORIGIN AS "VIA_1", c.ORIGIN AS "VIA_2", c.DESTINATION,
       round_even(CAST(a.w AS DOUBLE) * CAST(b.w AS DOUBLE) * CAST(c.w AS DOUBLE), 8) AS "MOVEMENT_INFLUENCE_AMOUNT_VIA_2"
FROM edges a JOIN edges b ON a.date = b.date AND a.place_id = b.place_id AND a.DESTINATION = b.ORIGIN
JOIN edges c ON c.date = b.date AND c.place_id = b.place_id AND b.DESTINATION = c.ORIGIN
WHERE a.w <> 0 AND b.w <> 0 AND c.w <> 0
"""
    sql["degree_popularity"] = f"""
WITH {_ARRIVALS}
SELECT date, place_id, member AS unique_id, round_even(degree / CAST(others AS DOUBLE), 4) AS popular_area FROM degree
"""
    sql["publish_popularity"] = _PUBLISHED
    sql["publish_all"] = " UNION ALL ".join(_published(by_floor, hourly) for hourly in (False, True) for by_floor in (False, True))
    sql["result_csv"] = f"""
WITH {_ARRIVALS}
SELECT date, place_id, member AS unique_id, CAST(round_even(degree / CAST(others AS DOUBLE), 4) AS DOUBLE) AS popular_area FROM degree
"""
    sql["plan_runs"] = f"""
WITH {_MINUTES} SELECT days.date, p.place_id FROM days CROSS JOIN (SELECT DISTINCT place_id FROM sight) p
"""

    # ----------------------------------------------------- two-member closed forms
    sql["var_fit_pair"] = f"""
WITH {_PAIR},
long AS (
  SELECT date, m1 AS target, NULL AS source, 0 AS lag, k1 AS coef FROM fit UNION ALL
  SELECT date, m2, NULL, 0, k2 FROM fit UNION ALL
  SELECT date, m1, m1, 1, a11 FROM fit UNION ALL SELECT date, m1, m2, 1, a12 FROM fit UNION ALL
  SELECT date, m2, m1, 1, a21 FROM fit UNION ALL SELECT date, m2, m2, 1, a22 FROM fit)
SELECT date, target, CAST(source AS VARCHAR) AS source, CAST(lag AS INTEGER) AS lag, round_even(coef, 8) + 0.0 AS coef FROM long
"""
    sql["var_sigma_pair"] = f"""
WITH {_PAIR},
long AS (
  SELECT date, m1 AS target, m1 AS source, e11 / (n - 3) AS sigma FROM fit UNION ALL
  SELECT date, m1, m2, e12 / (n - 3) FROM fit UNION ALL SELECT date, m2, m1, e12 / (n - 3) FROM fit UNION ALL
  SELECT date, m2, m2, e22 / (n - 3) FROM fit)
SELECT date, target, source, round_even(sigma, 8) + 0.0 AS sigma FROM long
"""
    sql["var_predict_pair"] = f"""
WITH {_PAIR},
long AS (
  SELECT p.date, p.t, m1 AS member, k1 + a11*x1 + a12*x2 AS v FROM pairs p JOIN fit USING (date) UNION ALL
  SELECT p.date, p.t, m2, k2 + a21*x1 + a22*x2 FROM pairs p JOIN fit USING (date))
SELECT date, t, member, round_even(v, 8) + 0.0 AS predicted FROM long
"""
    sql["var_rss_pair"] = f"""
WITH {_PAIR},
long AS (SELECT date, m1 AS member, e11 AS rss FROM fit UNION ALL SELECT date, m2, e22 FROM fit)
SELECT date, member, round_even(rss, 6) + 0.0 AS rss FROM long
"""
    sql["var_ic_pair"] = f"""
WITH {_PAIR},
ll AS (
  SELECT date, n, -0.5 * n * (2 * ln(2 * pi()) + ln(abs(e11*e22 - e12*e12) / (n*n) + 1e-256) + 2) AS loglik FROM fit)
SELECT date, CAST(1 AS INTEGER) AS lag, CAST(n AS INTEGER) AS n, round_even(loglik, 6) AS loglik,
       round_even((-2*loglik + 2*6) / n, 8) AS aic, round_even((-2*loglik + ln(n)*6) / n, 8) AS bic,
       round_even((-2*loglik + 2*ln(ln(n))*6) / n, 8) AS hqic
FROM ll
"""
    sql["influence_edges_pair"] = f"""
{_PAIR_RESPONSE}
SELECT date, src AS "ORIGIN", dst AS "DESTINATION",
       CASE WHEN src <> dst AND round_even(round_even(v, 10), 4) > 0 THEN round_even(round_even(v, 10), 4) ELSE 0.0 END AS "MOVEMENT_INFLUENCE_AMOUNT"
FROM long WHERE h = 1
"""
    sql["impulse_response_pair"] = f"""
{_PAIR_RESPONSE} SELECT date, h AS horizon, src, dst, round_even(v, 8) + 0.0 AS value FROM long
"""
    sql["impulse_response_sd_pair"] = f"""
{_PAIR_RESPONSE} SELECT date, h AS horizon, src, dst, round_even(v * sqrt(d / (n - 3)), 8) + 0.0 AS value FROM long
"""
    sql["ma_coefficients_pair"] = f"""
WITH RECURSIVE {_PAIR},
power AS (
  SELECT date, m1, m2, a11, a12, a21, a22, 0 AS h, CAST(1 AS DOUBLE) AS r11, CAST(0 AS DOUBLE) AS r12,
         CAST(0 AS DOUBLE) AS r21, CAST(1 AS DOUBLE) AS r22 FROM fit
  UNION ALL
  SELECT date, m1, m2, a11, a12, a21, a22, h + 1,
         a11*r11 + a12*r21, a11*r12 + a12*r22, a21*r11 + a22*r21, a21*r12 + a22*r22 FROM power WHERE h < 6),
long AS (
  SELECT date, h, m1 AS dst, m1 AS src, r11 AS v FROM power UNION ALL SELECT date, h, m1, m2, r12 FROM power UNION ALL
  SELECT date, h, m2, m1, r21 FROM power UNION ALL SELECT date, h, m2, m2, r22 FROM power)
SELECT date, h AS horizon, src, dst, round_even(v, 8) + 0.0 AS value FROM long
"""
    sql["fevd_pair"] = f"""
{_PAIR_RESPONSE},
grown AS (SELECT date, h, src, dst, sum(v*v*d) OVER (PARTITION BY date, dst, src ORDER BY h) AS w FROM long)
SELECT date, h AS horizon, src, dst, round_even(w / sum(w) OVER (PARTITION BY date, dst, h), 8) AS share FROM grown
"""
    sql["granger_pair"] = f"""
WITH {_PAIR},
tests AS (
  SELECT date, m2 AS causing, m1 AS caused, ((v11 - c11*c11/s11) - e11) / (e11 / (n - 3)) AS chi2 FROM fit UNION ALL
  SELECT date, m1, m2, ((v22 - c22*c22/s22) - e22) / (e22 / (n - 3)) FROM fit)
SELECT date, causing, caused, CAST(1 AS INTEGER) AS lag, round_even(chi2, 6) AS chi2, round_even(exp(-chi2 / 2), 8) AS p_value FROM tests
"""
    sql["sparse_var_site"] = f"""
WITH {_SINGLE} SELECT date, 'F1' AS target, 'F1' AS source, CAST(1 AS INTEGER) AS lag, round_even(b, 7) + 0.0 AS coef FROM fit
"""
    sql["sparse_predict_site"] = f"""
WITH {_SINGLE}
SELECT p.date, round_even(sum((p.y - (ay + (p.x - ax) * b * sy / sx)) ** 2), 4) AS rss FROM pairs p JOIN fit USING (date) GROUP BY p.date
"""

    # ------------------------------------------------- whole models, solved in SQL
    sql |= oracle_models.model_tables(_grid, "unit_id", by_place)
    sql |= oracle_models.lag_one_tables(_grid, "unit_id", by_place)
    sql |= oracle_models.statements(_grid, "unit_id", by_place, "all")
    sql |= oracle_models.statements(_grid, "unit_id", "place_id, floor_name", "floor")
    sql |= oracle_models.statements(_grid, "network_id", by_place, "network")
    sql |= oracle_models.statements(_hour_grid, "unit_id", "place_id, hour", "all", hourly=True)
    sql |= oracle_models.statements(_hour_grid, "unit_id", "place_id, floor_name, hour", "floor", hourly=True)
    sql |= oracle_models.chosen_lag_tables(_grid, _hour_grid)
    sql["analysis_tables"] = oracle_models.analysis_tables(_grid)
    sql["plan_runs_compact"] = sql["plan_runs"]
    # every equation of every group meets the conditions that only the optimum meets
    sql["sparse_certificate"] = f"WITH {_grid('unit_id', by_place, 10)} SELECT DISTINCT date, place_id, member AS target, true AS optimal FROM spine"
    for grain in ("hour", "day"):
        del sql[f"circulation3_{grain}_floor"]
    del sql["circulation3_hour_all"]
    sql["influence_hour_all_floor"] = sql["influence_hour_floor"]
    sql["circulation_hour_all_floor"] = sql["circulation_hour_floor"]
    sql["popularity_hour_all_floor"] = sql["popularity_hour_all"]
    sql["influence_day_all_floor"] = sql["influence_day_floor"]
    sql["circulation_day_all_floor"] = sql["circulation_day_floor"]
    sql["popularity_day_all_floor"] = sql["popularity_day_all"]
    return sql
