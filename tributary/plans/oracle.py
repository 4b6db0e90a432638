"""Independent DuckDB SQL for each registered query (same column names).

Written from the operator semantics, not from the Spark code: windows, lag
and grouping in plain SQL over the driver's views.
"""

from __future__ import annotations

_CLASS = """CASE WHEN {x} > 8 THEN 'star' WHEN {x} > 7 THEN 'good'
                 WHEN {x} > 6 THEN 'average' WHEN {x} IS NOT NULL THEN 'bad' END"""
_SCORE = """CASE WHEN {x} > 20 THEN 'star' WHEN {x} > 15 THEN 'good'
                 WHEN {x} > 10 THEN 'average' WHEN {x} IS NOT NULL THEN 'bad' END"""

# actor x year roll-up and the dense actor x year calendar, shared by D2-D9.
_ACTOR_SNAP = f"""
yr AS (
  SELECT o_custkey AS actorid, CAST(year(o_orderdate) AS INTEGER) AS y,
         count(*) AS n, min(o_orderkey) AS mn, max(o_orderkey) AS mx,
         sum(o_orderkey % 997) AS v, avg(o_totalprice / 49999.0) AS a
  FROM orders WHERE year(o_orderdate) <= 2001 GROUP BY 1, 2),
cal AS (
  SELECT actorid, CAST(unnest(generate_series(min(y), 2001)) AS INTEGER) AS current_year
  FROM yr GROUP BY actorid),
snap AS (
  SELECT cal.actorid, 'cust-' || CAST(cal.actorid AS VARCHAR) AS actor, cal.current_year,
         CAST(sum(yr.n) OVER w AS BIGINT) AS n_films,
         first_value(yr.mn) OVER w AS first_filmid,
         last_value(yr.mx IGNORE NULLS) OVER w AS last_filmid,
         CAST(sum(yr.v) OVER w AS BIGINT) AS total_votes,
         last_value({_CLASS.format(x='yr.a')} IGNORE NULLS) OVER w AS quality_class,
         yr.y IS NOT NULL AS is_active
  FROM cal LEFT JOIN yr ON cal.actorid = yr.actorid AND cal.current_year = yr.y
  WINDOW w AS (PARTITION BY cal.actorid ORDER BY cal.current_year
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

_SEASON_SNAP = f"""
ps AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS season,
         count(*) AS gp, sum(o_totalprice) / 19997.0 AS pts
  FROM orders GROUP BY 1, 2),
cal AS (
  SELECT player_id, CAST(unnest(generate_series(min(season), 2001)) AS INTEGER) AS current_season
  FROM ps WHERE season <= 2001 GROUP BY player_id),
snap AS (
  SELECT cal.player_id, cal.current_season,
         CAST(count(ps.season) OVER w AS BIGINT) AS n_seasons,
         CAST(sum(ps.gp) OVER w AS BIGINT) AS total_gp,
         last_value({_SCORE.format(x='ps.pts')} IGNORE NULLS) OVER w AS scoring_class,
         CAST(cal.current_season - last_value(ps.season IGNORE NULLS) OVER w AS INTEGER)
           AS years_since_last_season,
         ps.season IS NOT NULL AS is_active,
         first_value(ps.pts) OVER w AS first_pts,
         last_value(ps.pts IGNORE NULLS) OVER w AS last_pts
  FROM cal LEFT JOIN ps ON cal.player_id = ps.player_id AND cal.current_season = ps.season
  WINDOW w AS (PARTITION BY cal.player_id ORDER BY cal.current_season
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

_SCD_FROM_SNAP = """
prev AS (
  SELECT actorid, current_year, quality_class, is_active,
         CASE WHEN row_number() OVER (PARTITION BY actorid ORDER BY current_year) = 1 THEN 0
              WHEN quality_class IS DISTINCT FROM lag(quality_class) OVER (PARTITION BY actorid ORDER BY current_year)
                OR is_active IS DISTINCT FROM lag(is_active) OVER (PARTITION BY actorid ORDER BY current_year)
              THEN 1 ELSE 0 END AS chg
  FROM snap WHERE current_year <= {as_of}),
streak AS (
  SELECT *, sum(chg) OVER (PARTITION BY actorid ORDER BY current_year
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM prev)
SELECT actorid, quality_class, is_active, min(current_year) AS start_date,
       max(current_year) AS end_date, CAST({as_of} AS INTEGER) AS current_year
FROM streak GROUP BY actorid, sid, quality_class, is_active
"""

def _ratio4(n: str, d: str) -> str:
    """num/den to 4 places, halves up: the whole quotient, plus the remainder
    rounded by comparing twice its ten-thousandfold (in 128-bit integers)."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    rem = f"((10000 * ({n} % {d})) % {d})"
    whole = f"(10000 * ({n} // {d}) + (10000 * ({n} % {d})) // {d})"
    return (f"CASE WHEN {d} <> 0 THEN CAST({whole} + CASE WHEN 2 * {rem} >= {d} THEN 1 ELSE 0 END AS DOUBLE)"
            f" / CAST(10000.0 AS DOUBLE) END")


ORACLE: dict[str, str] = {}

ORACLE["dim_period_rollup"] = f"""
SELECT o_custkey AS actorid, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(*) AS n_films, min(o_orderkey) AS first_filmid, max(o_orderkey) AS last_filmid,
       round(avg(o_totalprice / 49999.0), 4) AS average_rating,
       {_CLASS.format(x='avg(o_totalprice / 49999.0)')} AS quality_class
FROM orders GROUP BY 1, 2
"""

ORACLE["dim_cumulative_snapshot"] = f"""
WITH {_ACTOR_SNAP}
SELECT actorid, actor, current_year, n_films, first_filmid, last_filmid, total_votes,
       quality_class, is_active FROM snap
"""

ORACLE["dim_cumulative_seasons"] = f"""
WITH {_SEASON_SNAP}
SELECT player_id, current_season, n_seasons, total_gp, scoring_class,
       years_since_last_season, is_active FROM snap
"""

ORACLE["dim_scd2_backfill"] = f"WITH {_ACTOR_SNAP}, {_SCD_FROM_SNAP.format(as_of=2001)}"

# incremental (backfill to 2000, merge 2001) must equal the backfill to 2001.
ORACLE["dim_scd2_incremental"] = ORACLE["dim_scd2_backfill"]

ORACLE["dim_scd2_stepwise"] = ORACLE["dim_scd2_backfill"]

ORACLE["dim_unnest_history"] = """
SELECT o_custkey AS actorid, CAST(o_orderkey AS VARCHAR) AS film,
       CAST(o_orderkey % 997 AS INTEGER) AS votes, round(o_totalprice / 49999.0, 4) AS rating,
       o_orderkey AS filmid
FROM orders WHERE year(o_orderdate) <= 2001
"""

ORACLE["dim_growth_ratio"] = f"""
WITH {_SEASON_SNAP}
SELECT player_id, round(first_pts, 4) AS first_pts, round(last_pts, 4) AS last_pts,
       round(last_pts / CASE WHEN first_pts = 0 THEN 1 ELSE first_pts END, 4) AS pts_ratio
FROM snap WHERE current_season = 2001 AND scoring_class = 'star'
"""

# --- facts ---------------------------------------------------------------------

ORACLE["fact_dedup_game_details"] = """
WITH first_line AS (
  SELECT l_orderkey, l_linenumber, min({'s': l_shipdate, 'p': l_partkey, 'k': l_suppkey, 'q': l_quantity,
                                        'e': l_extendedprice, 'd': l_discount}) AS m
  FROM lineitem GROUP BY ALL),
facts AS (
  SELECT f.l_orderkey AS game, f.l_linenumber AS line, f.m.p AS player, f.m.k AS team, f.m.q AS points,
         f.m.e * (1 - f.m.d) AS revenue, o.o_custkey AS opponent, CAST(o.o_orderdate AS DATE) AS played,
         regexp_extract(o.o_orderpriority, '(URGENT|HIGH|LOW)') AS note
  FROM first_line f LEFT JOIN orders o ON o.o_orderkey = f.l_orderkey)
SELECT points AS m_pts, round(revenue, 4) AS m_revenue,
       CASE WHEN line = 7 THEN NULL WHEN line = 6 THEN CAST(floor(points) AS DOUBLE)
            ELSE round(floor(points) + ((line * 7) % 60) / 60.0, 4) END AS m_minutes,
       coalesce(note = 'LOW', false) AS dim_not_with_team, coalesce(note = 'HIGH', false) AS dim_did_not_dress,
       coalesce(note = 'URGENT', false) AS dim_did_not_play, (team - opponent) % 30 = 0 AS dim_is_playing_at_home,
       player AS dim_player_id, team AS dim_team_id, played AS dim_game_date,
       CAST(year(played) AS INTEGER) AS dim_season, line AS dim_line, game AS dim_game_id
FROM facts
"""

_ACTIVITY = """
act AS (
  SELECT DISTINCT e.user_id, e.device_id, n.n_name AS browser_type, e.date
  FROM (SELECT user_id, json_extract_string(props, '$.k')::BIGINT % 25 AS device_id,
               CAST(ts AS DATE) AS date FROM events) e
  LEFT JOIN nation n ON CAST(n.n_nationkey AS BIGINT) = e.device_id
  WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL)
"""

ORACLE["fact_daily_device_activity"] = f"WITH {_ACTIVITY} SELECT * FROM act"

ORACLE["fact_device_datelist"] = f"""
WITH {_ACTIVITY},
firsts AS (
  SELECT user_id, device_id, browser_type, min(date) AS d0
  FROM act WHERE date <= DATE '2024-01-30' GROUP BY ALL),
cal AS (
  SELECT user_id, device_id, browser_type,
         CAST(unnest(generate_series(d0, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date
  FROM firsts)
SELECT c.user_id, c.device_id, c.browser_type, c.date,
       count(*) AS n_days, min(a.date) AS first_active, max(a.date) AS last_active
FROM cal c JOIN act a
  ON c.user_id = a.user_id AND c.device_id = a.device_id
 AND c.browser_type IS NOT DISTINCT FROM a.browser_type AND a.date <= c.date
GROUP BY ALL
"""

ORACLE["fact_datelist_int"] = f"""
WITH {_ACTIVITY}
SELECT user_id, device_id, browser_type, DATE '2024-01-30' AS date,
       CAST(sum(CASE WHEN DATE '2024-01-30' - date BETWEEN 0 AND 31
                     THEN 1::BIGINT << (31 - (DATE '2024-01-30' - date)) ELSE 0 END) AS BIGINT) AS datelist_int,
       lpad(bin(CAST(sum(CASE WHEN DATE '2024-01-30' - date BETWEEN 0 AND 31
                     THEN 1::BIGINT << (31 - (DATE '2024-01-30' - date)) ELSE 0 END) AS BIGINT)), 32, '0')
         AS datelist_bits
FROM act WHERE date <= DATE '2024-01-30' GROUP BY ALL
"""

ORACLE["fact_host_datelist"] = """
SELECT event_type AS host, CAST(date_trunc('month', ts) AS DATE) AS month_start,
       count(DISTINCT CAST(ts AS DATE)) AS n_days, min(CAST(ts AS DATE)) AS first_day,
       max(CAST(ts AS DATE)) AS last_day
FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-30' GROUP BY 1, 2
"""

ORACLE["fact_host_datelist_upsert"] = ORACLE["fact_host_datelist"]

ORACLE["fact_daily_host_metrics"] = """
SELECT event_type AS host, CAST(ts AS DATE) AS date, count(*) AS hits,
       count(DISTINCT user_id) AS unique_visitors
FROM events GROUP BY 1, 2
"""

ORACLE["fact_host_activity_reduced"] = """
WITH d AS (
  SELECT event_type AS host, CAST(ts AS DATE) AS date, count(*) AS hits, count(DISTINCT user_id) AS uv
  FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-30' GROUP BY 1, 2),
slots AS (
  SELECT host, month_start, CAST(unnest(generate_series(month_start,
           least(CAST(month_start + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), DATE '2024-01-30'), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT host, CAST(date_trunc('month', date) AS DATE) AS month_start FROM d))
SELECT s.host, s.month_start, count(*) AS n_slots,
       string_agg(CAST(coalesce(d.hits, 0) AS VARCHAR), ',' ORDER BY s.date) AS hit_array,
       string_agg(CAST(coalesce(d.uv, 0) AS VARCHAR), ',' ORDER BY s.date) AS unique_visitors_array
FROM slots s LEFT JOIN d ON s.host = d.host AND s.date = d.date
GROUP BY s.host, s.month_start
"""

ORACLE["fact_host_activity_incremental"] = ORACLE["fact_host_activity_reduced"]
ORACLE["fact_host_activity_merge"] = ORACLE["fact_host_activity_reduced"]

# --- analytical patterns ---------------------------------------------------------

ORACLE["pattern_state_change"] = f"""
WITH {_ACTOR_SNAP}
SELECT actorid, current_year, is_active,
       CASE WHEN is_active AND NOT coalesce(bool_or(is_active) OVER before, false) THEN 'New'
            WHEN is_active AND lag(is_active) OVER w0 THEN 'Continued Playing'
            WHEN is_active THEN 'Returned from Retirement'
            WHEN lag(is_active) OVER w0 IS NOT DISTINCT FROM true THEN 'Retired'
            ELSE 'Stayed Retired' END AS player_state,
       count(CASE WHEN is_active THEN current_year END) OVER upto AS n_years_active,
       max(CASE WHEN is_active THEN current_year END) OVER upto AS last_active_year
FROM snap
WINDOW w0 AS (PARTITION BY actorid ORDER BY current_year),
       before AS (PARTITION BY actorid ORDER BY current_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       upto AS (PARTITION BY actorid ORDER BY current_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_GAME_DETAILS = """
gd AS (SELECT l_partkey AS player_id, l_suppkey AS team_id, CAST(year(l_shipdate) AS INTEGER) AS season,
              l_quantity AS pts FROM lineitem)
"""

ORACLE["pattern_grouping_sets"] = f"""
WITH {_GAME_DETAILS}
SELECT player_id, team_id, season, sum(pts) AS total_points, count(*) AS n_rows,
       grouping_id(player_id, team_id, season) AS gid
FROM gd GROUP BY GROUPING SETS ((player_id, team_id), (player_id, season), (team_id))
"""

ORACLE["pattern_top_player_team"] = f"""
WITH {_GAME_DETAILS}
SELECT player_id, team_id, sum(pts) AS total_points FROM gd GROUP BY 1, 2
ORDER BY total_points DESC, player_id, team_id LIMIT 1
"""

ORACLE["pattern_top_player_season"] = f"""
WITH {_GAME_DETAILS}
SELECT player_id, season, sum(pts) AS total_points FROM gd GROUP BY 1, 2
ORDER BY total_points DESC, player_id, season LIMIT 1
"""

_SIDES = """
sides AS (
  SELECT (o_custkey + shift) % 30 AS team_id, CAST((o_orderstatus = 'F') = (shift = 0) AS INTEGER) AS win,
         row_number() OVER (PARTITION BY (o_custkey + shift) % 30 ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS nth
  FROM orders, (SELECT unnest([0, 7]) AS shift))
"""

ORACLE["pattern_team_most_wins"] = f"""
WITH {_SIDES}
SELECT team_id, CAST(sum(win) AS BIGINT) AS total_wins FROM sides GROUP BY 1
ORDER BY total_wins DESC, team_id LIMIT 1
"""

ORACLE["pattern_best_90_game_stretch"] = f"""
WITH {_SIDES}
, won AS (SELECT team_id, nth, sum(win) OVER (PARTITION BY team_id ORDER BY nth) AS so_far FROM sides)
SELECT now.team_id, CAST(max(now.so_far - coalesce(past.so_far, 0)) AS BIGINT) AS max_wins_90_game_stretch
FROM won now LEFT JOIN won past ON past.team_id = now.team_id AND past.nth = now.nth - 90
GROUP BY now.team_id
"""

ORACLE["pattern_longest_streak"] = """
WITH e AS (
  SELECT user_id, ts, event_id, value > 10 AS c,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (
  SELECT user_id, rn - row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp
  FROM e WHERE c),
runs AS (SELECT user_id, count(*) AS n FROM r GROUP BY user_id, grp)
SELECT u.user_id, CAST(coalesce(max(runs.n), 0) AS BIGINT) AS longest_streak
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN runs ON u.user_id = runs.user_id
GROUP BY u.user_id
"""

# --- sessions ------------------------------------------------------------------

_WEB_SESSIONS = """
e AS (SELECT event_type AS host, CAST(user_id % 3 AS VARCHAR) AS ip, ts FROM events),
f AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY host, ip ORDER BY ts) IS NULL
                       OR ts - lag(ts) OVER (PARTITION BY host, ip ORDER BY ts) > INTERVAL 5 MINUTE
                     THEN 1 ELSE 0 END AS nw FROM e),
g AS (SELECT *, sum(nw) OVER (PARTITION BY host, ip ORDER BY ts
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
ses AS (SELECT min(ts) AS event_window_timestamp, host, ip, count(*) AS num_hits, max(ts) AS last_hit
        FROM g GROUP BY host, ip, sid)
"""

ORACLE["stream_session_hits"] = f"WITH {_WEB_SESSIONS} SELECT * FROM ses"

# the replayed stream gives the batch sessions, and every event once
ORACLE["stream_replay_sessions"] = ORACLE["stream_session_hits"]
ORACLE["stream_replay_dedup"] = "SELECT DISTINCT event_id, user_id, event_type, ts FROM events"

ORACLE["stream_avg_session_hits"] = f"""
WITH {_WEB_SESSIONS}
SELECT ip, host, CAST(floor(avg(num_hits) + 0.5) AS BIGINT) AS average_num_hits
FROM ses WHERE host LIKE '%e' GROUP BY ip, host
"""

ORACLE["stream_compare_hosts"] = f"""
WITH {_WEB_SESSIONS}
SELECT host, count(DISTINCT ip) AS n_ips, count(*) AS n_sessions, CAST(sum(num_hits) AS BIGINT) AS total_hits,
       CAST(floor(sum(num_hits) / count(*) + 0.5) AS BIGINT) AS avg_hits
FROM ses WHERE host IN ('click', 'view', 'signup') GROUP BY host
"""

ORACLE["engagement_time_per_user_day"] = """
WITH f AS (SELECT user_id, ts,
                  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
ses AS (SELECT user_id, min(ts) AS s, max(ts) AS e FROM g GROUP BY user_id, sid),
d AS (SELECT user_id, s, e,
             CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
      FROM ses)
SELECT user_id, day,
       CAST(sum(epoch_us(least(e, CAST(day + INTERVAL 1 DAY AS TIMESTAMP)))
                - epoch_us(greatest(s, CAST(day AS TIMESTAMP)))) AS BIGINT) AS active_micros
FROM d GROUP BY user_id, day
"""


# --- layout and joins -------------------------------------------------------------

_MATCH_ROWS = """
md AS (SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag,
              CAST(sum(l_quantity) AS BIGINT) AS player_total_kills FROM lineitem GROUP BY 1, 2),
mr AS (SELECT o.o_orderkey AS match_id, md.player_gamertag, l.l_partkey AS medal_id,
              CAST(o.o_custkey % 25 AS INTEGER) AS mapid, o.o_orderpriority AS playlist_id,
              md.player_total_kills
       FROM orders o JOIN md ON o.o_orderkey = md.match_id
       JOIN lineitem l ON l.l_orderkey = md.match_id AND l.l_suppkey = md.player_gamertag)
"""

ORACLE["layout_broadcast_maps"] = """
SELECT o_orderkey AS match_id, CAST(o_custkey % 25 AS INTEGER) AS mapid, o_orderpriority AS playlist_id,
       n_name AS map_name
FROM orders JOIN nation ON n_nationkey = o_custkey % 25
"""

ORACLE["layout_broadcast_medals"] = """
SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag, l_partkey AS medal_id, p_type AS classification
FROM lineitem JOIN part ON p_partkey = l_partkey
"""

ORACLE["layout_bucket_join"] = f"WITH {_MATCH_ROWS} SELECT * FROM mr"

ORACLE["layout_sort_sizes"] = """
SELECT layout, (SELECT count(*) FROM lineitem) AS n_rows, CAST(16 AS BIGINT) AS n_files, true AS has_bytes
FROM (VALUES ('by_match'), ('by_medal'), ('by_player_medal')) v(layout)
"""

ORACLE["layout_avg_kills_per_game"] = f"""
WITH {_MATCH_ROWS},
g AS (SELECT DISTINCT match_id, player_gamertag, player_total_kills FROM mr)
SELECT player_gamertag, count(*) AS n_games,
       {_ratio4('sum(player_total_kills)', 'count(*)')} AS avg_kills_per_game
FROM g GROUP BY player_gamertag
"""

ORACLE["layout_top_playlist"] = f"""
WITH {_MATCH_ROWS}
SELECT playlist_id, count(DISTINCT match_id) AS n_matches FROM mr GROUP BY 1
ORDER BY n_matches DESC, playlist_id LIMIT 1
"""

ORACLE["layout_top_map"] = f"""
WITH {_MATCH_ROWS}
SELECT mapid, count(DISTINCT match_id) AS n_matches FROM mr GROUP BY 1
ORDER BY n_matches DESC, mapid LIMIT 1
"""

ORACLE["layout_top_killing_spree_map"] = f"""
WITH {_MATCH_ROWS}
SELECT mapid, count(*) AS n_medals FROM mr JOIN part ON p_partkey = mr.medal_id
WHERE p_type = 'PROMO' GROUP BY 1 ORDER BY n_medals DESC, mapid LIMIT 1
"""

ORACLE["join_salted_hot_key"] = """
SELECT o.o_orderpriority, count(*) AS n_rows, sum(l.l_quantity) AS total_qty
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k, l_quantity FROM lineitem) l
JOIN orders o ON o.o_orderkey = l.k GROUP BY 1
"""

# --- experiments ---------------------------------------------------------------------

_EXPOSURES = """
xe AS (SELECT * FROM (VALUES ('note_suggestions', TIMESTAMP '2024-01-05'), ('table_editor', TIMESTAMP '2024-01-10'),
                             ('mobile_performance', TIMESTAMP '2024-01-15')) x(experiment, launch)),
xb AS (SELECT xe.experiment, e.user_id, min(e.ts) AS exposure_ts,
              ('0x' || substr(md5(xe.experiment || ':' || CAST(e.user_id AS VARCHAR)), 1, 8))::BIGINT % 100 AS bucket
       FROM events e JOIN xe ON e.ts >= xe.launch GROUP BY xe.experiment, e.user_id),
xp AS (SELECT experiment, user_id, exposure_ts, bucket,
              CASE WHEN bucket < 50 THEN 'control' WHEN bucket < 100 THEN 'treatment' ELSE 'blue' END AS cell
       FROM xb)
"""

# every event with its user's cell in each experiment
_CELLS = """
xc AS (SELECT x.experiment, e.*,
              CASE WHEN ('0x' || substr(md5(x.experiment || ':' || CAST(e.user_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 50 THEN 'control' ELSE 'treatment' END AS cell
       FROM events e, (VALUES ('note_suggestions'), ('table_editor'), ('mobile_performance')) x(experiment))
"""


def _normal_tail(z: str) -> str:
    """Two-sided tail: the density's integral from 0 to |z| by Simpson's rule."""
    steps = 4000
    f = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-0.5 * pow(abs({z}) * i / {steps}.0, 2))"
    return f"(1 - 2 / sqrt(2 * pi()) * abs({z}) / {3 * steps}.0 * list_sum(list_transform(range({steps + 1}), lambda i: {f})))"


def _student_tail(t: str, v: str) -> str:
    """Two-sided tail: the integral of cos^(v-1) from 0 to atan(|t| / sqrt v)."""
    steps, top = 4000, f"atan(abs({t}) / sqrt({v}))"
    f = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos({top} * i / {steps}.0), {v} - 1)"
    scale = f"2 / sqrt(pi()) * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2))"
    return f"(1 - {scale} * {top} / {3 * steps}.0 * list_sum(list_transform(range({steps + 1}), lambda i: {f})))"


ORACLE["exp_user_hash"] = """
SELECT DISTINCT user_id, ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT AS user_hash
FROM events
"""

ORACLE["exp_assignment"] = f"WITH {_EXPOSURES} SELECT * FROM xp"

ORACLE["exp_conversion"] = f"""
WITH {_EXPOSURES},
lg AS (SELECT user_id, max(ts) AS last_goal FROM events WHERE event_type = 'purchase' GROUP BY 1),
j AS (SELECT xp.experiment, xp.cell,
             CASE WHEN lg.last_goal >= xp.exposure_ts THEN 1 ELSE 0 END AS conv
      FROM xp LEFT JOIN lg ON xp.user_id = lg.user_id)
SELECT experiment, cell, count(*) AS n_users, CAST(sum(conv) AS BIGINT) AS n_converted,
       {_ratio4('sum(conv)', 'count(*)')} AS conversion_rate
FROM j GROUP BY 1, 2
"""

ORACLE["exp_cell_filter"] = """
WITH b AS (SELECT DISTINCT user_id,
                  ('0x' || substr(md5('button_color_v3:' || CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 100 AS bucket
           FROM events),
c AS (SELECT user_id, CASE WHEN bucket < 25 THEN 'Red' WHEN bucket < 50 THEN 'Orange'
                           WHEN bucket < 75 THEN 'Blue' WHEN bucket < 100 THEN 'Green' ELSE 'blue' END AS cell
      FROM b)
SELECT c.cell, count(*) AS n_events, count(DISTINCT e.user_id) AS n_users
FROM events e JOIN c ON e.user_id = c.user_id
WHERE e.event_id % 2 = CASE WHEN c.cell IN ('Red', 'Orange') THEN 0 ELSE 1 END
GROUP BY c.cell
"""

ORACLE["exp_leading_metrics"] = f"""
WITH {_EXPOSURES},
j AS (SELECT xp.experiment, xp.cell, e.event_type AS metric, CAST(round(e.value * 100) AS BIGINT) AS cents
      FROM xp JOIN events e ON xp.user_id = e.user_id WHERE e.ts >= xp.exposure_ts)
SELECT experiment, cell, metric, count(*) AS n,
       {_ratio4('sum(cents)', 'count(*) * 100')} AS mean,
       round(stddev_samp(cents / 100.0), 4) AS stddev,
       min(cents) / 100.0 AS min_value, max(cents) / 100.0 AS max_value
FROM j GROUP BY 1, 2, 3
"""

ORACLE["exp_retention"] = f"""
WITH {_EXPOSURES},
d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
pu AS (SELECT xp.experiment, xp.cell, xp.user_id,
              max(CASE WHEN d.day - CAST(xp.exposure_ts AS DATE) BETWEEN 7 AND 13 THEN 1 ELSE 0 END) AS ret
       FROM xp LEFT JOIN d ON xp.user_id = d.user_id GROUP BY 1, 2, 3)
SELECT experiment, cell, count(*) AS n_users, CAST(sum(ret) AS BIGINT) AS n_retained,
       {_ratio4('sum(ret)', 'count(*)')} AS retention_rate
FROM pu GROUP BY 1, 2
"""

ORACLE["exp_compare_cells"] = f"""
WITH {_EXPOSURES},
pu AS (SELECT xp.experiment, xp.cell, xp.user_id, avg(e.value) AS v
       FROM xp JOIN events e ON xp.user_id = e.user_id WHERE e.ts >= xp.exposure_ts GROUP BY 1, 2, 3),
m AS (SELECT experiment,
             count(v) FILTER (WHERE cell = 'control') AS n_c, count(v) FILTER (WHERE cell = 'treatment') AS n_t,
             avg(v) FILTER (WHERE cell = 'control') AS mc, avg(v) FILTER (WHERE cell = 'treatment') AS mt,
             var_samp(v) FILTER (WHERE cell = 'control') AS vc, var_samp(v) FILTER (WHERE cell = 'treatment') AS vt
      FROM pu GROUP BY 1),
t AS (SELECT *, vc / n_c + vt / n_t AS se2, (mt - mc) / sqrt(vc / n_c + vt / n_t) AS tt FROM m),
q AS (SELECT *, se2 * se2 / (pow(vc / n_c, 2) / (n_c - 1) + pow(vt / n_t, 2) / (n_t - 1)) AS v FROM t)
SELECT experiment, n_c, n_t, round(mc, 4) AS mean_control, round(mt, 4) AS mean_treatment,
       round(tt, 4) AS t_stat, round(v, 2) AS dof, round({_student_tail('tt', 'v')}, 4) AS p_value
FROM q
"""

ORACLE["exp_two_proportion"] = f"""
WITH r AS ({ORACLE["exp_conversion"].replace("'purchase'", "'purchase' AND value > 200")}),
g AS (SELECT experiment, max(n_users) FILTER (cell = 'control') AS n_c, max(n_converted) FILTER (cell = 'control') AS x_c,
             max(n_users) FILTER (cell = 'treatment') AS n_t, max(n_converted) FILTER (cell = 'treatment') AS x_t FROM r GROUP BY 1),
p AS (SELECT *, (x_c + x_t) / (n_c + n_t) AS pool, x_t / n_t - x_c / n_c AS diff FROM g),
q AS (SELECT *, CASE WHEN pool > 0 AND pool < 1 THEN diff / sqrt(pool * (1 - pool) * (1 / n_c + 1 / n_t)) END AS z FROM p)
SELECT experiment, n_c, x_c, n_t, x_t, round(diff, 6) AS rate_difference, round(z, 6) AS z_stat, round({_normal_tail('z')}, 6) AS p_value FROM q
"""

ORACLE["exp_time_to_find"] = f"""
WITH n AS (
  SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
           PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS goal
  FROM events WHERE ts IS NOT NULL),
{_CELLS.replace("events e", "n e").strip()}
SELECT experiment, cell, count(*) AS n_starts, count(goal) AS n_found,
       {_ratio4("sum(date_diff('microsecond', ts, goal))", "count(goal) * 1000000")} AS mean_seconds
FROM xc WHERE event_type = 'view' GROUP BY 1, 2
"""

ORACLE["exp_adoption"] = f"""
WITH {_EXPOSURES},
f AS (SELECT xp.experiment, xp.cell, xp.user_id, xp.exposure_ts, min(e.ts) AS goal
      FROM xp LEFT JOIN events e ON e.user_id = xp.user_id AND e.event_type = 'signup' AND e.ts >= xp.exposure_ts GROUP BY ALL),
d AS (SELECT experiment, cell, coalesce(CAST(goal AS DATE), DATE '2024-01-30') - CAST(exposure_ts AS DATE) AS day, count(goal) AS n_adopted, count(*) - count(goal) AS n_censored
      FROM f GROUP BY 1, 2, 3),
r AS (SELECT *, sum(n_adopted + n_censored) OVER (PARTITION BY experiment, cell ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM d)
SELECT experiment, cell, CAST(day AS INTEGER) AS day, CAST(at_risk AS BIGINT) AS at_risk, n_adopted, n_censored,
       round(1 - product(1 - n_adopted / at_risk) OVER (PARTITION BY experiment, cell ORDER BY day), 6) AS adopted
FROM r
"""

ORACLE["exp_satisfaction"] = f"""
WITH {_CELLS},
ranked AS (SELECT experiment, cell, rank() OVER (PARTITION BY experiment ORDER BY value) + (count(*) OVER (PARTITION BY experiment, value) - 1) / 2.0 AS r,
                  1.0 * count(*) OVER (PARTITION BY experiment, value) AS same FROM xc WHERE value IS NOT NULL),
g AS (SELECT experiment, count(*) FILTER (cell = 'control') AS n_c, count(*) FILTER (cell = 'treatment') AS n_t,
             sum(r) FILTER (cell = 'treatment') AS rs, sum(same * same - 1) AS ties FROM ranked GROUP BY 1),
u AS (SELECT *, rs - n_t * (n_t + 1) / 2.0 AS u_stat, 1.0 * n_c + n_t AS n FROM g),
q AS (SELECT *, (u_stat - n_c * n_t / 2.0) / sqrt(n_c * n_t / 12.0 * (n + 1 - ties / (n * (n - 1)))) AS z FROM u)
SELECT experiment, n_c, n_t, CAST(u_stat AS DOUBLE) AS u_stat, round(u_stat / (n_c * n_t), 6) AS prob_higher, round(z, 6) AS z_stat, round({_normal_tail('z')}, 6) AS p_value FROM q
"""

# --- pipeline checks ---------------------------------------------------------------------

_MONEY = """
lo AS (SELECT c.c_nationkey AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS period,
              CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price_c,
              CAST(round((1 - l.l_discount) * 100) AS BIGINT) AS keep_c,
              CAST(round(l.l_tax * 100) AS BIGINT) AS tax_c
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
rv AS (SELECT unit, period, sum(price_c * keep_c) AS revenue FROM lo GROUP BY 1, 2),
ex AS (SELECT unit, period, sum(price_c * tax_c) AS expenses FROM lo GROUP BY 1, 2),
sa AS (SELECT s.s_nationkey AS unit, CAST(year(l.l_shipdate) AS INTEGER) AS period,
              sum(CAST(l.l_quantity AS BIGINT) * 10 * 10000) AS salaries
       FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2),
pr AS (SELECT coalesce(rv.unit, ex.unit, sa.unit) AS unit, coalesce(rv.period, ex.period, sa.period) AS period,
              rv.revenue IS NULL AS missing_revenue,
              coalesce(rv.revenue, 0) AS revenue, coalesce(ex.expenses, 0) AS expenses,
              coalesce(sa.salaries, 0) AS salaries
       FROM rv FULL OUTER JOIN ex ON rv.unit = ex.unit AND rv.period = ex.period
       FULL OUTER JOIN sa ON coalesce(rv.unit, ex.unit) = sa.unit AND coalesce(rv.period, ex.period) = sa.period)
"""

ORACLE["ops_profit"] = f"""
WITH {_MONEY}
SELECT unit, period, missing_revenue, CAST(revenue AS DOUBLE) / 10000.0 AS revenue,
       CAST(expenses AS DOUBLE) / 10000.0 AS expenses, CAST(salaries AS DOUBLE) / 10000.0 AS salaries,
       CAST(revenue - expenses - salaries AS DOUBLE) / 10000.0 AS profit
FROM pr
"""

_RECON = """
cp AS (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS period,
              sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS computed
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
rp AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS period,
              sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS reported FROM orders GROUP BY 1),
rc AS (SELECT coalesce(cp.period, rp.period) AS period, computed, reported,
              CAST(computed - reported AS DOUBLE) / CAST(nullif(reported, 0) AS DOUBLE) AS rel_diff
       FROM cp FULL OUTER JOIN rp ON cp.period = rp.period)
"""

ORACLE["ops_reconcile"] = f"""
WITH {_RECON}
SELECT period, CAST(computed AS DOUBLE) / 100.0 AS computed, CAST(reported AS DOUBLE) / 100.0 AS reported,
       round(rel_diff, 4) AS rel_diff, coalesce(abs(rel_diff) <= 0.05, false) AS within_tolerance
FROM rc
"""

_CHANGES = f"""
{_ACTOR_SNAP},
acc AS (SELECT actorid AS account_id, current_year AS period,
               CAST(CASE quality_class WHEN 'star' THEN 1 WHEN 'good' THEN 2 WHEN 'average' THEN 3
                                       WHEN 'bad' THEN 4 END AS INTEGER) AS plan_rank, is_active FROM snap),
lg AS (SELECT *, lag(is_active) OVER w AS pa, lag(plan_rank) OVER w AS pr FROM acc
       WINDOW w AS (PARTITION BY account_id ORDER BY period)),
chg AS (SELECT account_id, period, plan_rank, is_active,
               CASE WHEN pa IS NULL THEN CASE WHEN is_active THEN 'new' ELSE 'churned' END
                    WHEN pa AND NOT is_active THEN 'cancel'
                    WHEN NOT pa AND NOT is_active THEN 'churned'
                    WHEN NOT pa AND is_active THEN 'reactivate'
                    WHEN plan_rank < pr THEN 'upgrade'
                    WHEN plan_rank > pr THEN 'downgrade'
                    ELSE 'renew' END AS change
        FROM lg)
"""

ORACLE["ops_account_changes"] = f"WITH {_CHANGES} SELECT * FROM chg"

ORACLE["ops_churn"] = f"""
WITH {_CHANGES},
per AS (SELECT period, CAST(sum(CAST(is_active AS INTEGER)) AS BIGINT) AS n_active,
               count(*) FILTER (WHERE change = 'cancel') AS n_cancel,
               count(*) FILTER (WHERE change IN ('renew', 'upgrade', 'downgrade')) AS n_renew,
               count(*) FILTER (WHERE change = 'new') AS n_new
        FROM chg GROUP BY 1),
j AS (SELECT a.*, coalesce(b.n_active, 0) AS n_active_prev FROM per a LEFT JOIN per b ON a.period = b.period + 1)
SELECT period, n_active, n_new, n_cancel, n_renew, n_active_prev,
       {_ratio4('n_cancel', 'n_active_prev')} AS churn_rate,
       {_ratio4('n_renew', 'n_active_prev')} AS renewal_rate
FROM j
"""

ORACLE["ops_missing_periods"] = """
WITH p AS (SELECT DISTINCT o_custkey AS actorid, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
n AS (SELECT actorid, y + 1 AS missing_from, lead(y) OVER (PARTITION BY actorid ORDER BY y) - 1 AS missing_to
      FROM p)
SELECT actorid, missing_from, missing_to, CAST(missing_to - missing_from + 1 AS BIGINT) AS n_missing
FROM n WHERE missing_to >= missing_from
"""

_CLICKS = """
cl AS (SELECT event_id, user_id, event_type, ts,
              ts + to_seconds(CAST((event_id * 7919) % 1200 AS BIGINT)) AS arrival_ts FROM events)
"""

ORACLE["ops_dedup_events"] = f"WITH {_CLICKS} SELECT * FROM cl"

ORACLE["ops_lateness"] = f"""
WITH {_CLICKS},
l AS (SELECT CAST(floor((epoch_us(arrival_ts) - epoch_us(ts)) / 1000000) AS BIGINT) AS late FROM cl),
b AS (SELECT late, CASE WHEN late < 0 THEN 'early' WHEN late < 60 THEN '0-60s' WHEN late < 300 THEN '60-300s'
                        WHEN late < 900 THEN '300-900s' ELSE '>=900s' END AS band FROM l)
SELECT band, count(*) AS n_events, {_ratio4('sum(late)', 'count(*)')} AS avg_lateness_s,
       max(late) AS max_lateness_s
FROM b GROUP BY band
"""

_GAPS = "gp AS (SELECT ts AS gap_start, lead(ts) OVER (ORDER BY ts) AS gap_end FROM events)"

ORACLE["ops_gap_detection"] = f"""
WITH {_GAPS}
SELECT gap_start, gap_end, CAST((epoch_us(gap_end) - epoch_us(gap_start)) // 60000000 AS BIGINT) AS gap_minutes
FROM gp WHERE gap_end - gap_start > INTERVAL 10 MINUTE
"""

ORACLE["ops_backfill"] = f"""
WITH {_GAPS},
second AS (SELECT event_id + 1000000000 AS event_id, user_id, ts + INTERVAL 7 MINUTE AS ts FROM events)
SELECT event_id, user_id, ts FROM events
UNION ALL
SELECT s.event_id, s.user_id, s.ts FROM second s
WHERE EXISTS (SELECT 1 FROM gp WHERE gap_end - gap_start > INTERVAL 10 MINUTE AND s.ts > gap_start AND s.ts < gap_end)
"""

ORACLE["ops_exec_summary"] = f"""
WITH {_MONEY}, {_CHANGES.strip()},
pf AS (SELECT unit, CAST(sum(revenue - expenses - salaries) AS DOUBLE) / 10000.0 AS profit FROM pr GROUP BY 1),
gr AS (SELECT coalesce(c.c_nationkey, -1) AS unit, count(*) AS new_accounts
       FROM chg LEFT JOIN customer c ON chg.account_id = c.c_custkey WHERE change = 'new' GROUP BY 1),
f AS (SELECT user_id, ts,
             CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                    OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE
                  THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
ses AS (SELECT user_id, min(ts) AS s, max(ts) AS e FROM g GROUP BY user_id, sid),
d AS (SELECT user_id, s, e,
             CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
      FROM ses),
en AS (SELECT coalesce(c.c_nationkey, -1) AS unit,
              CAST(sum(epoch_us(least(e, CAST(day + INTERVAL 1 DAY AS TIMESTAMP)))
                       - epoch_us(greatest(s, CAST(day AS TIMESTAMP)))) AS BIGINT) AS engagement_micros
       FROM d LEFT JOIN customer c ON d.user_id = c.c_custkey GROUP BY 1)
SELECT coalesce(pf.unit, gr.unit, en.unit) AS unit, coalesce(pf.profit, 0) AS profit,
       coalesce(gr.new_accounts, 0) AS new_accounts, coalesce(en.engagement_micros, 0) AS engagement_micros
FROM pf FULL OUTER JOIN gr ON pf.unit = gr.unit FULL OUTER JOIN en ON coalesce(pf.unit, gr.unit) = en.unit
"""

ORACLE["ops_report_gate"] = f"""
WITH {_MONEY}, {_RECON},
r AS (
  SELECT 'missing_revenue' AS rule, count(*) FILTER (WHERE missing_revenue) AS n_bad FROM pr
  UNION ALL SELECT 'zero_denominator', count(*) FILTER (WHERE coalesce(reported = 0, true)) FROM rc
  UNION ALL SELECT 'out_of_tolerance', count(*) FILTER (WHERE NOT coalesce(abs(rel_diff) <= 0.05, false)) FROM rc
  UNION ALL SELECT 'stale_events', count(*) FILTER (WHERE newest < TIMESTAMP '2024-01-30 00:00:00')
            FROM (SELECT max(ts) AS newest FROM events))
SELECT rule, n_bad, n_bad = 0 AS passed FROM r
"""

ORACLE["ops_freshness"] = """
WITH t AS (
  SELECT 'events' AS table_name, max(ts) AS newest, 48 AS sla_hours FROM events
  UNION ALL SELECT 'orders', max(o_orderdate), 168 FROM orders
  UNION ALL SELECT 'lineitem', max(l_shipdate), 720 FROM lineitem)
SELECT table_name, newest,
       CAST((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(newest)) // 1000000 AS BIGINT) AS age_s,
       sla_hours,
       (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(newest)) // 1000000 <= sla_hours * 3600 AS fresh
FROM t
"""

ORACLE["dim_profile_seasons"] = """
WITH ps AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders)
SELECT season, count(*) AS n_players, (SELECT min(season) FROM ps) AS first_season FROM ps GROUP BY season
"""

# incremental steps: equal to the last period of the one-pass results
ORACLE["dim_cumulative_step"] = f"""
WITH {_ACTOR_SNAP}
SELECT actorid, actor, current_year, n_films, first_filmid, last_filmid, total_votes,
       quality_class, is_active FROM snap WHERE current_year = 2001
"""

ORACLE["fact_device_datelist_step"] = f"""
SELECT * FROM ({ORACLE["fact_device_datelist"]}) WHERE date = DATE '2024-01-30'
"""

# the array-free summary form must equal the array-based snapshot
ORACLE["dim_cumulative_summary"] = ORACLE["dim_cumulative_snapshot"]

ORACLE["ops_gap_detection_per_user"] = """
WITH g AS (SELECT user_id, ts AS gap_start, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap_end FROM events)
SELECT user_id, gap_start, gap_end,
       CAST((epoch_us(gap_end) - epoch_us(gap_start)) // 60000000 AS BIGINT) AS gap_minutes
FROM g WHERE gap_end - gap_start > INTERVAL 6 HOUR
"""

ORACLE["dim_growth_ratio_summary"] = ORACLE["dim_growth_ratio"]

# --- table checks, series and lists ------------------------------------------------

ORACLE["dim_unnest_points"] = """
SELECT o_custkey AS player_id, count(DISTINCT year(o_orderdate)) AS n_seasons, count(*) AS total_gp,
       CAST(min(year(o_orderdate)) AS INTEGER) AS first_season, CAST(max(year(o_orderdate)) AS INTEGER) AS last_season
FROM orders WHERE year(o_orderdate) <= 2001 GROUP BY 1
"""

ORACLE["dim_table_checks"] = f"""
WITH a AS (
  SELECT o_custkey, 2001 - min(year(o_orderdate)) + 1 AS n FROM orders WHERE year(o_orderdate) <= 2001 GROUP BY 1),
dev AS (SELECT * FROM ({ORACLE["fact_daily_device_activity"]})),
ses AS (SELECT * FROM ({ORACLE["stream_session_hits"]}))
SELECT 'actors' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS bad_values FROM a
UNION ALL SELECT 'device_activity', count(*), count(*) - count(DISTINCT (user_id, device_id, browser_type, date)), 0 FROM dev
UNION ALL SELECT 'sessions', count(*), count(*) - count(DISTINCT (event_window_timestamp, host, ip)), 0 FROM ses
"""

ORACLE["fact_day_series"] = """
SELECT CAST(d AS DATE) AS series_date, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = CAST(d AS DATE)) AS n_events
FROM (SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS d)
"""

ORACLE["pattern_active_periods"] = f"""
WITH {_ACTOR_SNAP}
SELECT s.actorid, s.current_year, string_agg(CAST(y.current_year AS VARCHAR), ',' ORDER BY y.current_year) AS years_active
FROM snap s JOIN snap y ON y.actorid = s.actorid AND y.current_year <= s.current_year AND y.is_active
GROUP BY s.actorid, s.current_year
"""

ORACLE["fact_activity_bitmap"] = """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) - DATE '2024-01-01' AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-01'),
b AS (SELECT user_id, x.k, coalesce(sum(CASE WHEN n // 8 = x.k THEN 1 << CAST(n % 8 AS INTEGER) END), 0) AS v
      FROM d, (SELECT unnest(range(8)) AS k) x GROUP BY 1, 2)
SELECT c.user_id, c.n_days, h.days_hex
FROM (SELECT user_id, count(*) AS n_days FROM d GROUP BY 1) c
JOIN (SELECT user_id, string_agg(printf('%02X', CAST(v AS INTEGER)), '' ORDER BY k) AS days_hex FROM b GROUP BY 1) h ON h.user_id = c.user_id
"""

ORACLE["source_event_times"] = """
WITH k AS (
  SELECT event_id, CAST(ts AS DATE) AS d,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'malformed' WHEN event_id % 83 = 0 THEN 'bad_time' ELSE 'good' END AS part
  FROM events)
SELECT part, CASE WHEN part = 'good' THEN d END AS day, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM k GROUP BY 1, 2
"""
