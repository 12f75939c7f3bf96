"""DuckDB SQL for the fixture views of ``sources/fixtures.py`` and a helper
that prefixes an oracle query with the views it names."""

from __future__ import annotations

import re

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# name -> (sql, dependencies); listed in dependency order
FIXTURE_SQL: dict[str, str] = {
    "fx_events": f"""
SELECT e.event_id,
       CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.user_id END AS user_id,
       e.k AS device_id,
       e.ts AS event_time,
       '/' || e.event_type AS url,
       CASE e.k % 4 WHEN 0 THEN 'alpha.shop.example' WHEN 1 THEN 'beta.shop.example'
                    WHEN 2 THEN 'blog.example' WHEN 3 THEN 'gamma.shop.example' END AS host,
       p.url AS referrer,
       '10.0.0.' || CAST(e.user_id % 50 AS VARCHAR) AS ip,
       '{{"country":"' || n.n_name || '"}}' AS geodata
FROM (SELECT event_id, ts, user_id, event_type, {_K} AS k FROM events) e
LEFT JOIN pages p ON p.page_id = e.k AND e.k % 10 <> 9
JOIN nation n ON n.n_nationkey = e.user_id % 25""",
    "fx_devices": """
SELECT c.c_custkey AS device_id,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS browser_type,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE r.r_name END AS os_type
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fx_processed_events": """
SELECT ip, date_trunc('millisecond', event_time) AS event_timestamp, referrer, host, url, geodata
FROM fx_events""",
    "fx_player_seasons": """
SELECT c.c_name AS player_name, c.c_mktsegment AS height, n.n_name AS college, r.r_name AS country,
       CAST(1990 + c.c_custkey % 5 AS VARCHAR) AS draft_year,
       CAST(c.c_custkey % 3 AS VARCHAR) AS draft_round,
       CAST(c.c_custkey % 60 AS VARCHAR) AS draft_number,
       o.season, o.gp,
       o.cents / o.gp / 2000000 AS pts, o.mx / 5000000 AS reb, o.mn / 5000000 AS ast
FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(count(*) AS INTEGER) AS gp,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
             max(CAST(round(o_totalprice * 100) AS BIGINT)) AS mx,
             min(CAST(round(o_totalprice * 100) AS BIGINT)) AS mn
      FROM orders GROUP BY 1, 2) o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fx_actor_films": """
SELECT c.c_name AS actor, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       'Film#' || CAST(o.o_orderkey AS VARCHAR) AS film,
       CAST(floor(o.o_totalprice) AS INTEGER) AS votes,
       round(o.o_totalprice / 50000, 1) AS rating,
       CAST(o.o_orderkey AS VARCHAR) AS filmid
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "fx_games": """
SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
       CAST(year(o_orderdate) AS INTEGER) AS season,
       o_custkey % 10 AS home_team_id, (o_custkey + 1) % 10 AS visitor_team_id,
       CAST(floor(o_totalprice / 5000) AS INTEGER) AS pts_home,
       CAST(floor(o_totalprice / 6000) AS INTEGER) AS pts_away,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins
FROM orders""",
    "fx_details_base": """
SELECT l_orderkey AS game_id, l_suppkey % 10 AS team_id,
       'T' || CAST(l_suppkey % 10 AS VARCHAR) AS team_abbreviation,
       l_partkey AS player_id, 'Player#' || CAST(l_partkey AS VARCHAR) AS player_name,
       l_returnflag AS start_position,
       CASE l_linenumber WHEN 1 THEN 'DNP - Coach' WHEN 2 THEN 'DND - Injury'
                         WHEN 3 THEN 'NWT - Personal' END AS comment,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ':' || CAST(l_linenumber * 7 AS VARCHAR) AS "min",
       l_linenumber AS fgm, l_linenumber AS fga, l_linenumber AS fg3m, l_linenumber AS fg3a,
       l_linenumber AS ftm, l_linenumber AS fta, l_linenumber AS oreb, l_linenumber AS dreb,
       l_linenumber AS reb, l_linenumber AS ast, l_linenumber AS stl, l_linenumber AS blk,
       l_linenumber AS "TO", l_linenumber AS pf,
       CAST(l_quantity AS INTEGER) AS pts, CAST(l_quantity AS INTEGER) - 25 AS plus_minus
FROM lineitem""",
    "fx_game_details": """
SELECT * FROM fx_details_base
UNION ALL
SELECT * FROM fx_details_base WHERE player_id % 50 = 0""",
    "fx_teams": """
SELECT s.s_suppkey AS team_id, 'T' || CAST(s.s_suppkey AS VARCHAR) AS abbreviation,
       s.s_name AS nickname, n.n_name AS city, 'Arena ' || n.n_name AS arena,
       1950 + s.s_nationkey AS yearfounded
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "fx_detail_player_seasons": """
SELECT DISTINCT gd.player_name, g.season
FROM fx_game_details gd JOIN fx_games g ON gd.game_id = g.game_id""",
}

_NAME = re.compile(r"\bfx_[a-z_]+\b")


def _deps(name: str) -> set[str]:
    return set(_NAME.findall(FIXTURE_SQL[name])) - {name}


def with_fixtures(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` with ``WITH`` clauses for every fixture it names
    (transitively), in dependency order. ``extra_ctes`` are appended after the
    fixtures ("a AS (...), b AS (...)")."""
    needed: set[str] = set()
    todo = set(_NAME.findall(sql + extra_ctes))
    while todo:
        n = todo.pop()
        if n in needed or n not in FIXTURE_SQL:
            continue
        needed.add(n)
        todo |= _deps(n)
    ordered = [n for n in FIXTURE_SQL if n in needed]
    parts = [f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in ordered]
    if extra_ctes.strip():
        parts.append(extra_ctes.strip())
    if not parts:
        return sql
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
