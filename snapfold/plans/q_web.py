from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import web
from snapfold.plans.oracle import oracle
from snapfold.plans.registry import query
from snapfold.session import cut_lineage
from snapfold.sources import fixtures as fx

# Fixed values for the fixture hosts: the LIKE pattern and the host list of
# the reports. As in the source, one listed host does not match the pattern.
HOST_LIKE = "%shop%"
LISTED_HOSTS = ("alpha.shop.example", "blog.example", "beta.shop.example")
GAP_MINUTES = 30
SESSION_KEYS = ["ip", "host"]
SESSION_SOURCE_KEYS = ["ip", "host", "referrer"]


def _hosts_sql():
    return ", ".join(f"'{h}'" for h in LISTED_HOSTS)


def hourly(spark, sf_dir, keys=("host",)):
    return web.hourly_counts(fx.fx_events(spark, sf_dir), list(keys))


def session_events(spark, sf_dir, hosts):
    """The narrow event columns the session jobs read, stored once: the
    bucketed sessionisation reads its input several times. The host is part of
    every session key, so the condition on it holds before sessions are built."""
    return cut_lineage(fx.fx_events(spark, sf_dir).where(hosts).select(*SESSION_SOURCE_KEYS, "event_time"))


def session_table(events, keys=SESSION_KEYS):
    """Batch sessions (bucketed: a busy ip/host is spread over many tasks);
    the stream uses ``session_window`` with the same result."""
    return web.sessions_bucketed(events, list(keys), GAP_MINUTES)


@query("inspection_scans")
def inspection_scans(spark, sf_dir):
    """``SELECT * FROM processed_events``: the plain read the scripts end with."""
    return fx.fx_processed_events(spark, sf_dir)


oracle("inspection_scans", "SELECT * FROM fx_processed_events")


@query("hits_by_country")
def hits_by_country(spark, sf_dir):
    return web.count_by_json(fx.fx_processed_events(spark, sf_dir), "geodata", "$.country", "country", top=10)


oracle("hits_by_country", """SELECT json_extract_string(geodata, '$.country') AS country, COUNT(1) AS num_hits
FROM fx_processed_events GROUP BY 1 ORDER BY num_hits DESC, country NULLS FIRST LIMIT 10""")

HOURLY_SQL = """WITH hourly AS (
  SELECT date_trunc('hour', event_time) AS event_hour, host, COUNT(*) AS num_hits FROM fx_events GROUP BY 1, 2)
"""


@query("host_share")
def host_share(spark, sf_dir):
    return web.share_of_total(hourly(spark, sf_dir), HOST_LIKE, LISTED_HOSTS)


oracle("host_share", HOURLY_SQL + f"""SELECT host, hours_seen, hours_seen / all_hours::DOUBLE AS share_of_hours
FROM (SELECT host, count(*) AS hours_seen, sum(count(*)) OVER () AS all_hours
      FROM hourly WHERE host LIKE '{HOST_LIKE}' GROUP BY host) shares
WHERE host IN ({_hosts_sql()})""")


@query("host_avg_filtered")
def host_avg_filtered(spark, sf_dir):
    return web.avg_rows_per_key(hourly(spark, sf_dir), HOST_LIKE)


@query("host_avg")
def host_avg(spark, sf_dir):
    return web.avg_rows_per_key(hourly(spark, sf_dir))


oracle("host_avg_filtered", HOURLY_SQL + f"""SELECT host, AVG(event_count) AS avg_events_per_session
FROM (SELECT host, COUNT(*) AS event_count FROM hourly WHERE host LIKE '{HOST_LIKE}' GROUP BY host) s
GROUP BY host""")
oracle("host_avg", HOURLY_SQL + """SELECT host, AVG(event_count) AS avg_events_per_session
FROM (SELECT host, COUNT(*) AS event_count FROM hourly GROUP BY host) s GROUP BY host""")


def sessions_sql(keys) -> str:
    k = ", ".join(keys)
    return f"""WITH ev AS (SELECT {k}, event_time FROM fx_events WHERE event_time IS NOT NULL),
s1 AS (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL
                        OR event_time - lag(event_time) OVER w > INTERVAL {GAP_MINUTES} MINUTE
                      THEN 1 ELSE 0 END AS new_session
       FROM ev WINDOW w AS (PARTITION BY {k} ORDER BY event_time)),
s2 AS (SELECT *, SUM(new_session) OVER (PARTITION BY {k} ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid
       FROM s1),
sessions AS (SELECT date_trunc('milliseconds', min(event_time)) AS session_start,
                    date_trunc('milliseconds', max(event_time) + INTERVAL {GAP_MINUTES} MINUTE) AS session_end,
                    {k}, count(*) AS num_hits
             FROM s2 GROUP BY {k}, sid)
"""


@query("session_avg")
def session_avg(spark, sf_dir):
    return web.avg_per_session(session_table(session_events(spark, sf_dir, F.col("host").like(HOST_LIKE))),
                               one_row=True)


oracle("session_avg", sessions_sql(SESSION_KEYS) + f"""SELECT AVG(n) AS average_events_per_session
FROM (SELECT session_start, ip, host, SUM(num_hits) AS n FROM sessions WHERE host LIKE '{HOST_LIKE}'
      GROUP BY 1, 2, 3) c""")


@query("session_avg_by_host")
def session_avg_by_host(spark, sf_dir):
    return web.avg_per_session(session_table(session_events(spark, sf_dir, F.col("host").isin(*LISTED_HOSTS))),
                               by="host", one_row=True).orderBy(F.desc_nulls_first("average_events_per_session"), "host")


oracle("session_avg_by_host", sessions_sql(SESSION_KEYS) + f"""SELECT host, AVG(n) AS average_events_per_session
FROM (SELECT session_start, ip, host, SUM(num_hits) AS n FROM sessions WHERE host IN ({_hosts_sql()})
      GROUP BY 1, 2, 3) c
GROUP BY host""")


@query("session_filter")
def session_filter(spark, sf_dir):
    ev = session_events(spark, sf_dir, F.col("host").like(HOST_LIKE))
    a = (session_table(ev).withColumn("referrer", F.lit(None).cast("string")).withColumn("sink", F.lit("ip_host")))
    return a.unionByName(session_table(ev, SESSION_SOURCE_KEYS).withColumn("sink", F.lit("ip_host_referrer")))


oracle("session_filter", f"""SELECT session_start, session_end, ip, host, CAST(NULL AS VARCHAR) AS referrer,
       num_hits, 'ip_host' AS sink
FROM ({sessions_sql(SESSION_KEYS)} SELECT * FROM sessions) a WHERE host LIKE '{HOST_LIKE}'
UNION ALL
SELECT session_start, session_end, ip, host, referrer, num_hits, 'ip_host_referrer' AS sink
FROM ({sessions_sql(SESSION_SOURCE_KEYS)} SELECT * FROM sessions) b WHERE host LIKE '{HOST_LIKE}'""")
