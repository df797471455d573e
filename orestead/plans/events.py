"""Queries over ordered events: saturation, quota, budgets, deferrals, first-seen candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import windows
from .base import Tables, query


@query("win_saturation", """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS seq, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)::INT AS new, count(*) OVER () AS total FROM events),
 z AS (SELECT DISTINCT total, greatest(50, floor(0.25 * total)::BIGINT) AS size FROM n), u AS (SELECT seq, sum(new) OVER (ORDER BY seq) AS upto FROM n),
 r AS (SELECT a.seq, a.upto - coalesce(b.upto, 0) AS recent FROM u a CROSS JOIN z LEFT JOIN u b ON b.seq = a.seq - size)
 SELECT min(seq) FILTER (WHERE seq >= greatest(size, floor(0.6 * total)) AND recent < 3 AND total >= 200) AS at_query, size AS window FROM r, z GROUP BY size""")
def saturation(t: Tables) -> DataFrame:
    """The discovery loop's stop; also tested against the sequential definition."""
    first = (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) == 1).cast("int")
    e = t.events.select("event_id", first.alias("new"))
    return windows.saturation(e, "event_id", "new", e.count())


@query("win_deferral", """WITH x AS (SELECT user_id, event_id, event_type = 'error' AS bad FROM events), i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM x)
 SELECT user_id, max(n)::BIGINT AS longest FROM (SELECT user_id, island, count(*) FILTER (WHERE bad) AS n FROM i GROUP BY ALL) GROUP BY user_id""")
def deferral(t: Tables) -> DataFrame:
    """Longest run of consecutive failures; any handled row resets it."""
    x = t.events.select("user_id", "event_id", (F.col("event_type") == "error").alias("bad"))
    i = windows.islands(x, ["user_id"], "event_id", ~F.col("bad"))
    return i.groupBy("user_id", "island").agg(F.count_if("bad").alias("n")).groupBy("user_id").agg(F.max("n").alias("longest"))


@query("st_quota", """WITH x AS (SELECT event_id, event_type, ts::DATE AS day, sum(1) OVER (PARTITION BY event_type, ts::DATE ORDER BY event_id) AS used FROM events)
 SELECT event_type, day, count(*) FILTER (WHERE used <= 60) AS allowed, count(*) FILTER (WHERE used > 60) AS refused FROM x GROUP BY ALL""")
def quota(t: Tables) -> DataFrame:
    """A daily quota per service: a request is refused if it would go over."""
    x = t.events.select("event_id", "event_type", F.col("ts").cast("date").alias("day"), F.lit(1).alias("cost"))
    x = windows.spend(x, ["event_type", "day"], "event_id", "cost", F.lit(60))
    return x.groupBy("event_type", "day").agg(F.count_if("allowed").alias("allowed"), F.count_if(~F.col("allowed")).alias("refused"))


@query("st_budget", """WITH x AS (SELECT user_id % 10 AS shard, sum(round(value * 100)::BIGINT) OVER (PARTITION BY user_id % 10 ORDER BY event_id)::BIGINT AS used FROM events)
 SELECT shard, count(*) FILTER (WHERE used <= 500000) AS charged, count(*) FILTER (WHERE used > 400000 AND used <= 500000) AS warned FROM x GROUP BY shard""")
def budget(t: Tables) -> DataFrame:
    """A hard stop before the budget is passed, with a warning from 80 %."""
    x = t.events.select((F.col("user_id") % 10).alias("shard"), "event_id", F.round(F.col("value") * 100).cast("long").alias("cost"))
    x = windows.spend(x, ["shard"], "event_id", "cost", F.lit(500000))
    return x.groupBy("shard").agg(F.count_if("allowed").alias("charged"), F.count_if(F.col("allowed") & (F.col("used") > 400000)).alias("warned"))


@query("st_first_seen", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def first_seen(t: Tables) -> DataFrame:
    """First candidate of each key in arrival order; the earliest id with what came along, by a mergeable aggregate."""
    g = t.events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return g.select("event_id", "user_id", "event_type")


@query("agg_layer_stats", """WITH f AS (SELECT event_type, min(event_id) AS e FROM events GROUP BY event_type, user_id) SELECT event_type, (SELECT count(*) FROM events e WHERE e.event_type = f.event_type) AS executed, count(*) AS new,
 (SELECT count(*) FROM events e WHERE e.event_type = f.event_type AND value < 1) AS errors FROM f GROUP BY event_type""")
def layer_stats(t: Tables) -> DataFrame:
    per = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.count_if(F.col("value") < 1).alias("e"))
    return per.groupBy("event_type").agg(F.sum("n").alias("executed"), F.count("*").alias("new"), F.sum("e").alias("errors"))


@query("win_error_stop", """WITH x AS (SELECT user_id, event_id, row_number() OVER w AS n, sum((event_type = 'error')::INT) OVER w AS bad FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
 SELECT user_id, min(event_id) AS stopped_at FROM x WHERE n >= 10 AND bad * 100 > n * 20 GROUP BY user_id""")
def error_stop(t: Tables) -> DataFrame:
    """Where the share of errors first passes 20 % after ten requests."""
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    x = t.events.select("user_id", "event_id", F.count("*").over(w).alias("n"), F.sum((F.col("event_type") == "error").cast("int")).over(w).alias("bad"))
    return x.where("n >= 10 and bad * 100 > n * 20").groupBy("user_id").agg(F.min("event_id").alias("stopped_at"))


@query("src_json_explode", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events WHERE (props->>'k')::BIGINT > 50")
def json_explode(t: Tables) -> DataFrame:
    """Nested JSON with a schema; what doesn't parse is null and drops out."""
    return t.events.select("event_id", F.from_json("props", "k long")["k"].alias("k")).where("k > 50")


@query("agg_telemetry", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS unreachable, count(*) FILTER (WHERE event_type = 'error') * 100 > count(*) * 15 AS alert FROM events GROUP BY 1")
def telemetry(t: Tables) -> DataFrame:
    bad = F.count_if(F.col("event_type") == "error")
    return t.events.groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), bad.alias("unreachable"), (bad * 100 > F.count("*") * 15).alias("alert"))


@query("st_retry_cap", """WITH a AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS tries, bool_or(event_type = 'purchase') AS ok FROM events GROUP BY 1) SELECT user_id, tries, CASE WHEN ok THEN 'done' WHEN tries >= 3 THEN 'unreachable' ELSE 'retry' END AS status FROM a""")
def retry_cap(t: Tables) -> DataFrame:
    a = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("tries"), F.bool_or(F.col("event_type") == "purchase").alias("ok"))
    return a.select("user_id", "tries", F.when(F.col("ok"), "done").when(F.col("tries") >= 3, "unreachable").otherwise("retry").alias("status"))


@query("http_contract", "SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'quota' WHEN 1 THEN 'quota' WHEN 2 THEN 'auth' WHEN 3 THEN 'auth' WHEN 4 THEN 'retry' WHEN 5 THEN 'retry' ELSE 'ok' END AS outcome FROM events")
def http_contract(t: Tables) -> DataFrame:
    """What a landed response's status means: 402 and 429 quota, 401 and 403 key, 503 and 504 again."""
    code = F.element_at(F.lit([402, 429, 401, 403, 503, 504, 200]), (F.col("event_id") % 7 + 1).cast("int"))
    return t.events.select("event_id", F.when(code.isin(402, 429), "quota").when(code.isin(401, 403), "auth").when(code.isin(503, 504), "retry").otherwise("ok").alias("outcome"))


@query("agg_judge_report", "SELECT count(*) AS compared, count(*) FILTER (WHERE quality = toxic) AS same, count(*) FILTER (WHERE quality <> toxic) AS diff, count(*) FILTER (WHERE d.lang = 'en' AND quality = 1) AS english FROM labels JOIN documents d USING (doc_id)")
def judge_report(t: Tables) -> DataFrame:
    j = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    same = F.col("quality") == F.col("toxic")
    return j.agg(F.count("*").alias("compared"), F.count_if(same).alias("same"), F.count_if(~same).alias("diff"), F.count_if((F.col("lang") == "en") & (F.col("quality") == 1)).alias("english"))
