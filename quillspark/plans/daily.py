"""Queries that compare a day with its history, and sections made of a day's papers."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillspark.operators import ranking as K
from quillspark.plans.common import PP, PR, PT, collection, papers, topics
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()

_M = "m AS (SELECT max(day) AS today FROM p)"


def recent(spark, d, days: int = 7):
    p = papers(spark, d)
    last = p.agg(F.max("day").alias("today"))
    return p.crossJoin(F.broadcast(last)).where(F.col("day") > F.date_sub("today", days))


@query(PP + f", {_M} SELECT count(*) AS papers, count(*) FILTER (WHERE state = 'published') AS published, count(*) FILTER (WHERE state = 'preprint') AS preprints, "
       "count(*) FILTER (WHERE abstract IS NULL) AS unreadable FROM p, m WHERE day > today - 7")
def a25_composition(spark, d):
    return recent(spark, d).agg(F.count("*").alias("papers"), F.count_if(F.col("state") == "published").alias("published"), F.count_if(F.col("state") == "preprint").alias("preprints"),
                                F.count_if(F.col("abstract").isNull()).alias("unreadable"))


@query(PT + f""", {_M}, n AS (SELECT topic, count(*) AS now FROM t, m WHERE day > today - 7 GROUP BY topic), b AS (SELECT topic, count(DISTINCT item_id) AS before FROM t, m WHERE day <= today - 7 AND day > today - 37 GROUP BY topic),
  dd AS (SELECT count(DISTINCT day) AS days FROM p, m WHERE day <= today - 7 AND day > today - 37)
SELECT n.topic, now, round(7.0 * coalesce(before, 0) / days, 4)::DOUBLE AS expected FROM n LEFT JOIN b ON b.topic = n.topic, dd WHERE now >= 3 AND now >= 1.2 * 7.0 * coalesce(before, 0) / days""")
def a26_deviations(spark, d):
    """Topics far above their share of the thirty days before."""
    p, t = papers(spark, d), topics(spark, d)
    last = p.agg(F.max("day").alias("today"))
    x = t.crossJoin(F.broadcast(last))
    now = x.where("day > date_sub(today, 7)").groupBy("topic").agg(F.count("*").alias("now"))
    before = x.where("day <= date_sub(today, 7) and day > date_sub(today, 37)").groupBy("topic").agg(F.countDistinct("item_id").alias("before"))
    days = p.crossJoin(F.broadcast(last)).where("day <= date_sub(today, 7) and day > date_sub(today, 37)").agg(F.countDistinct("day").alias("days"))
    e = 7.0 * F.coalesce("before", F.lit(0)) / F.col("days")
    return now.join(before, "topic", "left").crossJoin(F.broadcast(days)).where((F.col("now") >= 3) & (F.col("now") >= 1.2 * e)).select("topic", "now", F.round(e, 4).alias("expected"))


@query(PP + f", {_M}, a AS (SELECT item_id, day, unnest(authors) AS a FROM p, m WHERE day > today - 30), i AS (SELECT DISTINCT item_id, day, i.name AS name FROM (SELECT item_id, day, unnest(a.institutions) AS i FROM a) WHERE i.name IS NOT NULL) "
       ", c AS (SELECT name, count(*) AS in_window, count(*) FILTER (WHERE day > (SELECT today FROM m) - 7) AS now FROM i GROUP BY name) SELECT name, in_window, now FROM c WHERE in_window >= 3 OR now >= 2")
def a27_affiliations(spark, d):
    x = (recent(spark, d, 30).select("item_id", "day", "today", F.explode(F.flatten(F.transform("authors", lambda a: F.coalesce(a["institutions"], F.array())))).alias("i"))
         .where("i.name is not null").select("item_id", "day", "today", F.col("i.name").alias("name")).distinct())
    return x.groupBy("name").agg(F.count("*").alias("in_window"), F.count_if(F.expr("day > date_sub(today, 7)")).alias("now")).where("in_window >= 3 or now >= 2")


@query(PP + f", {_M}, a AS (SELECT DISTINCT item_id, a.name AS name FROM (SELECT item_id, unnest(authors) AS a FROM p, m WHERE day > today - 30) WHERE a.name IS NOT NULL) SELECT name, count(*) AS papers FROM a GROUP BY name HAVING count(*) >= 2")
def a28_repeat_authors(spark, d):
    a = recent(spark, d, 30).select("item_id", F.explode("authors.name").alias("name")).where("name is not null").distinct()
    return a.groupBy("name").agg(F.count("*").alias("papers")).where("papers >= 2")


@query(PT + f", {_M}, g AS (SELECT DISTINCT topic, item_id FROM t, m WHERE day > today - 7) SELECT topic, count(*) AS papers, list_sort(list(item_id)) AS members FROM g GROUP BY topic HAVING count(*) >= 3")
def a29_tag_groups(spark, d):
    g = topics(spark, d).join(recent(spark, d).select("item_id"), "item_id", "left_semi").select("topic", "item_id").distinct()
    return g.groupBy("topic").agg(F.count("*").alias("papers"), F.array_sort(F.collect_list("item_id")).alias("members")).where("papers >= 3")


@query(PT + f""", {_M}, g AS (SELECT DISTINCT topic, item_id FROM t, m WHERE day > today - 7), big AS (SELECT topic FROM g GROUP BY topic HAVING count(*) >= 6), used AS (SELECT DISTINCT item_id FROM g WHERE topic IN (SELECT topic FROM big)),
  h AS (SELECT item_id, cited, abstract FROM p, m WHERE day > today - 7 AND item_id NOT IN (SELECT item_id FROM used) ORDER BY cited DESC NULLS LAST, item_id LIMIT 20) SELECT item_id, cited FROM h WHERE abstract IS NOT NULL""")
def a30_highlights(spark, d):
    """The most cited papers in no large group; the limit comes before the filter on abstracts."""
    r = recent(spark, d)
    g = topics(spark, d).join(r.select("item_id"), "item_id", "left_semi").select("topic", "item_id").distinct()
    big = g.groupBy("topic").agg(F.count("*").alias("n")).where("n >= 6")
    used = g.join(big, "topic", "left_semi").select("item_id").distinct()
    return r.join(used, "item_id", "left_anti").orderBy(F.desc_nulls_last("cited"), "item_id").limit(20).where("abstract is not null").select("item_id", "cited")


@query(PP + " SELECT strftime(day, '%Y-%m') AS month, count(*) AS papers, count(*) FILTER (WHERE state = 'published') AS published, count(DISTINCT day) AS days FROM p WHERE day IS NOT NULL GROUP BY 1")
def a34_month_buckets(spark, d):
    return papers(spark, d).where("day is not null").groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("papers"), F.count_if(F.col("state") == "published").alias("published"), F.countDistinct("day").alias("days"))


@query(PP + """, m AS (SELECT max(day) AS today FROM p), s AS (SELECT unnest(range((today - 27)::TIMESTAMP, today::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day FROM m), c AS (SELECT day, count(*) AS n FROM p GROUP BY day)
SELECT s.day, coalesce(c.n, 0) AS papers, c.n IS NULL AS silent FROM s LEFT JOIN c ON c.day = s.day""")
def a35_last_weeks(spark, d):
    p = papers(spark, d)
    s = p.agg(F.max("day").alias("today")).select(F.explode(F.sequence(F.date_sub("today", 27), F.col("today"), F.expr("interval 1 day"))).alias("day"))
    return s.join(p.groupBy("day").agg(F.count("*").alias("n")), "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("papers"), F.col("n").isNull().alias("silent"))


@query(PT + """, f AS (SELECT topic, min(day) AS first_day FROM t GROUP BY topic), x AS (SELECT t.item_id, count(*) AS tags, count(*) FILTER (WHERE f.first_day = t.day) AS fresh FROM t JOIN f ON f.topic = t.topic GROUP BY t.item_id)
SELECT p.item_id, round(coalesce(fresh / tags, 0), 4)::DOUBLE AS novelty FROM p LEFT JOIN x ON x.item_id = p.item_id""")
def s29_j22_novelty(spark, d):
    """Share of a paper's tags that no earlier day has."""
    t = topics(spark, d)
    first = t.groupBy("topic").agg(F.min("day").alias("first_day"))
    x = t.join(first, "topic").groupBy("item_id").agg(F.count("*").alias("tags"), F.count_if(F.col("first_day") == F.col("day")).alias("fresh"))
    return papers(spark, d).select("item_id").join(x, "item_id", "left").select("item_id", F.round(F.coalesce(F.col("fresh") / F.col("tags"), F.lit(0.0)), 4).alias("novelty"))


@query(PP + """ SELECT item_id, round(least(1, (greatest(1, len(collectors)) - 1) / 2), 4)::DOUBLE AS multiplicity, round(least(1, 0.4 * (abstract IS NOT NULL)::INT + 0.4 * (doi IS NOT NULL)::INT + 0.2 * (state = 'published')::INT), 4)::DOUBLE AS completeness FROM p""")
def s27_s28_components(spark, d):
    one = lambda c: c.cast("int")
    return papers(spark, d).select("item_id", F.round(F.least(F.lit(1.0), (F.greatest(F.lit(1), F.size("collectors")) - 1) / 2), 4).alias("multiplicity"), F.round(F.least(
        F.lit(1.0), 0.4 * one(F.col("abstract").isNotNull()) + 0.4 * one(F.col("doi").isNotNull()) + 0.2 * one(F.col("state") == "published")), 4).alias("completeness"))


@query("""SELECT event_type, ts::DATE AS day, count(*) AS n, round(sum(value), 4) AS total, coalesce(sum((props ->> '$.k')::BIGINT), 0)::BIGINT AS k FROM events GROUP BY 1, 2""")
def sc_events_by_day(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, d, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"),
                                                                                                     F.coalesce(F.sum(k), F.lit(0)).alias("k"))


@query("""WITH w AS (SELECT event_id, value, ts, unnest(range(date_trunc('day', ts) - INTERVAL 6 DAY, date_trunc('day', ts) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS s FROM events)
SELECT s AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY s""")
def st1_sliding_week(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "7 days", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
 s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM x) SELECT user_id, min(ts) AS started, count(*) AS events FROM s GROUP BY user_id, session""")
def st2_sessions(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.min("ts").cast("timestamp_ntz").alias("started"), F.count("*").alias("events")).select("user_id", "started", "events")


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS hour, event_type FROM events), h AS (SELECT DISTINCT hour FROM e), u AS (SELECT DISTINCT event_type FROM e)
SELECT h.hour, u.event_type FROM h, u WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.hour = h.hour AND e.event_type = u.event_type)""")
def st4_silent_sources(spark, d):
    """Hours in which a known source delivered nothing while others did."""
    e = table(spark, d, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").distinct()
    grid = e.select("hour").distinct().crossJoin(e.select("event_type").distinct())
    return grid.join(e, ["hour", "event_type"], "left_anti")


@query("""WITH x AS (SELECT o_orderdate::DATE AS day, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) AS n FROM orders GROUP BY 1)
SELECT day, CASE WHEN n = 0 THEN 'quiet' WHEN f = 0 THEN 'open' WHEN o = 0 THEN 'closed' ELSE 'mixed' END AS outcome FROM x""")
def st6_outcomes(spark, d):
    x = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o"), F.count("*").alias("n"))
    return x.select("day", F.when(F.col("n") == 0, "quiet").when(F.col("f") == 0, "open").when(F.col("o") == 0, "closed").otherwise("mixed").alias("outcome"))


@query("SELECT ts::DATE AS day, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def st2_stream_first_seen(spark, d):
    """The events replayed as a stream: repeats within the watermark dropped, daily counts published once."""
    from quillspark.streaming.replay import daily_counts

    return daily_counts(spark, d)
