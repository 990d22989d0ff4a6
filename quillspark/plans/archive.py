"""Queries that meet an archive: reconciling, publishing, promoting, state and claims.

The records collected up to the median moment stand for the archive, the later ones for what comes in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillspark.functions import ids as I, text as T
from quillspark.operators import merge as X, nested as N, queues as Q, ranking as K
from quillspark.plans import nested as payloads
from quillspark.plans.common import PP, PR, collection, papers, refs
from quillspark.sources.feeds import atom_entries
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()

_BLANK = "coalesce(trim(abstract), '') = ''"
#: CTEs ``old`` and ``new``: of each key the last record up to the median moment, and after it; ``early`` and ``late`` have all of them.
HALVES = PP + """, m AS (SELECT quantile_disc(collected_at, 0.5) AS cut FROM p), early AS (SELECT p.* FROM p, m WHERE collected_at <= cut), late AS (SELECT p.* FROM p, m WHERE collected_at > cut),
  old AS (SELECT DISTINCT ON (work_key) * FROM early ORDER BY work_key, collected_at DESC, item_id), new AS (SELECT DISTINCT ON (work_key) * FROM late ORDER BY work_key, collected_at DESC, item_id)"""


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All records up to the median moment of collection, and all later ones."""
    half = table(spark, d, "items").dropDuplicates(["item_id"]).agg(F.expr("percentile_disc(0.5) within group (order by unix_micros(provenance.collected_at::timestamp))").alias("cut"))
    x = papers(spark, d).crossJoin(F.broadcast(half)).withColumn("late", F.expr("unix_micros(collected_at::timestamp) > cut")).drop("cut")
    return x.where("not late").drop("late"), x.where("late").drop("late")


def halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    early, late = sides(spark, d)
    return X.recent_first(early, "work_key", "collected_at", "item_id"), X.recent_first(late, "work_key", "collected_at", "item_id")


@query(HALVES + f""" SELECT n.work_key, CASE WHEN o.work_key IS NULL THEN 'fresh' ELSE 'merged' END AS outcome, o.state AS before,
  CASE WHEN o.state = 'published' OR n.state = 'published' THEN 'published' ELSE coalesce(n.state, o.state) END AS after,
  o.work_key IS NOT NULL AND CASE WHEN o.state = 'published' OR n.state = 'published' THEN 'published' ELSE coalesce(n.state, o.state) END IS DISTINCT FROM o.state AS moved,
  coalesce(CASE WHEN trim(o.abstract) <> '' THEN o.abstract END, CASE WHEN trim(n.abstract) <> '' THEN n.abstract END) AS abstract, coalesce(o.doi, n.doi) AS doi, greatest(o.cited, n.cited) AS cited,
  list_sort(list_distinct(coalesce(o.collectors, []) || n.collectors)) AS collectors FROM new n LEFT JOIN old o ON o.work_key = n.work_key""")
def j4_reconcile(spark, d):
    """What comes in against the archive: fresh rows, merged rows (the archive's fields first), and changes of state."""
    o, n = halves(spark, d)
    o, n = o.alias("o"), n.alias("n")
    c = F.col
    known = c("o.work_key").isNotNull()
    after = F.when((c("o.state") == "published") | (c("n.state") == "published"), "published").otherwise(F.coalesce("n.state", "o.state"))
    return n.join(o, c("n.work_key") == c("o.work_key"), "left").select(
        c("n.work_key"), F.when(known, "merged").otherwise("fresh").alias("outcome"), c("o.state").alias("before"), after.alias("after"), (known & ~after.eqNullSafe(c("o.state"))).alias("moved"),
        F.coalesce(*(F.when(F.trim(x) != "", c(x)) for x in ("o.abstract", "n.abstract"))).alias("abstract"), F.coalesce("o.doi", "n.doi").alias("doi"), F.greatest("o.cited", "n.cited").alias("cited"),
        F.array_sort(F.array_distinct(F.concat(F.coalesce("o.collectors", F.array().cast("array<string>")), "n.collectors"))).alias("collectors"))


@query(HALVES + f""", i AS (SELECT work_key, min(day) AS first_day FROM early WHERE NOT {_BLANK} GROUP BY work_key)
SELECT n.work_key, n.day, i.first_day, CASE WHEN i.first_day IS NOT NULL AND i.first_day IS DISTINCT FROM n.day THEN 'update' WHEN coalesce(trim(n.abstract), '') = '' AND coalesce(trim(o.abstract), '') = '' THEN 'unreadable'
  WHEN i.first_day IS NOT NULL THEN 'again' ELSE 'publish' END AS action FROM new n LEFT JOIN i ON i.work_key = n.work_key LEFT JOIN old o ON o.work_key = n.work_key""")
def j5_publish(spark, d):
    """Each incoming key against the index of days: known from another day, known from this one, new, or new without an abstract."""
    early, _ = sides(spark, d)
    o, n = halves(spark, d)
    i = early.where("trim(abstract) <> ''").groupBy("work_key").agg(F.min("day").alias("first_day"))
    j = n.select("work_key", "day", "abstract").join(i, "work_key", "left").join(o.select("work_key", F.col("abstract").alias("stored")), "work_key", "left")
    none = (F.coalesce(F.trim("abstract"), F.lit("")) == "") & (F.coalesce(F.trim("stored"), F.lit("")) == "")
    known = F.col("first_day").isNotNull()
    return j.select("work_key", "day", "first_day", F.when(known & ~F.col("first_day").eqNullSafe(F.col("day")), "update").when(none, "unreadable").when(known, "again").otherwise("publish").alias("action"))


@query(PP + f" SELECT work_key, min(day) AS first_day, count(*) AS records FROM p GROUP BY work_key HAVING count(*) FILTER (WHERE NOT {_BLANK}) = 0")
def j19_unreadable(spark, d):
    """Works none of whose records has an abstract, with their first day."""
    return (papers(spark, d).groupBy("work_key").agg(F.min("day").alias("first_day"), F.count("*").alias("records"), F.count_if(F.trim("abstract") != "").alias("n"))
            .where("n = 0").drop("n"))


@query(HALVES + f""", u AS (SELECT work_key, max(source_name) AS source FROM early GROUP BY work_key HAVING count(*) FILTER (WHERE NOT {_BLANK}) = 0), r AS (SELECT DISTINCT work_key FROM late WHERE NOT {_BLANK})
SELECT coalesce(source, 'unknown') AS source, count(*) AS unreadable, count(r.work_key) AS recovered FROM u LEFT JOIN r ON r.work_key = u.work_key GROUP BY 1""")
def j20_promote(spark, d):
    """Works of the archive without an abstract that a later record brings, by source."""
    early, late = sides(spark, d)
    u = early.groupBy("work_key").agg(F.max("source_name").alias("source"), F.count_if(F.trim("abstract") != "").alias("n")).where("n = 0")
    r = late.where("trim(abstract) <> ''").select("work_key").distinct().withColumn("r", F.lit(1))
    return u.join(r, "work_key", "left").groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count("*").alias("unreadable"), F.count("r").alias("recovered"))


@query(PP + """, s AS (SELECT unnest(range(min(day)::TIMESTAMP, max(day)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day FROM p),
  i AS (SELECT day, count(*) AS papers, count(*) FILTER (WHERE state = 'published') AS published, count(*) FILTER (WHERE len(raw_refs) > 0) AS with_references FROM p WHERE day IS NOT NULL GROUP BY day)
SELECT s.day, CASE WHEN i.day IS NULL THEN 'not_published' ELSE 'published' END AS state, coalesce(papers, 0) AS papers, coalesce(published, 0) AS published, coalesce(with_references, 0) AS with_references FROM s LEFT JOIN i ON i.day = s.day""")
def j23_archive_rows(spark, d):
    """Days with papers and days without, the latter by an anti-join against the spine of days."""
    p = table(spark, d, "items").dropDuplicates(["item_id"]).select(F.col("first_published").alias("day"), F.col("publication_status.state").alias("state"), F.coalesce(F.size("graph.referenced_works"), F.lit(0)).alias("n"))
    i = p.where("day is not null").groupBy("day").agg(F.count("*").alias("papers"), F.count_if(F.col("state") == "published").alias("published"), F.count_if(F.col("n") > 0).alias("with_references"))
    silent = K.day_spine(p, "day").join(i, "day", "left_anti").select("day", F.lit("not_published").alias("state"), *(F.lit(0).cast("bigint").alias(c) for c in ("papers", "published", "with_references")))
    return i.select("day", F.lit("published").alias("state"), "papers", "published", "with_references").union(silent)


@query(PP + " SELECT day, count(DISTINCT work_key) AS works, list_sort(list(DISTINCT work_key)) AS work_keys FROM p WHERE day IS NOT NULL GROUP BY day")
def sc32_issues(spark, d):
    """One issue a day with its works."""
    g = papers(spark, d).where("day is not null").select("day", "work_key").distinct().groupBy("day")
    return g.agg(F.count("*").alias("works"), F.array_sort(F.collect_list("work_key")).alias("work_keys"))


@query(PP + f""", x AS (SELECT 'items' AS origin, item_id AS id, title, day, source_name AS place FROM p WHERE {_BLANK}
  UNION ALL SELECT DISTINCT 'listings', listing_id, title, NULL::DATE, venue FROM listings WHERE coalesce(len(authors), 0) = 0) SELECT * FROM x WHERE trim(title) <> ''""")
def sc49_rejected(spark, d):
    """Rejects of two logs with different columns in one table; rows without a title are dropped."""
    a = papers(spark, d).where("abstract is null or trim(abstract) = ''").select(F.lit("items").alias("origin"), F.col("item_id").alias("id"), "title", "day", F.col("source_name").alias("place"))
    b = table(spark, d, "listings").where(F.coalesce(F.size("authors"), F.lit(0)) <= 0).select(F.lit("listings").alias("origin"), F.col("listing_id").alias("id"), "title", F.col("venue").alias("place")).distinct()
    return a.unionByName(b, allowMissingColumns=True).where("trim(title) <> ''")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY fetched_at DESC, payload DESC) AS rn, count(*) OVER (PARTITION BY record_id) AS lines FROM (SELECT DISTINCT * FROM raw_works))
SELECT record_id, collector, fetched_at, lines, json_valid(payload) AS readable FROM r WHERE rn = 1""")
def sc52_last_line(spark, d):
    """State kept as lines: the last line of each key counts."""
    x = table(spark, d, "raw_works").distinct().withColumn("lines", F.count("*").over(Window.partitionBy("record_id")))
    return K.latest(x, ["record_id"], [F.desc("fetched_at"), F.desc("payload")]).select("record_id", "collector", "fetched_at", "lines", F.try_parse_json("payload").isNotNull().alias("readable"))


@query("""WITH o(collector, origin) AS (VALUES ('openalex', 'collect'), ('crossref', 'backfill'), ('arxiv', 'probe')), r AS (SELECT DISTINCT record_id, collector, payload FROM raw_works)
SELECT record_id, collector FROM r WHERE json_valid(payload) AND collector IN (SELECT collector FROM o WHERE origin IN ('collect', 'backfill'))""")
def sc40_raw_by_origin(spark, d):
    """Readable payloads of collectors whose runs count, by a semi-join with the table of origins."""
    o = spark.createDataFrame([("openalex", "collect"), ("crossref", "backfill"), ("arxiv", "probe")], "collector string, origin string").where("origin in ('collect', 'backfill')")
    return table(spark, d, "raw_works").select("record_id", "collector", "payload").distinct().where(F.try_parse_json("payload").isNotNull()).join(o, "collector", "left_semi").select("record_id", "collector")


@query(r"""SELECT DISTINCT listing_id, regexp_extract(work_key, '([^/:]+)/*$', 1) AS id, venue AS source, year(publication_date) AS year, len(list_filter(coalesce(authors, []), lambda a: trim(a) <> '')) AS authors,
  list_filter(coalesce(authors, []), lambda a: trim(a) <> '')[1] AS first_author FROM listings""")
def sc55_flat_to_nested(spark, d):
    """Flat rows rebuilt as nested works, and fields read back out of them."""
    names = F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.trim(a) != "")
    work = F.struct(F.regexp_extract("work_key", r"([^/:]+)/*$", 1).alias("id"), F.struct(F.struct(F.col("venue").alias("display_name")).alias("source")).alias("primary_location"),
                    F.col("publication_date"), F.transform(names, lambda a: F.struct(F.struct(a.alias("display_name")).alias("author"))).alias("authorships"))
    w = table(spark, d, "listings").select("listing_id", work.alias("w"))
    return w.select("listing_id", "w.id", F.col("w.primary_location.source.display_name").alias("source"), F.year("w.publication_date").cast("bigint").alias("year"),
                    F.size("w.authorships").cast("bigint").alias("authors"), F.get("w.authorships", 0)["author"]["display_name"].alias("first_author")).distinct()


@query(PP + """, u AS (SELECT 'items' AS origin, title FROM p UNION ALL SELECT 'listings', title FROM (SELECT DISTINCT * FROM listings) UNION ALL SELECT 'documents', NULL FROM documents)
SELECT origin, count(*) AS n, count(title) AS titled FROM u GROUP BY origin""")
def se2_union_of_sources(spark, d):
    u = papers(spark, d).select(F.lit("items").alias("origin"), "title").unionByName(table(spark, d, "listings").distinct().select(F.lit("listings").alias("origin"), "title")).unionByName(
        table(spark, d, "documents").select(F.lit("documents").alias("origin")), allowMissingColumns=True)
    return u.groupBy("origin").agg(F.count("*").alias("n"), F.count("title").alias("titled"))


@query("""WITH r AS (SELECT DISTINCT lower(trim(payload ->> '$.work_key')) AS k FROM raw_works WHERE json_valid(payload)), c AS (SELECT DISTINCT lower(trim(work_key)) AS k FROM items)
SELECT k AS work_key FROM r WHERE k <> '' AND k NOT IN (SELECT k FROM c WHERE k IS NOT NULL)""")
def se8_unclaimed(spark, d):
    """Keys of raw works that no record claims."""
    k = table(spark, d, "raw_works").select(F.lower(F.trim(F.try_variant_get(F.try_parse_json("payload"), "$.work_key", "string"))).alias("work_key")).where("work_key <> ''").distinct()
    return k.join(table(spark, d, "items").select(F.lower(F.trim("work_key")).alias("work_key")), "work_key", "left_anti")


_SHOWN = "title, state, doi, cited, categories"


@query(HALVES + f""", a AS (SELECT work_key, to_json({{'title': title, 'state': state, 'ids': {{'doi': doi}}, 'cited': cited, 'categories': categories}}) AS j FROM old),
  b AS (SELECT work_key, to_json({{'title': title, 'state': state, 'ids': {{'doi': doi}}, 'cited': cited, 'categories': categories}}) AS j FROM new),
  x AS (SELECT a.work_key, t.fullkey AS path, t.atom ->> '$' AS v FROM a JOIN b ON a.work_key = b.work_key, json_tree(a.j) t WHERE t.atom IS NOT NULL AND t.type NOT IN ('OBJECT', 'ARRAY', 'NULL')),
  y AS (SELECT b.work_key, t.fullkey AS path, t.atom ->> '$' AS v FROM b JOIN a ON a.work_key = b.work_key, json_tree(b.j) t WHERE t.atom IS NOT NULL AND t.type NOT IN ('OBJECT', 'ARRAY', 'NULL'))
SELECT coalesce(x.work_key, y.work_key) AS work_key, coalesce(x.path, y.path) AS path, x.v AS before, y.v AS after FROM x FULL JOIN y ON x.work_key = y.work_key AND x.path = y.path WHERE x.v IS DISTINCT FROM y.v""")
def se9_changed_paths(spark, d):
    """Paths of nested records whose values differ between the archive and what comes in."""
    shape = F.to_json(F.struct("title", "state", F.struct("doi").alias("ids"), "cited", "categories"))
    o, n = (N.json_paths(x.select("work_key", shape.alias("j")), "work_key", "j") for x in halves(spark, d))
    both = o.select("work_key").distinct().join(n.select("work_key").distinct(), "work_key")
    o, n = (x.join(both, "work_key", "left_semi") for x in (o, n))
    j = o.withColumnRenamed("value", "before").join(n.withColumnRenamed("value", "after"), ["work_key", "path"], "full")
    return j.where(~F.col("before").eqNullSafe(F.col("after"))).select("work_key", "path", "before", "after")


@query("SELECT DISTINCT k FROM (SELECT doc_id AS k FROM level_labels UNION ALL SELECT doc_id FROM documents WHERE work_key IS NOT NULL)")
def se10_judged_keys(spark, d):
    return table(spark, d, "level_labels").select(F.col("doc_id").alias("k")).union(table(spark, d, "documents").where("work_key is not null").select("doc_id")).distinct()


@query(HALVES + """, w AS (SELECT DISTINCT ON (k) lower(regexp_replace(trim(doi), '^(https?://(dx\\.)?doi\\.[a-z]+/|doi:\\s*)', '', 'i')) AS k, upper(regexp_extract(trim(openalex), '([^/:\\s]+)/*$', 1)) AS w FROM p WHERE trim(doi) <> '' AND trim(openalex) <> '' ORDER BY k, w),
  t AS (SELECT lower(trim(title)) AS t, min(upper(regexp_extract(trim(openalex), '([^/:\\s]+)/*$', 1))) AS w FROM p WHERE trim(title) <> '' AND trim(openalex) <> '' GROUP BY 1),
  q AS (SELECT item_id, lower(regexp_replace(trim(doi), '^(https?://(dx\\.)?doi\\.[a-z]+/|doi:\\s*)', '', 'i')) AS k, lower(trim(title)) AS t FROM p WHERE openalex IS NULL OR trim(openalex) = '')
SELECT q.item_id, coalesce(w.w, t.w) AS openalex, CASE WHEN w.w IS NOT NULL THEN 'doi' WHEN t.w IS NOT NULL THEN 'title' ELSE 'miss' END AS basis FROM q LEFT JOIN w ON w.k = q.k LEFT JOIN t ON t.t = q.t""")
def sc12_enrich(spark, d):
    """Records without an OpenAlex id looked up among those with one: by DOI, else by title."""
    p = papers(spark, d).select("item_id", I.doi(F.col("doi")).alias("k"), T.blank_to_null(F.lower("title")).alias("t"), I.bare_segment(F.col("openalex")).alias("w"))
    known = p.where("w is not null")
    by_doi, by_title = (known.where(f"{c} is not null").groupBy(c).agg(F.min("w").alias("w_" + c)) for c in ("k", "t"))
    return (p.where("w is null").join(by_doi, "k", "left").join(by_title, "t", "left").select(
        "item_id", F.coalesce("w_k", "w_t").alias("openalex"), F.when(F.col("w_k").isNotNull(), "doi").when(F.col("w_t").isNotNull(), "title").otherwise("miss").alias("basis")))


@query(PP + f""", q AS (SELECT work_key, count(*) AS attempts FROM p GROUP BY work_key HAVING count(*) FILTER (WHERE NOT {_BLANK}) = 0)
SELECT work_key, attempts, attempts < 3 AS open, row_number() OVER (PARTITION BY attempts < 3 ORDER BY attempts, work_key) AS place FROM q""")
def sc13_retry_queue(spark, d):
    """Works still without an abstract with their fruitless attempts: open ones by least attempts, parked ones from the third on."""
    q = papers(spark, d).groupBy("work_key").agg(F.count("*").alias("attempts"), F.count_if(F.trim("abstract") != "").alias("n")).where("n = 0").drop("n")
    return Q.queue_places(q, "work_key", most=3)


@query(PR + """, own AS (SELECT DISTINCT nullif(upper(regexp_extract(trim(openalex), '([^/:\\s]+)/*$', 1)), '') AS ref FROM p), d AS (SELECT ref, count(*) AS demand, min(day) AS since FROM r WHERE ref NOT IN (SELECT ref FROM own WHERE ref IS NOT NULL) GROUP BY ref)
SELECT ref, demand, since, row_number() OVER (ORDER BY demand DESC, ref) AS place, row_number() OVER (ORDER BY demand DESC, ref) <= 50 AS in_batch FROM d""")
def so6_priority_queue(spark, d):
    """References without a record by demand; the first batch of fifty is marked (the batch is a parameter)."""
    own = papers(spark, d).select(I.bare_segment(F.col("openalex")).alias("ref")).where("ref is not null").distinct()
    q = refs(spark, d).groupBy("ref").agg(F.count("*").alias("demand"), F.min("day").alias("since")).join(own, "ref", "left_anti")
    return K.places(q, [F.desc("demand"), F.asc("ref")]).withColumn("in_batch", F.col("place") <= 50)


@query(HALVES + f""", s AS (SELECT work_key, count(*) AS attempts, bool_or(NOT {_BLANK}) AS done FROM early GROUP BY work_key), n AS (SELECT work_key, count(*) AS more, bool_or(NOT {_BLANK}) AS hit FROM late GROUP BY work_key)
SELECT coalesce(s.work_key, n.work_key) AS work_key, CASE WHEN coalesce(s.done, false) THEN s.attempts ELSE coalesce(s.attempts, 0) + coalesce(n.more, 0) END AS attempts,
  CASE WHEN coalesce(s.done, false) OR coalesce(n.hit, false) THEN 'resolved' WHEN coalesce(s.attempts, 0) + coalesce(n.more, 0) >= 3 THEN 'parked' ELSE 'pending' END AS state FROM s FULL JOIN n ON s.work_key = n.work_key""")
def st5_canon_state(spark, d):
    """Keyed state carried on by a batch: resolved keys stay, pending ones count attempts, and three park them."""
    early, late = sides(spark, d)
    side = lambda x: x.groupBy("work_key").agg(F.count("*").alias("attempts"), F.max(F.coalesce(F.trim("abstract") != "", F.lit(False))).alias("hit"))
    first = side(early)
    state = first.select("work_key", "attempts", F.when(F.col("hit"), "resolved").when(F.col("attempts") >= 3, "parked").otherwise("pending").alias("state"))
    return Q.advance(state, side(late), "work_key", most=3)


@query("""WITH o AS (SELECT o_orderdate::DATE AS day, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2), x AS (SELECT day, max(CASE WHEN s = 'F' THEN n END) AS f, max(CASE WHEN s = 'O' THEN n END) AS o, max(CASE WHEN s = 'P' THEN n END) AS p FROM o GROUP BY day)
SELECT day, coalesce(f, 0) AS done, coalesce(o, 0) AS failed, coalesce(p, 0) AS running, CASE WHEN coalesce(p, 0) > 0 THEN 'interrupted' WHEN coalesce(f, 0) = 0 AND coalesce(o, 0) > 0 THEN 'not_published' WHEN coalesce(o, 0) > coalesce(f, 0) THEN 'quiet' ELSE 'published' END AS outcome FROM x""")
def st6_outcome_of_stages(spark, d):
    """The outcome of each day out of the states of its stages, pivoted."""
    x = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    f, o, p = (F.coalesce(c, F.lit(0)) for c in "FOP")
    return x.select("day", f.alias("done"), o.alias("failed"), p.alias("running"), F.when(p > 0, "interrupted").when((f == 0) & (o > 0), "not_published").when(o > f, "quiet").otherwise("published").alias("outcome"))


@query("""WITH r AS (SELECT user_id, ts::DATE AS day, event_type, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id, ts::DATE) AS attempts FROM events),
  k AS (SELECT user_id, day, attempts, max_by(event_type, n) FILTER (WHERE event_type <> 'error') AS kept, max_by(event_type, n) AS last FROM r GROUP BY ALL) SELECT user_id, day, attempts, coalesce(kept, last) AS outcome FROM k""")
def st7_outcome_log(spark, d):
    """A log of outcomes: each row overwrites the day's and counts the attempts, but an error never overwrites an outcome."""
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", F.struct("ts", "event_id").alias("o"))
    kept = F.when(F.col("event_type") != "error", F.col("o"))
    return e.groupBy("user_id", "day").agg(F.count("*").alias("attempts"), F.coalesce(F.max_by("event_type", kept), F.max_by("event_type", "o")).alias("outcome"))


@query("SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 4) AS spent FROM events GROUP BY 1, 2")
def st8_backfill(spark, d):
    """Days taken one batch at a time from a stream with a checkpoint; a second run finds nothing left to do."""
    from quillspark.streaming.backfill import backfill_days

    return backfill_days(table(spark, d, "events"))


@query(r"""SELECT DISTINCT '10.9/' || listing_id AS doi, trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title, len(coalesce(authors, [])) AS authors,
  publication_date AS published, 'arxiv:2601.' || lpad((listing_id % 100000)::VARCHAR, 5, '0') AS work_key FROM listings WHERE trim(regexp_replace(lower(title), '[^a-z0-9\s]', ' ', 'g')) <> ''""")
def sc6_sc9_feed_round_trip(spark, d):
    """Listings written as Atom feeds and read back: keys, titles, authors, dates by their prefix, DOIs."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower("title"), r"[^a-z0-9\s]", " "), r"\s+", " "))
    names = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda _, i: F.concat(F.lit("<author><name>N"), i.cast("string"), F.lit("</name></author>"))), "")
    entry = F.concat(tag("id", F.concat(F.lit("https://archive.example/abs/2601."), F.lpad((F.col("listing_id") % 100000).cast("string"), 5, "0"))), tag("title", plain), names,
                     F.coalesce(tag("published", F.concat(F.col("publication_date").cast("string"), F.lit("T00:00:00Z"))), F.lit("")), tag("doi", F.concat(F.lit("10.9/"), "listing_id")))
    feeds = table(spark, d, "listings").distinct().where(plain != "").select(tag("feed", tag("entry", entry)).alias("xml"))
    return atom_entries(feeds, "xml").select("doi", "title", F.size("authors").cast("bigint").alias("authors"), "published", "work_key").distinct()


@query(f"""WITH {payloads._WORK}, x AS (SELECT record_id, result, loc, w, lower(trim(coalesce(loc ->> '$.source.type', loc ->> '$.type', ''))) AS kind, coalesce(loc ->> '$.landing_page_url', '') AS url FROM listed)
SELECT record_id, result, CASE WHEN kind = 'journal' THEN 'published' ELSE 'preprint' END AS state, coalesce(nullif(kind, ''), nullif(loc ->> '$.version', '')) AS location_type,
  nullif(regexp_extract(url, '(?:abs|pdf)/(\\d{{4}}\\.\\d{{4,5}})', 1), '') AS arxiv, contains(lower(url), 'deposit') AS repository, coalesce(w ->> '$.display_name', w ->> '$.title', w ->> '$.bibliography.title') AS title FROM x""")
def sc14_sc17_items_of_payloads(spark, d):
    """Records of fetched payloads as items: state by the kind of source, kind of location, arXiv id and repository of its address."""
    v = F.col("v")
    loc = F.coalesce(*(N._object(v, p) for p in N.LOCATION))
    text = lambda p: N._get(loc, p, "string")
    kind = F.lower(F.trim(F.coalesce(text("$.source.type"), text("$.type"), F.lit(""))))
    url = F.coalesce(text("$.landing_page_url"), F.lit(""))
    return N.parsed(table(spark, d, "raw_works")).select(
        "record_id", "result", F.when(kind == "journal", "published").otherwise("preprint").alias("state"), F.coalesce(I._some(kind), I._some(text("$.version"))).alias("location_type"),
        I._some(F.regexp_extract(url, r"(?:abs|pdf)/(\d{4}\.\d{4,5})", 1)).alias("arxiv"), F.lower(url).contains("deposit").alias("repository"), N._first(v, N.TITLE, "string").alias("title"))


@query(HALVES + """ SELECT coalesce(n.work_key, o.work_key) AS work_key, CASE WHEN len(n.topics) > 0 THEN len(n.topics) ELSE coalesce(len(o.topics), 0) END AS topics, CASE WHEN len(n.authors) > 0 THEN len(n.authors) ELSE coalesce(len(o.authors), 0) END AS authors,
  CASE WHEN len(n.categories) > 0 THEN n.categories ELSE coalesce(o.categories, []) END AS categories, coalesce(n.state, o.state) AS state FROM new n FULL JOIN old o ON o.work_key = n.work_key""")
def f27_restored(spark, d):
    """Merged rows in which what a fresh run filled overrides what was stored, and what it left empty does not."""
    o, n = halves(spark, d)
    j = o.alias("o").join(n.alias("n"), F.col("o.work_key") == F.col("n.work_key"), "full")
    size = lambda c: F.when(F.size(f"n.{c}") > 0, F.size(f"n.{c}")).otherwise(F.greatest(F.coalesce(F.size(f"o.{c}"), F.lit(0)), F.lit(0))).cast("bigint").alias(c)
    return j.select(F.coalesce("n.work_key", "o.work_key").alias("work_key"), size("topics"), size("authors"),
                    F.when(F.size("n.categories") > 0, F.col("n.categories")).otherwise(F.coalesce("o.categories", F.array().cast("array<string>"))).alias("categories"), F.coalesce("n.state", "o.state").alias("state"))


_KNOWN = ["id", "display_name", "publication_date", "cited_by_count", "authorships", "authors", "primary_location", "topics", "referenced_works", "work_key", "bibliography", "graph", "entities"]


@query(f"""WITH r AS (SELECT DISTINCT record_id, collector, payload FROM raw_works), k AS (SELECT collector, CASE WHEN NOT json_valid(payload) OR json_type(payload) <> 'OBJECT' THEN NULL ELSE json_keys(payload) END AS k FROM r)
SELECT collector, count(*) FILTER (WHERE k IS NOT NULL AND len(list_filter(k, lambda x: NOT list_contains({_KNOWN}, x))) = 0) AS strict, count(*) FILTER (WHERE len(list_filter(k, lambda x: NOT list_contains({_KNOWN}, x))) > 0 AND len(list_filter(k, lambda x: list_contains({_KNOWN}, x))) > 0) AS recovered,
  count(*) FILTER (WHERE k IS NULL OR len(list_filter(k, lambda x: list_contains({_KNOWN}, x))) = 0) AS lost FROM k GROUP BY collector""")
def sc36_recovered(spark, d):
    """Records that keep to the known members, those saved by dropping unknown ones, and those lost."""
    r = table(spark, d, "raw_works").select("record_id", "collector", "payload").distinct()
    k = F.when(F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>").isNotNull(), F.json_object_keys("payload"))
    known = F.array(*map(F.lit, _KNOWN))
    x = r.select("collector", F.coalesce(F.size(F.array_intersect(k, known)), F.lit(0)).alias("in_"), F.coalesce(F.size(F.array_except(k, known)), F.lit(0)).alias("out"))
    return x.groupBy("collector").agg(F.count_if((F.col("out") <= 0) & (F.col("in_") > 0)).alias("strict"), F.count_if((F.col("out") > 0) & (F.col("in_") > 0)).alias("recovered"), F.count_if(F.col("in_") <= 0).alias("lost"))
