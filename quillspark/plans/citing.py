"""Queries over citations and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillspark.functions.ids import bare_segment
from quillspark.operators import citations as C, graph as G, metrics as M, ranking as K
from quillspark.operators.components import connected_components
from quillspark.plans.common import PR, PT, collection, papers, refs, topics
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()


_ORDER_PARTS = """e AS (SELECT DISTINCT o.o_orderkey AS k, l.l_partkey AS r, o.o_orderdate::DATE AS d FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
  n AS (SELECT k, count(*) AS n FROM e GROUP BY k HAVING count(*) >= 2),
  pairs AS (SELECT x.k AS a, y.k AS b, count(*) AS shared, round(count(*) / (nx.n + ny.n - count(*)), 6) AS jaccard, y.d AS date
            FROM e x JOIN e y ON x.r = y.r AND abs(date_diff('day', x.d, y.d)) <= 90 AND (x.d < y.d OR (x.d = y.d AND x.k < y.k))
            JOIN n nx ON nx.k = x.k JOIN n ny ON ny.k = y.k GROUP BY x.k, y.k, nx.n, ny.n, y.d HAVING count(*) >= 2)"""


def order_parts(spark: SparkSession, d: str) -> DataFrame:
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return (l.select("l_orderkey", "l_partkey").join(o.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("k"), F.col("l_partkey").alias("r"), F.col("o_orderdate").cast("date").alias("d")).distinct())


@query(f"WITH {_ORDER_PARTS} SELECT * FROM pairs")
def j7_coupling(spark, d):
    return C.coupling(order_parts(spark, d), "k", "r", "d", min_shared=2)


@query(f"""WITH {_ORDER_PARTS}, ends AS (SELECT a AS item, b AS other, shared, jaccard FROM pairs UNION ALL SELECT b, a, shared, jaccard FROM pairs)
SELECT item, row_number() OVER (PARTITION BY item ORDER BY shared DESC, jaccard DESC, other) AS rank, other, shared, jaccard FROM ends
QUALIFY rank <= 3""")
def j8_neighbours(spark, d):
    return C.neighbours(C.coupling(order_parts(spark, d), "k", "r", "d", min_shared=2))


_PAIRS = f"""{PR}, e AS (SELECT item_id AS k, ref AS r, day AS d FROM r WHERE day IS NOT NULL),
  n AS (SELECT k, count(*) AS n FROM e GROUP BY k HAVING count(*) >= 3),
  pairs AS (SELECT x.k AS a, y.k AS b, count(*) AS shared, round(count(*) / (nx.n + ny.n - count(*)), 6) AS jaccard, y.d AS date
            FROM e x JOIN e y ON x.r = y.r AND abs(date_diff('day', x.d, y.d)) <= 90 AND (x.d < y.d OR (x.d = y.d AND x.k < y.k))
            JOIN n nx ON nx.k = x.k JOIN n ny ON ny.k = y.k GROUP BY x.k, y.k, nx.n, ny.n, y.d HAVING count(*) >= 3)"""


def paper_pairs(spark, d):
    return C.coupling(refs(spark, d), "item_id", "ref", "day")


@query(f"{_PAIRS} SELECT * FROM pairs")
def j7_paper_coupling(spark, d):
    return paper_pairs(spark, d)


@query(f"""{_PAIRS}, ends AS (SELECT a AS item, b AS other, shared, jaccard FROM pairs UNION ALL SELECT b, a, shared, jaccard FROM pairs)
SELECT item, row_number() OVER (PARTITION BY item ORDER BY shared DESC, jaccard DESC, other) AS rank, other, shared, jaccard FROM ends QUALIFY rank <= 3""")
def w12_paper_neighbours(spark, d):
    return C.neighbours(paper_pairs(spark, d))


_OWN = "nullif(upper(regexp_extract(trim(openalex), '([^/:\\s]+)/*$', 1)), '')"


@query(f"{PR}, own AS (SELECT DISTINCT item_id AS cited, {_OWN} AS ref FROM p) "
       "SELECT DISTINCT r.item_id AS citing, cited FROM r JOIN own ON own.ref = r.ref WHERE r.item_id <> cited")
def j6_internal_edges(spark, d):
    works = papers(spark, d).select("item_id", bare_segment(F.col("openalex")).alias("own"))
    return C.internal_edges(refs(spark, d), works, "item_id", "ref", "own")


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r)
SELECT ref, count(*) AS raw, round(sum(pow(0.5, greatest(date_diff('day', day, today), 0) / 180.0)), 6) AS weighted,
  count(*) FILTER (WHERE greatest(date_diff('day', day, today), 0) <= 365) AS recent FROM r, m WHERE day IS NOT NULL GROUP BY ref""")
def a4_decayed_citations(spark, d):
    return C.accumulate(refs(spark, d), "ref", "day")


@query(f"{PR}, c AS (SELECT ref, count(*) AS demand FROM r GROUP BY ref), own AS (SELECT DISTINCT {_OWN} AS ref FROM p WHERE openalex IS NOT NULL) "
       "SELECT ref, demand, row_number() OVER (ORDER BY demand DESC, ref) AS place FROM c WHERE ref NOT IN (SELECT ref FROM own WHERE ref IS NOT NULL)")
def a5_demand_queue(spark, d):
    """Every reference that no record stands for, by demand and id."""
    return demand_queue(refs(spark, d), papers(spark, d).select(bare_segment(F.col("openalex")).alias("ref")))


def demand_queue(cited, own):
    own = own.where("ref is not null").distinct()
    c = cited.groupBy("ref").agg(F.count("*").alias("demand")).join(own, "ref", "left_anti")
    return K.places(c, [F.desc("demand"), F.asc("ref")], "place")


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r), c AS (SELECT ref,
  sum(pow(0.5, greatest(date_diff('day', day, today), 0) / 180.0)) AS w FROM r, m WHERE day IS NOT NULL GROUP BY ref),
  top AS (SELECT ref, round(w, 6) AS weighted FROM c ORDER BY round(w, 6) DESC, ref LIMIT 300)
SELECT p.item_id, round(coalesce(sum(top.weighted::DECIMAL(18,6)), 0)::DOUBLE, 4) AS affinity, count(top.ref) AS cited_canon, count(top.ref) > 0 AS cites_canon,
  round(coalesce(sum(top.weighted::DECIMAL(18,6)), 0)::DOUBLE / greatest(count(r.ref), 1), 4) AS per_ref, round(coalesce(sum(top.weighted::DECIMAL(18,6)), 0)::DOUBLE / sqrt(greatest(count(r.ref), 1)), 4) AS per_root
FROM p LEFT JOIN r ON r.item_id = p.item_id LEFT JOIN top ON top.ref = r.ref GROUP BY p.item_id""")
def a54_canon_affinity(spark, d):
    e = refs(spark, d)
    top = C.accumulate(e, "ref", "day").orderBy(F.desc("weighted"), "ref").limit(300).select("ref", "weighted")
    j = papers(spark, d).select("item_id").join(e.select("item_id", "ref"), "item_id", "left").join(F.broadcast(top), "ref", "left")
    w, n = F.coalesce(F.sum(F.col("weighted").cast("decimal(18,6)")).cast("double"), F.lit(0.0)), F.greatest(F.count("ref"), F.lit(1))
    return j.groupBy("item_id").agg(F.round(w, 4).alias("affinity"), F.count("weighted").alias("cited_canon"), (F.count("weighted") > 0).alias("cites_canon"),
                                    F.round(w / n, 4).alias("per_ref"), F.round(w / F.sqrt(n), 4).alias("per_root"))


_CANON = """m AS (SELECT max(day) AS today FROM r),
  old AS (SELECT ref, row_number() OVER (ORDER BY count(*) DESC, ref) AS place FROM r, m WHERE day <= today - 30 GROUP BY ref QUALIFY place <= 30),
  new AS (SELECT ref, row_number() OVER (ORDER BY count(*) DESC, ref) AS place FROM r, m WHERE day <= today GROUP BY ref QUALIFY place <= 30)"""


def _canon(spark, d, back):
    e = refs(spark, d)
    last = e.agg(F.max("day").alias("today"))
    c = e.crossJoin(F.broadcast(last)).where(F.col("day") <= F.date_sub("today", back)).groupBy("ref").agg(F.count("*").alias("n"))
    return c.orderBy(F.desc("n"), "ref").limit(30).withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "ref")).cast("bigint")).select("ref", "place")


@query(f"{PR}, {_CANON} SELECT coalesce(old.ref, new.ref) AS ref, old.place AS before, new.place AS after, "
       "CASE WHEN old.ref IS NULL THEN 'entered' WHEN new.ref IS NULL THEN 'left' ELSE 'kept' END AS move FROM old FULL JOIN new ON old.ref = new.ref")
def j12_canon_diff(spark, d):
    a, b = _canon(spark, d, 30).withColumnRenamed("place", "before"), _canon(spark, d, 0).withColumnRenamed("place", "after")
    return a.join(b, "ref", "full").withColumn("move", F.when(F.col("before").isNull(), "entered").when(F.col("after").isNull(), "left").otherwise("kept"))


@query(f"{PR}, {_CANON}, b AS (SELECT max(place) AS nb FROM new), x AS (SELECT old.place AS ra, coalesce(new.place, nb + 1) AS rb FROM old LEFT JOIN new ON old.ref = new.ref, b) "
       "SELECT round(1 - 6 * sum((ra - rb) * (ra - rb)) / (count(*) * (count(*) * count(*) - 1)), 6) AS rho, count(*) AS n FROM x")
def w11_spearman_closed(spark, d):
    a, b = _canon(spark, d, 30), _canon(spark, d, 0)
    last = b.agg(F.max("place").alias("nb"))
    x = a.join(b.withColumnRenamed("place", "rb"), "ref", "left").crossJoin(F.broadcast(last)).withColumn("dd", F.col("place") - F.coalesce("rb", F.col("nb") + 1))
    return x.agg(F.round(1 - 6 * F.sum(F.col("dd") * F.col("dd")) / (F.count("*") * (F.count("*") * F.count("*") - 1)), 6).alias("rho"), F.count("*").alias("n"))


@query(f"""{PR}, {_CANON}, na AS (SELECT max(place) AS na FROM old), nb AS (SELECT max(place) AS nb FROM new),
  j AS (SELECT coalesce(old.place, na + 1) AS ra, coalesce(new.place, nb + 1) AS rb FROM old FULL JOIN new ON old.ref = new.ref, na, nb),
  k AS (SELECT rank() OVER (ORDER BY ra) + (count(*) OVER (PARTITION BY ra) - 1) / 2 AS x, rank() OVER (ORDER BY rb) + (count(*) OVER (PARTITION BY rb) - 1) / 2 AS y FROM j)
SELECT round(corr(x, y), 6) AS rho, count(*) AS n FROM k""")
def w10_spearman_union(spark, d):
    return M.spearman(_canon(spark, d, 30).withColumnRenamed("place", "rank"), _canon(spark, d, 0).withColumnRenamed("place", "rank"), "ref")


_TAGS = "SELECT DISTINCT item_id AS i, topic AS t, day AS d FROM t"


@query(f"{PT}, g AS ({_TAGS}) SELECT x.t AS a, y.t AS b, count(*) AS weight FROM g x JOIN g y ON x.i = y.i AND x.t < y.t GROUP BY 1, 2")
def a6_topic_projection(spark, d):
    return G.projection(topics(spark, d), "item_id", "topic")


@query(f"{PT}, g AS ({_TAGS}), e AS (SELECT DISTINCT x.t AS a, y.t AS b FROM g x JOIN g y ON x.i = y.i AND x.t < y.t), "
       "ends AS (SELECT a AS node FROM e UNION ALL SELECT b FROM e) SELECT node, count(*) AS degree FROM ends GROUP BY node")
def a8_topic_degree(spark, d):
    return G.degree(G.projection(topics(spark, d), "item_id", "topic"))


@query(f"{PT}, g AS ({_TAGS}) SELECT x.t AS a, y.t AS b, min({{'d': x.d, 'i': x.i}}).d AS day, min({{'d': x.d, 'i': x.i}}).i AS item "
       "FROM g x JOIN g y ON x.i = y.i AND x.t < y.t WHERE x.d IS NOT NULL GROUP BY 1, 2")
def w4_first_meetings(spark, d):
    return G.first_meetings(topics(spark, d), "item_id", "topic", "day")


@query()
def a9_betweenness(spark, d):
    return G.betweenness(G.projection(topics(spark, d), "item_id", "topic"))


@query(f"""{PR}, a AS (SELECT DISTINCT item_id, nullif(upper(regexp_extract(trim(a.openalex), '([^/:\\s]+)/*$', 1)), '') AS person FROM (SELECT item_id, unnest(authors) AS a FROM p)),
  x AS (SELECT DISTINCT a.person, r.ref FROM a JOIN r ON a.item_id = r.item_id WHERE a.person IS NOT NULL)
SELECT u.person AS a, v.person AS b, count(*) AS weight FROM x u JOIN x v ON u.ref = v.ref AND u.person < v.person GROUP BY 1, 2""")
def a7_researcher_projection(spark, d):
    """All pairs of researchers that share a reference, with the number of references shared."""
    refs_of = F.array_distinct(F.array_compact(F.transform(F.col("graph.referenced_works"), bare_segment)))
    authors = F.transform(F.col("bibliography.authors.openalex"), lambda o: F.struct(o.alias("openalex")))
    # only these columns of ``papers``, before its records are told apart: abstracts aren't shuffled
    return researcher_projection(table(spark, d, "items").select("item_id", authors.alias("authors"), refs_of.alias("refs")).dropDuplicates(["item_id"]))


def researcher_projection(works):
    people = works.where("item_id is not null").select(F.explode("authors").alias("a"), "refs").select(bare_segment(F.col("a.openalex")).alias("person"), "refs")
    return G.salted_projection(people.where("person is not null").select("person", F.explode("refs").alias("ref")), "ref", "person")


@query(f"""{PT}, e AS (SELECT 'topic' AS facet, topic AS id, label, item_id, day FROM t
  UNION ALL SELECT 'person', upper(regexp_extract(a.openalex, '([^/:]+)$', 1)), a.name, item_id, day FROM (SELECT item_id, day, unnest(authors) AS a FROM p) WHERE a.openalex IS NOT NULL
  UNION ALL SELECT 'org', regexp_extract(rtrim(i.ror, '/'), '([^/]+)$', 1), i.name, item_id, day FROM (SELECT item_id, day, unnest(a.institutions) AS i FROM
     (SELECT item_id, day, unnest(authors) AS a FROM p)) WHERE i.ror IS NOT NULL)
SELECT facet, id, first(label ORDER BY day NULLS LAST, item_id, label) FILTER (WHERE label IS NOT NULL) AS label, count(*) AS mentions, min(day) AS first_seen, max(day) AS last_seen FROM e GROUP BY facet, id""")
def a3_entity_nodes(spark, d):
    return G.node_rollup(mentions(spark, d), "facet", "id", "label", "day", "item_id")


def mentions(spark, d):
    from quillspark.functions.ids import ror_id
    p = papers(spark, d)
    people = p.select("item_id", "day", F.explode("authors").alias("a"))
    return (topics(spark, d).select(F.lit("topic").alias("facet"), F.col("topic").alias("id"), "label", "item_id", "day")
            .union(people.where("a.openalex is not null").select(F.lit("person"), bare_segment(F.col("a.openalex")), F.col("a.name"), "item_id", "day"))
            .union(people.select("item_id", "day", F.explode("a.institutions").alias("i")).where("i.ror is not null")
                   .select(F.lit("org"), ror_id(F.col("i.ror")), F.col("i.name"), "item_id", "day")))


@query(f"""{PT}, e AS (SELECT item_id AS src, topic AS dst, 'about' AS kind FROM t
  UNION SELECT item_id, upper(regexp_extract(a.openalex, '([^/:]+)$', 1)), 'by' FROM (SELECT item_id, unnest(authors) AS a FROM p) WHERE a.openalex IS NOT NULL
  UNION SELECT item_id, regexp_extract(rtrim(i.ror, '/'), '([^/]+)$', 1), 'from' FROM (SELECT item_id, unnest(a.institutions) AS i FROM (SELECT item_id, unnest(authors) AS a FROM p)) WHERE i.ror IS NOT NULL)
SELECT * FROM e""")
def se1_edges(spark, d):
    kind = F.when(F.col("facet") == "topic", "about").when(F.col("facet") == "person", "by").otherwise("from")
    return mentions(spark, d).select(F.col("item_id").alias("src"), F.col("id").alias("dst"), kind.alias("kind")).distinct()


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM p), top AS (SELECT ref, count(*) AS n FROM r GROUP BY ref ORDER BY n DESC, ref LIMIT 300),
  c AS (SELECT r.ref, count(*) FILTER (WHERE day >= today - 6) AS now, max(day) FILTER (WHERE day < today - 6 AND day >= today - 96) AS last_before
        FROM r JOIN top ON top.ref = r.ref, m GROUP BY r.ref)
SELECT ref, now, last_before, last_before IS NULL AS first_in_window FROM c WHERE now >= 2 OR (now > 0 AND last_before IS NULL)""")
def j13_anchors(spark, d):
    e = refs(spark, d)
    top = e.groupBy("ref").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ref").limit(300).select("ref")
    last = papers(spark, d).agg(F.max("day").alias("today"))
    x = e.join(F.broadcast(top), "ref", "left_semi").crossJoin(F.broadcast(last))
    c = x.groupBy("ref").agg(F.count_if(F.col("day") >= F.date_sub("today", 6)).alias("now"),
                             F.max(F.when((F.col("day") < F.date_sub("today", 6)) & (F.col("day") >= F.date_sub("today", 96)), F.col("day"))).alias("last_before"))
    return c.withColumn("first_in_window", F.col("last_before").isNull()).where("now >= 2 or (now > 0 and last_before is null)")


@query(f"""{_PAIRS}, m AS (SELECT max(day) - 30 AS since FROM p), new AS (SELECT item_id FROM p, m WHERE day >= since)
SELECT a, b, shared, (a IN (SELECT item_id FROM new)) AND (b IN (SELECT item_id FROM new)) AS both_new FROM pairs
WHERE a IN (SELECT item_id FROM new) OR b IN (SELECT item_id FROM new)""")
def j14_clusters(spark, d):
    p = papers(spark, d)
    last = p.agg(F.date_sub(F.max("day"), 30).alias("since"))
    new = p.crossJoin(F.broadcast(last)).where(F.col("day") >= F.col("since")).select("item_id")
    x = (paper_pairs(spark, d).join(new.select(F.col("item_id").alias("a"), F.lit(True).alias("na")), "a", "left")
         .join(new.select(F.col("item_id").alias("b"), F.lit(True).alias("nb")), "b", "left").where("na or nb"))
    return x.select("a", "b", "shared", (F.coalesce("na", F.lit(False)) & F.coalesce("nb", F.lit(False))).alias("both_new"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
  g AS (SELECT DISTINCT x.s AS u, y.s AS v FROM e x JOIN e y ON x.p = y.p), reach AS (SELECT u, v FROM g UNION SELECT r.u, g.v FROM reach r JOIN g ON r.v = g.u)
SELECT u AS node, min(v) AS component FROM reach GROUP BY u HAVING count(*) > 1""")
def j3_components(spark, d):
    """Suppliers joined by common parts, directly or through others, over all lines."""
    return supplier_components(table(spark, d, "lineitem"))


def supplier_components(lines):
    e = lines.select("l_suppkey", "l_partkey").distinct()
    low = e.groupBy("l_partkey").agg(F.min("l_suppkey").alias("low"))
    return connected_components(e.join(low, "l_partkey"), "l_suppkey", "low")


@query(f"{PR}, c AS (SELECT x.item_id, count(*) AS in_degree FROM (SELECT DISTINCT item_id, {_OWN} AS ref FROM p) x JOIN r ON r.ref = x.ref AND r.item_id <> x.item_id GROUP BY x.item_id) "
       "SELECT item_id, in_degree, row_number() OVER (ORDER BY in_degree DESC, item_id) AS place FROM c")
def a40_degree_ranking(spark, d):
    own = papers(spark, d).select(F.col("item_id").alias("own"), bare_segment(F.col("openalex")).alias("ref")).where("ref is not null")
    c = refs(spark, d).join(own, "ref").where("item_id <> own").groupBy(F.col("own").alias("item_id")).agg(F.count("*").alias("in_degree"))
    return K.places(c, [F.desc("in_degree"), F.asc("item_id")])


@query(f"""{PR}, n AS (SELECT p.item_id, coalesce(source_name, 'unknown') AS bucket, count(r.ref) AS refs FROM p LEFT JOIN r ON r.item_id = p.item_id GROUP BY 1, 2)
SELECT bucket, count(*) AS papers, round(avg(CASE WHEN refs > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_with, quantile_cont(refs, 0.5) FILTER (WHERE refs > 0) AS median_refs FROM n GROUP BY bucket""")
def j31_reference_coverage(spark, d):
    n = papers(spark, d).select(F.coalesce("source_name", F.lit("unknown")).alias("bucket"), F.size("refs").alias("refs"))
    return n.groupBy("bucket").agg(F.count("*").alias("papers"), F.round(F.avg(F.when(F.col("refs") > 0, 1.0).otherwise(0.0)), 6).alias("share_with"),
                                   F.percentile(F.when(F.col("refs") > 0, F.col("refs")), 0.5).alias("median_refs"))


@query(f"{_PAIRS}, x AS (SELECT a, b, shared, jaccard, round(shared / sqrt(nx.n * ny.n), 6) AS cosine FROM pairs JOIN n nx ON nx.k = a JOIN n ny ON ny.k = b) "
       "SELECT a, b, shared, jaccard, cosine FROM x")
def so9_pair_criteria(spark, d):
    n = refs(spark, d).groupBy("item_id").agg(F.count("*").alias("n"))
    return (paper_pairs(spark, d).join(n.select(F.col("item_id").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("item_id").alias("b"), F.col("n").alias("nb")), "b")
            .select("a", "b", "shared", "jaccard", F.round(F.col("shared") / F.sqrt(F.col("na") * F.col("nb")), 6).alias("cosine")))
