"""Queries that measure rules, lists and samples against judgements, and order what is shown."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillspark.durable import save
from quillspark.functions.ids import bare_segment
from quillspark.operators import citations as C, graph as G, metrics as M, ranking as K
from quillspark.plans import citing, daily, quality, records, vocabulary, words
from quillspark.plans.common import PP, PR, PT, collection, papers, refs, topics
from quillspark.plans.quality import _J, judged
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()


def _in(sql: str, name: str) -> str:
    return f"{name} AS (SELECT * FROM ({sql}))"


_REL = _in(words.SQL["s26_heuristic_relevance"], "rel")
_OWN = _in(records.SQL["f10_deny_list"], "own")
_RULES = f"""{PP}, {_REL}, {_OWN}, src AS (SELECT upper(source_id) AS s FROM sources WHERE source_type = 'journal'),
  x AS (SELECT p.item_id, p.day, p.source_id IN (SELECT s FROM src) AS journal, coalesce(p.cited, 0) >= 10 AS selected, coalesce(rel.relevance, 0) AS score, own.own, own.denied FROM p JOIN rel ON rel.item_id = p.item_id JOIN own ON own.item_id = p.item_id),
  h AS (SELECT *, CASE WHEN coalesce(journal, false) AND selected AND denied THEN 'off_subfield' WHEN NOT coalesce(journal, false) AND selected AND score < 0.43 THEN 'at_the_floor'
    WHEN NOT coalesce(journal, false) AND NOT selected AND score >= 0.25 AND score < 0.4 THEN 'uncertain' END AS rule FROM x)"""


def rules(spark, d, floor: float = 0.4, margin: float = 0.03, low: float = 0.25):
    """Papers with the rule that holds them back, if any; the floor, its margin and the uncertain band are parameters."""
    src = table(spark, d, "sources").where("source_type = 'journal'").select(F.upper("source_id").alias("source_id"), F.lit(True).alias("j"))
    x = (papers(spark, d).select("item_id", "day", "source_id", (F.coalesce("cited", F.lit(0)) >= 10).alias("selected")).join(src, "source_id", "left")
         .join(words.s26_heuristic_relevance(spark, d).withColumnRenamed("relevance", "score"), "item_id").join(records.f10_deny_list(spark, d), "item_id"))
    journal = F.coalesce("j", F.lit(False))
    rule = (F.when(journal & F.col("selected") & F.col("denied"), "off_subfield").when(~journal & F.col("selected") & (F.col("score") < floor + margin), "at_the_floor")
            .when(~journal & ~F.col("selected") & (F.col("score") >= low) & (F.col("score") < floor), "uncertain"))
    return x.select("item_id", "day", "selected", "score", "own", journal.alias("journal"), rule.alias("rule"))


_KIND = "CASE WHEN rule = 'uncertain' THEN 'near_miss' WHEN rule IS NOT NULL THEN 'withheld' END"


def _kind():
    return F.when(F.col("rule") == "uncertain", "near_miss").when(F.col("rule").isNotNull(), "withheld")


@query(f"{_RULES} SELECT item_id, rule, {_KIND} AS kind, round(score, 4) AS score FROM h WHERE rule IS NOT NULL")
def f11_suspicions(spark, d):
    """Papers in doubt: the first rule that applies, its kind and the score."""
    return rules(spark, d).where("rule is not null").select("item_id", "rule", _kind().alias("kind"), F.round("score", 4).alias("score"))


@query(f"{_RULES} SELECT rule, count(*) FILTER (WHERE rule <> 'uncertain') AS withheld, count(*) FILTER (WHERE rule = 'uncertain') AS near_miss, min(day) AS oldest FROM h WHERE rule IS NOT NULL GROUP BY rule")
def a23_counts_by_rule(spark, d):
    x = rules(spark, d).where("rule is not null").withColumn("kind", _kind())
    n = x.groupBy("rule").pivot("kind", ["withheld", "near_miss"]).agg(F.count("item_id"))
    return n.join(x.groupBy("rule").agg(F.min("day").alias("oldest")), "rule").select("rule", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("withheld", "near_miss")), "oldest")


@query(f"{_RULES} SELECT day, count(*) AS papers, count(*) FILTER (WHERE rule IN ('off_subfield', 'at_the_floor')) AS withheld, count(*) FILTER (WHERE rule IN ('off_subfield', 'at_the_floor')) / count(*) > 0.3 AS over FROM h WHERE selected AND day IS NOT NULL GROUP BY day")
def a24_a67_withheld_by_day(spark, d):
    """The share of selected papers that rules withhold, by day, against a bound of three tenths."""
    w = F.count_if(F.coalesce(F.col("rule").isin("off_subfield", "at_the_floor"), F.lit(False)))
    return rules(spark, d).where("selected and day is not null").groupBy("day").agg(F.count("*").alias("papers"), w.alias("withheld"), (w / F.count("*") > 0.3).alias("over"))


@query(PT + """, s AS (SELECT upper(source_id) AS s FROM sources WHERE source_type = 'journal'), o AS (SELECT item_id, first(topic ORDER BY coalesce(is_primary, false) DESC, score DESC, topic) AS topic, first(subfield ORDER BY coalesce(is_primary, false) DESC, score DESC, topic) AS subfield FROM t GROUP BY item_id)
SELECT p.item_id, coalesce(p.source_id IN (SELECT s FROM s), false) AS by_venue, coalesce(o.topic NOT IN ('T99144', 'T99148'), true) AND coalesce(o.subfield NOT IN ('9907'), true) AS by_subfield,
  CASE WHEN o.topic IN ('T99101', 'T99141') THEN 'foundation' WHEN o.topic IN ('T99157', 'T99140') THEN 'instrument' WHEN p.cited >= 80 THEN 'instrument' ELSE 'foundation' END AS class,
  CASE WHEN o.topic IN ('T99101', 'T99141', 'T99157', 'T99140') THEN 'topic' WHEN p.cited >= 80 THEN 'ratio' ELSE 'default' END AS basis FROM p LEFT JOIN o ON o.item_id = p.item_id""")
def f12_f14_scope_and_class(spark, d):
    """Scope by venue and by deny-lists of topics and subfields; the class of a work by its topic, else by its citations."""
    order = F.struct((~F.coalesce("is_primary", F.lit(False))).alias("a"), (-F.col("score")).alias("b"), F.col("topic"))
    o = topics(spark, d).groupBy("item_id").agg(F.min_by(F.struct("topic", "subfield"), order).alias("o")).select("item_id", "o.*")
    s = table(spark, d, "sources").where("source_type = 'journal'").select(F.upper("source_id").alias("source_id"), F.lit(True).alias("v"))
    t, hot = F.col("topic"), F.coalesce(F.col("cited") >= 80, F.lit(False))
    known = F.coalesce(t.isin("T99101", "T99141", "T99157", "T99140"), F.lit(False))
    return papers(spark, d).select("item_id", "source_id", "cited").join(o, "item_id", "left").join(s, "source_id", "left").select(
        "item_id", F.coalesce("v", F.lit(False)).alias("by_venue"), (F.coalesce(~t.isin("T99144", "T99148"), F.lit(True)) & F.coalesce(F.col("subfield") != "9907", F.lit(True))).alias("by_subfield"),
        F.when(t.isin("T99101", "T99141"), "foundation").when(t.isin("T99157", "T99140"), "instrument").when(hot, "instrument").otherwise("foundation").alias("class"),
        F.when(known, "topic").when(hot, "ratio").otherwise("default").alias("basis"))


@query("""WITH r AS (SELECT DISTINCT record_id, collector, payload FROM raw_works), x AS (SELECT collector, json_valid(payload) AS v, CASE WHEN json_valid(payload) THEN json_type(payload) END AS t,
  CASE WHEN json_valid(payload) THEN json_type(payload, '$.cited_by_count') END AS c, CASE WHEN json_valid(payload) THEN json_type(payload, '$.publication_date') END AS p FROM r)
SELECT collector, count(*) AS files, count(*) FILTER (WHERE v AND t = 'OBJECT' AND coalesce(c IN ('UBIGINT', 'BIGINT', 'NULL'), true) AND coalesce(p IN ('VARCHAR', 'NULL'), true)) AS valid FROM x GROUP BY collector""")
def f17_schema(spark, d):
    """Payloads that keep to the types of their members, by collector."""
    v = F.try_parse_json("payload")
    kind = lambda p: F.schema_of_variant(F.try_variant_get(v, p, "variant"))
    fine = (F.try_variant_get(v, "$", "map<string,variant>").isNotNull() & F.coalesce(kind("$.cited_by_count").isin("BIGINT", "VOID"), F.lit(True)) & F.coalesce(kind("$.publication_date").isin("STRING", "VOID"), F.lit(True)))
    return table(spark, d, "raw_works").select("record_id", "collector", "payload").distinct().groupBy("collector").agg(F.count("*").alias("files"), F.count_if(F.coalesce(fine, F.lit(False))).alias("valid"))


@query(PP + r""", a AS (SELECT unnest(authors) AS a FROM p), e AS (SELECT 'topic' AS facet, t.id AS id, '^T\d+$' AS form FROM (SELECT unnest(topics) AS t FROM p) UNION ALL SELECT 'person', a.openalex, '^A\d+$' FROM a UNION ALL SELECT 'orcid', a.orcid, '^\d{15}[\dX]$' FROM a
  UNION ALL SELECT 'org', i.ror, '^[0-9a-z]{9}$' FROM (SELECT unnest(a.institutions) AS i FROM a) UNION ALL SELECT 'work', w, '^W\d+$' FROM (SELECT unnest(raw_refs) AS w FROM p) UNION ALL SELECT 'source', bibliography.primary_location.source_id, '^S\d+$' FROM (SELECT DISTINCT ON (item_id) * FROM items)
  UNION ALL SELECT 'category', c, '^[a-z\-]+\.[A-Za-z\-]+$' FROM (SELECT unnest(categories) AS c FROM p))
SELECT facet, count(*) AS refs, count(*) FILTER (WHERE NOT regexp_matches(id, form)) AS free_strings FROM e WHERE id IS NOT NULL GROUP BY facet""")
def f18_id_shapes(spark, d):
    """Ids of all facets that don't have the bare form."""
    raw = table(spark, d, "items").dropDuplicates(["item_id"])
    a = raw.select(F.explode("bibliography.authors").alias("a"))
    parts = [("topic", raw.select(F.explode("entities.topics.id").alias("id")), r"^T\d+$"), ("person", a.select(F.col("a.openalex").alias("id")), r"^A\d+$"), ("orcid", a.select(F.col("a.orcid").alias("id")), r"^\d{15}[\dX]$"),
             ("org", a.select(F.explode("a.institutions.ror").alias("id")), r"^[0-9a-z]{9}$"), ("work", raw.select(F.explode("graph.referenced_works").alias("id")), r"^W\d+$"),
             ("source", raw.select(F.col("bibliography.primary_location.source_id").alias("id")), r"^S\d+$"), ("category", raw.select(F.explode("bibliography.categories").alias("id")), r"^[a-z\-]+\.[A-Za-z\-]+$")]
    e = None
    for facet, ids, form in parts:
        x = ids.where("id is not null").select(F.lit(facet).alias("facet"), (~F.col("id").rlike(form)).alias("free"))
        e = x if e is None else e.union(x)
    return e.groupBy("facet").agg(F.count("*").alias("refs"), F.count_if("free").alias("free_strings"))


@query("""WITH i AS (SELECT DISTINCT work_key FROM items), x AS (SELECT DISTINCT doc_id, work_key FROM documents WHERE work_key IS NOT NULL)
SELECT 'missing' AS side, count(*) AS n FROM x WHERE work_key NOT IN (SELECT work_key FROM i) UNION ALL SELECT 'orphans', count(*) FROM i WHERE work_key NOT IN (SELECT work_key FROM x)""")
def f19_both_directions(spark, d):
    """References to works that don't exist, and works that nothing refers to."""
    i = table(spark, d, "items").select("work_key").distinct()
    x = table(spark, d, "documents").where("work_key is not null").select("doc_id", "work_key").distinct()
    return x.join(i, "work_key", "left_anti").agg(F.lit("missing").alias("side"), F.count("*").alias("n")).union(i.join(x, "work_key", "left_anti").agg(F.lit("orphans"), F.count("*")))


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r), c AS (SELECT ref, count(*) AS raw, round(sum(pow(0.5, greatest(date_diff('day', day, today), 0) / 180.0)), 6) AS weighted FROM r, m WHERE day IS NOT NULL GROUP BY ref HAVING count(*) >= 2),
  pool AS (SELECT * FROM c ORDER BY weighted DESC, ref LIMIT 300), own AS (SELECT {citing._OWN} AS ref, min(item_id) AS item_id FROM p WHERE openalex IS NOT NULL GROUP BY 1)
SELECT pool.ref, raw, weighted, own.item_id, p.title, p.source_id IS NOT NULL AS in_scope FROM pool LEFT JOIN own ON own.ref = pool.ref LEFT JOIN p ON p.item_id = own.item_id ORDER BY weighted DESC, pool.ref LIMIT 100""")
def j11_candidates(spark, d):
    """The first hundred candidates out of a pool three times as large, with what the collection knows of them."""
    pool = C.accumulate(refs(spark, d), "ref", "day").where("raw >= 2").orderBy(F.desc("weighted"), "ref").limit(300).select("ref", "raw", "weighted")
    p = papers(spark, d)
    own = p.select(bare_segment(F.col("openalex")).alias("ref"), "item_id").where("ref is not null").groupBy("ref").agg(F.min("item_id").alias("item_id"))
    j = pool.join(own, "ref", "left").join(p.select("item_id", "title", F.col("source_id").isNotNull().alias("s")), "item_id", "left")
    return j.select("ref", "raw", "weighted", "item_id", "title", F.coalesce("s", F.lit(False)).alias("in_scope")).orderBy(F.desc("weighted"), "ref").limit(100)


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM p), own AS (SELECT DISTINCT item_id AS cited, {citing._OWN} AS ref FROM p), e AS (SELECT DISTINCT r.item_id, r.day, cited FROM r JOIN own ON own.ref = r.ref WHERE r.item_id <> cited)
SELECT count(*) FILTER (WHERE day = today) AS today_edges, count(*) FILTER (WHERE day < today) > 0 AS earlier, min(day) AS first_day FROM e, m""")
def j15_first_internal(spark, d):
    """Citations within the collection by the papers of the last day, and whether any came before."""
    last = papers(spark, d).agg(F.max("day").alias("today"))
    e = citing.j6_internal_edges(spark, d).join(papers(spark, d).select(F.col("item_id").alias("citing"), "day"), "citing").crossJoin(F.broadcast(last))
    return e.agg(F.count_if(F.col("day") == F.col("today")).alias("today_edges"), (F.count_if(F.col("day") < F.col("today")) > 0).alias("earlier"), F.min("day").alias("first_day"))


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r), c AS (SELECT ref, count(*) FILTER (WHERE day > today - 7) AS now, count(*) AS total FROM r, m GROUP BY ref)
SELECT ref, now, total FROM c WHERE now > 0 ORDER BY now DESC, total DESC, ref LIMIT 1""")
def j16_still_cited(spark, d):
    """The work most cited in the last week, of equals by all citations; no row if none is."""
    e = refs(spark, d)
    x = e.crossJoin(F.broadcast(e.agg(F.max("day").alias("today")))).groupBy("ref").agg(F.count_if(F.col("day") > F.date_sub("today", 7)).alias("now"), F.count("*").alias("total"))
    return x.where("now > 0").orderBy(F.desc("now"), F.desc("total"), "ref").limit(1)


_LABELLED = "lab AS (SELECT j.doc_id, j.grade, j.keep, j.rater, j.n_chars, k.work_key FROM j JOIN (SELECT DISTINCT doc_id, work_key FROM documents) k ON k.doc_id = j.doc_id)"
_ONE = "one AS (SELECT DISTINCT ON (work_key) work_key, item_id, source_id, raw_refs FROM p ORDER BY work_key, item_id)"


def labelled(spark, d):
    return judged(spark, d).join(table(spark, d, "documents").select("doc_id", "work_key").distinct(), "doc_id")


def _one(spark, d):
    return K.latest(papers(spark, d), ["work_key"], [F.col("item_id")])


@query(PP + f", {_J}, {_LABELLED}, {_ONE} SELECT keep, count(*) AS labelled, count(one.item_id) AS found, count(*) FILTER (WHERE len(list_filter(one.raw_refs, lambda r: r IS NOT NULL)) > 0) AS with_references FROM lab LEFT JOIN one ON one.work_key = lab.work_key GROUP BY keep")
def j17_labels_with_references(spark, d):
    """Labels with the references of the paper they are about; those without a paper are counted."""
    one = _one(spark, d).select("work_key", "item_id", "refs")
    return labelled(spark, d).join(one, "work_key", "left").groupBy("keep").agg(F.count("*").alias("labelled"), F.count("item_id").alias("found"), F.count_if(F.coalesce(F.size("refs"), F.lit(0)) > 0).alias("with_references"))


@query(PP + f", {_J}, {_LABELLED}, {_ONE}, {_OWN} SELECT own.own AS subfield, count(*) AS n, count(*) FILTER (WHERE keep) AS kept, round(avg(keep::INT), 6) AS rate FROM lab JOIN one ON one.work_key = lab.work_key JOIN own ON own.item_id = one.item_id GROUP BY 1")
def j24_rate_by_subfield(spark, d):
    x = labelled(spark, d).join(_one(spark, d).select("work_key", "item_id"), "work_key").join(records.f10_deny_list(spark, d), "item_id")
    return x.groupBy(F.col("own").alias("subfield")).agg(F.count("*").alias("n"), F.count_if("keep").alias("kept"), F.round(F.avg(F.col("keep").cast("int")), 6).alias("rate"))


@query(f"WITH {quality._SLOT} SELECT DISTINCT k FROM (SELECT k FROM f UNION ALL SELECT k FROM o) WHERE k IN (SELECT k FROM q WHERE v >= 100000)")
def j27_would_publish(spark, d):
    """Keys that slot filling takes and that reach a threshold."""
    good = table(spark, d, "orders").where("o_totalprice >= 100000").select(F.col("o_orderkey").alias("k"))
    return quality.w3_lent_slots(spark, d).select("k").distinct().join(good, "k", "left_semi")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM level_labels)")
def j28_u15_unjudged(spark, d):
    """Documents nobody has judged yet."""
    return table(spark, d, "documents").select("doc_id").distinct().join(table(spark, d, "level_labels").select("doc_id"), "doc_id", "left_anti")


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r), a AS (SELECT ref, count(*) AS w FROM r GROUP BY ref ORDER BY w DESC, ref LIMIT 100), b AS (SELECT ref, count(*) AS w FROM r, m WHERE day <= today - 60 GROUP BY ref ORDER BY w DESC, ref LIMIT 100),
  med AS (SELECT list_sort(list(w))[len(list(w)) // 2 + 1] AS um FROM a)
SELECT coalesce(a.ref, b.ref) AS ref, CASE WHEN a.ref IS NULL THEN 'external' WHEN b.ref IS NULL THEN 'ours' ELSE 'both' END AS side, coalesce(a.w, um) AS weight FROM a FULL JOIN b ON a.ref = b.ref, med""")
def j29_merged_lists(spark, d):
    """Two lists merged: ours, external or both; what only the external one has gets the upper median of our weights."""
    e = refs(spark, d)
    last = e.agg(F.max("day").alias("today"))
    top = lambda x: x.groupBy("ref").agg(F.count("*").alias("w")).orderBy(F.desc("w"), "ref").limit(100)
    a, b = top(e), top(e.crossJoin(F.broadcast(last)).where(F.col("day") <= F.date_sub("today", 60)))
    med = M.values_at(a, [], "w", {"um": M.upper_half})
    j = a.join(b.select("ref", F.col("w").alias("v")), "ref", "full").crossJoin(F.broadcast(med))
    return j.select("ref", F.when(F.col("w").isNull(), "external").when(F.col("v").isNull(), "ours").otherwise("both").alias("side"), F.coalesce("w", "um").alias("weight"))


_REVIEW = "regexp_matches(lower(coalesce(title, '')), 'a review of|systematic review|comparative study')"


@query(f"""{citing._PAIRS}, f AS (SELECT item_id, {_REVIEW} AS review FROM p)
SELECT a, b, shared, fa.review AS review_a, fb.review AS review_b, nx.n AS refs_a, ny.n AS refs_b FROM pairs JOIN f fa ON fa.item_id = a JOIN f fb ON fb.item_id = b JOIN n nx ON nx.k = a JOIN n ny ON ny.k = b""")
def j34_review_flags(spark, d):
    """Coupled pairs with flags of reviews and lengths of reference lists at both ends."""
    f = papers(spark, d).select("item_id", F.lower(F.coalesce("title", F.lit(""))).rlike("a review of|systematic review|comparative study").alias("review"), F.size("refs").cast("bigint").alias("n"))
    end = lambda x: f.select(F.col("item_id").alias(x), F.col("review").alias(f"review_{x}"), F.col("n").alias(f"refs_{x}"))
    return citing.paper_pairs(spark, d).select("a", "b", "shared").join(end("a"), "a").join(end("b"), "b")


@query(f"""{vocabulary._headline_sql()}, {PP[5:]}, src AS (SELECT upper(source_id) AS s FROM sources WHERE source_type = 'journal'),
  u AS (UNPIVOT (SELECT coalesce(p.source_id IN (SELECT s FROM src), false) AS journal, q1.item_id, relevance, novelty, multiplicity, completeness FROM q1 JOIN q2 ON q2.item_id = q1.item_id JOIN q3 ON q3.item_id = q1.item_id JOIN p ON p.item_id = q1.item_id) ON relevance, novelty, multiplicity, completeness INTO NAME component VALUE v),
  c AS (SELECT journal, component, v, count(*) AS n FROM u GROUP BY 1, 2, 3), g AS (SELECT journal, component, max(n) / sum(n) AS share FROM c GROUP BY 1, 2)
SELECT journal, count(*) FILTER (WHERE share >= 0.5) AS flat, count(*) FILTER (WHERE share >= 0.5) >= 3 AS provisional FROM g GROUP BY journal""")
def a14_provisional(spark, d):
    """On each path, how many components of the score are mostly one value."""
    src = table(spark, d, "sources").where("source_type = 'journal'").select(F.upper("source_id").alias("source_id"), F.lit(True).alias("j"))
    p = papers(spark, d).select("item_id", "source_id").join(src, "source_id", "left").select("item_id", F.coalesce("j", F.lit(False)).alias("journal"))
    u = vocabulary.headline_scores(spark, d).join(p, "item_id").unpivot(["journal"], ["relevance", "novelty", "multiplicity", "completeness"], "component", "v")
    g = u.groupBy("journal", "component", "v").agg(F.count("*").alias("n")).groupBy("journal", "component").agg((F.max("n") / F.sum("n")).alias("share"))
    return g.groupBy("journal").agg(F.count_if(F.col("share") >= 0.5).alias("flat"), (F.count_if(F.col("share") >= 0.5) >= 3).alias("provisional"))


@query(f"""WITH {_J}, b AS (SELECT *, CASE WHEN n_chars < 800 THEN 'zero' WHEN n_chars < 1500 THEN 'mid' ELSE 'high' END AS band FROM j)
SELECT band, count(*) AS n, round(avg(keep::INT), 6) AS keep_rate, count(*) FILTER (WHERE NOT keep AND grade = 1) AS lowest, list_sort(list(n_chars))[count(*) // 2 + 1] AS upper_median FROM b GROUP BY band""")
def a20_bands(spark, d):
    b = judged(spark, d).withColumn("band", F.when(F.col("n_chars") < 800, "zero").when(F.col("n_chars") < 1500, "mid").otherwise("high"))
    g = b.groupBy("band").agg(F.count("*").alias("n"), F.round(F.avg(F.col("keep").cast("int")), 6).alias("keep_rate"), F.count_if(~F.col("keep") & (F.col("grade") == 1)).alias("lowest"))
    return g.join(M.values_at(b, ["band"], "n_chars", {"upper_median": M.upper_half}), "band")


@query(f"WITH {_J} SELECT rater, sum(CASE WHEN grade IN (1, 2) THEN 1 ELSE 0 END)::BIGINT AS weak, count(*) FILTER (WHERE grade = 3) AS fair, count(*) FILTER (WHERE grade = 4) AS strong, count(*) FILTER (WHERE grade = 4) >= 3 AND count(*) FILTER (WHERE grade <= 2) >= 3 AS ready FROM j GROUP BY rater")
def a21_a60_folded_labels(spark, d):
    """Labels folded into fewer classes, and whether each class reaches its floor."""
    weak, strong = F.sum(F.when(F.col("grade").isin(1, 2), 1).otherwise(0)), F.count_if(F.col("grade") == 4)
    return judged(spark, d).groupBy("rater").agg(weak.alias("weak"), F.count_if(F.col("grade") == 3).alias("fair"), strong.alias("strong"), ((strong >= 3) & (F.count_if(F.col("grade") <= 2) >= 3)).alias("ready"))


@query(PP + """, c AS (SELECT list_sort(list(cited))[floor(0.66 * (count(*) - 1))::BIGINT + 1] AS cut FROM p WHERE cited > 0) SELECT CASE WHEN coalesce(cited, 0) <= 0 THEN 'zero' WHEN cited >= cut THEN 'high' ELSE 'mid' END AS band, count(*) AS papers FROM p, c GROUP BY 1""")
def a22_affinity_bands(spark, d):
    p = papers(spark, d).select("cited")
    cut = M.values_at(p.where("cited > 0"), [], "cited", {"cut": lambda n: F.floor(0.66 * (n - 1))})
    return p.crossJoin(F.broadcast(cut)).groupBy(F.when(F.coalesce("cited", F.lit(0)) <= 0, "zero").when(F.col("cited") >= F.col("cut"), "high").otherwise("mid").alias("band")).agg(F.count("*").alias("papers"))


@query(PP + """, c AS (SELECT day, count(*) AS n FROM p WHERE day IS NOT NULL GROUP BY day) SELECT count(*) AS days, round(quantile_cont(n, 0.1))::BIGINT AS p10, round(quantile_cont(n, 0.9))::BIGINT AS p90, sum(n)::BIGINT AS papers, (max(day) - min(day) + 1 - count(*))::BIGINT AS silent,
  max_by(n, day) AS last_count, max(day) AS last_day FROM (SELECT day, n FROM c)""")
def a33_a74_archive_stats(spark, d):
    """Days, their usual range, silent days, and the last day's count."""
    c = papers(spark, d).where("day is not null").groupBy("day").agg(F.count("*").alias("n"))
    q = lambda x: F.round(F.percentile("n", x)).cast("bigint")
    return c.agg(F.count("*").alias("days"), q(0.1).alias("p10"), q(0.9).alias("p90"), F.sum("n").alias("papers"), (F.datediff(F.max("day"), F.min("day")) + 1 - F.count("*")).cast("bigint").alias("silent"),
                 F.max_by("n", "day").alias("last_count"), F.max("day").alias("last_day"))


@query(f"{_RULES}, s AS (SELECT * FROM h WHERE NOT selected ORDER BY md5('42:' || item_id), item_id LIMIT 200) SELECT count(*) AS drawn, count(*) FILTER (WHERE score >= 0.4) AS above, count(*) FILTER (WHERE score >= 0.4) <= 3 AS fine FROM s")
def a38_gate_recall(spark, d):
    """Of two hundred rejects, drawn by hash, how many score above the floor."""
    s = rules(spark, d).where("not selected").orderBy(F.md5(F.concat(F.lit("42:"), "item_id")), "item_id").limit(200)
    above = F.count_if(F.col("score") >= 0.4)
    return s.agg(F.count("*").alias("drawn"), above.alias("above"), (above <= 3).alias("fine"))


@query(PT + " SELECT p.source_id, count(DISTINCT t.item_id) AS works FROM t JOIN p ON p.item_id = t.item_id WHERE subfield = '9902' AND p.day >= DATE '2026-03-01' AND p.source_id IS NOT NULL GROUP BY 1")
def a42_sources_of_subfield(spark, d):
    t = topics(spark, d).where("subfield = '9902' and day >= date'2026-03-01'").select("item_id").distinct()
    return papers(spark, d).where("source_id is not null").select("item_id", "source_id").join(t, "item_id", "left_semi").groupBy("source_id").agg(F.count("*").alias("works"))


@query(f"""WITH {quality._SLOT}, n AS (SELECT day, count(*) AS lent FROM (SELECT day FROM f UNION ALL SELECT day FROM o) GROUP BY day), z AS (SELECT day, least(3, count(*) FILTER (WHERE first_)) + least(2, count(*) FILTER (WHERE NOT first_)) AS fixed FROM q GROUP BY day)
SELECT fixed, lent, count(*) AS days FROM n JOIN z ON z.day = n.day GROUP BY 1, 2""")
def a51_slot_replay(spark, d):
    """How many each day takes under fixed slots and under lent ones."""
    n = quality.w3_lent_slots(spark, d).groupBy("day").agg(F.count("*").alias("lent"))
    first = F.col("o_orderpriority") == "1-URGENT"
    z = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg((F.least(F.lit(3), F.count_if(first)) + F.least(F.lit(2), F.count_if(~first))).alias("fixed"))
    return n.join(z, "day").groupBy("fixed", "lent").agg(F.count("*").alias("days"))


@query(f"""{PR}, top AS (SELECT ref, count(*) AS w FROM r GROUP BY ref ORDER BY w DESC, ref LIMIT 300), h AS (SELECT p.item_id, count(r.ref) AS n, count(top.ref) AS h, coalesce(sum(top.w), 0) AS w FROM p LEFT JOIN r ON r.item_id = p.item_id LEFT JOIN top ON top.ref = r.ref GROUP BY 1)
SELECT item_id, CASE WHEN n > 0 THEN round(100 * h / sqrt(n), 4) ELSE 0.0 END AS over_root, h::DOUBLE AS raw_hits, CASE WHEN n > 0 THEN round(h / ln(n + exp(1)), 4) ELSE 0.0 END AS over_log, CASE WHEN n > 0 THEN round(h / n, 4) ELSE 0.0 END AS share, w::DOUBLE AS weighted FROM h""")
def a55_affinity_variants(spark, d):
    """Five ways to set the foundations a paper cites against the length of its list."""
    e = refs(spark, d)
    top = e.groupBy("ref").agg(F.count("*").alias("w")).orderBy(F.desc("w"), "ref").limit(300)
    x = papers(spark, d).select("item_id").join(e.select("item_id", "ref"), "item_id", "left").join(F.broadcast(top), "ref", "left").groupBy("item_id").agg(
        F.count("ref").alias("n"), F.count("w").alias("h"), F.coalesce(F.sum("w"), F.lit(0)).alias("w"))
    n, h = F.col("n"), F.col("h")
    some = lambda c: F.when(n > 0, F.round(c, 4)).otherwise(0.0)
    return x.select("item_id", some(100 * h / F.sqrt(n)).alias("over_root"), h.cast("double").alias("raw_hits"), some(h / F.ln(n + F.e())).alias("over_log"), some(h / n).alias("share"), F.col("w").cast("double").alias("weighted"))


@query(f"""WITH {_J}, a AS (SELECT *, row_number() OVER (PARTITION BY rater ORDER BY rank) AS r2 FROM j WHERE n_chars >= 500), x AS (SELECT rater, avg(keep::INT) AS p, count(*) AS n FROM a WHERE r2 <= 10 GROUP BY rater)
SELECT count(*) FILTER (WHERE n >= 8) AS days, round(avg(p) FILTER (WHERE n >= 8), 6) AS precision, round(min(p) FILTER (WHERE n >= 8), 6) AS worst, round(max(p) FILTER (WHERE n >= 8) - min(p) FILTER (WHERE n >= 8), 6) AS spread FROM x""")
def a56_a57_filtered_precision(spark, d):
    """Precision of the first ten after a filter has taken others out of the ranking, the worst side and the spread."""
    a = K.top_in_group(judged(spark, d).where("n_chars >= 500"), ["rater"], [F.col("rank")], 10, "r2")
    x = a.groupBy("rater").agg(F.avg(F.col("keep").cast("double")).alias("p"), F.count("*").alias("n")).where("n >= 8")
    return x.agg(F.count("*").alias("days"), F.round(F.avg("p"), 6).alias("precision"), F.round(F.min("p"), 6).alias("worst"), F.round(F.max("p") - F.min("p"), 6).alias("spread"))


@query(f"""WITH {_J}, a AS (SELECT source FROM (SELECT DISTINCT doc_id, source FROM documents) WHERE source IS NOT NULL GROUP BY source HAVING count(*) >= 100), k AS (SELECT DISTINCT doc_id, source FROM documents)
SELECT count(*) FILTER (WHERE keep) AS keeps, count(*) FILTER (WHERE keep AND (k.source IS NULL OR k.source NOT IN (SELECT source FROM a))) AS lost, count(*) FILTER (WHERE NOT keep AND k.source IN (SELECT source FROM a)) AS let_in FROM j JOIN k ON k.doc_id = j.doc_id""")
def a59_list_recall(spark, d):
    """What an inclusion list of large sources would lose of the kept documents."""
    k = table(spark, d, "documents").select("doc_id", "source").distinct()
    a = k.where("source is not null").groupBy("source").agg(F.count("*").alias("n")).where("n >= 100").select("source", F.lit(True).alias("listed"))
    j = judged(spark, d).join(k, "doc_id").join(a, "source", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return j.agg(F.count_if("keep").alias("keeps"), F.count_if(F.col("keep") & ~F.col("listed")).alias("lost"), F.count_if(~F.col("keep") & F.col("listed")).alias("let_in"))


@query(f"""{PR}, m AS (SELECT max(day) AS today FROM r), a AS (SELECT ref, count(*) AS w FROM r GROUP BY ref ORDER BY w DESC, ref LIMIT 100), b AS (SELECT ref, count(*) AS w FROM r, m WHERE day <= today - 60 GROUP BY ref ORDER BY w DESC, ref LIMIT 100)
SELECT day, count(*) AS citations, count(*) FILTER (WHERE ref IN (SELECT ref FROM a)) AS anchored, count(*) FILTER (WHERE ref IN (SELECT ref FROM b)) AS anchored_before FROM r WHERE day IS NOT NULL GROUP BY day""")
def a61_anchor_shares(spark, d):
    """Citations of each day that meet the list of now and the list of two months before."""
    e = refs(spark, d)
    last = e.agg(F.max("day").alias("today"))
    top = lambda x, c: x.groupBy("ref").agg(F.count("*").alias("w")).orderBy(F.desc("w"), "ref").limit(100).select("ref", F.lit(1).alias(c))
    a, b = top(e, "a"), top(e.crossJoin(F.broadcast(last)).where(F.col("day") <= F.date_sub("today", 60)), "b")
    return e.where("day is not null").join(F.broadcast(a), "ref", "left").join(F.broadcast(b), "ref", "left").groupBy("day").agg(F.count("*").alias("citations"), F.count("a").alias("anchored"), F.count("b").alias("anchored_before"))


@query(f"""WITH {_J}, t AS (SELECT rater, grade, n_chars >= 1200 AS long, rank <= 5 AS early, corrected_from IS NOT NULL AS corrected FROM (SELECT j.*, v.corrected_from FROM j JOIN v ON v.doc_id = j.doc_id AND v.rn = 1) WHERE rank <= 15),
  u AS (UNPIVOT t ON long, early, corrected INTO NAME rule VALUE hit) SELECT rule, grade, count(*) AS n, count(*) FILTER (WHERE hit) AS hits FROM u GROUP BY 1, 2""")
def a62_rule_hits(spark, d):
    """Hits of three rules by grade among the first fifteen of each rater."""
    v = K.latest(table(spark, d, "level_labels").distinct(), ["doc_id"], [F.desc("labelled_at"), F.col("grade")]).select("doc_id", F.col("corrected_from").isNotNull().alias("corrected"))
    t = judged(spark, d).where("rank <= 15").join(v, "doc_id").select("grade", (F.col("n_chars") >= 1200).alias("long"), (F.col("rank") <= 5).alias("early"), "corrected")
    return t.unpivot(["grade"], ["long", "early", "corrected"], "rule", "hit").groupBy("rule", "grade").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))


@query(PT + """, f AS (SELECT topic, min(day) AS a FROM t GROUP BY topic), g AS (SELECT topic, min(day) AS b FROM t WHERE is_primary GROUP BY topic), x AS (SELECT t.item_id, avg((f.a = t.day)::INT) AS live, avg((g.b IS NULL OR g.b >= t.day)::INT) AS replay FROM t JOIN f ON f.topic = t.topic LEFT JOIN g ON g.topic = t.topic WHERE t.day IS NOT NULL GROUP BY 1)
SELECT count(*) AS papers, round(avg(live), 6) AS live, round(avg(replay), 6) AS replay, round(quantile_cont(replay - live, 0.5), 6) AS median_offset, round(max(abs(replay - live)), 6) AS most FROM x""")
def a65_novelty_offset(spark, d):
    """Novelty against all topics seen and against primary topics alone."""
    t = topics(spark, d).where("day is not null")
    f, g = t.groupBy("topic").agg(F.min("day").alias("a")), t.where("is_primary").groupBy("topic").agg(F.min("day").alias("b"))
    x = t.join(f, "topic").join(g, "topic", "left").groupBy("item_id").agg(F.avg((F.col("a") == F.col("day")).cast("int")).alias("live"), F.avg((F.col("b").isNull() | (F.col("b") >= F.col("day"))).cast("int")).alias("replay"))
    return x.agg(F.count("*").alias("papers"), F.round(F.avg("live"), 6).alias("live"), F.round(F.avg("replay"), 6).alias("replay"), F.round(F.percentile(F.col("replay") - F.col("live"), 0.5), 6).alias("median_offset"),
                 F.round(F.max(F.abs(F.col("replay") - F.col("live"))), 6).alias("most"))


@query(PT + """, c AS (SELECT day, topic, count(DISTINCT item_id) AS n FROM t WHERE day IS NOT NULL GROUP BY 1, 2) SELECT day, count(*) AS tags, count(*) FILTER (WHERE n >= 2) AS at_2, count(*) FILTER (WHERE n >= 3) AS at_3, count(*) FILTER (WHERE n >= 4) AS at_4 FROM c GROUP BY day""")
def a66_tag_groups_at_n(spark, d):
    c = topics(spark, d).where("day is not null").groupBy("day", "topic").agg(F.countDistinct("item_id").alias("n"))
    return c.groupBy("day").agg(F.count("*").alias("tags"), *(F.count_if(F.col("n") >= k).alias(f"at_{k}") for k in (2, 3, 4)))


_FEATURES = """x AS (SELECT j.keep, j.n_chars::DOUBLE AS chars, len(regexp_extract_all(k.text, '\\d[\\d,.]*'))::DOUBLE AS numbers, len(regexp_extract_all(k.text, '\\n'))::DOUBLE AS lines FROM j JOIN (SELECT DISTINCT doc_id, text FROM documents) k ON k.doc_id = j.doc_id),
  u AS (UNPIVOT x ON chars, numbers, lines INTO NAME feature VALUE v)"""


def judged_features(spark, d):
    """(keep, feature, v) of three figures of each judged document."""
    k = table(spark, d, "documents").select("doc_id", "text").distinct()
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("double")
    x = judged(spark, d).join(k, "doc_id").select("keep", F.col("n_chars").cast("double").alias("chars"), n(r"\d[\d,.]*").alias("numbers"), n(r"\n").alias("lines"))
    return x.unpivot(["keep"], ["chars", "numbers", "lines"], "feature", "v")


@query(f"""WITH {_J}, {_FEATURES}, a AS (SELECT f.feature, avg(CASE WHEN f.v > g.v THEN 1.0 WHEN f.v = g.v THEN 0.5 ELSE 0.0 END) AS auc FROM u f JOIN u g ON f.feature = g.feature AND f.keep AND NOT g.keep GROUP BY 1)
SELECT u.feature, quantile_cont(v, 0.5) FILTER (WHERE keep) AS median_kept, quantile_cont(v, 0.5) FILTER (WHERE NOT keep) AS median_dropped, round(any_value(auc), 6)::DOUBLE AS auc FROM u JOIN a ON a.feature = u.feature GROUP BY u.feature""")
def u6_a69_separation(spark, d):
    """How well single figures part kept from dropped: medians and the area under the curve, by rank sums within each figure."""
    u = judged_features(spark, d)
    ties = u.groupBy("feature", "v").agg(F.count("*").alias("n"), F.count_if("keep").alias("p")).withColumn("neg", F.col("n") - F.col("p"))
    c = M.cumulated(ties, ["feature"], F.col("v").asc(), "neg")
    auc = c.groupBy("feature").agg(F.sum(F.col("p") * (F.col("before") + F.col("neg") / 2)).alias("wins"), F.sum("p").alias("np"), F.sum("neg").alias("nn")).select("feature", F.round(F.col("wins") / (F.col("np") * F.col("nn")), 6).alias("auc"))
    m = u.groupBy("feature").agg(F.percentile(F.when(F.col("keep"), F.col("v")), 0.5).alias("median_kept"), F.percentile(F.when(~F.col("keep"), F.col("v")), 0.5).alias("median_dropped"))
    return m.join(auc, "feature")


@query(PP + """, l AS (SELECT max(day) AS today FROM p), x AS (SELECT count(*) FILTER (WHERE len(raw_refs) > 0) AS measurable, count(*) AS papers, count(*) FILTER (WHERE len(raw_refs) >= 20) AS long_lists FROM p, l WHERE day = today)
SELECT papers, measurable, CASE WHEN measurable > 0 THEN long_lists END AS long_lists FROM x""")
def a73_measured_or_absent(spark, d):
    """A figure of the last day that is null where it can't be measured and zero where it was measured as zero."""
    raw = table(spark, d, "items").dropDuplicates(["item_id"]).select(F.col("first_published").alias("day"), F.coalesce(F.size("graph.referenced_works"), F.lit(0)).alias("n"))
    x = raw.crossJoin(F.broadcast(raw.agg(F.max("day").alias("today")))).where("day = today")
    return x.agg(F.count("*").alias("papers"), F.count_if(F.col("n") > 0).alias("measurable"), F.count_if(F.col("n") >= 20).alias("long_")).select(
        "papers", "measurable", F.when(F.col("measurable") > 0, F.col("long_")).alias("long_lists"))


@query("SELECT ts::DATE AS day, count(*) FILTER (WHERE event_type = 'error') AS throttled, round(coalesce(sum(value) FILTER (WHERE event_type = 'error'), 0), 4) AS waited FROM events GROUP BY 1")
def a75_throttle_totals(spark, d):
    e = F.col("event_type") == "error"
    return table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_if(e).alias("throttled"), F.round(F.coalesce(F.sum(F.when(e, F.col("value"))), F.lit(0.0)), 4).alias("waited"))


@query(f"{PR}, k AS (SELECT ref, count(*) AS n FROM r GROUP BY ref), s AS (SELECT ref, n FROM k ORDER BY md5('42:' || ref), ref LIMIT 500) SELECT (SELECT sum(n)::BIGINT FROM k) AS mentions, (SELECT count(*) FROM k) AS kinds, count(*) AS drawn, count(*) FILTER (WHERE n > 1) AS repeated FROM s")
def a76_reference_sample(spark, d):
    """Mentions and distinct references, and a sample of five hundred drawn by hash."""
    k = refs(spark, d).groupBy("ref").agg(F.count("*").alias("n"))
    s = k.orderBy(F.md5(F.concat(F.lit("42:"), "ref")), "ref").limit(500).agg(F.count("*").alias("drawn"), F.count_if(F.col("n") > 1).alias("repeated"))
    return k.agg(F.sum("n").alias("mentions"), F.count("*").alias("kinds")).crossJoin(s)


@query(f"""WITH {_J}, p AS (SELECT rater, avg(keep::INT) AS p FROM j WHERE rank <= 10 GROUP BY rater HAVING count(*) >= 5), dd AS (SELECT rater, day, count(*) AS n FROM j GROUP BY 1, 2), q AS (SELECT rater, list_sort(list(n))[count(*) // 2 + 1] AS m FROM dd GROUP BY rater)
SELECT round(min(p.p), 6) AS worst, max(q.m) AS busiest_median, count(*) AS raters FROM p JOIN q ON q.rater = p.rater""")
def a77_verdict_scalars(spark, d):
    """The worst precision over raters and the largest upper median of a rater's labels a day."""
    j = judged(spark, d)
    p = j.where("rank <= 10").groupBy("rater").agg(F.avg(F.col("keep").cast("double")).alias("p"), F.count("*").alias("n")).where("n >= 5")
    q = M.values_at(j.groupBy("rater", "day").agg(F.count("*").alias("c")), ["rater"], "c", {"m": M.upper_half})
    return p.join(q, "rater").agg(F.round(F.min("p"), 6).alias("worst"), F.max("m").alias("busiest_median"), F.count("*").alias("raters"))


@query(PP + " SELECT coalesce(source_name, 'unknown') AS source, count(*) AS unreadable, row_number() OVER (ORDER BY count(*) DESC, coalesce(source_name, 'unknown')) AS place FROM p WHERE abstract IS NULL OR trim(abstract) = '' GROUP BY 1")
def a79_unreadable_ranking(spark, d):
    return K.places(records.a32_a79_unreadable_by_source(spark, d), [F.desc("unreadable"), F.asc("source")])


@query(f"""WITH {_J}, {_FEATURES}, t(feature, least) AS (VALUES ('chars', 1000.0), ('numbers', 5.0), ('lines', 4.0)), c AS (SELECT u.feature, count(*) FILTER (WHERE keep AND v >= least) AS tp, count(*) FILTER (WHERE NOT keep AND v >= least) AS fp, count(*) FILTER (WHERE keep AND v < least) AS fn FROM u JOIN t ON t.feature = u.feature GROUP BY 1)
SELECT feature, tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM c""")
def a80_confusion(spark, d):
    """Hits, false hits and misses of single figures as classifiers, with precision and recall."""
    least = F.when(F.col("feature") == "chars", 1000.0).when(F.col("feature") == "numbers", 5.0).otherwise(4.0)
    yes = F.col("v") >= least
    c = judged_features(spark, d).groupBy("feature").agg(F.count_if(F.col("keep") & yes).alias("tp"), F.count_if(~F.col("keep") & yes).alias("fp"), F.count_if(F.col("keep") & ~yes).alias("fn"))
    tp = F.col("tp")
    return c.select("feature", "tp", "fp", "fn", F.round(tp / F.nullif(tp + F.col("fp"), F.lit(0)), 6).alias("precision"), F.round(tp / F.nullif(tp + F.col("fn"), F.lit(0)), 6).alias("recall"))


@query(f"""WITH {_J}, k AS (SELECT DISTINCT doc_id, source FROM documents), x AS (SELECT j.*, k.source FROM j JOIN k ON k.doc_id = j.doc_id WHERE k.source IS NOT NULL)
SELECT source, count(*) AS weak FROM x WHERE grade <= 2 AND source IN (SELECT source FROM x WHERE keep) GROUP BY source""")
def a84_weak_beside_kept(spark, d):
    """Weak labels of sources that also hold kept documents, by a semi-join."""
    x = judged(spark, d).join(table(spark, d, "documents").select("doc_id", "source").distinct(), "doc_id").where("source is not null")
    return x.where("grade <= 2").join(x.where("keep").select("source"), "source", "left_semi").groupBy("source").agg(F.count("*").alias("weak"))


@query(PP + """, x AS (SELECT source_id, item_id, row_number() OVER (PARTITION BY source_id ORDER BY cited DESC NULLS LAST, item_id) AS rank FROM p WHERE source_id IS NOT NULL AND trim(abstract) <> '') SELECT source_id, item_id, rank FROM x WHERE rank <= 15""")
def w2_rank_in_source(spark, d):
    """The first fifteen of each source, papers without an abstract left out before ranking."""
    x = papers(spark, d).where("source_id is not null and trim(abstract) <> ''")
    return K.top_in_group(x, ["source_id"], [F.desc_nulls_last("cited"), F.col("item_id")], 15).select("source_id", "item_id", "rank")


@query(PP + """, l AS (SELECT max(day) AS today FROM p), c AS (SELECT day, count(*) AS n, max(collected_at)::DATE AS seen FROM p WHERE day IS NOT NULL GROUP BY day) SELECT coalesce(max(day) FILTER (WHERE seen <= today - 7), max(day)) AS settled, max(day) AS newest FROM c, l""")
def w15_newest_settled(spark, d):
    """The newest day all of whose records were collected a week before the last day, else the newest."""
    p = papers(spark, d)
    c = p.where("day is not null").groupBy("day").agg(F.max(F.col("collected_at").cast("date")).alias("seen")).crossJoin(F.broadcast(p.agg(F.max("day").alias("today"))))
    return c.agg(F.coalesce(F.max(F.when(F.col("seen") <= F.date_sub("today", 7), F.col("day"))), F.max("day")).alias("settled"), F.max("day").alias("newest"))


@query("""WITH l AS (SELECT DISTINCT * FROM level_labels), v AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY labelled_at DESC, grade) AS rn FROM l) SELECT doc_id, rater, grade, corrected_from, 'second look' AS sampling FROM v WHERE rn = 1 AND corrected_from IS NOT NULL""")
def w20_u14_to_rejudge(spark, d):
    """Latest labels that were corrected, as rows of a new session that name their sampling."""
    v = K.latest(table(spark, d, "level_labels").distinct(), ["doc_id"], [F.desc("labelled_at"), F.col("grade")])
    return v.where("corrected_from is not null").select("doc_id", "rater", "grade", "corrected_from", F.lit("second look").alias("sampling"))


@query(f"""WITH {_J}, s AS (SELECT doc_id, keep, row_number() OVER (PARTITION BY keep ORDER BY md5('7:' || doc_id), doc_id) AS rn FROM j) SELECT doc_id, keep, CASE WHEN rn <= 10 THEN 'eval' ELSE 'train' END AS part FROM s""")
def w22_eval_split(spark, d):
    """Ten kept and ten dropped, drawn by hash, held out; the rest is for training."""
    w = Window.partitionBy("keep").orderBy(F.md5(F.concat(F.lit("7:"), "doc_id")), "doc_id")
    return judged(spark, d).select("doc_id", "keep", F.when(F.row_number().over(w) <= 10, "eval").otherwise("train").alias("part"))


@query(PP + """, b AS (SELECT day, first(item_id ORDER BY cited DESC NULLS LAST, item_id) AS lead FROM p WHERE day IS NOT NULL GROUP BY day) SELECT p.day, p.item_id, row_number() OVER (PARTITION BY p.day ORDER BY p.item_id <> lead, CASE WHEN state = 'published' THEN 0 ELSE 1 END, cited DESC NULLS LAST, p.item_id) AS place FROM p JOIN b ON b.day = p.day""")
def so4_card_order(spark, d):
    """The order of a day's papers: the lead, then published before preprints, then by citations."""
    p = papers(spark, d).where("day is not null")
    b = K.latest(p.select("day", "cited", "item_id"), ["day"], [F.desc_nulls_last("cited"), F.col("item_id")]).select("day", F.col("item_id").alias("lead"))
    w = Window.partitionBy("day").orderBy(F.col("item_id") != F.col("lead"), F.when(F.col("state") == "published", 0).otherwise(1), F.desc_nulls_last("cited"), "item_id")
    return p.join(b, "day").select("day", "item_id", F.row_number().over(w).cast("bigint").alias("place"))


@query(f"{vocabulary._headline_sql()}, {_in(vocabulary.SQL['f5_f7_detectors'], 'w')} SELECT q2.item_id, round((0.5 * completeness + 0.3 * novelty + 0.2 * multiplicity) * w.weight, 4) AS score FROM q2 JOIN q3 ON q3.item_id = q2.item_id JOIN w ON w.id = 'i' || q2.item_id")
def so5_journal_score(spark, d):
    """The score that ranks journal papers; reviews and notices come last."""
    w = vocabulary.f5_f7_detectors(spark, d).where("id like 'i%'").select(F.expr("cast(substring(id, 2) as bigint)").alias("item_id"), "weight")
    j = daily.s29_j22_novelty(spark, d).join(daily.s27_s28_components(spark, d), "item_id").join(w, "item_id")
    return j.select("item_id", F.round((0.5 * F.col("completeness") + 0.3 * F.col("novelty") + 0.2 * F.col("multiplicity")) * F.col("weight"), 4).alias("score"))


@query(f"{citing._PAIRS} SELECT a, b, shared, row_number() OVER (ORDER BY shared DESC, a, b) AS place FROM pairs")
def so8_coupling_order(spark, d):
    # saved, since places() reads its rows twice, once to draw the bounds of its ranges
    return K.places(save(citing.paper_pairs(spark, d).select("a", "b", "shared")), [F.desc("shared"), F.asc("a"), F.asc("b")])


@query(f"""WITH {_in(citing.SQL['so9_pair_criteria'], 'c')}, e AS (SELECT a AS item, b AS other, shared::DOUBLE AS shared, jaccard, cosine FROM c UNION ALL SELECT b, a, shared, jaccard, cosine FROM c), u AS (UNPIVOT e ON shared, jaccard, cosine INTO NAME criterion VALUE v)
SELECT criterion, item, other, row_number() OVER (PARTITION BY criterion, item ORDER BY v DESC, other) AS rank FROM u QUALIFY rank <= 3""")
def so9_top_by_criterion(spark, d):
    """The three closest partners of each paper under three criteria."""
    c = citing.so9_pair_criteria(spark, d).withColumn("shared", F.col("shared").cast("double"))
    ends = c.select(F.col("a").alias("item"), F.col("b").alias("other"), "shared", "jaccard", "cosine").union(c.select("b", "a", "shared", "jaccard", "cosine"))
    u = ends.unpivot(["item", "other"], ["shared", "jaccard", "cosine"], "criterion", "v")
    return K.top_in_group(u, ["criterion", "item"], [F.desc("v"), F.col("other")], 3).select("criterion", "item", "other", "rank")


@query(PP + " SELECT item_id, list_transform(authors[1:5], lambda a: a.name) AS authors, len(authors) AS n_authors, raw_refs[1:10] AS refs FROM p")
def so11_first_n(spark, d):
    """The first five authors and ten references of each paper, as written."""
    raw = table(spark, d, "items").dropDuplicates(["item_id"])
    a, r = F.coalesce("bibliography.authors", F.array()), F.coalesce("graph.referenced_works", F.array().cast("array<string>"))
    return raw.select("item_id", F.transform(F.slice(a, 1, 5), lambda x: x["name"]).alias("authors"), F.size(a).cast("bigint").alias("n_authors"), F.slice(r, 1, 10).alias("refs"))


@query(PP + """, l AS (SELECT max(day) AS today FROM p), s AS (SELECT unnest(range((today - 60)::TIMESTAMP, today::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM l) SELECT s.day, row_number() OVER (ORDER BY s.day) AS place FROM s WHERE day NOT IN (SELECT day FROM p WHERE day IS NOT NULL)""")
def so12_catch_up(spark, d):
    """Days of the last sixty without papers, oldest first."""
    p = papers(spark, d).where("day is not null")
    s = p.agg(F.max("day").alias("today")).select(F.explode(F.sequence(F.date_sub("today", 60), F.date_sub("today", 1), F.expr("interval 1 day"))).alias("day"))
    return K.places(s.join(p.select("day").distinct(), "day", "left_anti"), [F.asc("day")])


@query(PP + """, w AS (SELECT source_id, sum(cited) AS weight, count(*) AS papers FROM p WHERE source_id IS NOT NULL GROUP BY 1) SELECT source_id, weight::BIGINT AS weight, papers, row_number() OVER (ORDER BY weight DESC NULLS LAST, source_id) AS place FROM w WHERE source_id NOT IN (SELECT upper(source_id) FROM sources WHERE source_type = 'journal')""")
def so13_venue_gap(spark, d):
    """Venues on no list, by the citations of their papers."""
    w = papers(spark, d).where("source_id is not null").groupBy("source_id").agg(F.sum("cited").alias("weight"), F.count("*").alias("papers"))
    listed = table(spark, d, "sources").where("source_type = 'journal'").select(F.upper("source_id").alias("source_id"))
    return K.places(w.join(listed, "source_id", "left_anti"), [F.desc_nulls_last("weight"), F.asc("source_id")])


@query(f"WITH {_in(citing.SQL['a8_topic_degree'], 'g')} SELECT node, degree, row_number() OVER (ORDER BY degree DESC, node) AS place FROM g")
def so14_degree_order(spark, d):
    return K.places(citing.a8_topic_degree(spark, d), [F.desc("degree"), F.asc("node")])


@query(r"""WITH x AS (SELECT sha256(trim(coalesce(title, '')) || chr(10) || chr(10)) AS k FROM (SELECT DISTINCT * FROM listings)), c AS (SELECT DISTINCT sha256(trim(coalesce(bibliography.title, '')) || chr(10) || chr(10)) AS k FROM items)
SELECT count(*) AS texts, count(DISTINCT x.k) AS keys, count(DISTINCT c.k) AS cached FROM x LEFT JOIN c ON c.k = x.k""")
def u1_u11_cache_keys(spark, d):
    """Texts to embed by their digest: how many keys, and how many of them a cache holds."""
    key = lambda c: F.sha2(F.concat(F.trim(F.coalesce(c, F.lit(""))), F.lit("\n\n")), 256)
    c = table(spark, d, "items").select(key(F.col("bibliography.title")).alias("k")).distinct().withColumn("c", F.col("k"))
    x = table(spark, d, "listings").distinct().select(key(F.col("title")).alias("k")).join(c, "k", "left")
    return x.agg(F.count("*").alias("texts"), F.countDistinct("k").alias("keys"), F.countDistinct("c").alias("cached"))


@query(PP + f""", {daily._M}, w AS (SELECT * FROM p, m WHERE day > today - 7) SELECT count(*) AS papers, count(*) FILTER (WHERE state = 'published') AS published, count(DISTINCT source_id) AS sources, sum(len(authors))::BIGINT AS authorships,
  count(*) FILTER (WHERE len(raw_refs) > 0) AS with_references, 'papers: ' || count(*) || '; published: ' || count(*) FILTER (WHERE state = 'published') || '; sources: ' || count(DISTINCT source_id) AS line FROM w""")
def u10_a31_facts(spark, d):
    """The facts of the last week as one record and one line of text."""
    r = daily.recent(spark, d)
    raw = table(spark, d, "items").dropDuplicates(["item_id"]).select("item_id", (F.coalesce(F.size("graph.referenced_works"), F.lit(0)) > 0).alias("has"))
    x = r.join(raw, "item_id").agg(F.count("*").alias("papers"), F.count_if(F.col("state") == "published").alias("published"), F.countDistinct("source_id").alias("sources"), F.sum(F.size("authors")).alias("authorships"), F.count_if("has").alias("with_references"))
    return x.withColumn("line", F.concat(F.lit("papers: "), "papers", F.lit("; published: "), "published", F.lit("; sources: "), "sources"))


@query()
def u12_sampled_betweenness(spark, d):
    """Betweenness along citations within the collection, from two hundred works drawn by hash."""
    e = citing.j6_internal_edges(spark, d).select(F.col("citing").alias("a"), F.col("cited").alias("b"))
    return G.betweenness(e, min_degree=1, directed=True, sources=200)


@query()
def w9_window_stability(spark, d):
    """The ten most central topics of the last 30, 60 and 90 days, and how the rankings agree, pair by pair."""
    from quillspark.operators.replay import window_stability
    return window_stability(topics(spark, d).select("item_id", "topic", "day"))


@query()
def w5_growing_archive(spark, d):
    """Days in order: the novelty of each paper against the topics of papers taken on earlier days."""
    from quillspark.operators.replay import growing_archive
    r = words.s26_heuristic_relevance(spark, d)
    t = topics(spark, d).groupBy("item_id").agg(F.collect_set("topic").alias("tags"))
    p = papers(spark, d).where("day is not null").select("item_id", "day").join(r, "item_id").join(t, "item_id", "left")
    return growing_archive(p)
