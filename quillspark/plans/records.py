"""Queries over records: scans, filters, merging, joins to an archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.durable import save
from quillspark.functions import ids as I, text as T
from quillspark.operators import merge as X, ranking as K, references as R
from quillspark.plans.common import PP, PR, PT, collection, papers, refs, topics
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()


@query(PP + ", e AS (SELECT min(day) AS a, max(day) AS b FROM p), s AS (SELECT unnest(range(a::TIMESTAMP, b::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS s, b FROM e) "
       "SELECT s::DATE AS window_from, least((s + INTERVAL 6 DAY)::DATE, b) AS window_to FROM s")
def sc2_windows(spark, d):
    e = papers(spark, d).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return e.select(F.explode(K.windows(F.col("a"), F.col("b"))).alias("w")).select(F.col("w.from").alias("window_from"), F.col("w.to").alias("window_to"))


@query("""WITH s AS (SELECT source_id, row_number() OVER (ORDER BY source_id) - 1 AS n FROM sources)
SELECT n // 40 AS chunk, count(*) AS size, min(source_id) AS first_id, max(source_id) AS last_id FROM s GROUP BY 1""")
def sc18_chunks(spark, d):
    s = K.places(table(spark, d, "sources").select("source_id"), [F.asc("source_id")])
    return s.groupBy(F.floor((F.col("place") - 1) / 40).alias("chunk")).agg(F.count("*").alias("size"), F.min("source_id").alias("first_id"), F.max("source_id").alias("last_id"))


@query(PP + """, s AS (SELECT upper(source_id) AS source_id FROM sources WHERE source_type = 'journal')
SELECT p.item_id, p.source_id, p.source_id IN (SELECT source_id FROM s) AS listed FROM p WHERE p.source_id IS NOT NULL""")
def f8_whitelist(spark, d):
    s = table(spark, d, "sources").where("source_type = 'journal'").select(F.upper("source_id").alias("source_id"), F.lit(True).alias("in_"))
    return (papers(spark, d).where("source_id is not null").select("item_id", "source_id").join(s, "source_id", "left")
            .select("item_id", "source_id", F.coalesce("in_", F.lit(False)).alias("listed")))


@query("""WITH r AS (SELECT DISTINCT record_id, collector, payload FROM raw_works)
SELECT collector, count(*) AS records, count(*) FILTER (WHERE json_valid(payload)) AS readable, count(*) FILTER (WHERE NOT json_valid(payload)) AS malformed FROM r GROUP BY collector""")
def sc26_f20_malformed(spark, d):
    v = F.try_parse_json("payload").isNotNull()
    return (table(spark, d, "raw_works").select("record_id", "collector", "payload").distinct().groupBy("collector")
            .agg(F.count("*").alias("records"), F.count_if(v).alias("readable"), F.count_if(~v).alias("malformed")))


@query("""WITH r AS (SELECT DISTINCT record_id, payload FROM raw_works WHERE json_valid(payload)), k AS (SELECT DISTINCT record_id, unnest(json_keys(payload)) AS k FROM r)
SELECT k AS member, count(*) AS records, k NOT IN ('id', 'display_name', 'publication_date', 'cited_by_count', 'authorships', 'primary_location', 'topics', 'referenced_works') AS unknown FROM k GROUP BY k""")
def sc36_schema_drift(spark, d):
    known = ["id", "display_name", "publication_date", "cited_by_count", "authorships", "primary_location", "topics", "referenced_works"]
    k = (table(spark, d, "raw_works").select("record_id", "payload").distinct().where(F.try_parse_json("payload").isNotNull())
         .select("record_id", F.explode(F.json_object_keys("payload")).alias("member")).distinct())
    return k.groupBy("member").agg(F.count("*").alias("records")).withColumn("unknown", ~F.col("member").isin(known))


@query(PP + " SELECT work_key, min(day) AS first_day, count(*) AS records FROM p GROUP BY work_key")
def sc33_published_index(spark, d):
    return papers(spark, d).groupBy("work_key").agg(F.min("day").alias("first_day"), F.count("*").alias("records"))


@query(PP + ", x AS (SELECT *, row_number() OVER (PARTITION BY work_key ORDER BY len(raw_refs) = 0, collected_at, item_id) AS rn FROM p) SELECT work_key, item_id, len(raw_refs) > 0 AS has_refs FROM x WHERE rn = 1")
def sc39_first_with_references(spark, d):
    raw = table(spark, d, "items").dropDuplicates(["item_id"]).select("work_key", "item_id", F.col("provenance.collected_at").alias("collected_at"),
                                                                     F.coalesce(F.size("graph.referenced_works"), F.lit(0)).alias("n"))
    return K.latest(raw, ["work_key"], [F.col("n") <= 0, F.col("collected_at"), F.col("item_id")]).select("work_key", "item_id", (F.col("n") > 0).alias("has_refs"))


_CUT = "m AS (SELECT quantile_disc(collected_at, 0.5) AS cut FROM p)"


@query(PP + f""", {_CUT}, o AS (SELECT DISTINCT ON (work_key) work_key, title, cited, state, collected_at FROM p, m WHERE collected_at <= cut ORDER BY work_key, collected_at DESC, item_id),
  n AS (SELECT DISTINCT ON (work_key) work_key, title, cited, state, collected_at FROM p, m WHERE collected_at > cut ORDER BY work_key, collected_at DESC, item_id)
SELECT coalesce(o.work_key, n.work_key) AS work_key, coalesce(n.title, o.title) AS title, coalesce(n.cited, o.cited) AS cited, coalesce(n.state, o.state) AS state,
  CASE WHEN o.work_key IS NULL OR (n.work_key IS NOT NULL AND (coalesce(n.title, o.title) IS DISTINCT FROM o.title OR coalesce(n.cited, o.cited) IS DISTINCT FROM o.cited OR coalesce(n.state, o.state) IS DISTINCT FROM o.state))
       THEN n.collected_at ELSE o.collected_at END AS collected_at,
  CASE WHEN o.work_key IS NULL THEN 'added' WHEN n.work_key IS NULL THEN 'kept' WHEN coalesce(n.title, o.title) IS DISTINCT FROM o.title OR coalesce(n.cited, o.cited) IS DISTINCT FROM o.cited
       OR coalesce(n.state, o.state) IS DISTINCT FROM o.state THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n ON o.work_key = n.work_key""")
def sc31_upsert(spark, d):
    """The later half of the records merged into the earlier half."""
    p = papers(spark, d).select("work_key", "title", "cited", "state", "collected_at", "item_id")
    half = table(spark, d, "items").dropDuplicates(["item_id"]).agg(F.expr("percentile_disc(0.5) within group (order by unix_micros(provenance.collected_at::timestamp))").alias("cut"))
    x = p.crossJoin(F.broadcast(half)).withColumn("late", F.expr("unix_micros(collected_at::timestamp) > cut"))
    old, new = X.recent_first(x.where("not late"), "work_key", "collected_at", "item_id"), X.recent_first(x.where("late"), "work_key", "collected_at", "item_id")
    return X.upsert(old, new, "work_key", ["title", "cited", "state"], "collected_at")


@query(PP + """, s AS (SELECT work_key, state, lag(state) OVER (PARTITION BY work_key ORDER BY collected_at, item_id) AS before, collected_at, item_id FROM p)
SELECT work_key, item_id, before, state AS after, collected_at FROM s WHERE before IS NOT NULL AND before <> state""")
def j4_status_changes(spark, d):
    from pyspark.sql import Window
    w = Window.partitionBy("work_key").orderBy("collected_at", "item_id")
    return (papers(spark, d).withColumn("before", F.lag("state").over(w)).where("before is not null and before <> state")
            .select("work_key", "item_id", "before", F.col("state").alias("after"), "collected_at"))


_KEYS = PP + r""", fields AS (SELECT DISTINCT item_id, lower(trim(f)) AS f FROM (SELECT item_id, unnest([work_key, 'arxiv:' || arxiv, doi, openalex, url]) AS f FROM p) WHERE trim(f) <> ''),
  parts AS (SELECT item_id, regexp_extract(f, '(10\.\d{4,9}/\S+)', 1) AS doi, regexp_extract(f, '/arxiv\.(\d{4}\.\d{4,5})', 1) AS old, regexp_extract(f, '(?:^|[/:])(w\d+)/*$', 1) AS w, regexp_extract(f, '(?:^|[/:])(\d{4}\.\d{4,5})(?:v\d+)?$', 1) AS ax FROM fields),
  keys AS (SELECT item_id, 'arxiv:' || CASE WHEN old <> '' THEN old ELSE ax END AS k FROM parts WHERE old <> '' OR (doi = '' AND ax <> '') UNION SELECT item_id, 'doi:' || doi FROM parts WHERE doi <> '' AND old = '' UNION SELECT item_id, 'openalex:' || upper(w) FROM parts WHERE w <> '')"""
#: CTEs ``keys`` and ``roots``: the identity keys of each record, and the smallest record that shared keys lead to.
_ROOTS = _KEYS.replace("WITH ", "WITH RECURSIVE ", 1) + """, links AS (SELECT DISTINCT a.item_id AS u, b.item_id AS v FROM keys a JOIN keys b ON a.k = b.k), reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
  roots AS (SELECT p.item_id, coalesce(min(v), p.item_id) AS root FROM p LEFT JOIN reach ON reach.u = p.item_id GROUP BY p.item_id)"""


@query(_KEYS + " SELECT p.item_id, coalesce((SELECT list_sort(list(k)) FROM keys WHERE keys.item_id = p.item_id), []) AS keys FROM p")
def j25_identity_keys(spark, d):
    """All identity keys of each record: arXiv id, DOI and OpenAlex id of work_key, ids and landing page."""
    return identity_keys(papers(spark, d))


def identity_keys(p):
    keys = I.paper_keys(F.col("work_key"), F.concat(F.lit("arxiv:"), I.arxiv_id(F.col("arxiv"))), F.col("doi"), F.col("openalex"), F.col("url"))
    return p.select("item_id", F.array_sort(keys).alias("keys"))


@query(_ROOTS + " SELECT item_id, root FROM roots")
def j1_j3_paper_components(spark, d):
    """Each record with the smallest record of its paper: what shared keys join, directly or through other records; a record alone is its own."""
    return paper_components(papers(spark, d))


def paper_components(p):
    return X.identity_groups(save(identity_keys(p)), "item_id", "keys").select(F.col("id").alias("item_id"), "root")


_ORDER = "CASE WHEN work_key LIKE 'arxiv:%' THEN 0 WHEN work_key LIKE 'doi:%' THEN 1 WHEN work_key LIKE 'openalex:%' THEN 2 ELSE 3 END, work_key, p.item_id"


@query(_ROOTS + f""", o AS (SELECT p.*, root, row_number() OVER (PARTITION BY root ORDER BY {_ORDER}) AS o FROM p JOIN roots ON roots.item_id = p.item_id),
  g AS (SELECT root, first(work_key ORDER BY o) AS work_key, first(abstract ORDER BY o) FILTER (WHERE trim(abstract) <> '') AS abstract, first(arxiv ORDER BY o) FILTER (WHERE arxiv IS NOT NULL) AS arxiv, first(doi ORDER BY o) FILTER (WHERE doi IS NOT NULL) AS doi,
    first(openalex ORDER BY o) FILTER (WHERE openalex IS NOT NULL) AS openalex, max(cited) AS cited, last(state ORDER BY o) FILTER (WHERE state = 'published') AS published, count(*) AS members, list_sort(list_distinct(flatten(list(collectors)))) AS collectors,
    list_sort(list_distinct(list(work_key))) AS member_keys, first(len(authors) ORDER BY o) FILTER (WHERE len(authors) > 0) AS n_authors, first(list_transform(topics, lambda t: t.id) ORDER BY o) FILTER (WHERE len(topics) > 0) AS topics FROM o GROUP BY root),
  c AS (SELECT root, c, min(o * 1000 + at_) AS w FROM (SELECT root, o, unnest(categories) AS c, unnest(range(len(categories))) AS at_ FROM o) GROUP BY 1, 2), k AS (SELECT root, list(c ORDER BY w) AS categories FROM c WHERE c IS NOT NULL GROUP BY root),
  a AS (SELECT o.root, o.o, unnest(authors) AS a, unnest(range(1, len(authors) + 1)) AS at_ FROM o JOIN g ON g.root = o.root WHERE len(authors) = n_authors),
  f AS (SELECT root, at_, first(a.name ORDER BY o) FILTER (WHERE a.name IS NOT NULL) AS name, first(a.orcid ORDER BY o) FILTER (WHERE a.orcid IS NOT NULL) AS orcid FROM a GROUP BY 1, 2), n AS (SELECT root, list(coalesce(name, '') || '|' || coalesce(orcid, '') ORDER BY at_) AS authors FROM f GROUP BY root)
SELECT g.root, work_key, abstract, arxiv, doi, openalex, cited, published, members, collectors, member_keys, topics, coalesce(k.categories, []) AS categories, coalesce(n.authors, []) AS authors FROM g LEFT JOIN k ON k.root = g.root LEFT JOIN n ON n.root = g.root""")
def a1_a2_collapse(spark, d):
    """All records, those of one paper merged field by field in the order of their keys; a paper is what shared keys join, directly or
    through other records, and a record alone stays."""
    return collapse(papers(spark, d))


def collapse(p):
    """One row a paper. Scalars, topics and the list of authors come from the first record that has them; the fields of an author are filled
    from records with as many authors; categories keep the order of first sight; collectors and keys are sets."""
    o = F.struct(I.key_rank(F.col("work_key")), "work_key", "item_id")
    x = save(p.join(paper_components(p), "item_id").withColumn("o", o))
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    first = lambda c: X.first_filled(F.col(c), F.col("o")).alias(c)
    g = x.groupBy("root").agg(
        F.min_by("work_key", "o").alias("work_key"), X.first_filled(F.when(F.trim("abstract") != "", F.col("abstract")), F.col("o")).alias("abstract"), first("arxiv"), first("doi"), first("openalex"),
        F.max("cited").alias("cited"), X.last_filled(F.when(F.col("state") == "published", F.col("state")), F.col("o")).alias("published"), F.count("*").alias("members"), F.array_sort(F.collect_set("work_key")).alias("member_keys"),
        X.first_filled(F.size(some("authors")), F.col("o")).alias("n_authors"), F.transform(X.first_filled(some("topics"), F.col("o")), lambda t: t["id"]).alias("topics"))
    sets = x.select("root", F.explode("collectors").alias("c")).groupBy("root").agg(F.array_sort(F.collect_set("c")).alias("collectors"))
    cats = x.select("root", "o", F.posexplode("categories").alias("at", "c")).where("c is not null").groupBy("root", "c").agg(F.min(F.struct("o", "at")).alias("w"))
    cats = cats.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "c"))), lambda y: y["c"]).alias("categories"))
    a = x.join(g.select("root", "n_authors"), "root").where(F.size("authors") == F.col("n_authors")).select("root", "o", F.posexplode("authors").alias("at", "a"))
    a = a.groupBy("root", "at").agg(X.first_filled(F.col("a.name"), F.col("o")).alias("name"), X.first_filled(F.col("a.orcid"), F.col("o")).alias("orcid"))
    line = F.concat_ws("|", F.coalesce("name", F.lit("")), F.coalesce("orcid", F.lit("")))
    names = a.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("at"), line.alias("l")))), lambda y: y["l"]).alias("authors"))
    none = F.array().cast("array<string>")
    j = g.drop("n_authors").join(sets, "root", "left").join(cats, "root", "left").join(names, "root", "left")
    return j.select(*(c for c in j.columns if c not in ("collectors", "categories", "authors")), *(F.coalesce(c, none).alias(c) for c in ("collectors", "categories", "authors")))


@query()
def j2_fuzzy_titles(spark, d):
    """Pairs of records with one first author's surname and nearly equal titles."""
    p = papers(spark, d).select("item_id", T.last_name(F.get("authors", 0)["name"]).alias("block"), T.plain_title(F.col("title")).alias("t"))
    return X.fuzzy_pairs(p, "item_id", "block", "t")


@query(PP + """, l AS (SELECT DISTINCT listing_id, lower(trim(title)) AS t FROM listings), i AS (SELECT lower(trim(title)) AS t, min(item_id) AS item_id, count(*) AS n FROM p GROUP BY 1)
SELECT l.listing_id, i.item_id, coalesce(i.n, 0) AS candidates FROM l LEFT JOIN i ON l.t = i.t""")
def sc12_title_lookup(spark, d):
    lst = table(spark, d, "listings").select("listing_id", F.lower(F.trim("title")).alias("t")).distinct()
    i = papers(spark, d).groupBy(F.lower(F.trim("title")).alias("t")).agg(F.min("item_id").alias("item_id"), F.count("*").alias("n"))
    return lst.join(i, "t", "left").select("listing_id", "item_id", F.coalesce("n", F.lit(0)).alias("candidates"))


@query("""WITH i AS (SELECT DISTINCT work_key FROM items), x AS (SELECT DISTINCT doc_id, work_key FROM documents WHERE work_key IS NOT NULL)
SELECT count(*) AS docs, count(*) FILTER (WHERE work_key IN (SELECT work_key FROM i)) AS resolved FROM x""")
def f19_references_resolve(spark, d):
    i = table(spark, d, "items").select("work_key").distinct().withColumn("known", F.lit(True))
    return (table(spark, d, "documents").where("work_key is not null").select("doc_id", "work_key").distinct().join(i, "work_key", "left")
            .agg(F.count("*").alias("docs"), F.count("known").alias("resolved")))


@query(PP + """, c AS (SELECT item_id, [CASE WHEN title IS NULL THEN 'no title' END, CASE WHEN abstract IS NULL OR trim(abstract) = '' THEN 'no abstract' END, CASE WHEN len(authors) = 0 THEN 'no authors' END,
  CASE WHEN source_id IS NULL THEN 'no source' END] AS l FROM p) SELECT array_to_string(list_filter(l, lambda x: x IS NOT NULL), '; ') AS reasons, count(*) AS papers FROM c GROUP BY 1""")
def j35_reasons(spark, d):
    r = F.array_compact(F.array(F.when(F.col("title").isNull(), "no title"), F.when(F.col("abstract").isNull() | (F.trim("abstract") == ""), "no abstract"),
                                F.when(F.size("authors") == 0, "no authors"), F.when(F.col("source_id").isNull(), "no source")))
    return papers(spark, d).groupBy(F.array_join(r, "; ").alias("reasons")).agg(F.count("*").alias("papers"))


@query(PT + """, o AS (SELECT item_id, first(subfield ORDER BY is_primary DESC, score DESC, topic) AS own FROM t GROUP BY item_id)
SELECT p.item_id, o.own, coalesce(o.own IN ('9901', '9907'), false) AS denied FROM p LEFT JOIN o ON o.item_id = p.item_id""")
def f10_deny_list(spark, d):
    """A paper's own subfield (of its primary topic, else of its best) against a deny-list; none is never denied."""
    order = F.struct((~F.coalesce("is_primary", F.lit(False))).alias("a"), (-F.col("score")).alias("b"), F.col("topic"))
    own = topics(spark, d).groupBy("item_id").agg(F.min_by("subfield", order).alias("own"))
    return papers(spark, d).select("item_id").join(own, "item_id", "left").withColumn("denied", F.coalesce(F.col("own").isin("9901", "9907"), F.lit(False)))


@query(PT + """, c AS (SELECT source_id, subfield, count(*) AS n FROM t JOIN p ON p.item_id = t.item_id WHERE source_id IS NOT NULL AND subfield IS NOT NULL GROUP BY 1, 2)
SELECT source_id, first(subfield ORDER BY n DESC, subfield) AS subfield, max(n) AS n, round(max(n) / sum(n), 6) AS share FROM c GROUP BY source_id""")
def j32_a43_modal_subfield(spark, d):
    c = (topics(spark, d).join(papers(spark, d).select("item_id", "source_id"), "item_id").where("source_id is not null and subfield is not null")
         .groupBy("source_id", "subfield").agg(F.count("*").alias("n")))
    return c.groupBy("source_id").agg(F.min_by("subfield", F.struct((-F.col("n")).alias("a"), F.col("subfield"))).alias("subfield"), F.max("n").alias("n"),
                                      F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query(PP + """, a AS (SELECT DISTINCT source_id FROM p WHERE source_id IS NOT NULL), b AS (SELECT DISTINCT upper(regexp_extract(trim(source_id), '([^/:\\s]+)/*$', 1)) AS source_id FROM documents WHERE source_id IS NOT NULL)
SELECT coalesce(a.source_id, b.source_id) AS source_id, CASE WHEN a.source_id IS NULL THEN 'documents' WHEN b.source_id IS NULL THEN 'items' ELSE 'both' END AS side FROM a FULL JOIN b ON a.source_id = b.source_id""")
def j29_j30_compare_lists(spark, d):
    a = papers(spark, d).where("source_id is not null").select("source_id").distinct().withColumn("a", F.lit(1))
    b = table(spark, d, "documents").where("source_id is not null").select(I.bare_segment(F.col("source_id")).alias("source_id")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "source_id", "full").select("source_id", F.when(F.col("a").isNull(), "documents").when(F.col("b").isNull(), "items").otherwise("both").alias("side"))


@query(PP + """, c AS (SELECT upper(source_id) AS source_id, source_name, 0 AS o FROM sources UNION ALL SELECT source_id, source_name, 1 FROM p WHERE source_id IS NOT NULL AND source_name IS NOT NULL)
SELECT source_id, first(source_name ORDER BY o, source_name) AS source_name FROM c GROUP BY source_id""")
def j33_first_name_wins(spark, d):
    c = (table(spark, d, "sources").select(F.upper("source_id").alias("source_id"), "source_name", F.lit(0).alias("o"))
         .union(papers(spark, d).where("source_id is not null and source_name is not null").select("source_id", "source_name", F.lit(1))))
    return c.groupBy("source_id").agg(F.min_by("source_name", F.struct("o", "source_name")).alias("source_name"))


@query(PP + """, h AS (SELECT item_id, day FROM p WHERE cited >= 10), j AS (SELECT DISTINCT doc_id, work_key FROM documents WHERE work_key IS NOT NULL)
SELECT h.item_id, h.day FROM h WHERE NOT EXISTS (SELECT 1 FROM j JOIN p q ON q.work_key = j.work_key WHERE q.item_id = h.item_id)""")
def j18_pending(spark, d):
    """Rows held that no judged row answers: an anti-join."""
    done = (papers(spark, d).join(table(spark, d, "documents").where("work_key is not null").select("work_key").distinct(), "work_key", "left_semi").select("item_id"))
    return papers(spark, d).where("cited >= 10").select("item_id", "day").join(done, "item_id", "left_anti")


@query(PR + """, b AS (SELECT item_id, list_sort(list(ref)) AS refs FROM r GROUP BY item_id) SELECT p.item_id, p.work_key, coalesce(b.refs, []) AS refs, len(coalesce(b.refs, [])) AS n FROM p LEFT JOIN b ON b.item_id = p.item_id""")
def sc54_j9_reference_base(spark, d):
    """The part of ``j9_reference_base`` that the SQL states: each record with its sorted references, none included."""
    return papers(spark, d).select("item_id", "work_key", F.array_sort("refs").alias("refs"), F.size("refs").cast("bigint").alias("n"))


@query(PP + """ SELECT item_id, work_key, title, day, list_transform(authors[1:5], lambda a: a.name) AS first_authors FROM p""")
def j10_work_index(spark, d):
    """The records' part of ``j10_whole_index``, as the SQL states."""
    return papers(spark, d).select("item_id", "work_key", "title", "day", F.transform(F.slice("authors", 1, 5), lambda a: a["name"]).alias("first_authors"))


@query()
def j9_reference_base(spark, d):
    """References of all records and of the works as fetched that no record stands for, one row for each key."""
    return base_rows(papers(spark, d), table(spark, d, "raw_works"))


def by_work_key(p):
    """The last collected record of each key of its own, the key in one spelling."""
    key = F.coalesce(F.get(I.paper_keys(F.col("work_key")), F.lit(0)), F.col("work_key"))
    return K.latest(p.withColumn("work_key", key), ["work_key"], [F.desc("collected_at"), F.desc("item_id")])


def base_rows(p, raw):
    held = by_work_key(p.select("item_id", "work_key", "day", "refs", "collected_at").where(F.size("refs") > 0))
    return R.reference_base(held, identity_keys(p), R.raw_works(raw))


@query()
def j10_whole_index(spark, d):
    """Title, first authors, year, venue and DOI of all records and of the works as fetched under other keys."""
    return index_rows(papers(spark, d), table(spark, d, "raw_works"))


def index_rows(p, raw):
    held = p.select("item_id", "work_key", "title", "day", "collected_at", F.transform(F.slice("authors", 1, 5), lambda a: a["name"]).alias("first_authors"),
                    F.col("source_name").alias("venue"), I.doi(F.col("doi")).alias("doi"))
    return R.work_index(by_work_key(held), R.raw_works(raw))


@query(PP + """, a AS (SELECT unnest(collectors) AS c, categories, item_id FROM p) SELECT c AS collector, category, count(*) AS papers FROM (SELECT c, unnest(categories) AS category FROM a) GROUP BY 1, 2""")
def a16_category_intake(spark, d):
    return (papers(spark, d).select(F.explode("collectors").alias("collector"), "categories").select("collector", F.explode("categories").alias("category"))
            .groupBy("collector", "category").agg(F.count("*").alias("papers")))


@query(PP + """, x AS (SELECT work_key, count(DISTINCT state) AS states, count(*) AS records, list_sort(list_distinct(flatten(list(categories)))) AS categories FROM p GROUP BY work_key)
SELECT work_key, records, states, categories FROM x WHERE records > 1""")
def se3_se4_unions(spark, d):
    return (papers(spark, d).groupBy("work_key").agg(F.count("*").alias("records"), F.countDistinct("state").alias("states"),
                                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))).alias("categories")).where("records > 1"))


@query(PR + """, s AS (SELECT item_id, list(ref) AS l FROM r GROUP BY item_id), q AS (SELECT p.work_key, s.item_id, s.l FROM s JOIN p ON p.item_id = s.item_id)
SELECT x.item_id AS a, y.item_id AS b, round(len(list_intersect(x.l, y.l)) / len(list_distinct(x.l || y.l)), 6) AS jaccard FROM q x JOIN q y ON x.work_key = y.work_key AND x.item_id < y.item_id""")
def se7_jaccard_of_versions(spark, d):
    q = papers(spark, d).where(F.size("refs") > 0).select("work_key", "item_id", "refs")
    x, y = q.alias("x"), q.alias("y")
    return x.join(y, (F.col("x.work_key") == F.col("y.work_key")) & (F.col("x.item_id") < F.col("y.item_id"))).select(
        F.col("x.item_id").alias("a"), F.col("y.item_id").alias("b"),
        F.round(F.size(F.array_intersect("x.refs", "y.refs")) / F.size(F.array_union("x.refs", "y.refs")), 6).alias("jaccard"))


@query(PP + """, c AS (SELECT source_id, count(*) FILTER (WHERE len(raw_refs) > 0) AS ours, count(*) AS all_ FROM p WHERE source_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS sources, round(quantile_cont(ours / all_, 0.5), 6) AS median_share, round(min(ours / all_), 6) AS least, round(max(ours / all_), 6) AS most, round(avg(CASE WHEN ours >= 0.9 * all_ THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS nearly_all FROM c""")
def a82_completeness(spark, d):
    """How complete reference lists are, by source."""
    raw = table(spark, d, "items").dropDuplicates(["item_id"]).select(I.bare_segment(F.col("bibliography.primary_location.source_id")).alias("source_id"),
                                                                     (F.coalesce(F.size("graph.referenced_works"), F.lit(0)) > 0).alias("has"))
    c = raw.where("source_id is not null").groupBy("source_id").agg(F.count_if("has").alias("ours"), F.count("*").alias("all_"))
    r = F.col("ours") / F.col("all_")
    return c.agg(F.count("*").alias("sources"), F.round(F.percentile(r, 0.5), 6).alias("median_share"), F.round(F.min(r), 6).alias("least"), F.round(F.max(r), 6).alias("most"),
                 F.round(F.avg(F.when(F.col("ours") >= 0.9 * F.col("all_"), 1.0).otherwise(0.0)), 6).alias("nearly_all"))


@query(PP + r""", k AS (SELECT item_id, CASE WHEN url LIKE '%/abs/%' THEN 'preprint' WHEN url LIKE '%/article/%' THEN 'article' WHEN url LIKE '%/item/%' THEN 'deposit' WHEN url IS NULL OR trim(url) = '' THEN 'none' ELSE 'other' END AS kind FROM p)
SELECT kind, count(*) AS papers FROM k GROUP BY kind""")
def a83_kind_tally(spark, d):
    u = F.col("url")
    kind = (F.when(u.contains("/abs/"), "preprint").when(u.contains("/article/"), "article").when(u.contains("/item/"), "deposit")
            .when(u.isNull() | (F.trim(u) == ""), "none").otherwise("other"))
    return papers(spark, d).groupBy(kind.alias("kind")).agg(F.count("*").alias("papers"))


@query(PP + """, k AS (SELECT DISTINCT work_key FROM p), x AS (SELECT DISTINCT work_key FROM documents WHERE work_key IS NOT NULL)
SELECT count(*) AS known, count(x.work_key) AS resolved, round(count(x.work_key) / nullif(count(*), 0), 6) AS share FROM k LEFT JOIN x ON x.work_key = k.work_key""")
def a71_a72_resolved_share(spark, d):
    x = table(spark, d, "documents").where("work_key is not null").select("work_key").distinct().withColumn("x", F.lit(1))
    return papers(spark, d).select("work_key").distinct().join(x, "work_key", "left").agg(
        F.count("*").alias("known"), F.count("x").alias("resolved"), F.round(F.count("x") / F.nullif(F.count("*"), F.lit(0)), 6).alias("share"))


@query(PP + """ SELECT count(*) AS papers, count(*) FILTER (WHERE abstract IS NOT NULL) AS with_abstract, count(*) FILTER (WHERE openalex IS NOT NULL) AS with_openalex, count(*) FILTER (WHERE len(raw_refs) > 0) AS with_references,
  count(*) FILTER (WHERE state = 'published') AS published, count(*) FILTER (WHERE state = 'published' AND arxiv IS NOT NULL) AS published_with_arxiv, count(DISTINCT day) AS days FROM p""")
def a78_archive_counts(spark, d):
    raw = table(spark, d, "items").dropDuplicates(["item_id"])
    st = F.col("publication_status.state") == "published"
    return raw.agg(F.count("*").alias("papers"), F.count("bibliography.abstract").alias("with_abstract"), F.count("ids.openalex").alias("with_openalex"),
                   F.count_if(F.coalesce(F.size("graph.referenced_works"), F.lit(0)) > 0).alias("with_references"), F.count_if(st).alias("published"),
                   F.count_if(st & F.col("ids.arxiv").isNotNull()).alias("published_with_arxiv"), F.countDistinct("first_published").alias("days"))


@query(PP + """ SELECT coalesce(source_name, 'unknown') AS source, count(*) AS unreadable FROM p WHERE abstract IS NULL OR trim(abstract) = '' GROUP BY 1""")
def a32_a79_unreadable_by_source(spark, d):
    return (papers(spark, d).where("abstract is null or trim(abstract) = ''").groupBy(F.coalesce("source_name", F.lit("unknown")).alias("source"))
            .agg(F.count("*").alias("unreadable")))


@query(PT + """, m AS (SELECT max(day) AS today FROM p), w AS (SELECT p.source_id, t.subfield, sum(pow(0.5, greatest(date_diff('day', t.day, today), 0) / 180.0)) AS w FROM t JOIN p ON p.item_id = t.item_id, m
  WHERE p.source_id IS NOT NULL AND t.subfield IS NOT NULL AND t.day IS NOT NULL GROUP BY 1, 2)
SELECT subfield, count(*) AS sources, round(sum(w), 3) AS weighted, round(sum(w) / sum(sum(w)) OVER (), 4) AS share FROM w GROUP BY subfield""")
def a41_a68_weighted_shares(spark, d):
    """Decayed weight of each subfield over sources, and its share of all."""
    from quillspark.operators.citations import decayed

    x = topics(spark, d).join(papers(spark, d).select("item_id", "source_id"), "item_id").where("source_id is not null and subfield is not null and day is not null")
    last = papers(spark, d).agg(F.max("day").alias("today"))
    w = x.crossJoin(F.broadcast(last)).groupBy("source_id", "subfield").agg(F.sum(decayed(F.datediff("today", "day"), 180)).alias("w"))
    g = w.groupBy("subfield").agg(F.count("*").alias("sources"), F.sum("w").alias("w"))
    whole = g.agg(F.sum("w").alias("whole"))
    return g.crossJoin(F.broadcast(whole)).select("subfield", "sources", F.round("w", 3).alias("weighted"), F.round(F.col("w") / F.col("whole"), 4).alias("share"))


@query(PP + """, kept AS (SELECT day, count(*) AS n FROM p WHERE len(categories) > 0 GROUP BY day), rest AS (SELECT day, count(*) AS n FROM p WHERE len(categories) = 0 GROUP BY day)
SELECT coalesce(kept.day, rest.day) AS day, coalesce(kept.n, 0) AS kept, coalesce(rest.n, 0) AS rejected FROM kept FULL JOIN rest ON kept.day = rest.day WHERE coalesce(kept.day, rest.day) IS NOT NULL""")
def a64_intake_both_sides(spark, d):
    return papers(spark, d).where("day is not null").groupBy("day").agg(F.count_if(F.size("categories") > 0).alias("kept"), F.count_if(F.size("categories") == 0).alias("rejected"))


@query(PP + """, f AS (SELECT item_id, list_transform(flatten(list_transform(authors, lambda a: coalesce(a.institutions, []))), lambda i: i.name) AS l FROM p)
SELECT item_id, list_sort(list_distinct(list_filter(l, lambda x: x IS NOT NULL))) AS orgs FROM f""")
def s19_organisations_of_papers(spark, d):
    names = F.transform(F.flatten(F.transform("authors", lambda a: F.coalesce(a["institutions"], F.array()))), lambda i: i["name"])
    return papers(spark, d).select("item_id", F.array_sort(F.array_distinct(F.array_compact(names))).alias("orgs"))
