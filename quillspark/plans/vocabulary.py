"""Queries that read texts by vocabularies and rules: signals, genres, lines, terms, places, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import ids as I, signals as S, text as T
from quillspark.operators import metrics as M, vocabulary as V
from quillspark.operators.ranking import latest
from quillspark.plans.common import PP, PT, collection, papers, topics
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()

#: An example vocabulary: family, term, aliases.
FAMILIES = (("m:learning", "machine learning", (("m:forests", "random forests", ("causal forests",)), ("m:gnn", "graph neural networks", ()), ("m:llm", "large language models", ("language models",)))),
            ("m:space", "spatial methods", (("m:regression", "spatial regression", ("spatial lag models",)), ("m:syntax", "space syntax", ()), ("m:prisms", "space-time prisms", ()), ("m:density", "kernel density estimation", ()))),
            ("m:text", "text methods", (("m:topics", "topic models", ()), ("m:interviews", "walking interviews", ()))),
            ("d:traces", "trace data", (("d:phones", "mobile phone traces", ()), ("d:street", "street-view segmentation", ("street view segmentation",)), ("d:sensing", "remote sensing", ("satellite imagery",)))))
_FAMILIES = [(n, f, lab, [(i, t, list(a)) for i, t, a in ts]) for n, (f, lab, ts) in enumerate(FAMILIES)]
_ROWS = ", ".join(f"({n}, {at}, {k}, '{s}', '{i}', {p})" for n, (f, lab, ts) in enumerate(FAMILIES) for at, k, s, i, p in
                  [(-1, 0, lab, f, "NULL")] + [(m, k, s, i, f"'{f}'") for m, (i, t, al) in enumerate(ts) for k, s in enumerate((t, *al))])
_SURFACES = f"""v0(place, at_, k, surface, id, parent) AS (VALUES {_ROWS}), v1 AS (SELECT trim(replace(replace(lower(surface), '-', ' '), '_', ' ')) AS surface, id, parent, place, at_, k FROM v0),
  v AS (SELECT surface, id, parent FROM v1 QUALIFY row_number() OVER (PARTITION BY surface ORDER BY place, at_, k) = 1)"""
_X = r"x AS (SELECT item_id, state, url, trim(coalesce(title, '') || chr(10) || coalesce(abstract, '')) AS x, title, abstract FROM p)"


def families(spark):
    return spark.createDataFrame(_FAMILIES, "place int, id string, label string, terms array<struct<id:string,label:string,aliases:array<string>>>")


def _text():
    return F.trim(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("abstract", F.lit(""))))


@query(f"WITH {_SURFACES} SELECT surface, id, parent FROM v")
def s16_vocabulary(spark, d):
    """Families, terms and aliases as one table of surfaces; the first of equal surfaces counts."""
    return V.flattened(families(spark)).select("surface", "id", "parent")


@query(PP + rf""", {_SURFACES}, x AS (SELECT item_id, ' ' || trim(regexp_replace(regexp_replace(lower(coalesce(title, '') || ' ' || coalesce(abstract, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) || ' ' AS x FROM p)
SELECT item_id, id, max(least(0.95, 0.6 + 0.02 * len(string_split(surface, ' '))))::DOUBLE AS confidence FROM x JOIN v ON len(surface) >= 3 AND contains(x, ' ' || surface || ' ') GROUP BY item_id, id""")
def s15_vocabulary_scan(spark, d):
    """Vocabulary terms found in title or abstract, by a hash join on their first words."""
    x = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    return V.scan(papers(spark, d), "item_id", x, V.flattened(families(spark)))


@query(PP + rf""", {_SURFACES}, x AS (SELECT ' ' || trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) || ' ' AS x, item_id, day FROM p),
  h AS (SELECT DISTINCT item_id, day, id, parent FROM x JOIN v ON contains(x, ' ' || surface || ' ')) SELECT id, any_value(parent) AS parent, count(*) AS mentions, min(day) AS first_seen FROM h GROUP BY id""")
def s17_terms_with_parents(spark, d):
    """Term nodes with their family."""
    v = V.flattened(families(spark))
    hits = V.scan(papers(spark, d), "item_id", F.coalesce("title", F.lit("")), v)
    parents = v.groupBy("id").agg(F.max("parent").alias("parent"))
    return (hits.join(papers(spark, d).select("item_id", "day"), "item_id").join(parents, "id").groupBy("id", "parent")
            .agg(F.count("*").alias("mentions"), F.min("day").alias("first_seen")))


def _venues(spark, d):
    """The named sources as a vocabulary of venues."""
    s = table(spark, d, "sources").select(V.surface(F.col("source_name")).alias("surface"), F.col("source_id").alias("id"), F.col("source_id").alias("place"))
    return s.groupBy("surface").agg(F.min("id").alias("id"), F.min("place").alias("place"))


@query()
def s14_vocabulary_match(spark, d):
    """Venues as listings name them against the named sources: exact, else the most similar from 88 per cent on."""
    return V.matched(table(spark, d, "listings"), "venue", _venues(spark, d))


@query(r"""WITH v AS (SELECT trim(regexp_replace(replace(replace(lower(source_name), '-', ' '), '_', ' '), '\s+', ' ', 'g')) AS s, min(source_id) AS id FROM sources GROUP BY 1),
  t AS (SELECT DISTINCT venue AS term, trim(regexp_replace(replace(replace(lower(venue), '-', ' '), '_', ' '), '\s+', ' ', 'g')) AS s FROM listings WHERE trim(venue) <> '') SELECT term, v.id FROM t JOIN v ON v.s = t.s""")
def s14_exact_match(spark, d):
    """The part of ``s14_vocabulary_match`` that SQL can state: equal surfaces."""
    return V.matched(table(spark, d, "listings"), "venue", _venues(spark, d), least=100.01).where("id is not null").select("term", "id")


@query(r"""WITH v AS (SELECT DISTINCT trim(regexp_replace(replace(replace(lower(source_name), '-', ' '), '_', ' '), '\s+', ' ', 'g')) AS s FROM sources),
  t AS (SELECT DISTINCT work_key, venue AS term, trim(regexp_replace(replace(replace(lower(venue), '-', ' '), '_', ' '), '\s+', ' ', 'g')) AS s FROM listings WHERE trim(venue) <> '')
SELECT s AS term, count(DISTINCT work_key) AS works FROM t WHERE s NOT IN (SELECT s FROM v) GROUP BY s""")
def a53_unmatched_terms(spark, d):
    """Venue names that no named source bears, by the number of works."""
    t = table(spark, d, "listings").where("trim(venue) <> ''").select("work_key", V.surface(F.col("venue")).alias("term")).distinct()
    return t.join(_venues(spark, d).select(F.col("surface").alias("term")), "term", "left_anti").groupBy("term").agg(F.count("*").alias("works"))


@query(r"""WITH t AS (SELECT DISTINCT lower(p_brand) AS term FROM part), b AS (SELECT term, trim(regexp_extract(term, '^(.*?[^\s\d#.v-])[\s#-]*v?\d+(?:\.\d+)*$', 1)) AS base FROM t), k(s) AS (VALUES ('brand'), ('model'))
SELECT term, base AS alias_of FROM b WHERE base IN (SELECT s FROM k)""")
def s37_alias_of(spark, d):
    """Terms that are a known surface with a version at its end."""
    known = spark.createDataFrame([("brand",), ("model",)], "alias_of string")
    t = table(spark, d, "part").select(F.lower("p_brand").alias("term")).distinct()
    return t.withColumn("alias_of", V.without_version(F.col("term"))).join(known, "alias_of", "left_semi").select("term", "alias_of")


_STOP = "of in for and the a an to with on by from through how can as at".split()


@query(PP + rf""", w AS (SELECT item_id, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM p),
  g AS (SELECT item_id, w[i:i + n - 1] AS g, n FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (VALUES (2), (3)) k(n) WHERE len(w) >= n)),
  u AS (SELECT DISTINCT item_id, array_to_string(g, ' ') AS phrase FROM g WHERE NOT list_contains({_STOP}, g[1]) AND NOT list_contains({_STOP}, g[n])) SELECT phrase, count(*) AS n FROM u GROUP BY phrase HAVING count(*) >= 3""")
def a52_phrase_mining(spark, d):
    """Phrases of two and three words in titles, none with a stop word at its ends, by the number of titles."""
    return V.mined(papers(spark, d), "item_id", F.coalesce("title", F.lit("")), _STOP)


@query()
def s39_longest_runs(spark, d):
    """Records of one work: the longest run of words that two abstracts in a row, by time of collection, share."""
    from pyspark.sql import Window
    w = Window.partitionBy("work_key").orderBy("collected_at", "item_id")
    x = papers(spark, d).where("trim(abstract) <> ''").withColumn("before", F.lag("abstract").over(w)).where("before is not null")
    return x.select("work_key", "item_id", V.longest_common_run("before", "abstract").alias("r")).select("work_key", "item_id", "r.words", "r.at")


@query(r"""WITH g AS (SELECT doc_id, w[i:i+7] AS g FROM (SELECT doc_id, string_split(text, ' ') AS w, unnest(range(1, len(string_split(text, ' ')) - 6)) AS i FROM (SELECT DISTINCT doc_id, text FROM documents))),
 u AS (SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g FROM g) SELECT g AS shingle, count(*) AS docs FROM u GROUP BY g HAVING count(*) >= 5""")
def s39_shared_runs(spark, d):
    """Runs of eight words that stand in at least five documents."""
    return V.shared_runs(table(spark, d, "documents"), "doc_id", "text")


def _sql_signal(cases, other):
    return "CASE " + " ".join(f"WHEN {c} THEN {{'value': {v}, 'confidence': '{k}', 'detail': {x}}}" for c, v, k, x in cases) + f" ELSE {{'value': false, 'confidence': '{other}', 'detail': NULL::VARCHAR}} END"


_UNITS = "|".join(S.SAMPLE_UNITS)
_NO = r"regexp_matches(x, '(?i)\b(neither\s+the\s+data\s+nor\s+the\s+code|not\s+publicly\s+(available|released))\b')"
_HOST = r"(?i)https?://(www\.)?(github\.com|gitlab\.com|bitbucket\.org|codeberg\.org)/[\w.\-]+/[\w.\-]+"
_NUMBER = rf"(?i)\b\d[\d,.]*\s*(k|m|b|million|billion|thousand)?\s*({_UNITS})\b"
_LOOSE = r"(?i)\b(from|between|since)\s+(19|20)\d{2}\b|\b\d+\s+(years|months|weeks)\s+of\b"
_YEARS = r"(?i)\b(19|20)\d{2}\s*(-|–|—|to|through|and)\s*(19|20)\d{2}\b"
_CODE = _sql_signal([(_NO, "false", "high", "NULL"), (f"regexp_matches(x, '{_HOST}')", "true", "high", f"rtrim(regexp_extract(x, '{_HOST}'), '.,);')"),
                     (r"regexp_matches(x, '(?i)\b(code|implementation)\s+(is\s+)?(publicly\s+)?(available|released)\b')", "true", "medium", "NULL")], "medium")
_DATA = _sql_signal([(_NO, "false", "high", "NULL"), ("lower(url) LIKE '%deposit%'", "true", "high", "url"),
                     (r"regexp_matches(x, '(?i)\bwe\s+(release|publish|make\s+available)\b[^.]{0,60}\bdata') OR regexp_matches(x, '(?i)\b(data|datasets?)\s+(is|are)?\s*(publicly\s+)?(available|released|open)\b')",
                      "true", "medium", "NULL")], "low")
_SIZE = _sql_signal([(f"regexp_matches(x, '{_NUMBER}')", "true", "high", f"trim(regexp_extract(x, '{_NUMBER}'))"), (r"regexp_matches(x, '(?i)\bn\s*=\s*\d[\d,]*')", "true", "high", r"trim(regexp_extract(x, '(?i)\bn\s*=\s*\d[\d,]*'))")], "medium")
_SPAN = _sql_signal([(f"regexp_matches(x, '{_YEARS}')", "true", "high", f"trim(regexp_extract(x, '{_YEARS}'))"), (f"regexp_matches(x, '{_LOOSE}')", "true", "high", f"trim(regexp_extract(x, '{_LOOSE}'))")], "medium")


def _all_signals(t, deposits, state):
    code, data, size, span = S.code_signal(t), S.data_signal(t, deposits), S.sample_signal(t), S.period_signal(t)
    return [code["value"].alias("code"), code["confidence"].alias("code_confidence"), code["detail"].alias("code_address"), data["value"].alias("data"), data["confidence"].alias("data_confidence"),
            size["detail"].alias("sample"), span["detail"].alias("period"), F.array_join(S.badges(code, data, state), " ").alias("badges")]


_SIGNALS = (f"y AS (SELECT *, {_CODE} AS c, {_DATA} AS dd, {_SIZE} AS s, {_SPAN} AS t FROM x) SELECT KEY, c.value AS code, c.confidence AS code_confidence, c.detail AS code_address, dd.value AS data, dd.confidence AS data_confidence, "
            "s.detail AS sample, t.detail AS period, concat_ws(' ', CASE WHEN c.value THEN 'code' END, CASE WHEN dd.value THEN 'data' END, CASE WHEN state = 'published' THEN 'published' ELSE 'preprint' END) AS badges FROM y")


@query(PP + f", {_X}, " + _SIGNALS.replace("KEY", "item_id"))
def s21_s24_signals(spark, d):
    """Signals about code, data, samples and periods in titles and abstracts, and the badges they give; a deposit's address is one that names it."""
    deposits = S.repository_addresses(F.array("url"), ("deposit",))
    return papers(spark, d).select("item_id", *_all_signals(_text(), deposits, F.col("state")))


@query("WITH x AS (SELECT DISTINCT doc_id, text AS x, NULL::VARCHAR AS url, lang AS state FROM documents), " + _SIGNALS.replace("KEY", "doc_id"))
def s21_s24_document_signals(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text", "lang").distinct()
    return t.select("doc_id", *_all_signals(F.col("text"), F.array().cast("array<string>"), F.col("lang")))


@query(PP + r""", t AS (SELECT 'i' || item_id AS id, title, source_name AS kind FROM p UNION ALL SELECT DISTINCT 'l' || listing_id, title, venue FROM listings), x AS (SELECT id, coalesce(title, '') AS t, coalesce(lower(kind) = 'book-review', false) AS typed,
  coalesce(lower(kind) IN ('erratum', 'correction', 'retraction'), false) AS typed2 FROM t),
  s AS (SELECT id, regexp_matches(t, '(?i)<(/)?(em|i|scp)>') AS markup, regexp_matches(t, ',\s*by\s+[A-Z][\w''’.\-]+') AS by_author, regexp_matches(t, '(?i)^\s*(book\s+review|review\s+essay|review\s*:|reviews\s*:|review\s+of\s+[a-z"“<])') AS genre, typed,
    regexp_matches(t, '(?i)^\s*["''“‘(\[]*\s*(corrigendum|errat(um|a)|correction|retraction|withdrawal|addendum|publisher(''?s?)? note|editorial expression of concern)\b') AS phrase, typed2 FROM x)
SELECT id, markup, by_author, genre, genre OR typed OR (markup AND by_author) AS review, phrase, phrase OR typed2 AS notice, CASE WHEN genre OR typed OR (markup AND by_author) OR phrase OR typed2 THEN 0.0 ELSE 1.0 END::DOUBLE AS weight FROM s""")
def f5_f7_detectors(spark, d):
    """Signs of book reviews and notices in all titles, and the weight that ranks them last."""
    t = papers(spark, d).select(F.concat(F.lit("i"), "item_id").alias("id"), "title", F.col("source_name").alias("kind")).union(
        table(spark, d, "listings").select(F.concat(F.lit("l"), "listing_id"), "title", "venue").distinct())
    b, c = S.book_review(F.col("title"), F.col("kind")), S.correction(F.col("title"), F.col("kind"))
    return t.select("id", b["markup"].alias("markup"), b["by_author"].alias("by_author"), b["genre"].alias("genre"), b["review"].alias("review"), c["phrase"].alias("phrase"), c["notice"].alias("notice"),
                    S.demotion(b["review"], c["notice"]).alias("weight"))


def _any(words):
    return "(?i)\\b(" + "|".join(words).replace("'", "''") + ")\\b"


@query(rf"""WITH l AS (SELECT DISTINCT listing_id, trim(coalesce(title, '')) AS t, lower(coalesce(venue, '')) AS m FROM listings), x AS (SELECT listing_id, t, len(regexp_split_to_array(t, '\s+')) AS n,
   lower(nullif(regexp_extract(t, '{_any(S.BANNED)}'), '')) AS banned, len(regexp_extract_all(t, '(?i)\bfirst\b')) > len(regexp_extract_all(t, '(?i)\bfirst\b\s*[-–]\s*(mile|order|come|hand|person|author|stage|principle)')) AS first_,
   lower(nullif(regexp_extract(t, '{_any(S.QUANTITIES)}'), '')) AS quantity, lower(nullif(regexp_extract(t, '{_any(S.RELATIONS)}'), '')) AS relation,
   list_filter(regexp_extract_all(t, '\d[\d,.]*') || regexp_extract_all(t, '{_any(S.NUMBER_WORDS)}'), lambda w: NOT contains(m, lower(w)))[1] AS lost FROM l)
SELECT listing_id, CASE WHEN t = '' THEN 'empty' WHEN contains(t, chr(10)) THEN 'lines' WHEN n > 12 THEN 'words' WHEN right(t, 1) IN ('.', '!', '?') THEN 'ending' WHEN left(t, 1) IN ('"', '''', '“') THEN 'quotes' WHEN banned IS NOT NULL THEN 'banned'
  WHEN first_ THEN 'first' WHEN list_contains({S.QUESTIONS}, lower(regexp_extract(t, '^\w+'))) THEN 'question' WHEN quantity IS NOT NULL THEN 'quantity' WHEN relation IS NOT NULL THEN 'relation' WHEN lost IS NOT NULL THEN 'number' END AS rule,
  CASE WHEN t = '' OR contains(t, chr(10)) THEN NULL WHEN n > 12 THEN n::VARCHAR WHEN right(t, 1) IN ('.', '!', '?') OR left(t, 1) IN ('"', '''', '“') THEN NULL WHEN banned IS NOT NULL THEN banned
  WHEN first_ OR list_contains({S.QUESTIONS}, lower(regexp_extract(t, '^\w+'))) THEN NULL WHEN quantity IS NOT NULL THEN quantity WHEN relation IS NOT NULL THEN relation ELSE lost END AS detail FROM x""")
def f22_line_check(spark, d):
    """Listing titles as headline lines, their venue as the material: the first rule each breaks."""
    v = S.line_violation(F.col("title"), F.col("venue"))
    return table(spark, d, "listings").select("listing_id", v["rule"].alias("rule"), v["detail"].alias("detail")).distinct()


@query(PP + """, u AS (SELECT item_id, list_distinct(list_filter(list_transform(categories, lambda c: lower(trim(c))), lambda c: c <> '')) AS c, title, abstract FROM p)
SELECT item_id, coalesce(trim(title), '') <> '' AND coalesce(trim(abstract), '') <> '' AS valid, CASE WHEN coalesce(trim(title), '') <> '' AND coalesce(trim(abstract), '') <> '' THEN len(c[1:6]) END AS tags FROM u""")
def f23_payload_check(spark, d):
    """Payloads whose required texts are filled; their lists lower-cased, trimmed, each term once in order, at most six."""
    tags = F.slice(F.array_distinct(F.filter(F.transform("categories", lambda c: F.lower(F.trim(c))), lambda c: c != "")), 1, 6)
    fine = F.coalesce(F.trim("title") != "", F.lit(False)) & F.coalesce(F.trim("abstract") != "", F.lit(False))
    return papers(spark, d).select("item_id", fine.alias("valid"), F.when(fine, F.size(tags).cast("bigint")).alias("tags"))


@query(r"""WITH x AS (SELECT DISTINCT doc_id, text FROM documents) SELECT doc_id, regexp_matches(lower(text), '<img[^>]+(width|height)=["'']?1["'']?|utm_[a-z]+=|google-analytics\.com|[?&](fbclid|gclid)=') AS tracked FROM x""")
def f21_tracking(spark, d):
    """Texts with traces of tracking."""
    p = r"""<img[^>]+(width|height)=["']?1["']?|utm_[a-z]+=|google-analytics\.com|[?&](fbclid|gclid)="""
    return table(spark, d, "documents").select("doc_id", F.lower("text").rlike(p).alias("tracked"), "text").distinct().select("doc_id", "tracked")


@query(PP + """, t AS (SELECT 'i' || item_id AS id, title FROM p UNION ALL SELECT DISTINCT 'l' || listing_id, title FROM listings)
SELECT id, contains(lower(title), 'a review of') OR contains(lower(title), 'systematic review') OR contains(lower(title), 'literature review') OR contains(lower(title), 'scoping review') OR contains(lower(title), 'meta-analysis') AS review,
  contains(lower(title), ':') AS two_parts FROM t WHERE title IS NOT NULL""")
def f15_review_titles(spark, d):
    t = papers(spark, d).select(F.concat(F.lit("i"), "item_id").alias("id"), "title").union(table(spark, d, "listings").select(F.concat(F.lit("l"), "listing_id"), "title").distinct())
    return t.where("title is not null").select("id", F.lower("title").rlike("a review of|systematic review|literature review|scoping review|meta-analysis").alias("review"), F.col("title").contains(":").alias("two_parts"))


@query(PP + r""", x AS (SELECT item_id, len(list_distinct(regexp_extract_all(lower(coalesce(title, '')), '\b(sensing|traces|models|regression|forests|networks|estimation|segmentation)\b'))) AS in_title,
  len(list_distinct(regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(abstract, '')), '\b(sensing|traces|models|regression|forests|networks|estimation|segmentation)\b'))) AS in_all,
  regexp_matches(lower(coalesce(title, '') || ' ' || coalesce(abstract, '')), '\bneural networks\b') AS strong FROM p) SELECT item_id, in_title, in_all, in_title >= 2 OR (strong AND in_all >= 2) AS drifts FROM x""")
def f16_drift(spark, d):
    """Papers of another field by its terms: two in the title, or a strong one and one more."""
    terms = F.lit(r"\b(sensing|traces|models|regression|forests|networks|estimation|segmentation)\b")
    t, x = F.lower(F.coalesce("title", F.lit(""))), F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))))
    n = lambda c: F.size(F.array_distinct(F.regexp_extract_all(c, terms, F.lit(0)))).cast("bigint")
    return papers(spark, d).select("item_id", n(t).alias("in_title"), n(x).alias("in_all"), ((n(t) >= 2) | (x.rlike(r"\bneural networks\b") & (n(x) >= 2))).alias("drifts"))


_PLACES = """b AS (SELECT lower(trim(city)) AS k, upper(trim(country)) AS c, count(*) AS n FROM (SELECT DISTINCT * FROM institutions) WHERE trim(city) <> '' GROUP BY 1, 2),
  known AS (SELECT k, 'place:' || k AS id, max_by(c, n * 1000 - ascii(coalesce(c, 'z'))) AS country FROM b GROUP BY k), alias(k, id) AS (VALUES ('qp', 'place:country-qp'), ('xa', 'place:country-xa'))"""


def _places(spark, d):
    b = (table(spark, d, "institutions").distinct().where("trim(city) <> ''").groupBy(F.lower(F.trim("city")).alias("k"), F.upper(F.trim("country")).alias("c")).agg(F.count("*").alias("n")))
    known = b.groupBy("k").agg(F.max_by("c", F.col("n") * 1000 - F.ascii(F.coalesce("c", F.lit("z")))).alias("country")).select("k", F.concat(F.lit("place:"), "k").alias("id"), "country")
    return known, spark.createDataFrame([("qp", "place:country-qp"), ("xa", "place:country-xa")], "k string, id string")


@query(f"""WITH {_PLACES}, x AS (SELECT DISTINCT inst_id, lower(trim(regexp_replace(coalesce(nullif(trim(city), ''), country), '\\s+', ' ', 'g'))) AS k FROM institutions)
SELECT inst_id, coalesce(a.id, known.id) AS place, CASE WHEN a.id IS NOT NULL THEN 'alias' WHEN known.id IS NOT NULL THEN 'table' ELSE 'none' END AS basis FROM x LEFT JOIN alias a ON a.k = x.k LEFT JOIN known ON known.k = x.k""")
def j21_place_lookup(spark, d):
    """Place names looked up among aliases, then in the table of places."""
    known, alias = _places(spark, d)
    x = table(spark, d, "institutions").select("inst_id", F.lower(T.squeeze(F.coalesce(T.blank_to_null(F.col("city")), "country"))).alias("k")).distinct()
    j = x.join(alias.withColumnRenamed("id", "a"), "k", "left").join(known.select("k", "id"), "k", "left")
    return j.select("inst_id", F.coalesce("a", "id").alias("place"), F.when(F.col("a").isNotNull(), "alias").when(F.col("id").isNotNull(), "table").otherwise("none").alias("basis"))


@query(PP + f""", {_PLACES}, c AS (SELECT item_id, unnest(regexp_extract_all(coalesce(title, ''), '(?:in|around|from|and|&) (\\p{{Lu}}[\\p{{L}}\\-]+)', 1)) AS c, unnest(range(len(regexp_extract_all(coalesce(title, ''), '(?:in|around|from|and|&) (\\p{{Lu}}[\\p{{L}}\\-]+)', 1)))) AS at_ FROM p),
  j AS (SELECT c.item_id, c.c, c.at_, known.id FROM c LEFT JOIN known ON known.k = lower(c.c)), f AS (SELECT item_id, id, min(at_) AS at_ FROM j WHERE id IS NOT NULL GROUP BY 1, 2),
  r AS (SELECT item_id, list(id ORDER BY at_) AS places FROM f GROUP BY 1), u AS (SELECT item_id, count(*) FILTER (WHERE id IS NULL) AS unmatched FROM j GROUP BY 1)
SELECT p.item_id, coalesce(r.places, []) AS places, coalesce(u.unmatched, 0) AS unmatched, CASE WHEN r.places IS NULL THEN 'unspecified' ELSE 'resolved' END AS status FROM p LEFT JOIN r ON r.item_id = p.item_id LEFT JOIN u ON u.item_id = p.item_id""")
def s18_place_links(spark, d):
    """Places named in titles: their ids in order, each once, how many names are unknown, and the status."""
    known, _ = _places(spark, d)
    names = F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(r"(?:in|around|from|and|&) (\p{Lu}[\p{L}\-]+)"), F.lit(1))
    c = papers(spark, d).select("item_id", F.posexplode(names).alias("at", "c")).withColumn("k", F.lower("c"))
    f = c.join(known.select("k", "id"), "k", "left").groupBy("item_id", "id").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    g = f.groupBy("item_id").agg(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "id")))).alias("l"), F.sum(F.when(F.col("id").isNull(), F.col("n"))).alias("unmatched"))
    out = papers(spark, d).select("item_id").join(g, "item_id", "left")
    ids = F.coalesce(F.transform("l", lambda x: x["id"]), F.array().cast("array<string>"))
    return out.select("item_id", ids.alias("places"), F.coalesce("unmatched", F.lit(0)).alias("unmatched"), F.when(F.size(ids) > 0, "resolved").otherwise("unspecified").alias("status"))


@query(PP + r""", a AS (SELECT item_id, unnest(authors) AS a, unnest(range(len(authors))) AS at_ FROM p), k AS (SELECT item_id, at_, coalesce('orcid:' || nullif(regexp_extract(regexp_replace(upper(a.orcid), '[^0-9X]', '', 'g'), '([0-9]{15}[0-9X])$', 1), ''),
  'openalex:' || nullif(upper(regexp_extract(trim(a.openalex), '([^/:\s]+)/*$', 1)), '')) AS id FROM a WHERE trim(a.name) <> ''), f AS (SELECT item_id, id, min(at_) AS at_ FROM k WHERE id IS NOT NULL GROUP BY 1, 2)
SELECT p.item_id, coalesce((SELECT list(id ORDER BY at_) FROM f WHERE f.item_id = p.item_id), []) AS people  FROM p""")
def s19_s20_people(spark, d):
    """People of a paper by ORCID, else by OpenAlex id, in order and each once; people without a name or an id are left out."""
    key = lambda a: F.coalesce(F.concat(F.lit("orcid:"), I._some(F.regexp_extract(F.regexp_replace(F.upper(a["orcid"]), "[^0-9X]", ""), r"([0-9]{15}[0-9X])$", 1))),
                               F.concat(F.lit("openalex:"), I.bare_segment(a["openalex"])))
    people = F.array_distinct(F.array_compact(F.transform(F.filter("authors", lambda a: F.trim(a["name"]) != ""), key)))
    return papers(spark, d).select("item_id", people.alias("people"))


_ROUTES = "n(needle, route, ord) AS (VALUES ('archive', 'archive', 1), ('repository', 'archive', 2), ('preprint', 'preprint', 3), ('quarterly', 'society', 4), ('review', 'society', 5))"


@query(PP + f""", {_ROUTES}, s AS (SELECT DISTINCT source_name FROM p WHERE source_name IS NOT NULL), h AS (SELECT source_name, min_by(route, ord) AS route FROM s JOIN n ON contains(lower(source_name), needle) GROUP BY 1)
SELECT coalesce(h.route, 'default') AS route, count(*) AS papers, count(abstract) AS with_abstract FROM p LEFT JOIN h ON h.source_name = p.source_name GROUP BY 1""")
def sc23_routing(spark, d):
    """The route of each source: the first needle of an ordered table found in its name. Distinct names meet the table; papers join on the name."""
    n = [("archive", "archive"), ("repository", "archive"), ("preprint", "preprint"), ("quarterly", "society"), ("review", "society")]
    names = papers(spark, d).select("source_name").where("source_name is not null").distinct()
    route = F.coalesce(*(F.when(F.lower("source_name").contains(a), b) for a, b in n))
    p = papers(spark, d).select("source_name", "abstract").join(names.withColumn("route", route), "source_name", "left")
    return p.groupBy(F.coalesce("route", F.lit("default")).alias("route")).agg(F.count("*").alias("papers"), F.count("abstract").alias("with_abstract"))


@query(PP + r""", x AS (SELECT item_id, source_name, nullif(split_part(regexp_replace(lower(trim(doi)), '^(https?://(dx\.)?doi\.[a-z]+/|doi:\s*)', ''), '/', 1), '') AS prefix FROM p),
  m AS (SELECT prefix, source_name, count(*) AS n FROM x WHERE prefix IS NOT NULL AND source_name IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3), k AS (SELECT DISTINCT ON (prefix) prefix, source_name FROM m ORDER BY prefix, n DESC, source_name)
SELECT item_id, coalesce(k.source_name, x.prefix, 'unknown') AS publisher FROM x LEFT JOIN k ON k.prefix = x.prefix""")
def sc24_publishers(spark, d):
    """The publisher of each DOI by the table of prefixes, else the prefix itself, else unknown. The table holds for each prefix the commonest source."""
    x = papers(spark, d).select("item_id", "source_name", I._some(F.split_part(I.doi(F.col("doi")), F.lit("/"), F.lit(1))).alias("prefix"))
    m = x.where("prefix is not null and source_name is not null").groupBy("prefix", "source_name").agg(F.count("*").alias("n")).where("n >= 3")
    k = m.groupBy("prefix").agg(F.min_by("source_name", F.struct(-F.col("n"), F.col("source_name"))).alias("publisher"))
    return x.join(k, "prefix", "left").select("item_id", F.coalesce("publisher", "prefix", F.lit("unknown")).alias("publisher"))


@query(PP + """, q AS (SELECT work_key, collector, abstract, row_number() OVER (PARTITION BY work_key, collector ORDER BY collected_at, item_id) AS rn FROM (SELECT work_key, unnest(collectors) AS collector, abstract, collected_at, item_id FROM p WHERE trim(abstract) <> '')),
  w AS (SELECT DISTINCT work_key FROM p), f AS (SELECT work_key, max(CASE WHEN collector = 'openalex' THEN abstract END) AS a, max(CASE WHEN collector = 'crossref' THEN abstract END) AS b, max(CASE WHEN collector = 'arxiv' THEN abstract END) AS c FROM q WHERE rn = 1 GROUP BY 1)
SELECT w.work_key, coalesce(a, b, c) AS abstract, CASE WHEN a IS NOT NULL THEN 'openalex' WHEN b IS NOT NULL THEN 'crossref' WHEN c IS NOT NULL THEN 'arxiv' ELSE 'none' END AS abstract_source FROM w LEFT JOIN f ON f.work_key = w.work_key""")
def sc22_abstract_fill(spark, d):
    """Each work's abstract from the first collector that has one, in a fixed order, with where it came from."""
    p = papers(spark, d)
    q = p.where("trim(abstract) <> ''").select("work_key", "abstract", F.struct("collected_at", "item_id").alias("o"), F.explode("collectors").alias("collector"))
    order = ("openalex", "crossref", "arxiv")
    f = q.groupBy("work_key").agg(*(F.min_by("abstract", F.when(F.col("collector") == c, F.col("o"))).alias(c) for c in order))
    source = F.coalesce(*(F.when(F.col(c).isNotNull(), c) for c in order), F.lit("none"))
    return p.select("work_key").distinct().join(f, "work_key", "left").select("work_key", F.coalesce(*order).alias("abstract"), source.alias("abstract_source"))


@query(PP + r""" SELECT item_id, coalesce(array_to_string(list_filter(list_transform(authors[1:3], lambda a: a.name), lambda n: n IS NOT NULL), ', '), '') || CASE WHEN len(authors) > 3 THEN ' et al.' ELSE '' END AS byline,
  CASE WHEN state = 'published' AND arxiv IS NOT NULL THEN CASE WHEN len(categories) > 0 AND categories[1] IS NOT NULL THEN 'was arXiv [' || categories[1] || ']' ELSE 'was arXiv' END END AS note,
  CASE WHEN trim(coalesce(abstract, '')) = '' THEN 'no abstract' WHEN len(string_split(trim(abstract), '. ')[1]) > 0 THEN 'opening' ELSE 'title' END AS basis,
  CASE WHEN trim(coalesce(abstract, '')) = '' THEN title ELSE CASE WHEN right(trim(string_split(abstract, '. ')[1]), 1) = '.' THEN trim(string_split(abstract, '. ')[1]) ELSE trim(string_split(abstract, '. ')[1]) || '.' END END AS line,
  trim(coalesce(title, '')) || chr(10) || chr(10) || trim(coalesce(abstract, '')) AS embed_text, trim(regexp_replace(title, '</?[a-zA-Z][^<>]*>', '', 'g')) AS plain FROM p""")
def s46_s50_cards(spark, d):
    """Display rows: byline, note, the basis and text of the line, the text to embed, the title without tags."""
    names = F.filter(F.transform(F.slice("authors", 1, 3), lambda a: a["name"]), lambda n: n.isNotNull())
    first = F.trim(F.split_part("abstract", F.lit(". "), F.lit(1)))
    none = F.trim(F.coalesce("abstract", F.lit(""))) == ""
    cat = F.get("categories", 0)
    return papers(spark, d).select(
        "item_id", F.concat(F.array_join(names, ", "), F.when(F.size("authors") > 3, " et al.").otherwise("")).alias("byline"),
        F.when((F.col("state") == "published") & F.col("arxiv").isNotNull(), F.coalesce(F.concat(F.lit("was arXiv ["), cat, F.lit("]")), F.lit("was arXiv"))).alias("note"),
        F.when(none, "no abstract").when(F.length(first) > 0, "opening").otherwise("title").alias("basis"),
        F.when(none, F.col("title")).otherwise(F.when(first.endswith("."), first).otherwise(F.concat(first, F.lit(".")))).alias("line"),
        F.concat(F.trim(F.coalesce("title", F.lit(""))), F.lit("\n\n"), F.trim(F.coalesce("abstract", F.lit("")))).alias("embed_text"),
        F.trim(F.regexp_replace("title", r"</?[a-zA-Z][^<>]*>", "")).alias("plain"))


@query(PP + r""" SELECT item_id, CASE WHEN published IS NULL THEN 'unknown' WHEN strftime(published, '%m-%d') = '01-01' THEN 'year' WHEN day(published) = 1 THEN 'month' ELSE 'day' END AS precision,
  CASE WHEN regexp_matches(coalesce(doi, ''), '(?i)10\.48550') THEN 'arxiv' WHEN doi IS NULL THEN 'none' ELSE 'other' END AS doi_kind, try_cast(left(published::VARCHAR, 10) AS DATE) AS parsed, 'openalex:' || nullif(regexp_extract(trim(openalex), '([^/:]+)/*$', 1), '') AS norm_id,
  '10.48550/arxiv.' || nullif(regexp_extract(arxiv, '(\d{4}\.\d{4,5})', 1), '') AS arxiv_doi, regexp_replace(abstract, '^(Abstract: |Abstract |ABSTRACT |Summary )', '') AS body FROM p""")
def s32_s51_dates_and_ids(spark, d):
    """Precision of dates, lenient parsing, ids in one shape, the DOI of an arXiv id, abstracts without their heading."""
    p = F.col("published")
    return papers(spark, d).select(
        "item_id", F.when(p.isNull(), "unknown").when(F.date_format(p, "MM-dd") == "01-01", "year").when(F.dayofmonth(p) == 1, "month").otherwise("day").alias("precision"),
        F.when(F.col("doi").rlike(r"10\.48550"), "arxiv").when(F.col("doi").isNull(), "none").otherwise("other").alias("doi_kind"), F.try_to_date(p.cast("string")).alias("parsed"),
        F.concat(F.lit("openalex:"), I._some(F.regexp_extract(F.trim("openalex"), r"([^/:]+)/*$", 1))).alias("norm_id"), F.concat(F.lit("10.48550/arxiv."), I.arxiv_id(F.col("arxiv"))).alias("arxiv_doi"),
        F.regexp_replace("abstract", "^(Abstract: |Abstract |ABSTRACT |Summary )", "").alias("body"))


@query("""WITH r AS (SELECT DISTINCT record_id, payload FROM raw_works) SELECT record_id, CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END AS readable FROM r""")
def s44_json_of_answers(spark, d):
    """JSON out of answers that wrap it in a fence and talk around it."""
    r = table(spark, d, "raw_works").select("record_id", "payload").distinct()
    answer = F.when(F.col("record_id") % 2 == 0, F.concat(F.lit("```json\n"), "payload", F.lit("\n```"))).otherwise(F.concat(F.lit("Here you are: "), "payload", F.lit(" Done.")))
    got = F.try_parse_json(T.json_block(answer))
    return r.select("record_id", F.coalesce(F.try_variant_get(got, "$", "map<string,variant>").isNotNull(), F.lit(False)).alias("readable"))


@query(PT + """, k AS (SELECT item_id, topic, label, round(score, 4) AS score, coalesce(is_primary, false) AS is_primary, row_number() OVER (PARTITION BY item_id, topic ORDER BY pos) AS rn FROM t) SELECT item_id, topic, label, score, is_primary FROM k WHERE rn = 1""")
def s19_topics(spark, d):
    """Topics of a paper, each once by its first place, the score to four digits."""
    return latest(topics(spark, d), ["item_id", "topic"], [F.col("pos")]).select("item_id", "topic", "label", F.round("score", 4).alias("score"), F.coalesce("is_primary", F.lit(False)).alias("is_primary"))


@query(PT + """, s AS (SELECT subfield, max(score) AS top, count(*) AS n FROM t WHERE subfield IS NOT NULL GROUP BY 1) SELECT CASE WHEN subfield IN ('9901', '9903') THEN 'single_city' WHEN subfield = '9905' THEN 'global' END AS scope, sum(n)::BIGINT AS n FROM s GROUP BY 1""")
def s25_scopes(spark, d):
    """Scopes of five allowed values, others null."""
    s = topics(spark, d).where("subfield is not null").groupBy("subfield").agg(F.count("*").alias("n"))
    raw = F.when(F.col("subfield").isin("9901", "9903"), "single_city").when(F.col("subfield") == "9905", "global").otherwise("planet")
    return s.groupBy(S.scope(raw).alias("scope")).agg(F.sum("n").alias("n"))


def headline_scores(spark, d):
    """Relevance, novelty, multiplicity and completeness of each paper, weighted 0.4, 0.2, 0.2 and 0.2."""
    from quillspark.plans import daily, words
    r, n, m = words.s26_heuristic_relevance(spark, d), daily.s29_j22_novelty(spark, d), daily.s27_s28_components(spark, d)
    j = r.join(n, "item_id").join(m, "item_id")
    return j.withColumn("score", F.round(0.4 * F.col("relevance") + 0.2 * F.col("novelty") + 0.2 * F.col("multiplicity") + 0.2 * F.col("completeness"), 4))


def _named(sql, name):
    return f"{name} AS (SELECT * FROM ({sql}))"


def _headline_sql():
    from quillspark.plans import daily, words
    parts = [("q1", words.SQL["s26_heuristic_relevance"]), ("q2", daily.SQL["s29_j22_novelty"]), ("q3", daily.SQL["s27_s28_components"])]
    return "WITH " + ", ".join(_named(s, n) for n, s in parts)


@query(_headline_sql() + " SELECT q1.item_id, round(0.4 * relevance + 0.2 * novelty + 0.2 * multiplicity + 0.2 * completeness, 4) AS score FROM q1 JOIN q2 ON q2.item_id = q1.item_id JOIN q3 ON q3.item_id = q1.item_id")
def s30_headline_score(spark, d):
    return headline_scores(spark, d).select("item_id", "score")


@query(_headline_sql() + """ SELECT q1.item_id, row_number() OVER (ORDER BY round(0.4 * relevance + 0.2 * novelty + 0.2 * multiplicity + 0.2 * completeness, 4) DESC, relevance DESC, q1.item_id) AS place
FROM q1 JOIN q2 ON q2.item_id = q1.item_id JOIN q3 ON q3.item_id = q1.item_id""")
def so3_selection_order(spark, d):
    """Papers by score, then relevance, then key: places over all of them."""
    from quillspark.operators.ranking import places
    return places(headline_scores(spark, d).select("item_id", "score", "relevance"), [F.desc("score"), F.desc("relevance"), F.asc("item_id")]).select("item_id", "place")


@query(_headline_sql() + """, u AS (UNPIVOT (SELECT q1.item_id, relevance, novelty, multiplicity, completeness FROM q1 JOIN q2 ON q2.item_id = q1.item_id JOIN q3 ON q3.item_id = q1.item_id) ON relevance, novelty, multiplicity, completeness INTO NAME component VALUE v)
SELECT component, quantile_disc(v, 0.5) AS low_median, max(v) AS most, count(DISTINCT v) AS kinds FROM u GROUP BY component""")
def a13_component_spread(spark, d):
    """Median, largest value and number of values of each component of the score."""
    j = headline_scores(spark, d)
    u = j.unpivot(["item_id"], ["relevance", "novelty", "multiplicity", "completeness"], "component", "v")
    low = M.values_at(u, ["component"], "v", {"low_median": lambda n: F.floor((n - 1) / 2)})
    return low.join(u.groupBy("component").agg(F.max("v").alias("most"), F.countDistinct("v").alias("kinds")), "component")
