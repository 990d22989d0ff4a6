"""Queries over texts: normalising, signals, vocabularies, identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import ids as I, text as T
from quillspark.plans.common import PP, collection, papers
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()

#: Keywords of the example gate (a parameter of ``keyword_pattern``).
KEYWORDS = ("urban", "street view", "land use", "transit", "commut*", "tree canopy", "housing", "ride-hailing", "infrastructur*")
_KW = r"(?i)\b(?:urban|street[\s\-]view|land[\s\-]use|transit|commut\w*|tree[\s\-]canopy|housing|ride-hailing|infrastructur\w*)\b"

@query(PP + r""", k AS (SELECT item_id, nullif(regexp_extract(arxiv, '(\d{4}\.\d{4,5})', 1), '') AS a,
  nullif(regexp_replace(regexp_replace(lower(trim(doi)), '^https?://(?:dx\.)?doi\.[a-z]+/', ''), '^doi:\s*', ''), '') AS b,
  nullif(regexp_extract(trim(openalex), '([^/]+)/*$', 1), '') AS c FROM p)
SELECT item_id, a AS arxiv, b AS doi, c AS openalex, coalesce('arxiv:' || a, 'doi:' || b, 'openalex:' || c) AS work_key FROM k""")
def s1_s5_identifiers(spark, d):
    a, b, c = I.arxiv_id(F.col("arxiv")), I.doi(F.col("doi")), I.openalex_id(F.col("openalex"))
    return papers(spark, d).select("item_id", a.alias("arxiv"), b.alias("doi"), c.alias("openalex"), I.work_key(a, b, c).alias("work_key"))


@query(PP + r""", x AS (SELECT item_id, regexp_replace(abstract, '(?i)</?(?:[a-z0-9_-]+:)?(?:sub|sup|i|b|em|strong|scp|sc|italic|bold|underline|monospace|roman|sans-serif|span|a|code|inline-formula|tex-math|styled-content)(?:\s[^<>]*?)?/?>', '', 'g') AS x FROM p),
  y AS (SELECT item_id, replace(replace(replace(replace(replace(replace(regexp_replace(x, '</?[a-zA-Z][a-zA-Z0-9:_-]*(?:\s[^<>]*?)?/?>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', ' ') AS y FROM x)
SELECT item_id, nullif(trim(regexp_replace(regexp_replace(trim(regexp_replace(y, '\s+', ' ', 'g')), '\s+([,.;:!?)\]}])', '\1', 'g'), '([(\[{])\s+', '\1', 'g')), '') AS text FROM y""")
def s7_markup(spark, d):
    return papers(spark, d).select("item_id", T.strip_markup(F.col("abstract")).alias("text"))


@query(r"""SELECT DISTINCT listing_id, trim(regexp_replace(regexp_replace(lower(title), '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title,
  len(title) AS chars FROM listings""")
def s10_titles(spark, d):
    t = table(spark, d, "listings").select("listing_id", "title").distinct()
    return t.select("listing_id", T.plain_title(F.col("title")).alias("title"), F.length("title").cast("bigint").alias("chars"))


@query(PP + r""", a AS (SELECT item_id, trim(a.name) AS n FROM (SELECT item_id, unnest(authors) AS a FROM p)),
  s AS (SELECT item_id, CASE WHEN contains(n, ',') THEN split_part(n, ',', 1) ELSE regexp_extract(n, '(\S+)$', 1) END AS s FROM a WHERE n IS NOT NULL)
SELECT trim(regexp_replace(regexp_replace(lower(s), '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS surname, count(*) AS records, count(DISTINCT item_id) AS papers FROM s GROUP BY 1""")
def s11_surnames(spark, d):
    a = papers(spark, d).select("item_id", F.explode("authors.name").alias("n")).where("n is not null")
    return a.groupBy(T.last_name(F.col("n")).alias("surname")).agg(F.count("*").alias("records"), F.countDistinct("item_id").alias("papers"))


@query(r"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM (SELECT DISTINCT doc_id, text FROM documents))
SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM w GROUP BY doc_id""")
def s12_inverted_index(spark, d):
    """Texts to an inverted index and back."""
    docs = table(spark, d, "documents").select("doc_id", "text").distinct()
    words = docs.select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "w")).groupBy("doc_id", "w").agg(F.collect_list("i").alias("at"))
    index = words.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("index"))
    return index.select("doc_id", T.from_inverted_index(F.col("index")).alias("text"))


@query(PP + f""", x AS (SELECT item_id, categories, coalesce(title, '') || ' ' || coalesce(abstract, '') AS x FROM p)
SELECT item_id, CASE WHEN len(categories) = 0 THEN 'none' WHEN list_has_any(categories, ['cs.CY', 'cs.SI', 'stat.AP', 'physics.soc-ph']) THEN 'open'
  WHEN list_has_any(categories, ['cs.LG', 'cs.CV', 'cs.AI']) THEN CASE WHEN regexp_matches(x, '{_KW}') THEN 'keyword' ELSE 'dropped' END ELSE 'other' END AS gate,
  list_sort(list_distinct(list_transform(regexp_extract_all(x, '{_KW}', 0), lambda s: lower(s)))) AS keywords FROM x""")
def f1_f4_gate(spark, d):
    """The volume gate: open categories pass, gated ones need a keyword."""
    x = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    pattern = T.keyword_pattern(KEYWORDS)
    cats = F.col("categories")
    gated = F.arrays_overlap(cats, F.array(*map(F.lit, ("cs.LG", "cs.CV", "cs.AI"))))
    free = F.arrays_overlap(cats, F.array(*map(F.lit, ("cs.CY", "cs.SI", "stat.AP", "physics.soc-ph"))))
    gate = (F.when(F.size(cats) == 0, "none").when(F.coalesce(free, F.lit(False)), "open").when(F.coalesce(gated, F.lit(False)), F.when(x.rlike(pattern), "keyword").otherwise("dropped"))
            .otherwise("other"))
    found = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), F.lower)))
    return papers(spark, d).select("item_id", gate.alias("gate"), found.alias("keywords"))


@query(r"""WITH x AS (SELECT DISTINCT listing_id, title FROM listings), s AS (SELECT listing_id, (CASE WHEN regexp_matches(title, '(?i)</?(i|scp|em)>') THEN ['markup'] ELSE [] END) ||
  (CASE WHEN contains(title, ':') THEN ['colon'] ELSE [] END) || (CASE WHEN contains(title, '?') THEN ['question'] ELSE [] END) AS l FROM x)
SELECT array_to_string(list_sort(l), ' + ') AS signals, count(*) AS titles FROM s GROUP BY 1""")
def a81_signal_combinations(spark, d):
    t = F.col("title")
    s = F.array_compact(F.array(F.when(t.rlike(r"(?i)</?(i|scp|em)>"), "markup"), F.when(t.contains(":"), "colon"), F.when(t.contains("?"), "question")))
    return (table(spark, d, "listings").select("listing_id", "title").distinct().groupBy(F.array_join(F.array_sort(s), " + ").alias("signals")).agg(F.count("*").alias("titles")))


@query(r"""WITH w AS (SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS w FROM (SELECT DISTINCT doc_id, text FROM documents)), k AS (SELECT DISTINCT w FROM w WHERE len(w) > 3)
SELECT w AS word, CASE WHEN regexp_matches(w, '(ss|us|is)$') THEN w WHEN regexp_matches(w, 'ies$') AND len(w) > 4 THEN regexp_replace(w, 'ies$', 'y')
 WHEN regexp_matches(w, '(ches|shes|xes|sses|zes)$') THEN regexp_replace(w, 'es$', '') WHEN regexp_matches(w, 's$') AND len(w) > 3 THEN regexp_replace(w, 's$', '') ELSE w END AS singular FROM k""")
def s36_singular(spark, d):
    w = (table(spark, d, "documents").select("doc_id", "text").distinct().select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
         .select(F.lower("w").alias("word")).where("length(word) > 3").distinct())
    return w.select("word", T.singular(F.col("word")).alias("singular"))


@query(r"""WITH n AS (SELECT DISTINCT display_name AS name FROM authors WHERE display_name IS NOT NULL)
SELECT CASE WHEN regexp_matches(regexp_replace(name, '\p{Latin}', '', 'g'), '\p{L}') THEN 'non_latin' WHEN regexp_matches(name, '[^\x00-\x7F]') THEN 'diacritic' ELSE 'ascii' END AS script, count(*) AS names FROM n GROUP BY 1""")
def s38_scripts(spark, d):
    n = table(spark, d, "authors").where("display_name is not null").select("display_name").distinct()
    return n.groupBy(T.script_of(F.col("display_name")).alias("script")).agg(F.count("*").alias("names"))


@query(PP + r""" SELECT item_id, regexp_replace(work_key, '[\\/:*?"<>|\s]', '_', 'g') AS file, substr(sha1(concat_ws(chr(0), work_key, state)), 1, 10) AS digest, sha256(work_key) AS full_hash FROM p""")
def s41_s42_names_and_digests(spark, d):
    return papers(spark, d).select("item_id", T.file_name(F.col("work_key")).alias("file"), T.digest(F.col("work_key"), F.col("state")).alias("digest"),
                                   F.sha2("work_key", 256).alias("full_hash"))


@query(r"""WITH x AS (SELECT DISTINCT doc_id, text FROM documents) SELECT doc_id, CASE WHEN len(text) <= 200 THEN text WHEN len(regexp_extract(substr(text, 1, 200), '(?s)^(.*[.?!])\s', 1)) > 100
  THEN regexp_extract(substr(text, 1, 200), '(?s)^(.*[.?!])\s', 1) ELSE rtrim(substr(text, 1, 200)) || '…' END AS opening FROM x""")
def s40_openings(spark, d):
    return table(spark, d, "documents").select("doc_id", "text").distinct().select("doc_id", T.first_sentences(F.col("text"), 200).alias("opening"))


@query(r"""WITH x AS (SELECT DISTINCT doc_id, text FROM documents) SELECT doc_id, len(regexp_extract_all(text, '\d[\d,.]*')) AS quantities,
  len(regexp_extract_all(text, '(?i)\b(may|might|could|approximately|partially|considerably)\b')) AS hedges, len(regexp_extract_all(text, '(?i)\b(more|less|than|lower|higher)\b')) AS comparatives, len(text) AS chars FROM x""")
def a70_feature_counts(spark, d):
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("bigint")
    return table(spark, d, "documents").select("doc_id", "text").distinct().select(
        "doc_id", n(r"\d[\d,.]*").alias("quantities"), n(r"(?i)\b(may|might|could|approximately|partially|considerably)\b").alias("hedges"),
        n(r"(?i)\b(more|less|than|lower|higher)\b").alias("comparatives"), F.length("text").cast("bigint").alias("chars"))


@query(PP + r""", x AS (SELECT item_id, coalesce(title, '') || ' ' || coalesce(abstract, '') AS x FROM p)
SELECT item_id, round(least(0.95, 0.05 + 0.115 * len(list_distinct(list_transform(regexp_extract_all(x, '(?i)\b(urban|city|street|transit|housing|walkability|mobility|neighbourhood)\b', 0), lambda s: lower(s))))), 4)::DOUBLE AS relevance FROM x""")
def s26_heuristic_relevance(spark, d):
    x = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    hit = F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(r"(?i)\b(urban|city|street|transit|housing|walkability|mobility|neighbourhood)\b"), F.lit(0)), F.lower))
    return papers(spark, d).select("item_id", F.round(F.least(F.lit(0.95), 0.05 + 0.115 * F.size(hit)), 4).alias("relevance"))
