"""The queries of this package over a data folder, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspark.functions.ids import bare_segment
from quillspark.llm.leaks import leaked, without_leaks
from quillspark.llm.matching import match_items_listings
from quillspark.llm.mixture import mix_sources
from quillspark.llm.names import all_clusters, cluster_pairs
from quillspark.llm.reading import reading_levels
from quillspark.llm.set_pairs import SimilarSets, similar_sets
from quillspark.llm.survivor import item_keys, paper_groups, survivors
from quillspark.sources.tables import table


def _citing(spark: SparkSession, d: str) -> SimilarSets:
    works = table(spark, d, "items").select("item_id", F.transform("graph.referenced_works", lambda w: bare_segment(w)).alias("works"))
    return similar_sets(works, "item_id", "works", threshold=0.6, min_size=5)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _citing(spark, d).record_pairs().select(F.col("id_a").alias("item_a"), F.col("id_b").alias("item_b"))


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """One row per record: its class and how many records cite largely the same works."""
    return _citing(spark, d).link_counts().select(F.col("id").alias("item_id"), F.col("rep").alias("class_id"), "links")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    people, orgs = map(cluster_pairs, all_clusters(table(spark, d, "authors"), table(spark, d, "institutions")))
    return (people.select(F.lit("author").alias("entity"), "id_a", "id_b")
            .union(orgs.select(F.lit("institution").alias("entity"), "id_a", "id_b")))


def p3_clusters(spark: SparkSession, d: str) -> DataFrame:
    """One row per author profile and institution with the smallest id of its cluster."""
    people, orgs = all_clusters(table(spark, d, "authors"), table(spark, d, "institutions"))
    return (people.select(F.lit("author").alias("entity"), "id", "cluster")
            .union(orgs.select(F.lit("institution").alias("entity"), "id", "cluster")))


def p4_scored(spark: SparkSession, d: str) -> DataFrame:
    """The matches of p4_found with their confidence."""
    return match_items_listings(table(spark, d, "items"), table(spark, d, "listings")).select(
        "item_id", "listing_id", F.round("probability", 6).alias("confidence"), "fitted")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return match_items_listings(table(spark, d, "items"), table(spark, d, "listings")).select("item_id", "listing_id")


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Records that belong together: one row per record of a group of two or more."""
    return paper_groups(item_keys(table(spark, d, "items"))).select(F.col("id").alias("item_id"), F.col("g").alias("first_item_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors(table(spark, d, "items"), table(spark, d, "sources"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "eval_id")


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents without leaked passages."""
    docs = table(spark, d, "documents")
    return without_leaks(docs, leaked(docs, table(spark, d, "eval_items"))).select("doc_id", "source", "text")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")).selection.select(
        "doc_id", "copy", "source", "n_tokens", "text")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of each source."""
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"), with_text=False).shares


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return reading_levels(table(spark, d, "documents"), table(spark, d, "level_labels")).select("doc_id", "grade")


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    """Grades with their confidence, the expected grade and the number of prose sentences."""
    return reading_levels(table(spark, d, "documents"), table(spark, d, "level_labels"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_links, p3_found, p3_clusters, p4_found, p4_scored, p5_found, p5_groups, p6_found,
                                    p6_clean, p7_mix, p7_shares, p8_found, p8_levels)}


_WORKS = """
    cited AS (SELECT DISTINCT item_id, upper(regexp_extract(trim(w), '([^/:]+)/*$', 1)) AS work FROM
              (SELECT item_id, unnest(graph.referenced_works) AS w FROM items) WHERE trim(w) <> ''),
    sized AS (SELECT item_id, count(*) AS n FROM cited GROUP BY item_id HAVING count(*) >= 5),
    pairs AS (SELECT a.item_id AS item_a, b.item_id AS item_b FROM cited a JOIN cited b ON a.work = b.work AND a.item_id < b.item_id
              JOIN sized x ON x.item_id = a.item_id JOIN sized y ON y.item_id = b.item_id
              GROUP BY a.item_id, b.item_id, x.n, y.n HAVING 10 * count(*) >= 6 * (x.n + y.n - count(*)))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"WITH {_WORKS} SELECT item_a, item_b FROM pairs",
        "p2_links": f"""
WITH {_WORKS},
    tokens AS (SELECT s.item_id, list_sort(list(c.work)) AS works FROM sized s JOIN cited c ON c.item_id = s.item_id GROUP BY s.item_id),
    ends AS (SELECT item_a AS item_id FROM pairs UNION ALL SELECT item_b FROM pairs)
SELECT t.item_id, min(t.item_id) OVER (PARTITION BY t.works) AS class_id, coalesce(e.n, 0) AS links
FROM tokens t LEFT JOIN (SELECT item_id, count(*) AS n FROM ends GROUP BY item_id) e ON e.item_id = t.item_id""",
        "p5_groups": r"""
WITH RECURSIVE fields AS (
    SELECT DISTINCT item_id, lower(trim(f)) AS f FROM (
        SELECT item_id, unnest([work_key, ids.arxiv, ids.doi, ids.openalex, bibliography.primary_location.landing_page_url]) AS f FROM items)
    WHERE f IS NOT NULL),
  parts AS (SELECT item_id, f, regexp_extract(f, '(10\.\d{4,9}/\S+)', 1) AS doi,
                   regexp_extract(f, '/arxiv\.(\d{4}\.\d{4,5})', 1) AS old, regexp_extract(f, '(?:^|[/:])(w\d+)/*$', 1) AS w,
                   regexp_extract(f, '(?:^|[/:])(\d{4}\.\d{4,5})(?:v\d+)?$', 1) AS ax FROM fields),
  keys AS (SELECT item_id, 'a' || CASE WHEN old <> '' THEN old ELSE ax END AS k FROM parts WHERE old <> '' OR (doi = '' AND ax <> '')
           UNION SELECT item_id, 'd' || doi FROM parts WHERE doi <> '' AND old = ''
           UNION SELECT item_id, 'w' || w FROM parts WHERE w <> ''),
  links AS (SELECT DISTINCT a.item_id AS u, b.item_id AS v FROM keys a JOIN keys b ON a.k = b.k),
  reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT u AS item_id, min(v) AS first_item_id FROM reach GROUP BY u HAVING count(*) > 1""",
    }
