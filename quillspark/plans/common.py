"""Frames that many queries start from, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspark.functions.ids import bare_segment
from quillspark.sources.tables import table


def collection():
    """A decorator that gathers queries by name, with their SQL where it is given, and the two dictionaries it fills."""
    queries: dict = {}
    sql: dict[str, str] = {}

    def query(text: str | None = None):
        def keep(f):
            queries[f.__name__] = f
            if text:
                sql[f.__name__] = text
            return f
        return keep

    return query, queries, sql


def papers(spark: SparkSession, d: str) -> DataFrame:
    """Paper records, flat, each item_id once."""
    b = F.col("bibliography")
    return table(spark, d, "items").dropDuplicates(["item_id"]).select(
        "item_id", "work_key", F.col("first_published").alias("day"), b["publication_date"].alias("published"), b["title"].alias("title"),
        b["abstract"].alias("abstract"), F.coalesce(b["categories"], F.array().cast("array<string>")).alias("categories"),
        bare_segment(b["primary_location"]["source_id"]).alias("source_id"), b["primary_location"]["source_name"].alias("source_name"),
        b["primary_location"]["landing_page_url"].alias("url"), F.col("publication_status.state").alias("state"),
        F.col("graph.cited_by_count").alias("cited"), F.coalesce(b["authors"], F.array()).alias("authors"),
        F.array_distinct(F.array_compact(F.transform(F.coalesce("graph.referenced_works", F.array().cast("array<string>")), bare_segment))).alias("refs"),
        F.coalesce("entities.topics", F.array()).alias("topics"), F.col("provenance.collected_at").alias("collected_at"),
        F.coalesce("provenance.collectors", F.array().cast("array<string>")).alias("collectors"),
        F.col("ids.arxiv").alias("arxiv"), F.col("ids.doi").alias("doi"), F.col("ids.openalex").alias("openalex"))


def refs(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, day, ref), distinct."""
    return papers(spark, d).select("item_id", "day", F.explode("refs").alias("ref"))


def topics(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, day, topic, label, subfield, score, is_primary, pos)."""
    return (papers(spark, d).select("item_id", "day", F.posexplode("topics").alias("pos", "t")).where("t.id is not null")
            .select("item_id", "day", F.col("t.id").alias("topic"), F.col("t.label").alias("label"), F.col("t.subfield").alias("subfield"),
                    F.col("t.score").alias("score"), F.col("t.is_primary").alias("is_primary"), F.col("pos").cast("bigint").alias("pos")))


_BARE = "nullif(upper(regexp_extract(trim({0}), '([^/:\\s]+)/*$', 1)), '')"

#: CTE ``p``: as ``papers``.
P = f"""p AS (SELECT item_id, work_key, first_published AS day, bibliography.publication_date AS published, bibliography.title AS title,
  bibliography.abstract AS abstract, coalesce(bibliography.categories, []) AS categories,
  {_BARE.format('bibliography.primary_location.source_id')} AS source_id, bibliography.primary_location.source_name AS source_name,
  bibliography.primary_location.landing_page_url AS url, publication_status.state AS state, graph.cited_by_count AS cited,
  coalesce(bibliography.authors, []) AS authors, coalesce(graph.referenced_works, []) AS raw_refs, coalesce(entities.topics, []) AS topics,
  provenance.collected_at AS collected_at, coalesce(provenance.collectors, []) AS collectors, ids.arxiv AS arxiv, ids.doi AS doi, ids.openalex AS openalex
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id) AS rn FROM items) WHERE rn = 1)"""
#: CTE ``r``: as ``refs``; needs ``p``.
R = f"""r AS (SELECT DISTINCT item_id, day, {_BARE.format('w')} AS ref FROM (SELECT item_id, day, unnest(raw_refs) AS w FROM p)
  WHERE {_BARE.format('w')} IS NOT NULL)"""
#: CTE ``t``: as ``topics``; needs ``p``.
T = """t AS (SELECT item_id, day, t.id AS topic, t.label AS label, t.subfield AS subfield, t.score AS score, t.is_primary AS is_primary, pos FROM
  (SELECT item_id, day, unnest(topics) AS t, unnest(range(0, len(topics))) AS pos FROM p) WHERE t.id IS NOT NULL)"""
PR, PT = f"WITH {P}, {R}", f"WITH {P}, {T}"
PP = f"WITH {P}"
