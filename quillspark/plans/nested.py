"""Queries over nested payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspark.operators.nested import child_rows, flat_tables
from quillspark.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return child_rows(table(spark, d, "raw_works"))


def p1_authors(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_works"))["authors"]


def p1_works(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_works"))["works"]


def p1_child_counts(spark: SparkSession, d: str) -> DataFrame:
    return (child_rows(table(spark, d, "raw_works")).groupBy("child")
            .agg(F.count("*").alias("children"), F.countDistinct("record_id").alias("records")))


QUERIES = {f.__name__: f for f in (p1_found, p1_authors, p1_works, p1_child_counts)}

_WORK = r"""
    raw AS (SELECT DISTINCT record_id, payload FROM raw_works WHERE json_valid(payload)),
    inner_ AS (SELECT record_id, CASE WHEN json_type(payload, '$.payload') = 'VARCHAR' AND json_valid(payload ->> '$.payload')
                                      THEN (payload ->> '$.payload')::JSON ELSE payload::JSON END AS p FROM raw),
    opened AS (SELECT record_id, CASE WHEN json_type(p, '$.results') = 'ARRAY' AND len(list_filter(json_extract(p, '$.results[*]'), lambda x: json_type(x) = 'OBJECT')) > 0
                                           THEN list_filter(json_extract(p, '$.results[*]'), lambda x: json_type(x) = 'OBJECT')
                                      WHEN json_type(p, '$.data.work') = 'OBJECT' THEN [p -> '$.data.work'] ELSE [p] END AS l FROM inner_),
    work AS (SELECT record_id, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS result FROM opened),
    listed AS (SELECT record_id, result,
        CASE WHEN json_type(w, '$.authors') = 'ARRAY' THEN w -> '$.authors' WHEN json_type(w, '$.authorships') = 'ARRAY'
             THEN w -> '$.authorships' WHEN json_type(w, '$.bibliography.authors') = 'ARRAY' THEN w -> '$.bibliography.authors' END AS authors,
        CASE WHEN json_type(w, '$.topics') = 'ARRAY' THEN w -> '$.topics' WHEN json_type(w, '$.entities.topics') = 'ARRAY'
             THEN w -> '$.entities.topics' END AS topics,
        CASE WHEN json_type(w, '$.referenced_works') IN ('ARRAY', 'VARCHAR') THEN w -> '$.referenced_works'
             WHEN json_type(w, '$.graph.referenced_works') IN ('ARRAY', 'VARCHAR') THEN w -> '$.graph.referenced_works' END AS refs,
        CASE WHEN json_type(w, '$.primary_location') = 'OBJECT' THEN w -> '$.primary_location'
             WHEN json_type(w, '$.bibliography.primary_location') = 'OBJECT' THEN w -> '$.bibliography.primary_location' END AS loc,
        w FROM work)"""
_ITEMS = r"""
    author AS (SELECT record_id, result, unnest(authors -> '$[*]') AS a, unnest(range(1, json_array_length(authors)::BIGINT + 1)) AS author_pos FROM listed
               WHERE authors IS NOT NULL),
    inst_list AS (SELECT record_id, author_pos, CASE json_type(a, '$.institutions') WHEN 'ARRAY' THEN a -> '$.institutions[*]'
                         WHEN 'OBJECT' THEN [a -> '$.institutions'] END AS l FROM author),
    inst AS (SELECT record_id, author_pos, unnest(l) AS i, unnest(range(1, len(l) + 1)) AS pos FROM inst_list WHERE l IS NOT NULL),
    ref_list AS (SELECT record_id, CASE json_type(refs) WHEN 'ARRAY' THEN refs ->> '$[*]'
                        ELSE CASE WHEN trim(refs ->> '$') <> '' THEN regexp_split_to_array(trim(refs ->> '$'), '\s*[;|,]\s*|\s+') END END AS l
                 FROM listed WHERE refs IS NOT NULL),
    ref AS (SELECT record_id, unnest(l) AS r, unnest(range(1, len(l) + 1)) AS pos FROM ref_list WHERE l IS NOT NULL),
    topic AS (SELECT record_id, unnest(topics -> '$[*]') AS t, unnest(range(1, json_array_length(topics)::BIGINT + 1)) AS pos FROM listed
              WHERE topics IS NOT NULL),
    place AS (SELECT record_id, coalesce(nullif(trim(coalesce(loc ->> '$.source.id', '')), ''), nullif(trim(coalesce(loc ->> '$.source_id', '')), '')) AS s,
                     loc ->> '$.landing_page_url' AS u FROM listed WHERE loc IS NOT NULL),
    child AS (
        SELECT record_id, 'institution' AS child, author_pos, pos, coalesce(
            nullif(regexp_replace(regexp_replace(trim(i ->> '$.ror'), '/+$', ''), '^.*/', ''), ''),
            CASE WHEN trim(coalesce(i ->> '$.display_name', i ->> '$.name')) <> '' THEN coalesce(i ->> '$.display_name', i ->> '$.name') END) AS child_key
        FROM inst
        UNION ALL SELECT record_id, 'reference', 0, pos, nullif(upper(regexp_replace(regexp_replace(trim(r), '/+$', ''), '^.*[/:]', '')), '') FROM ref
        UNION ALL SELECT record_id, 'topic', 0, pos, nullif(upper(regexp_replace(regexp_replace(trim(CASE WHEN json_type(t) = 'VARCHAR' THEN t ->> '$'
            ELSE t ->> '$.id' END), '/+$', ''), '^.*[/:]', '')), '') FROM topic
        UNION ALL SELECT record_id, 'location', 0, 1, coalesce(nullif(upper(regexp_replace(regexp_replace(s, '/+$', ''), '^.*[/:]', '')), ''),
            CASE WHEN trim(u) <> '' THEN u END) FROM place)"""

SQL = {
    "p1_found": f"WITH {_WORK}, {_ITEMS} SELECT record_id, child, author_pos::BIGINT AS author_pos, pos::BIGINT AS pos, child_key FROM child WHERE child_key IS NOT NULL",
    "p1_child_counts": f"WITH {_WORK}, {_ITEMS} SELECT child, count(*) AS children, count(DISTINCT record_id) AS records FROM child "
                       "WHERE child_key IS NOT NULL GROUP BY child",
    "p1_authors": f"""WITH {_WORK}, {_ITEMS} SELECT record_id, result, author_pos::BIGINT AS author_pos,
        coalesce(a ->> '$.author.display_name', a ->> '$.display_name', a ->> '$.name') AS name,
        nullif(upper(regexp_replace(coalesce(a ->> '$.author.id', a ->> '$.id', a ->> '$.openalex'), '^.*[/:]', '')), '') AS openalex,
        coalesce(a ->> '$.author.orcid', a ->> '$.orcid') AS orcid FROM author""",
    "p1_works": f"""WITH {_WORK} SELECT record_id, result, coalesce(nullif(trim(w ->> '$.id'), ''), nullif(trim(w ->> '$.work_key'), '')) AS work_key,
        coalesce(w ->> '$.display_name', w ->> '$.title', w ->> '$.bibliography.title') AS title,
        try_cast(coalesce(w ->> '$.publication_date', w ->> '$.bibliography.publication_date') AS DATE) AS publication_date,
        coalesce(w ->> '$.cited_by_count', w ->> '$.bibliography.cited_by_count')::BIGINT AS cited_by_count FROM work""",
}
