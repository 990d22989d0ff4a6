"""The reference base: collected records first, then works as fetched that no record stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillspark.durable import save
from quillspark.functions.ids import paper_keys
from quillspark.functions.text import strip_markup
from quillspark.operators import nested as N
from quillspark.operators.ranking import latest

#: Members of a payload that can hold an identifier of the work.
IDENTIFIERS = ("$.id", "$.work_key", "$.doi", "$.ids.arxiv", "$.ids.doi", "$.ids.openalex")


def first_key(keys: Column) -> Column:
    """The arXiv key, else the DOI, else the OpenAlex id: also their order as text."""
    return F.array_min(keys)


def raw_works(raw: DataFrame) -> DataFrame:
    """``(record_id, keys, work_key, title, day, venue, first_authors, refs)`` of payloads with an identifier and a reference."""
    v = F.col("v")
    place = F.coalesce(*(N._object(v, p) for p in N.LOCATION))
    pages = F.transform(N.items_of(v, ("$.locations",)), lambda x: N._get(x, "$.landing_page_url", "string"))
    keys = F.array_union(paper_keys(*(N._get(v, p, "string") for p in IDENTIFIERS), N._get(place, "$.landing_page_url", "string")),
                         F.coalesce(F.flatten(F.transform(pages, lambda u: paper_keys(u))), F.array().cast("array<string>")))
    names = F.transform(F.slice(N.items_of(v, N.AUTHORS), 1, 5), lambda a: F.coalesce(
        *(N._get(a, p, "string") for p in ("$.author.display_name", "$.display_name", "$.name"))))
    return N.parsed(raw).select(
        "record_id", F.array_sort(keys).alias("keys"), N._first(v, N.TITLE, "string").alias("title"),
        F.try_to_date(N._first(v, N.DATE, "string")).alias("day"),
        F.coalesce(N._get(place, "$.source.display_name", "string"), N._get(place, "$.source_name", "string")).alias("venue"),
        F.coalesce(names, F.array().cast("array<string>")).alias("first_authors"),
        F.array_sort(F.array_distinct(F.array_compact(F.transform(N.reference_list(v), N.bare)))).alias("refs"),
    ).where("size(keys) > 0 and size(refs) > 0").withColumn("work_key", first_key(F.col("keys")))


def first_claims(records: DataFrame, id: str, keys: str) -> DataFrame:
    """``(id)`` of the records kept when each, by id, is taken unless a record kept before has one of its keys.

    In each round the records that are first for all their keys are kept, and those that share a key with them leave;
    what a dropped record alone had stays free. Rounds grow with the longest chain of records.
    """
    live = save(records.select(F.col(id).alias("id"), F.explode(keys).alias("k")).distinct())
    kept = live.select("id").limit(0)
    while live.limit(1).count():
        low = live.groupBy("k").agg(F.min("id").alias("low"))
        won = save(live.join(low, "k").groupBy("id").agg(F.min(F.col("id") == F.col("low")).alias("all")).where("all").select("id"))
        taken = live.join(won, "id", "left_semi").select("k").distinct()
        out = live.join(taken, "k", "left_semi").select("id").distinct()
        live = save(live.join(out, "id", "left_anti"))
        kept = kept.union(won)
    return kept


def reference_base(records: DataFrame, held: DataFrame, raw: DataFrame) -> DataFrame:
    """``(work_key, day, from_raw, refs)``: records with references, and of ``raw`` (as ``raw_works``) the works none of whose keys
    is in ``held`` (``keys``, of all records) or with a work taken before."""
    claimed = held.select(F.explode("keys").alias("k")).distinct()
    known = raw.select("record_id", F.explode("keys").alias("k")).join(claimed, "k", "left_semi").select("record_id").distinct()
    free = save(raw.join(known, "record_id", "left_anti"))
    new = free.join(first_claims(free, "record_id", "keys").withColumnRenamed("id", "record_id"), "record_id", "left_semi")
    return (records.where("size(refs) > 0").select("work_key", "day", F.lit(False).alias("from_raw"), F.array_sort("refs").alias("refs"))
            .union(new.select("work_key", "day", F.lit(True), "refs")))


def work_index(records: DataFrame, raw: DataFrame) -> DataFrame:
    """``(work_key, title, first_authors, year, venue, doi, from_raw)``: records, then the first of the works in ``raw`` under each key no record has."""
    new = raw.join(records.select("work_key").distinct(), "work_key", "left_anti")
    new = latest(new, ["work_key"], [F.asc("record_id")])
    ids = F.get(F.filter("keys", lambda k: k.startswith("doi:")), F.lit(0))
    return (records.select("work_key", "title", "first_authors", F.year("day").alias("year"), "venue", "doi", F.lit(False).alias("from_raw"))
            .union(new.select("work_key", strip_markup(F.col("title")), "first_authors", F.year("day"), "venue", F.substring(ids, 5, 1_000_000), F.lit(True))))
