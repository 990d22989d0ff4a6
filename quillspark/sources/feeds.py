"""Readers for Atom feeds and for JSON lines that may be damaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspark.functions.ids import arxiv_id
from quillspark.functions.text import strip_markup

ENTRY = ("struct<id:string,title:string,summary:string,published:string,updated:string,doi:string,comment:string,journal_ref:string,"
         "author:array<struct<name:string>>,category:array<struct<_term:string>>,primary_category:struct<_term:string>,link:array<struct<_href:string,_rel:string,_title:string>>>")


def date_prefix(c: Column) -> Column:
    """The date at the start of a text, or null."""
    return F.try_to_date(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1))


def atom_entries(feeds: DataFrame, xml: str) -> DataFrame:
    """One row per entry of Atom feeds held as text: key, title, abstract, authors, categories (the primary first), dates, DOI.

    Entries without an id or a title are left out; null and unreadable feeds give no rows.
    """
    parsed = feeds.select(F.from_xml(F.col(xml), f"entry array<{ENTRY}>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"}).alias("f"))
    e = parsed.select(F.explode("f.entry").alias("e")).select("e.*")
    first = F.col("primary_category")["_term"]
    terms = F.transform(F.coalesce("category", F.array()), lambda c: c["_term"])
    key = arxiv_id(F.col("id"))
    return (e.select(F.concat(F.lit("arxiv:"), key).alias("work_key"), strip_markup(F.col("title")).alias("title"), strip_markup(F.col("summary")).alias("abstract"),
                     F.transform(F.coalesce("author", F.array()), lambda a: F.trim(a["name"])).alias("authors"),
                     F.array_distinct(F.array_compact(F.concat(F.array(first), terms))).alias("categories"),
                     date_prefix(F.col("published")).alias("published"), date_prefix(F.col("updated")).alias("updated"),
                     F.coalesce(F.lower("doi"), F.concat(F.lit("10.48550/arxiv."), key)).alias("doi"), F.col("comment"), F.col("journal_ref"))
            .where("work_key is not null and title is not null"))


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)`` of JSON lines: parsed rows, and the lines that are no JSON object of the schema, as text. Blank lines are skipped."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    parsed = lines.select("value", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    fine = F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    return parsed.where(fine).select("r.*").drop("_corrupt"), parsed.where(~fine).select("value")
