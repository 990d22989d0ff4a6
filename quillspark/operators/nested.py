"""Deeply nested records as related flat tables.

The payload is parsed once into a variant. Nested ``transform`` calls attach the keys and the
places of all ancestors to each child, ``flatten`` joins the arrays, and one ``inline`` per
target table emits its rows, so each table is one scan without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Members that hold each part of a record, in the order in which they are tried.
AUTHORS = ("$.authors", "$.authorships", "$.bibliography.authors")
REFERENCES = ("$.referenced_works", "$.graph.referenced_works")
TOPICS = ("$.topics", "$.entities.topics")
LOCATION = ("$.primary_location", "$.bibliography.primary_location")
TITLE = ("$.display_name", "$.title", "$.bibliography.title")
DATE = ("$.publication_date", "$.bibliography.publication_date")
CITED = ("$.cited_by_count", "$.bibliography.cited_by_count")
KEY = ("$.id", "$.work_key")

CHILD = "array<struct<child:string,author_pos:bigint,pos:bigint,child_key:string>>"


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _first(v: Column, paths, kind: str) -> Column:
    return F.coalesce(*(_get(v, p, kind) for p in paths))


def _text(c: Column) -> Column:
    """The text itself; null where it is blank."""
    return F.when(F.trim(c) != "", c)


def _object(v: Column, path: str) -> Column:
    return F.when(_get(v, path, "map<string,variant>").isNotNull(), _get(v, path))


def _string(v: Column) -> Column:
    """A variant that is itself a string, else null."""
    return F.when(F.schema_of_variant(v) == "STRING", _get(v, "$", "string"))


def _payload(v: Column) -> Column:
    return F.try_parse_json(_get(v, "$.payload", "string"))


def _opened(v: Column) -> Column:
    """The records in one envelope, an array of variants: all objects of a result list, a data member, or JSON in a string;
    what is in no envelope is its own only record."""
    results = F.filter(_get(v, "$.results", "array<variant>"), lambda x: _get(x, "$", "map<string,variant>").isNotNull())
    return F.when(F.size(results) > 0, results).otherwise(F.array(F.coalesce(_object(v, "$.data.work"), _payload(v), v)))


def _enveloped(v: Column) -> Column:
    return (F.coalesce(F.exists(_get(v, "$.results", "array<variant>"), lambda x: _get(x, "$", "map<string,variant>").isNotNull()), F.lit(False))
            | _object(v, "$.data.work").isNotNull() | _payload(v).isNotNull())


def _records(v: Column, depth: int) -> Column:
    """All records inside up to ``depth`` envelopes, in order."""
    inside = F.reduce(F.sequence(F.lit(1), F.lit(depth)), F.array(v), lambda acc, _: F.when(
        F.exists(acc, _enveloped), F.flatten(F.transform(acc, _opened))).otherwise(acc))
    return F.when(_enveloped(v), inside).otherwise(F.array(v))


def _once(c: Column) -> Column:
    """A generator of one row: the optimizer can't copy what is below it into each later use."""
    return F.explode(F.array(c))


def items_of(v: Column, paths) -> Column:
    """A member as an array of variants; a lone object counts as a list of one, anything else as null."""
    lists = _first(v, paths, "array<variant>")
    lone = F.coalesce(*(_object(v, p) for p in paths))
    return F.coalesce(lists, F.when(lone.isNotNull(), F.array(lone)))


def bare(c: Column) -> Column:
    """An id without prefix or address, in upper case."""
    return _text(F.upper(F.regexp_replace(F.regexp_replace(F.trim(c), "/+$", ""), "^.*[/:]", "")))


def bare_ror(c: Column) -> Column:
    """The last segment of a ror address as written."""
    return _text(F.regexp_replace(F.regexp_replace(F.trim(c), "/+$", ""), "^.*/", ""))


def reference_list(v: Column) -> Column:
    """Referenced works as an array of strings, from a list or from one text with separators."""
    lists = F.transform(_first(v, REFERENCES, "array<variant>"),
                        lambda x: F.coalesce(_get(x, "$.id", "string"), _get(x, "$", "string")))
    text = F.trim(F.coalesce(*(F.when(_get(v, p, "array<variant>").isNull(), _get(v, p, "string")) for p in REFERENCES)))
    return F.coalesce(lists, F.when(text != "", F.split(text, r"\s*[;|,]\s*|\s+")))


def institution_key(i: Column) -> Column:
    name = F.coalesce(_get(i, "$.display_name", "string"), _get(i, "$.name", "string"))
    return F.coalesce(bare_ror(_get(i, "$.ror", "string")), _text(name), _text(_string(i)))


def _source_id(loc: Column) -> Column:
    return bare(F.coalesce(_text(_get(loc, "$.source.id", "string")), _text(_get(loc, "$.source_id", "string"))))


def _child(kind: str, author_pos: Column, pos: Column, key: Column) -> Column:
    return F.struct(F.lit(kind).alias("child"), author_pos.cast("bigint").alias("author_pos"),
                    pos.cast("bigint").alias("pos"), key.alias("child_key"))


def _children(v: Column) -> dict[str, Column]:
    """For each kind of child an array of structs with the places of its ancestors."""
    zero = F.lit(0)
    institutions = F.flatten(F.transform(
        F.coalesce(items_of(v, AUTHORS), F.array().cast("array<variant>")),
        lambda a, n: F.coalesce(F.transform(items_of(a, ("$.institutions",)),
                                            lambda i, m: _child("institution", n + 1, m + 1, institution_key(i))),
                                F.array().cast(CHILD))))
    references = F.transform(reference_list(v), lambda r, n: _child("reference", zero, n + 1, bare(r)))
    topics = F.transform(items_of(v, TOPICS), lambda t, n: _child(
        "topic", zero, n + 1, bare(F.coalesce(_get(t, "$.id", "string"), _string(t)))))
    loc = F.coalesce(*(_object(v, p) for p in LOCATION))
    place = F.array(_child("location", zero, F.lit(1), F.coalesce(
        _source_id(loc), _text(_get(loc, "$.landing_page_url", "string")))))
    return {"institution": institutions, "reference": references, "topic": topics, "location": place}


def parsed(raw: DataFrame, record_id: str = "record_id", payload: str = "payload", depth: int = 16) -> DataFrame:
    """``(record_id, result, v)``: a variant for each record inside each distinct row of valid JSON.

    A payload may wrap its records in up to ``depth`` envelopes (``still_wrapped`` lists those with more) and a result
    list may hold several; ``result`` is the place of the record among them, from 1.
    """
    df = (raw.select(F.col(record_id).alias("record_id"), F.col(payload).alias("payload"))
          .where("payload is not null").dropDuplicates(["record_id", "payload"])
          .select("record_id", _once(F.try_parse_json("payload")).alias("v")).where("v is not null"))
    return (df.select("record_id", F.posexplode(_records(F.col("v"), depth)).alias("result", "v"))
            .withColumn("result", (F.col("result") + 1).cast("bigint")))


def still_wrapped(raw: DataFrame, record_id: str = "record_id", payload: str = "payload", depth: int = 16) -> DataFrame:
    """``(record_id, result)`` of what is still in an envelope after ``depth`` of them were opened: the rejects of ``parsed``."""
    return parsed(raw, record_id, payload, depth).where(_enveloped(F.col("v"))).select("record_id", "result")


def child_rows(raw: DataFrame, record_id: str = "record_id", payload: str = "payload",
               kinds=("institution", "reference", "topic", "location")) -> DataFrame:
    """``(record_id, child, author_pos, pos, child_key)``: every child of every record.

    Places count from 1 and include empty entries and repeats; children without a key are left
    out. Invalid JSON, JSON that is no object, null payloads and empty tables give no rows;
    identical rows count once; other columns of ``raw`` are ignored.
    """
    arrays = _children(F.col("v"))
    joined = F.flatten(F.array(*(F.coalesce(arrays[k].cast(CHILD), F.array().cast(CHILD)) for k in kinds)))
    return (parsed(raw, record_id, payload).select("record_id", F.inline(joined))
            .where("child_key is not null"))


def flat_tables(raw: DataFrame, record_id: str = "record_id", payload: str = "payload") -> dict[str, DataFrame]:
    """Related flat tables: works, authors, institutions, references, topics, locations.

    Children keep ``record_id`` with ``result``, the place of their record in its result list, and, for institutions,
    ``author_pos``, as links to their parents.
    """
    base = parsed(raw, record_id, payload)
    v = F.col("v")
    works = base.select("record_id", "result", F.coalesce(*(_text(_get(v, p, "string")) for p in KEY)).alias("work_key"),
                        _first(v, TITLE, "string").alias("title"),
                        F.try_to_date(_first(v, DATE, "string")).alias("publication_date"),
                        _first(v, CITED, "bigint").alias("cited_by_count"))
    author = lambda a, n: F.struct(
        (n + 1).cast("bigint").alias("author_pos"),
        F.coalesce(*(_get(a, p, "string") for p in ("$.author.display_name", "$.display_name", "$.name"))).alias("name"),
        bare(F.coalesce(*(_get(a, p, "string") for p in ("$.author.id", "$.id", "$.openalex")))).alias("openalex"),
        F.coalesce(*(_get(a, p, "string") for p in ("$.author.orcid", "$.orcid"))).alias("orcid"))
    authors = base.select("record_id", "result", F.inline(F.transform(items_of(v, AUTHORS), author)))
    institution = lambda i, n, m: F.struct(
        (n + 1).cast("bigint").alias("author_pos"), (m + 1).cast("bigint").alias("pos"),
        bare_ror(_get(i, "$.ror", "string")).alias("ror"),
        F.coalesce(_get(i, "$.display_name", "string"), _get(i, "$.name", "string"), _string(i)).alias("name"))
    nested = F.flatten(F.transform(items_of(v, AUTHORS), lambda a, n: F.coalesce(
        F.transform(items_of(a, ("$.institutions",)), lambda i, m: institution(i, n, m)),
        F.array().cast("array<struct<author_pos:bigint,pos:bigint,ror:string,name:string>>"))))
    institutions = base.select("record_id", "result", F.inline(nested))
    references = base.select("record_id", "result", F.inline(F.transform(reference_list(v), lambda r, n: F.struct(
        (n + 1).cast("bigint").alias("pos"), bare(r).alias("work_id")))))
    topics = base.select("record_id", "result", F.inline(F.transform(items_of(v, TOPICS), lambda t, n: F.struct(
        (n + 1).cast("bigint").alias("pos"), bare(F.coalesce(_get(t, "$.id", "string"), _string(t))).alias("topic_id"),
        F.coalesce(_get(t, "$.display_name", "string"), _get(t, "$.label", "string")).alias("label"),
        _get(t, "$.score", "double").alias("score")))))
    loc = F.coalesce(*(_object(v, p) for p in LOCATION))
    locations = base.select("record_id", "result", _source_id(loc).alias("source_id"),
                            F.coalesce(_get(loc, "$.source.display_name", "string"),
                                       _get(loc, "$.source_name", "string")).alias("source_name"),
                            _text(_get(loc, "$.landing_page_url", "string")).alias("landing_page_url")
                            ).where("source_id is not null or landing_page_url is not null")
    return {"works": works, "authors": authors, "institutions": institutions, "references": references,
            "topics": topics, "locations": locations}


def json_paths(df: DataFrame, key: str, json: str, depth: int = 12) -> DataFrame:
    """``(key, path, value)``: one row for each leaf of a JSON text that isn't null, with its path as ``$.a.b[0]``.

    Objects and lists are opened level by level, up to ``depth`` levels; what is nested deeper comes as the text of its JSON.
    Null and unreadable texts, empty objects and empty lists give no rows.
    """
    def step(v: Column, path: Column) -> Column:
        fields = F.transform(F.map_entries(_get(v, "$", "map<string,variant>")), lambda e: F.struct(F.concat(path, F.lit("."), e["key"]).alias("path"), e["value"].alias("v")))
        items = F.transform(_get(v, "$", "array<variant>"), lambda x, i: F.struct(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("v")))
        return F.coalesce(fields, items, F.array(F.struct(path.alias("path"), v.alias("v"))))

    x = df.select(key, _once(F.try_parse_json(json)).alias("v")).where("v is not null")
    nodes = F.reduce(F.sequence(F.lit(1), F.lit(depth)), F.array(F.struct(F.lit("$").alias("path"), F.col("v").alias("v"))),
                     lambda acc, _: F.flatten(F.transform(acc, lambda n: step(n["v"], n["path"]))))
    leaves = x.select(key, F.inline(nodes)).where("not is_variant_null(v)")
    return leaves.select(key, "path", F.coalesce(_get(F.col("v"), "$", "string"), F.to_json("v")).alias("value"))
