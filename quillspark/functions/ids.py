"""Identifiers of works, people, places of publication, however written."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _some(c: Column) -> Column:
    return F.when(c != "", c)


def bare_segment(c: Column) -> Column:
    """The part after the last slash or colon, in upper case; null if blank."""
    return _some(F.upper(F.regexp_extract(F.trim(c), r"([^/:\s]+)/*$", 1)))


def openalex_id(c: Column) -> Column:
    """Last path segment of an id, as written; null stays null."""
    return _some(F.regexp_extract(F.trim(c), r"([^/]+)/*$", 1))


def ror_id(c: Column) -> Column:
    return _some(F.regexp_extract(F.regexp_replace(F.trim(c), "/+$", ""), r"([^/]+)$", 1))


def doi(c: Column) -> Column:
    """Lower case, without resolver address or prefix; null if blank."""
    x = F.lower(F.trim(c))
    for prefix in ("^https?://(?:dx\\.)?doi\\.[a-z]+/", "^doi:\\s*"):
        x = F.regexp_replace(x, prefix, "")
    return _some(x)


def arxiv_id(c: Column) -> Column:
    """The bare arXiv id without version, from an id, an address or a DOI of the arXiv form; else null."""
    c = F.regexp_replace(c, r"(?i)^.*arxiv[.:]\s*(?=[\da-z])", "")
    new = F.regexp_extract(c, r"(?<![\d.])(\d{4}\.\d{4,5})(?:v\d+)?(?!\d)", 1)
    old = F.lower(F.regexp_extract(c, r"(?<![\w.])([a-zA-Z\-]+(?:\.[A-Z]{2})?/\d{7})(?:v\d+)?(?!\d)", 1))
    return F.coalesce(_some(new), _some(old))


def work_key(arxiv: Column, doi_: Column, openalex: Column) -> Column:
    """The first of arXiv, DOI and OpenAlex ids that is there, with its scheme."""
    return F.coalesce(F.concat(F.lit("arxiv:"), arxiv), F.concat(F.lit("doi:"), doi_),
                      F.concat(F.lit("openalex:"), openalex))


def key_rank(c: Column) -> Column:
    """0 for arXiv, 1 for DOI, 2 for OpenAlex keys, 3 for any other."""
    return (F.when(c.startswith("arxiv:"), 0).when(c.startswith("doi:"), 1).when(c.startswith("openalex:"), 2)
            .otherwise(3))


def paper_keys(*fields: Column) -> Column:
    """Distinct identity keys in any of the fields: ``arxiv:``, ``doi:`` and ``openalex:`` ids in one spelling each.

    A DOI of the arXiv form counts as the arXiv id. Null fields give nothing.
    """
    def keys(c: Column) -> list[Column]:
        low = F.lower(F.trim(c))
        d = _some(F.regexp_extract(low, r"(10\.\d{4,9}/\S+)", 1))
        from_doi = _some(F.regexp_extract(d, r"/arxiv\.(\d{4}\.\d{4,5}|[a-z\-]+(?:\.[a-z]{2})?/\d{7})", 1))
        w = _some(F.upper(F.regexp_extract(low, r"(?:^|[/:])(w\d+)/*$", 1)))
        a = F.coalesce(from_doi, F.when(d.isNull() & low.rlike(r"^\s*\d{4}\.|arxiv|/abs/|/pdf/"), arxiv_id(low)))
        return [F.concat(F.lit("arxiv:"), a), F.concat(F.lit("doi:"), F.when(from_doi.isNull(), d)),
                F.concat(F.lit("openalex:"), w)]
    return F.array_distinct(F.array_compact(F.array(*(k for f in fields for k in keys(f)))))
