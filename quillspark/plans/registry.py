"""All queries of the core with their SQL, gathered from the modules of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.plans import archive, citing, daily, measure, nested, quality, records, vocabulary, words

MODULES = (archive, citing, daily, measure, nested, quality, records, vocabulary, words)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return citing.QUERIES["j7_coupling"](spark, folder)


def queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= m.SQL
    return out
