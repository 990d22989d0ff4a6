"""Tables of records and issues: partitioned writes, point reads, JSON lines, raw answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_issues(issues: DataFrame, path: str, day: str = "day") -> None:
    """Overwrites the days in ``issues`` and leaves the other days of the table as they are."""
    issues.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read_issue(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One day; other days are not read."""
    return spark.read.parquet(path).where(F.col("day") == F.lit(day).cast("date"))


def read_item(items: DataFrame, work_key: str) -> DataFrame:
    """The records of one key; the filter reaches the scan."""
    return items.where(F.col("work_key") == work_key)


def json_line(df: DataFrame) -> DataFrame:
    """``(value)``: rows as JSON, members in order of their names, line separators inside texts escaped."""
    text = F.to_json(F.struct(*sorted(df.columns)))
    return df.select(F.replace(F.replace(text, F.lit("\u2028"), F.lit("\\u2028")), F.lit("\u2029"), F.lit("\\u2029")).alias("value"))


def append_labels(labels: DataFrame, path: str, sampling: str) -> None:
    """Appends labels; a row whose ``sampling`` is not the one of the table fails the write."""
    fine = F.assert_true(F.col("sampling") == sampling, F.concat(F.lit("label of another sampling: "), F.coalesce("sampling", F.lit("null"))))
    labels.where(fine.isNull()).write.mode("append").parquet(path)


def export_bundle(rows: DataFrame, version: int = 1) -> DataFrame:
    """``(version, day, bundle)``: the rows of each day as one JSON text; days are the unit, so no task holds more than a day."""
    body = [c for c in sorted(rows.columns) if c != "day"]
    return rows.groupBy("day").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*body)))).alias("bundle")).select(F.lit(version).alias("version"), "day", "bundle")


def import_bundle(bundles: DataFrame, schema: str, version: int = 1) -> DataFrame:
    """The rows again; a bundle of another version fails the read."""
    fine = F.assert_true(F.col("version") == version, F.concat(F.lit("bundle of version "), F.col("version").cast("string")))
    return bundles.where(fine.isNull()).select("day", F.inline(F.from_json("bundle", f"array<struct<{schema}>>")))


def newest_feed(issues: DataFrame, most: int = 50) -> DataFrame:
    """``(xml)``: an entry for each of the newest ``most`` issues ``(day, title)``, special characters escaped."""
    entry = F.to_xml(F.struct(F.col("title"), F.date_format("day", "yyyy-MM-dd").alias("updated")), {"rowTag": "entry", "indent": "0"})
    return issues.orderBy(F.desc("day")).limit(most).select("day", entry.alias("xml"))
