"""Merging records: identity keys, ordered collapse, change-aware upsert, fuzzy blocks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillspark.operators.components import connected_components


def identity_groups(records: DataFrame, id: str, keys: str) -> DataFrame:
    """``(id, root)`` of every record: records that share a key, directly or through others, have one root (the smallest id)."""
    h = records.select(F.col(id).alias("id"), F.explode(keys).alias("k")).where("id is not null and k is not null").distinct()
    low = h.groupBy("k").agg(F.min("id").alias("low"))
    c = connected_components(h.join(low, "k").where("id <> low"), "id", "low")
    return records.select(F.col(id).alias("id")).distinct().join(c, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("root"))


def first_filled(value: Column, order: Column) -> Column:
    """Aggregate: the first value that isn't null in the given order."""
    return F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), order))


def last_filled(value: Column, order: Column) -> Column:
    return F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), order))


def upsert(old: DataFrame, new: DataFrame, key: str, values: list[str], stamp: str) -> DataFrame:
    """Old and new rows by key: new values win where they are not null; ``stamp`` moves only if a value changed.

    ``change`` tells added, changed, same or kept. One full join on the key.
    """
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    merged = {v: F.coalesce(F.col(f"n.{v}"), F.col(f"o.{v}")) for v in values}
    moved = F.lit(False)
    for v in values:
        moved = moved | ~merged[v].eqNullSafe(F.col(f"o.{v}"))
    change = (F.when(F.col(f"o.{key}").isNull(), "added").when(F.col(f"n.{key}").isNull(), "kept").when(moved, "changed").otherwise("same"))
    at = F.when(change.isin("added", "changed"), F.col(f"n.{stamp}")).otherwise(F.col(f"o.{stamp}"))
    return j.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *(c.alias(v) for v, c in merged.items()), at.alias(stamp), change.alias("change"))


def lcs_ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence by the two lengths (bit-parallel rows)."""
    if not a and not b:
        return 100.0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & where.get(ch, 0)
        s = (s + u | s - u) & full
    return 200.0 * (len(a) - bin(s).count("1")) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts with their words sorted, 0 to 100."""
    return pd.Series([lcs_ratio(" ".join(sorted((x or "").split())), " ".join(sorted((y or "").split()))) for x, y in zip(a, b)])


def fuzzy_pairs(records: DataFrame, id: str, block: str, title: str, least: float = 95.0) -> DataFrame:
    """``(a, b, ratio)``: records of one block whose titles are nearly equal. Equal titles are joined once, as a class:
    a pair stands for two classes. Blocks are equi-join keys; the length bound drops most pairs before the comparison."""
    r = records.select(F.col(id).alias("id"), F.col(block).alias("k"), F.col(title).alias("t")).where("k <> '' and t <> ''")
    c = r.groupBy("k", "t").agg(F.min("id").alias("id")).withColumn("n", F.length("t"))
    x, y = c.alias("x"), c.alias("y")
    near = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.id") < F.col("y.id")) & (2 * F.least("x.n", "y.n") >= least / 100 * (F.col("x.n") + F.col("y.n"))))
    return near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), token_sort_ratio("x.t", "y.t").alias("ratio")).where(F.col("ratio") >= least)


def recent_first(df: DataFrame, key: str, at: str, *ties: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(at), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
