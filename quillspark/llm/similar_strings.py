"""Strings within a small edit distance: the pigeonhole segment join.

A string is cut into k + 1 segments. If two strings are within k edits, one segment of the shorter
stands unchanged in the longer, shifted by few places. Segments go into an inverted index by
(length, segment number, text); each string looks up its substrings at the shifted places, and
candidates are verified with a banded edit distance. All of it runs on JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _segments(k: int) -> Column:
    """For string ``s`` of length ``n``: its k + 1 segments as (i, from, length), the longer ones last."""
    parts = k + 1
    return F.expr(f"transform(sequence(1, {parts}), i -> struct(i as i, "
                  f"cast((i - 1) * (n div {parts}) + greatest(0, i - 1 - ({parts} - n % {parts})) as int) as at, "
                  f"cast(n div {parts} + if(i > {parts} - n % {parts}, 1, 0) as int) as len))")


def similar_strings(values: DataFrame, column: str, k: int = 2) -> DataFrame:
    """``(a, b, edits)`` for all pairs a < b of distinct strings within ``k`` edits of each other.

    Exact for strings of more than k characters; shorter ones are compared with strings of up to 2 k + 1
    characters by their first character or, being so short, by length. Nulls and empty strings are ignored.
    """
    parts = k + 1
    s = (values.select(F.col(column).alias("s")).where("s <> ''").distinct()
         .withColumn("n", F.length("s")))
    long = s.where(F.col("n") >= parts)
    index = (long.select("s", "n", F.explode(_segments(k)).alias("g"))
             .select(F.col("s").alias("b"), F.col("n").alias("l"), F.col("g.i").alias("i"),
                     F.expr("substring(s, g.at + 1, g.len)").alias("seg")))
    probe = (long.withColumn("l", F.explode(F.expr(f"sequence(greatest({parts}, n - {k}), n)")))
             .select("s", F.col("n").alias("own"), F.col("l").alias("n"))
             .withColumn("g", F.explode(_segments(k)))
             # the segment may shift by what the edits before it and after it allow
             .withColumn("p", F.explode(F.expr(
                 f"sequence(greatest(0, g.at - (g.i - 1), g.at + (own - n) - ({parts} - g.i)), "
                 f"greatest(greatest(0, g.at - (g.i - 1), g.at + (own - n) - ({parts} - g.i)), "
                 f"least(own - g.len, g.at + (g.i - 1), g.at + (own - n) + ({parts} - g.i))))")))
             .where("p + g.len <= own")
             .select(F.col("s").alias("a"), "own", F.col("n").alias("l"), F.col("g.i").alias("i"),
                     F.expr("substring(s, p + 1, g.len)").alias("seg")).distinct())
    found = (probe.join(index, ["l", "i", "seg"]).where("own > l or a > b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    short = s.where(F.col("n") <= k)
    near = s.where(F.col("n") <= 2 * k + 1)
    found = found.union(short.select(F.col("s").alias("x"), F.explode(F.expr(f"sequence(1, n + {k})")).alias("m"))
                        .join(near.select(F.col("s").alias("y"), F.col("n").alias("m")), "m").where("x <> y")
                        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return (found.withColumn("edits", F.levenshtein("a", "b", k)).where("edits >= 0").dropDuplicates(["a", "b"]))
