"""Quality figures: precision, quantiles of several kinds, calibration, rank tests."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillspark.durable import save


def nearest(q: float):
    """The place, from 0, of a nearest-rank quantile among n sorted values: int(q (n - 1) + 0.5)."""
    return lambda n: F.floor(F.lit(q) * (n - 1) + 0.5)


def upper_half(n: Column) -> Column:
    """The place, from 0, of the upper median: n div 2."""
    return F.floor(n / 2)


def cumulated(counts: DataFrame, by: list[str], order: Column, n: str) -> DataFrame:
    """Adds ``before``, the sum of ``n`` over the rows of a group that come before this one in ``order`` (no ties), and
    ``all_``, that over the group.

    In two levels, so that no task holds a group: ranges of (group, order) sorted and written to the shared folder,
    the sums of each group in each range, and within a range a window. Runs a job.
    """
    keys = [F.col(c) for c in by]
    x = save(counts.repartitionByRange(*keys, order).withColumn("_p", F.spark_partition_id()))
    parts = x.groupBy(*by, "_p").agg(F.sum(n).alias("_s"))
    w = Window.partitionBy(*by)
    run = w.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*(F.col(c).alias("_k" + c) for c in by), F.col("_p").alias("_q"), F.coalesce(F.sum("_s").over(run), F.lit(0)).alias("_ahead"), F.sum("_s").over(w).alias("all_"))
    on = F.col("_p") == F.col("_q")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col("_k" + c))
    inner = Window.partitionBy("_p", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (x.join(parts, on).withColumn("before", F.col("_ahead") + F.coalesce(F.sum(n).over(inner), F.lit(0)))
            .drop("_p", "_q", "_ahead", *("_k" + c for c in by)))


def values_at(df: DataFrame, by: list[str], value: str, at: dict) -> DataFrame:
    """One row a group with the values at given places of its sorted values; ``at`` maps a name to the place by their number.

    Null values don't count. Values are counted first, so a group is never collected.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    x = cumulated(c, by, F.col(value).asc(), "_n")
    here = lambda f: (F.col("before") <= f(F.col("all_"))) & (f(F.col("all_")) < F.col("before") + F.col("_n"))
    return x.groupBy(*by).agg(*(F.max(F.when(here(f), F.col(value))).alias(k) for k, f in at.items()))


def precision_at_k(judged: DataFrame, day: str, rank: str, keep: str, k: int = 10, coverage: int = 8, by: list[str] | None = None) -> DataFrame:
    """``(by..., days, precision)``: mean over days of the share kept of the first k; days with too few judged don't count."""
    by = by or []
    days = (judged.where(F.col(rank) <= k).groupBy(*by, day).agg(F.avg(F.col(keep).cast("double")).alias("p"), F.count("*").alias("n"))
            .where(F.col("n") >= coverage))
    return days.groupBy(*by).agg(F.count("*").alias("days"), F.round(F.avg("p"), 6).alias("precision"))


def below(df: DataFrame, order: str, value: Column, name: str, buckets: int = 200) -> DataFrame:
    """Adds the sum of ``value`` over all rows with a smaller ``order`` (distinct numbers).

    A running sum in two levels, so that no task holds all rows: sums of ``buckets`` ranges of about equal size,
    and within each range a window.
    """
    cuts = df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.002)
    x = df.withColumn("_b", F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col(order)))) if cuts else df.withColumn("_b", F.lit(0))
    sums = x.groupBy("_b").agg(F.sum(value).alias("_s"))
    ahead = sums.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    w = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (x.join(F.broadcast(ahead), "_b").withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(w), F.lit(0))).drop("_b", "_before"))


def auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """``(auc)``: the probability that a positive scores above a negative, ties one half (rank sum); null without both."""
    ties = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"), F.count_if(F.col(positive)).alias("p"))
    return below(ties, score, F.col("n") - F.col("p"), "neg_below").agg((F.sum(F.col("p") * (F.col("neg_below") + (F.col("n") - F.col("p")) / 2)).alias("wins")),
                                  F.sum("p").alias("np"), F.sum(F.col("n") - F.col("p")).alias("nn")).select(
        F.round(F.col("wins") / F.nullif(F.col("np") * F.col("nn"), F.lit(0)), 6).alias("auc"))


def wilson_upper(kept: Column, n: Column, z: float = 1.96) -> Column:
    """Upper end of the Wilson interval of a share."""
    p = kept / n
    return (p + z * z / (2 * n) + z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def calibration(tops: DataFrame, value: str, low: float = 0.3, high: float = 0.5) -> DataFrame:
    """``(value, rate, chosen)``: for each distinct daily best its share of days at or above it; chosen is the value
    whose rate is in the band and nearest to its middle, the smaller of two."""
    v = tops.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    rates = cumulated(v, [], F.col("value").desc(), "n").withColumn("rate", (F.col("before") + F.col("n")) / F.col("all_"))
    order = F.struct(F.when((F.col("rate") >= low) & (F.col("rate") <= high), 0).otherwise(1), F.round(F.abs(F.col("rate") - (low + high) / 2), 9), F.col("value"))
    best = rates.agg(F.min_by("value", order).alias("best"))
    return rates.crossJoin(F.broadcast(best)).select("value", F.round("rate", 6).alias("rate"), F.col("value").eqNullSafe(F.col("best")).alias("chosen"))


def spearman(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``(rho, n)`` of two rankings ``(key, rank)``; a key that one lacks takes the place after its last. Ties share their mean place."""
    na, nb = a.agg(F.max("rank").alias("na")), b.agg(F.max("rank").alias("nb"))
    j = (a.select(key, F.col("rank").alias("ra")).join(b.select(key, F.col("rank").alias("rb")), key, "full")
         .crossJoin(F.broadcast(na)).crossJoin(F.broadcast(nb))
         .select(key, F.coalesce("ra", F.col("na") + 1).alias("ra"), F.coalesce("rb", F.col("nb") + 1).alias("rb")))
    for c, name in (("ra", "x"), ("rb", "y")):
        place = cumulated(j.groupBy(c).agg(F.count("*").alias("k")), [], F.col(c).asc(), "k").select(c, (F.col("before") + (F.col("k") + 1) / 2).alias(name))
        j = j.join(place, c)
    return j.agg(F.round(F.corr("x", "y"), 6).alias("rho"), F.count("*").alias("n"))


@F.pandas_udf(T.DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided p of a 2 x 2 table, by summing the tables no likelier than the one seen."""
    def log_p(w, x, y, z):
        lf = math.lgamma
        return (lf(w + x + 1) + lf(y + z + 1) + lf(w + y + 1) + lf(x + z + 1)
                - lf(w + 1) - lf(x + 1) - lf(y + 1) - lf(z + 1) - lf(w + x + y + z + 1))

    def one(w, x, y, z):
        seen, lo, hi = log_p(w, x, y, z), max(0, w - z), min(w + x, w + y)
        return min(1.0, sum(math.exp(p) for i in range(lo, hi + 1) if (p := log_p(i, w + x - i, w + y - i, z - w + i)) <= seen + 1e-9))

    return pd.Series([one(*map(int, r)) for r in zip(a, b, c, d)])


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """Two-sided tail of the standard normal distribution."""
    return z.map(lambda v: None if v is None or v != v else math.erfc(abs(v) / math.sqrt(2)))


def mann_whitney(df: DataFrame, score: str, positive: str) -> DataFrame:
    """``(u, p)``: U of the positives and its tie-corrected normal two-sided p; null p below 8 rows a side."""
    ties = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"), F.count_if(F.col(positive)).alias("k"))
    r = below(ties, score, F.col("n"), "below")
    t = r.agg(F.sum(F.col("k") * (F.col("below") + (F.col("n") + 1) / 2)).alias("ranks"), F.sum("k").alias("n1"), F.sum("n").alias("n"),
              F.sum(F.pow("n", F.lit(3)) - F.col("n")).alias("ties"))
    n0 = F.col("n") - F.col("n1")
    u = F.col("ranks") - F.col("n1") * (F.col("n1") + 1) / 2
    var = F.col("n1") * n0 / 12 * ((F.col("n") + 1) - F.col("ties") / F.nullif(F.col("n") * (F.col("n") - 1), F.lit(0)))
    return t.select(u.alias("u"), F.when((F.col("n1") >= 8) & (n0 >= 8) & (var > 0), normal_tail((u - F.col("n1") * n0 / 2) / F.sqrt(var))).alias("p"))
