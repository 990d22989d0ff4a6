"""Ranks, slots, samples and spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspark.durable import save


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; all columns kept."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_rn = 1").drop("_rn")


def top_in_group(df: DataFrame, by: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")).where(F.col(name) <= k)


def places(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Adds each row's place from 1 in an order of all rows (no two rows equal in it).

    A running count in two levels, so that no task holds all rows: ranges of the order, sorted and written to the shared
    folder with their number and the place within, then the count of rows in all ranges before. Runs a job.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    x = save(sorted_.withColumn("_b", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m"))
    n = x.groupBy("_b").agg(F.count("*").alias("_n"))
    ahead = n.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    return x.join(F.broadcast(ahead), "_b").withColumn(name, F.col("_ahead") + F.col("_i") + 1).drop("_b", "_i", "_ahead")


def lent_slots(df: DataFrame, day: str, first: Column, first_order: list[Column], first_slots: int, other_order: list[Column],
               other_slots: int, other_most: int) -> DataFrame:
    """Per day the best rows of a first path and of another, which also gets the slots the first leaves free.

    Adds ``path`` ('first' or 'other') and ``rank``. Days without rows of the first path lend all its slots.
    """
    f = (df.where(first).withColumn("rank", F.row_number().over(Window.partitionBy(day).orderBy(*first_order)))
         .where(F.col("rank") <= first_slots).withColumn("path", F.lit("first")))
    used = f.groupBy(day).agg(F.count("*").alias("used"))
    o = (df.where(~first).withColumn("rank", F.row_number().over(Window.partitionBy(day).orderBy(*other_order)))
         .join(used, day, "left").withColumn("limit", F.least(F.lit(other_most), other_slots + F.greatest(
             F.lit(0), F.lit(first_slots) - F.coalesce("used", F.lit(0)))))
         .where("rank <= limit").drop("used", "limit").withColumn("path", F.lit("other")))
    return f.unionByName(o)


def hash_sample(df: DataFrame, by: list[str], key: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows of each group in the order of a seeded hash of their key: the same draw on any cluster."""
    order = [F.md5(F.concat_ws(":", F.lit(seed), *key)), *key]
    return top_in_group(df, by, [F.col(o) if isinstance(o, str) else o for o in order], n, "draw")


def round_robin(df: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """One row of each stratum in turn, larger strata first, until n are drawn (the size of the draw is a parameter)."""
    size = df.groupBy(stratum).agg(F.count("*").alias("size"))
    turn = df.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy(F.md5(F.concat_ws(":", F.lit(seed), key)), key)))
    return turn.where(F.col("turn") <= n).join(size, stratum).orderBy("turn", F.desc("size"), stratum).limit(n)


def stride(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """Every step-th row of each group, step = max(1, size div k), at most k."""
    w = Window.partitionBy(*by)
    x = df.withColumn("_rn", F.row_number().over(w.orderBy(*order))).withColumn("_step", F.greatest(F.lit(1), F.floor(F.count("*").over(w) / k)))
    return x.where("(_rn - 1) % _step = 0").withColumn("_at", F.row_number().over(w.orderBy("_rn"))).where(F.col("_at") <= k).drop("_rn", "_step", "_at")


def day_spine(df: DataFrame, date: str) -> DataFrame:
    """``day``: every day from the first to the last, without gaps; empty for an empty table."""
    ends = df.agg(F.min(date).cast("date").alias("a"), F.max(date).cast("date").alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))


def windows(start: Column, end: Column, days: int = 7) -> Column:
    """Closed windows of ``days`` days that tile [start, end], as an array of (from, to)."""
    return F.transform(F.sequence(start, end, F.expr(f"interval {days} days")),
                       lambda s: F.struct(s.cast("date").alias("from"), F.least(F.date_add(s.cast("date"), days - 1), end).alias("to")))


def runs(df: DataFrame, by: list[str], day: str) -> DataFrame:
    """Runs of consecutive days: ``(by..., first, last, days)``. Days must be distinct within a group."""
    w = Window.partitionBy(*by).orderBy(day)
    return (df.withColumn("_g", F.date_sub(F.col(day), F.row_number().over(w))).groupBy(*by, "_g")
            .agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count("*").alias("days")).drop("_g"))
