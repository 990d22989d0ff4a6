"""Citations: edges, coupling, neighbours, decayed counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspark.durable import save
from quillspark.operators.ranking import places


def reference_edges(works: DataFrame, key: str, refs: str, *carry: str) -> DataFrame:
    """One row per distinct (work, reference), with the columns in ``carry``."""
    return works.select(key, *carry, F.explode(F.array_distinct(F.array_compact(refs))).alias("ref"))


def coupling(edges: DataFrame, key: str, ref: str, date: str, min_shared: int = 3, window_days: int | None = 90) -> DataFrame:
    """``(a, b, shared, jaccard, date)``: pairs of works that share references.

    ``a`` is the earlier work (the smaller key on one date); both dates lie within ``window_days`` of each other, ends
    included. Edges must be distinct; a work has one date, of several the first. Null keys, references and dates are ignored.

    An exact prefix filter: references are numbered, the rarest first, and a work's list stands in that order; what a single work cites
    counts for its size alone. Two works that share
    ``min_shared`` of them share one that is not among the last ``min_shared - 1`` of either, so those, the works cited by
    everyone, are no join keys. The key also holds the date in steps of the window. Lists go along as numbers: a pair is verified where
    it meets, and counts only where its first common reference is the key, so pairs are never shuffled. What follows the key in a list
    goes along as 64 bits too: where these bits are all different on one side, two lists whose bits have too few in common are not compared.
    """
    e = edges.select(F.col(key).alias("k"), F.col(ref).alias("r"), F.col(date).alias("d")).where("k is not null and r is not null and d is not null")
    numbers = places(e.groupBy("r").agg(F.count("*").alias("f")).where("f > 1"), [F.asc("f"), F.asc("r")], "i").select("r", "i")
    works = e.join(numbers, "r", "left").groupBy("k").agg(F.min("d").alias("d"), F.count("*").alias("n"), F.array_sort(F.collect_list("i")).alias("refs"))
    works = save(works.where(F.size("refs") >= min_shared))
    bits = lambda v: F.aggregate(v, F.lit(0).cast("bigint"), lambda o, i: o.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(i, F.lit(64)).cast("int"))))
    rare = F.inline(F.transform(F.sequence(F.lit(1), F.size("refs") - (min_shared - 1)), lambda p: F.struct(
        F.get("refs", p - 1).alias("i"), bits(F.slice("refs", p + 1, F.size("refs") - p)).alias("o"), (F.size("refs") - p).alias("rest"))))
    step = F.lit(0) if window_days is None else F.floor(F.unix_date(F.col("d").cast("date")) / max(window_days, 1))
    x = works.select(F.col("k").alias("a"), F.col("d").alias("da"), F.col("n").alias("na"), F.col("refs").alias("ra"), (F.array(step) if window_days is None else F.array(step, step + 1)).alias("s"), rare)
    x = x.select("a", "da", "na", "ra", "i", F.col("o").alias("oa"), (F.bit_count("o") < F.col("rest")).alias("crowded"), F.explode("s").alias("s"))
    y = works.select(F.col("k").alias("b"), F.col("d").alias("date"), F.col("n").alias("nb"), F.col("refs").alias("rb"), step.alias("s"), rare).drop("rest").withColumnRenamed("o", "ob")
    near = F.lit(True) if window_days is None else F.datediff("date", "da") <= window_days
    order = (F.col("da") < F.col("date")) | ((F.col("da") == F.col("date")) & (F.col("a") < F.col("b")))
    likely = F.col("crowded") | (F.bit_count(F.col("oa").bitwiseAND(F.col("ob"))) >= min_shared - 1)
    # the generator keeps the common references from being computed again at each use
    met = x.join(y, ["i", "s"]).where(near & order & likely).select("a", "b", "i", "date", (F.col("na") + F.col("nb")).alias("both"), F.inline(F.array(F.struct(F.array_intersect("ra", "rb").alias("common")))))
    met = met.where((F.size("common") >= min_shared) & (F.get("common", 0) == F.col("i"))).withColumn("shared", F.size("common").cast("bigint"))
    return met.select("a", "b", "shared", F.round(F.col("shared") / (F.col("both") - F.col("shared")), 6).alias("jaccard"), "date")


def neighbours(pairs: DataFrame, k: int = 3) -> DataFrame:
    """``(item, rank, other, shared, jaccard)``: the k closest partners of each work, seen from both ends."""
    end = lambda item, other: F.struct(F.col(item).alias("item"), F.col(other).alias("other"), "shared", "jaccard")
    both = pairs.select(F.inline(F.array(end("a", "b"), end("b", "a"))))  # a union would compute the pairs twice
    w = Window.partitionBy("item").orderBy(F.desc("shared"), F.desc("jaccard"), "other")
    return both.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k).select("item", "rank", "other", "shared", "jaccard")


def decayed(age: Column, half_life: float) -> Column:
    """Weight of a citation by its age in days; ages below 0 count as 0."""
    return F.pow(F.lit(0.5), F.greatest(age, F.lit(0)) / F.lit(float(half_life)))


def accumulate(edges: DataFrame, ref: str, date: str, half_life: float = 180, recent_days: int = 365, today: Column | None = None) -> DataFrame:
    """``(ref, raw, weighted, recent)``: citations of each reference, plain, decayed, and of the last days."""
    e = edges.select(F.col(ref).alias("ref"), F.col(date).alias("d")).where("ref is not null and d is not null")
    if today is None:
        e = e.crossJoin(F.broadcast(e.agg(F.max("d").alias("today"))))
    else:
        e = e.withColumn("today", today)
    age = F.datediff("today", "d")
    return e.groupBy("ref").agg(F.count("*").alias("raw"), F.round(F.sum(decayed(age, half_life)), 6).alias("weighted"),
                                F.count_if(F.greatest(age, F.lit(0)) <= recent_days).alias("recent"))


def internal_edges(edges: DataFrame, works: DataFrame, key: str, ref: str, own_id: str) -> DataFrame:
    """``(citing, cited)``: references that are works of the collection themselves, no loops."""
    t = works.select(F.col(own_id).alias("ref_id"), F.col(key).alias("cited")).where("ref_id is not null").distinct()
    return (edges.select(F.col(key).alias("citing"), F.col(ref).alias("ref_id")).join(t, "ref_id")
            .where("citing <> cited").select("citing", "cited").distinct())
