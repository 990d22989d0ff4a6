"""Replays: novelty against an archive that grows by what each day takes, and rankings over windows that roll back."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from quillspark.durable import save
from quillspark.operators import graph as G, metrics as M


def growing_archive(papers: DataFrame, threshold: float = 0.5, weight: float = 0.2, most_days: int = 5_000) -> DataFrame:
    """``(item_id, day, novelty, score, taken)`` of papers ``(item_id, day, relevance, tags)``.

    A day's papers are scored against the tags of papers *taken* on earlier days: novelty is the share of tags not seen, the
    score is relevance plus ``weight`` times novelty, and papers from ``threshold`` on are taken. The first day each tag was
    taken is the whole state: one row a tag. Rounds over all days replace the loop over days; they end when a round changes
    nothing, after as many rounds as there are days at most. Papers without tags have no novelty. More days than ``most_days`` raise.
    """
    p = save(papers.select("item_id", F.col("day").cast("date").alias("day"), F.coalesce("relevance", F.lit(0.0)).alias("relevance"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags")))
    days = [r[0] for r in p.select("day").where("day is not null").distinct().limit(most_days + 1).collect()]
    if len(days) > most_days:
        raise ValueError(f"more than {most_days} days")
    # What a day takes depends on the days before alone, so after k rounds the first k days stand; once a round changes nothing, all do.
    tags = save(p.select("item_id", "day", "relevance", F.explode("tags").alias("tag")).distinct())
    taken = p.withColumn("taken", F.col("relevance") >= threshold)
    for _ in range(len(days) + 1):
        first = tags.join(taken.where("taken").select("item_id"), "item_id", "left_semi").groupBy("tag").agg(F.min("day").alias("first"))
        n = tags.join(first, "tag", "left").groupBy("item_id").agg(F.avg((F.col("first").isNull() | (F.col("first") >= F.col("day"))).cast("double")).alias("novelty"))
        scored = p.join(n, "item_id", "left").withColumn("novelty", F.coalesce("novelty", F.lit(0.0))).withColumn("score", F.round(F.col("relevance") + weight * F.col("novelty"), 6))
        now = save(scored.withColumn("taken", F.col("score") >= threshold).select("item_id", "day", "relevance", "novelty", "score", "taken"))
        before = taken.select("item_id", F.col("taken").alias("t"))
        if not now.join(before, "item_id").where("taken <> t").limit(1).count():
            return now.where("day is not null").select("item_id", "day", F.round("novelty", 6).alias("novelty"), "score", "taken")
        taken = now
    raise RuntimeError("the replay did not settle")


def window_stability(tags: DataFrame, windows=(30, 60, 90), top: int = 10, min_degree: int = 3) -> DataFrame:
    """``(shorter, longer, rho, n, degenerate)`` for each pair of windows that end on the last day of tags ``(item_id, topic, day)``:
    the rank correlation of the ``top`` tags by betweenness, absent ones last. A window whose scores are all equal is degenerate."""
    last = tags.agg(F.max("day").alias("today"))
    x = save(tags.crossJoin(F.broadcast(last)).where(F.col("day") > F.date_sub("today", max(windows))))
    ranks = {}
    for w in windows:
        part = G.betweenness(G.projection(x.where(F.col("day") > F.date_sub("today", w)), "item_id", "topic"), min_degree)
        head = part.orderBy(F.desc("score"), "node").limit(top).collect()
        flat = len({r["score"] for r in head}) <= 1
        rows = [(r["node"], i + 1) for i, r in enumerate(head)]
        ranks[w] = (tags.sparkSession.createDataFrame(rows, "topic string, rank int"), flat)
    out = None
    for a, b in combinations(windows, 2):
        r = M.spearman(ranks[a][0], ranks[b][0], "topic").select(F.lit(a).alias("shorter"), F.lit(b).alias("longer"), "rho", "n", F.lit(ranks[a][1] or ranks[b][1]).alias("degenerate"))
        out = r if out is None else out.union(r)
    return out
