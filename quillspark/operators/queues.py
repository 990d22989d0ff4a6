"""Keyed state of work still to do: attempts, parking, and batches of the most wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def queue_places(queue: DataFrame, key: str, most: int) -> DataFrame:
    """Adds ``open`` (fewer than ``most`` attempts) and ``place``, the place among the open or the parked, by attempts and key.

    Rows of one number of attempts are numbered apart and shifted by those with fewer, so the windows are as many as there
    are numbers of attempts and ranges of keys.
    """
    from quillspark.operators.metrics import cumulated

    q = queue.withColumn("open", F.col("attempts") < most).withColumn("_one", F.lit(1))
    order = F.struct("attempts", key).asc()
    return cumulated(q, ["open"], order, "_one").withColumn("place", F.col("before") + 1).drop("before", "all_", "_one")


def due(queue: DataFrame, key: str, most: int, batch: int) -> DataFrame:
    """The next ``batch`` keys to try: open ones, least attempts first."""
    return queue.where(F.col("attempts") < most).orderBy("attempts", key).limit(batch)


def advance(state: DataFrame, tries: DataFrame, key: str, most: int) -> DataFrame:
    """``(key, attempts, state)`` after a round of ``tries`` (key, attempts, hit): resolved keys stay as they are, others add their
    attempts and are resolved by a hit, parked from ``most`` attempts on, else pending. One full join on the key."""
    s, t = state.alias("s"), tries.alias("t")
    done = F.coalesce(F.col("s.state") == "resolved", F.lit(False))
    n = F.when(done, F.col("s.attempts")).otherwise(F.coalesce("s.attempts", F.lit(0)) + F.coalesce("t.attempts", F.lit(0)))
    now = F.when(done | F.coalesce("t.hit", F.lit(False)), "resolved").when(n >= most, "parked").otherwise("pending")
    return s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "full").select(F.coalesce(f"s.{key}", f"t.{key}").alias(key), n.alias("attempts"), now.alias("state"))
