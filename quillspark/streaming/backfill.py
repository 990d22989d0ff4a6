"""Backfill of days: oldest first, a checkpoint after each batch, what is done is skipped."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from quillspark.durable import save, shared_dir


def pending(days: DataFrame, done: DataFrame, day: str = "day") -> DataFrame:
    """Days not yet done, oldest first."""
    return days.select(day).distinct().join(done.select(day).distinct(), day, "left_anti").orderBy(day)


def backfill_days(events: DataFrame, files_per_batch: int = 1) -> DataFrame:
    """``(day, event_type, n, spent)`` of events written by day and read again as a stream with a checkpoint.

    The stream takes ``files_per_batch`` files at a time until none is left. Each batch overwrites its own part of the result, so a batch
    repeated after a failure changes nothing; sums are taken when the parts are read.
    """
    spark = events.sparkSession
    root = f"{shared_dir(spark)}/quillspark/{spark.sparkContext.applicationId}/backfill-{uuid.uuid4().hex}"
    e = events.select(F.col("ts").cast("date").alias("day"), "event_type", "value")
    e.repartitionByRange("day").write.parquet(f"{root}/in")
    out = "day date, event_type string, n bigint, spent double"

    def part(batch: DataFrame, number: int) -> None:
        (batch.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("spent"))
         .write.mode("overwrite").parquet(f"{root}/out/batch={number}"))

    def run() -> int:
        q = (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{root}/in").writeStream
             .foreachBatch(part).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    run()
    if run():
        raise RuntimeError("a resumed backfill took rows again")
    parts = spark.read.schema(out).parquet(f"{root}/out")
    return save(parts.groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("spent"), 4).alias("spent")))
