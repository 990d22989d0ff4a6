"""Streams: repeats within a watermark, windows, and a sink that publishes each key once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspark.durable import shared_dir


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stream(spark: SparkSession, folder: str, name: str, time: str) -> DataFrame:
    """A table replayed as a stream, be it one file or a folder; its time column as a timestamp with zone, which watermarks need."""
    path = f"{folder}/{name}.parquet"
    fs, p = _fs(spark, path)
    s = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 4)
    s = s.option("pathGlobFilter", "*.parquet").parquet(path) if fs.getFileStatus(p).isDirectory() else s.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return s.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(events: DataFrame, time: str, keys: list[str], delay: str = "7 days") -> DataFrame:
    """The first event of each key within the watermark; later repeats are dropped with bounded state."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def publish_once(batch: DataFrame, path: str, key: list[str], day: str | None = None) -> None:
    """Append the rows whose key the table at ``path`` doesn't hold yet: replaying a batch adds nothing.

    With ``day`` the table is partitioned by it, and only the days of the batch are read again; a key belongs to one day.
    """
    spark = batch.sparkSession
    new = batch.dropDuplicates(key)
    fs, p = _fs(spark, path)
    if fs.exists(p):
        held = spark.read.schema(batch.schema).parquet(path)
        if day:
            # a watermark bounds the days of a batch
            held = held.where(F.col(day).isin([r[0] for r in new.select(day).distinct().collect()]))
        new = new.join(held.select(*key), key, "left_anti")
    out = new.write.mode("append")
    (out.partitionBy(day) if day else out).parquet(path)


def run(frame: DataFrame, path: str, key: list[str], day: str | None = None) -> DataFrame:
    """Run a stream over all that is there (``availableNow``) into a table that holds each key once."""
    spark = frame.sparkSession
    q = (frame.writeStream.foreachBatch(lambda b, _: publish_once(b, path, key, day)).option("checkpointLocation", path + "-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(frame.schema).parquet(path)


def daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``(day, event_type, n)`` of the events, each counted once, by way of a stream and a publish-once table."""
    path = f"{shared_dir(spark)}/quillspark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    first = deduplicated(stream(spark, folder, "events", "ts"), "ts", ["event_id"])
    got = run(first.select("event_id", "event_type", F.col("ts").cast("date").alias("day")), path, ["event_id"], "day")
    return got.groupBy("day", "event_type").agg(F.count("*").alias("n"))
