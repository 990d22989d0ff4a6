from pyspark.sql import functions as F

from quillspark.streaming.replay import daily_counts, publish_once


def test_publish_once_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    publish_once(a, path, ["k"])
    publish_once(a, path, ["k"])
    publish_once(spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string"), path, ["k"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "x"), (2, "y"), (3, "w")}


def test_stream_equals_batch(spark):
    folder = "/root/testdata/sf0.001"
    n = daily_counts(spark, folder).groupBy().sum("n").first()[0]
    assert n == spark.read.parquet(f"{folder}/events.parquet").select("event_id").distinct().count()


def test_publish_by_day_reads_only_its_days(spark, tmp_path):
    from datetime import date
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, day date")
    publish_once(rows((1, date(2026, 1, 1)), (2, date(2026, 1, 2))), path, ["k"], "day")
    publish_once(rows((2, date(2026, 1, 2)), (3, date(2026, 1, 2))), path, ["k"], "day")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_backfill_is_whole_and_resumes(spark):
    from quillspark.streaming.backfill import backfill_days, pending
    e = spark.createDataFrame([(f"2026-01-0{1 + i % 4} 10:00:00", "ab"[i % 2], float(i)) for i in range(40)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert backfill_days(e).groupBy().sum("n").first()[0] == 40
    days = e.select(F.col("ts").cast("date").alias("day"))
    assert [str(r.day) for r in pending(days, days.where("day < '2026-01-03'")).collect()] == ["2026-01-03", "2026-01-04"]
