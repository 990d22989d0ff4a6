"""Session settings the engine expects, and the helpers that read them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "quillspark", cores: int | str | None = None, shuffle: int | None = None,
                  memory: str | None = None) -> SparkSession:
    """A local session with UTC, AQE and Arrow; on a cluster, master and sizes come from spark-submit."""
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle or 8))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", memory or "8g"))
    if "spark.master" not in dict(b._options) and not os.environ.get("SPARK_MASTER_SET"):
        b = b.master(f"local[{cores}]")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
