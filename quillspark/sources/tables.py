"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings items listings "
          "raw_works authors institutions sources eval_items mix_targets level_labels").split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names=TABLES) -> None:
    """Temporary views for ``spark.sql``."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)
