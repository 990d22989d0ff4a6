"""Cutting lineage with tables in the folder that all executors share.

``save`` writes a frame as Parquet below ``spark.checkpoint.dir`` and reads it back. Loss of an
executor then never loses the intermediate result, and the next step plans on real file sizes.
The folder is taken from the session; only a session with a local master may name none and gets a
temporary one. The tables of an application are deleted when its process ends, or by ``release``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_used: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; under a local master a temporary folder of this process where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="quillspark-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quillspark/{spark.sparkContext.applicationId}"


def _delete(jvm, folder: str) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Deletes the tables saved by this application; frames that read them end with it."""
    _delete(spark._jvm, _folder(spark))


def _at_exit() -> None:
    for folder, jvm in _used.items():
        try:
            _delete(jvm, folder)
        except Exception:  # the JVM is gone: the folder is the cluster's to clean
            pass


def save(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder. Runs one job."""
    spark = df.sparkSession
    folder = _folder(spark)
    if not _used:
        atexit.register(_at_exit)
    _used.setdefault(folder, spark._jvm)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
