"""Shared-storage helpers: where durable intermediate data goes, and its removal."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_left: dict[str, SparkSession] = {}
_tables: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    A folder given to `SparkContext.setCheckpointDir` counts as well. With
    neither set this is an error: a machine-local default would fail on a
    cluster, late and confusingly.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return current.rstrip("/")


def ensure_workspace(spark: SparkSession) -> SparkSession:
    """Under a local master without `spark.checkpoint.dir`, set a temporary folder (tests, local runs)."""
    sc = spark.sparkContext
    unset = not spark.conf.get("spark.checkpoint.dir", None) and sc.getCheckpointDir() is None
    if unset and sc.master.split("[")[0] == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stockpolicy-"))
    return spark


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of the path, and the path as its object."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name on shared storage; the folder goes when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _left[path] = spark
    return path


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write to a scratch folder as Parquet and read it back. Runs a job.

    Later steps see the very same rows even if executors are lost, which a
    cache would not guarantee, and read only the columns they use, which a
    checkpoint would not allow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held._scratch = path
    return held


def release(held: DataFrame) -> None:
    """Deletes the folder of a frame that `stored` returned, when nothing reads it any more.

    Frames that did not come from `stored` are left alone.
    """
    path = getattr(held, "_scratch", None)
    if path in _left:
        fs, where = file_system(_left.pop(path), path)
        fs.delete(where, True)


def stored_count(df: DataFrame, name: str = "stored") -> tuple[DataFrame, int]:
    """`stored`, and the rows written, observed by the job that writes them."""
    seen = Observation()
    held = stored(df.observe(seen, F.count("*").alias("n")), name)
    return held, seen.get["n"]


def stored_by(df: DataFrame, key: str, buckets: int, name: str = "stored") -> DataFrame:
    """`stored`, as a table bucketed by `key`: grouping by it needs no further shuffle. Runs a job.

    Only a table in the catalog carries its buckets. It is dropped with its folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    _tables[table] = spark
    return spark.table(table)


def remove_scratch() -> None:
    """Delete the scratch folders and tables of this program. Frames that read them stop working."""
    for table, spark in list(_tables.items()):
        _tables.pop(table)
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # as below
            continue
    for path, spark in list(_left.items()):
        _left.pop(path)
        try:
            fs, where = file_system(spark, path)
            fs.delete(where, True)
        except Exception:  # the session is gone; its folder is left to the cluster's clean-up
            continue


atexit.register(remove_scratch)
