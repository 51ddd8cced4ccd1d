"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the session, ``spark.checkpoint.dir``.

    Only a local session, as in tests, may leave it unset: then a temporary
    folder of this machine is used.  On a cluster executors would not share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="taskcurate-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark finds it."""
    store, place = _hadoop(spark, path)
    return store.exists(place)


def put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Let the finished folder ``new`` take the name ``path``; what was there goes only after it is moved aside."""
    store, target = _hadoop(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced")
    if store.exists(old):
        if store.exists(target):
            store.delete(old, True)  # left by a job that ended after its switch
        elif not store.rename(old, target):
            raise OSError(f"cannot restore {path}")
    if store.exists(target) and not store.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    store.mkdirs(target.getParent())
    if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(new), target):
        store.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    store.delete(old, True)
