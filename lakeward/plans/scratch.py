"""Where a run may put intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``, deleted when the driver ends.

    Only a local session without that setting falls back to a folder on this machine: on a
    cluster such a folder would not be visible to every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/lakeward/{label}-{uuid4().hex}"
        atexit.register(_forget, spark, folder)
        return folder
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"lakeward-{label}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new catalog database whose tables lie in a scratch folder; dropped when the driver ends."""
    name = f"lakeward_{label}_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_root(spark, label)}'")
    atexit.register(_forget_database, spark, name)
    return name


def _forget_database(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    except Exception:  # the session is gone, and with it a catalog that it alone held
        pass


def _forget(spark: SparkSession, folder: str) -> None:
    """Delete a folder when the driver ends, if its session can still be reached."""
    try:
        drop_folder(spark, folder)
    except Exception:  # the JVM is gone: the shared folder is the cluster's to clean
        pass


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables in whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
