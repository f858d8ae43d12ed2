"""Small files that must appear whole or not at all, in whatever store holds the tables."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False, and nothing changed, if there is one already.

    The text is written beside it and then renamed without leave to replace, as streaming checkpoints
    are: where the store renames atomically, one of two writers gets True.
    """
    store, target = _target(spark, path)
    if store.exists(target):
        return False
    jvm = spark._jvm
    store.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{jvm.java.util.UUID.randomUUID()}")
    stream = store.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        # Without the option to overwrite, this rename fails where the target exists.
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(store.makeQualified(draft), store.makeQualified(target), none)
        return True
    except Exception as error:
        if not _exists_already(error):
            raise
        return False
    finally:
        store.delete(draft, False)


def _exists_already(error: Exception) -> bool:
    return "FileAlreadyExists" in str(error) or isinstance(error, PySparkException) and "exist" in str(error)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, in order, without drafts; none if there is no folder."""
    store, target = _target(spark, folder)
    if not store.exists(target):
        return []
    return sorted(n for n in (f.getPath().getName() for f in store.listStatus(target)) if not n.startswith(("_", ".")))


def text_of(spark: SparkSession, path: str) -> str:
    store, target = _target(spark, path)
    stream = store.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
