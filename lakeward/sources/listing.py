"""Which files have landed, without reading them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "dataset string, file_name string, modified_time timestamp, size bigint"
FAILURES = "dataset string, error_message string"


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` at any depth: dataset (first folder), name, time and size.

    The content column of the binary source is pruned, so only the listing is read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    anchor = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.substring_index("path", anchor + "/", -1)
    return listed.select(
        F.substring_index(below, "/", 1).alias("dataset"),
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("modificationTime").alias("modified_time"),
        F.col("length").alias("size"),
    )


def listed_folders(spark: SparkSession, folders: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Files of each dataset's folder (as ``landed_files`` gives them), and a row for each folder that cannot be listed.

    One folder that fails does not stop the others. Folders are the monitored datasets, a short list from the
    configuration; the files below them are listed by Spark and never reach the driver.
    """
    files, failures = spark.createDataFrame([], FILES), []
    for dataset, folder in folders.items():
        try:
            below = landed_files(spark, folder)
        except AnalysisException as error:
            failures.append((dataset, f"listing failed: {error.getCondition()}"))
        else:
            files = files.unionByName(below.withColumn("dataset", F.lit(dataset)))
    return files, spark.createDataFrame(failures, FAILURES)
