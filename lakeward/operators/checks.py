"""Lineage and consistency checks. Each returns rows; none collects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.batches import RUNNING, running
from lakeward.operators.quality import union_by_name


def _check(df: DataFrame, name: str, expected: int, actual: Column) -> DataFrame:
    """One row: what was counted, what should have been counted, and whether they agree."""
    return df.agg(actual.cast("bigint").alias("actual")).select(
        F.lit(name).alias("check"),
        F.lit(expected).cast("bigint").alias("expected"),
        "actual",
        (F.col("actual") == expected).alias("passed"),
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.filter(F.col("duplicate_count") > 1)


def distinct_batches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The batch ids present in each table."""
    tagged = [df.select(F.lit(name).alias("table_name"), "batch_id") for name, df in tables.items()]
    return union_by_name(tagged).distinct()


def batch_consistency(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of batches per table; a table that is empty still has its row.

    One pass over all tables: their batch ids become distinct map-side, and only those are shuffled.
    """
    held = distinct_batches(tables)
    names = F.explode(F.array(*map(F.lit, tables))).alias("table_name")
    listed = held.sparkSession.range(1).select(names, F.lit(None).cast("string").alias("batch_id"))
    counted = held.unionByName(listed).groupBy("table_name").agg(F.count("batch_id").alias("batch_count"))
    return counted.withColumn("passed", F.col("batch_count") == 1)


def lineage_layers(layers: Mapping[str, DataFrame]) -> DataFrame:
    """The newest batch id of each layer."""
    newest = [
        df.agg(F.max("batch_id").alias("batch_id")).select(F.lit(name).alias("layer"), "batch_id")
        for name, df in layers.items()
    ]
    return union_by_name(newest)


def lineage_end_to_end(state: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per control batch, whether each layer holds it.

    Every layer is reduced to its batch ids before the join, so the rows of a batch do not
    multiply across layers.
    """
    out = state.select("batch_id", "status", "start_time")
    for layer, df in (("bronze", bronze), ("silver", silver), ("gold", gold)):
        seen = df.select("batch_id").distinct().withColumn(f"_{layer}", F.lit(1))
        out = out.join(seen, "batch_id", "left")
    counts = [
        F.coalesce(f"_{layer}", F.lit(0)).cast("bigint").alias(f"{layer}_batches")
        for layer in ("bronze", "silver", "gold")
    ]
    return out.select("batch_id", "status", "start_time", *counts)


def running_batch_count(state: DataFrame) -> DataFrame:
    return running(state).agg(F.count(F.lit(1)).alias("running_batch_count"))


def check_batch_open(state: DataFrame) -> DataFrame:
    """Running batches have a 14-digit id, a start and no end."""
    sound = (
        F.col("batch_id").rlike("^[0-9]{14}$") & F.col("start_time").isNotNull() & F.col("end_time").isNull()
    )
    broken = F.count_if(~F.coalesce(sound, F.lit(False)))
    return _check(running(state), "running batches without a sound opening", 0, broken)


def check_stale(state: DataFrame) -> DataFrame:
    """Never more than one running batch: counts the running batches beyond the first."""
    surplus = F.greatest(F.count_if(F.col("status") == RUNNING) - 1, F.lit(0))
    return _check(state, "running batches beyond the first", 0, surplus)


def check_known_batches(tables: Mapping[str, DataFrame], known: DataFrame) -> DataFrame:
    """Batch ids of each table that ``known`` does not have."""
    ids = known.select("batch_id").distinct()
    checks = []
    for name, df in tables.items():
        unknown = df.select("batch_id").distinct().join(ids, "batch_id", "left_anti")
        checks.append(_check(unknown, f"{name}: batches unknown upstream", 0, F.count(F.lit(1))))
    return union_by_name(checks)


def check_one_batch(tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """The tables of a layer together hold exactly one batch."""
    ids = union_by_name([df.select("batch_id") for df in tables.values()])
    return _check(ids, f"{layer}: distinct batches", 1, F.count_distinct("batch_id"))


def check_metadata(tables: Mapping[str, DataFrame], stage: str) -> DataFrame:
    """Rows of each table whose batch, time or stage is not filled in correctly."""
    whole = (
        F.col("batch_id").isNotNull() & F.col("processed_timestamp").isNotNull() & (F.col("pipeline_stage") == stage)
    )
    broken = F.count_if(~F.coalesce(whole, F.lit(False)))
    return union_by_name(
        [_check(df, f"{name}: rows without lineage", 0, broken) for name, df in tables.items()]
    )


def check_inventory(inventory: DataFrame) -> DataFrame:
    """Inventory rows without batch, count or status."""
    whole = F.col("batch_id").isNotNull() & (F.col("record_count") > 0) & F.col("process_status").isNotNull()
    return _check(inventory, "inventory rows incomplete", 0, F.count_if(~F.coalesce(whole, F.lit(False))))
