"""Batch lineage columns, record hashes and numbered copies."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import fingerprint

COPY_NUMBER = "copy_number"
COPIES_PER_ROW_GROUP = 100_000


def number_copies(df: DataFrame, group: int = COPIES_PER_ROW_GROUP) -> DataFrame:
    """Number the copies of identical rows 1, 2, … without ranking rows.

    Copies are interchangeable, so they are counted (combined before the shuffle, whatever
    their share of the table) and written out again. Large counts are first split into groups
    of ``group`` copies that are spread over the tasks, so no task rebuilds a hot row alone.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    starts = F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), F.lit(group).cast("bigint"))
    groups = counted.withColumn("_start", F.explode(starts))
    # A stated partition count keeps adaptive execution from merging these small rows
    # back into a few tasks just before they grow.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = groups.repartition(tasks, F.xxhash64(*columns), "_start")
    last = F.least(F.col("_copies"), F.col("_start") + (group - 1))
    return spread.select(*columns, F.explode(F.sequence("_start", last)).alias(COPY_NUMBER))


def add_batch_lineage(
    df: DataFrame, batch_id: str, run_ts: datetime, content: Sequence[str]
) -> DataFrame:
    """Stamp batch, time and stage, and hash the row's origin and content.

    The hash is a function of batch, file and raw content: reading the same file again in the
    same batch gives the same hashes. Identical rows share a hash unless the frame carries
    ``copy_number`` (see ``number_copies``; batch frames only, since a stream cannot count
    copies without state).
    """
    origin = [F.lit(batch_id), F.col("file_name"), F.col("file_modification_time")]
    extra = [F.col(COPY_NUMBER)] if COPY_NUMBER in df.columns else []
    return df.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "processed_timestamp": F.lit(run_ts),
            "pipeline_stage": F.lit("BRONZE"),
            "record_hash": fingerprint(*origin, *[F.col(c) for c in content], *extra),
        }
    ).drop(COPY_NUMBER)
