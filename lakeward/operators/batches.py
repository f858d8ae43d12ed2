"""Batch control as an append-only event table and a view of its latest state.

Plain file tables have no UPDATE. Opening, failing and closing a batch each append one event;
the state of a batch is its newest event.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.quality import union_by_name
from lakeward.schemas import BATCH_EVENTS

RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"
BATCH_ID_FORMAT = "yyyyMMddHHmmss"


def _as_events(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in BATCH_EVENTS])


def batch_state(events: DataFrame) -> DataFrame:
    """One row per batch. At equal times a closing event outranks the opening one."""
    newest = F.struct(
        "event_time", (F.col("status") != RUNNING).alias("closing"), "status", "source_files", "processed_records"
    )
    state = events.groupBy("batch_id").agg(
        F.min(F.struct("event_time", "pipeline_name")).alias("_first"), F.max(newest).alias("_last")
    )
    return state.select(
        "batch_id",
        "_first.pipeline_name",
        F.col("_first.event_time").alias("start_time"),
        F.when(F.col("_last.closing"), F.col("_last.event_time")).alias("end_time"),
        "_last.status",
        "_last.source_files",
        "_last.processed_records",
    )


def running(state: DataFrame) -> DataFrame:
    return state.filter(F.col("status") == RUNNING)


def current_batch(state: DataFrame) -> DataFrame:
    """The newest running batch: one row, or none."""
    return running(state).orderBy(F.col("start_time").desc_nulls_last(), F.col("batch_id").desc()).limit(1)


def require_current_batch(state: DataFrame) -> str:
    """Id of the newest running batch, for callers that need it as a value."""
    row = current_batch(state).select("batch_id").first()
    if row is None:
        raise LookupError("no RUNNING batch in the control table")
    return row["batch_id"]


def batch_history(state: DataFrame) -> DataFrame:
    return state.orderBy(F.col("start_time").desc_nulls_last(), F.col("batch_id").desc())


def latest_batch(state: DataFrame) -> DataFrame:
    return batch_history(state).limit(1).select("batch_id", "status", "start_time", "end_time")


def open_event(spark: SparkSession, run_ts: datetime, pipeline_name: str) -> DataFrame:
    """The RUNNING event of a new batch, whose id is its start time."""
    started = F.lit(run_ts)
    return _as_events(
        spark.range(1).select(
            F.date_format(started, BATCH_ID_FORMAT).alias("batch_id"),
            F.lit(pipeline_name).alias("pipeline_name"),
            started.alias("event_time"),
            F.lit(RUNNING).alias("status"),
            F.lit(0).alias("source_files"),
            F.lit(0).alias("processed_records"),
        )
    )


def stale_events(state: DataFrame, run_ts: datetime) -> DataFrame:
    """FAILED events for every batch that is still running."""
    return _as_events(
        running(state).withColumns({"event_time": F.lit(run_ts), "status": F.lit(FAILED)})
    )


def start_batch(spark: SparkSession, events: DataFrame, run_ts: datetime, pipeline_name: str) -> DataFrame:
    """Events that fail the stale batches and open a new one.

    Ids have a resolution of one second; opening a batch whose id is taken would merge two
    runs, so that fails the query.
    """
    batch_id = run_ts.strftime("%Y%m%d%H%M%S")
    taken = events.filter(F.col("batch_id") == batch_id).select(F.count(F.lit(1)).alias("n")).scalar() > 0
    opened = open_event(spark, run_ts, pipeline_name).withColumn(
        "batch_id",
        F.when(taken, F.raise_error(F.lit(f"batch {batch_id} exists already")).cast("string")).otherwise(F.col("batch_id")),
    )
    return stale_events(batch_state(events), run_ts).unionByName(_as_events(opened))


def batch_totals(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Records and distinct source files of every batch over the bronze tables."""
    return _totals(union_by_name([df.select("batch_id", "file_path") for df in bronze.values()]))


def _totals(rows: DataFrame) -> DataFrame:
    # Counting per file first leaves one row per file for the distinct count.
    per_file = rows.groupBy("batch_id", "file_path").agg(F.count(F.lit(1)).alias("_rows"))
    return per_file.groupBy("batch_id").agg(
        F.sum("_rows").alias("processed_records"), F.count("file_path").alias("source_files")
    )


def batch_files(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """The distinct source files of every batch over the bronze tables."""
    return union_by_name([df.select("batch_id", "file_path") for df in bronze.values()]).distinct()


def close_events(
    state: DataFrame, bronze: Mapping[str, DataFrame], status: str, run_ts: datetime
) -> DataFrame:
    """The closing event of the newest running batch, with its totals; none if nothing runs.

    The bronze tables are united and joined to the one row of the current batch, which prunes
    the partitions of tables partitioned by batch.
    """
    if status not in (COMPLETED, FAILED):
        raise ValueError(f"a batch closes as {COMPLETED} or {FAILED}, not {status!r}")
    current = current_batch(state).select("batch_id", "pipeline_name")
    rows = union_by_name([df.select("batch_id", "file_path") for df in bronze.values()])
    # One row at most, so its broadcast is bounded.
    totals = _totals(rows.join(F.broadcast(current.select("batch_id")), "batch_id"))
    return _as_events(
        current.join(totals, "batch_id", "left").withColumns(
            {
                "event_time": F.lit(run_ts),
                "status": F.lit(status),
                "source_files": F.coalesce("source_files", F.lit(0)),
                "processed_records": F.coalesce("processed_records", F.lit(0)),
            }
        )
    )
