"""File streams from the landing folders into a bronze table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeward.datasets import Dataset
from lakeward.operators.lineage import add_batch_lineage
from lakeward.sources.landing import read_landing
from lakeward.sources.tables import COMPRESSION


def content_columns(dataset: Dataset) -> list[str]:
    return [*dataset.columns, "_rescued_data"]


def bronze_stream(
    spark: SparkSession,
    dataset: Dataset,
    batch_id: str,
    run_ts: datetime,
    *,
    csv_path: str | None = None,
    json_path: str | None = None,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """CSV and JSON file streams of one feed, united and stamped with batch lineage."""
    landed = read_landing(
        spark,
        dataset.schema,
        run_ts,
        csv_path=csv_path,
        json_path=json_path,
        multi_line=multi_line,
        streaming=True,
        max_files_per_trigger=max_files_per_trigger,
    )
    return add_batch_lineage(landed, batch_id, run_ts, content_columns(dataset))


def ingest_available(stream: DataFrame, table_path: str, checkpoint: str, layout: str = "batch_id") -> StreamingQuery:
    """Append every file that has landed since the last run, then stop.

    The checkpoint remembers the files already taken and the file sink commits a micro-batch
    as a whole, so a run that dies and restarts neither loses nor repeats a file.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .option("compression", COMPRESSION)
        .partitionBy(layout)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
