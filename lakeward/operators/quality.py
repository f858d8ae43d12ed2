"""Reconciliation metrics, the file inventory and the error table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.datasets import DATASETS
from lakeward.functions.expressions import ColumnOrName, joined_key
from lakeward.operators.refine import RECENCY, TIE_BREAKER, latest_by
from lakeward.operators.rules import PASSED, passing
from lakeward.schemas import SERIALIZATION_ERRORS

RESCUED = "_rescued_data"


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tagged(frames: Mapping[str, DataFrame], columns: Sequence[ColumnOrName]) -> DataFrame:
    return union_by_name([df.select(F.lit(name).alias("dataset_name"), *columns) for name, df in frames.items()])


_GROUP = ["dataset_name", "batch_id"]


def received_counts(validated: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, different record hashes, passing rows and first processing time of the judged rows, per feed and batch."""
    # A hash written in hex is shuffled as the bytes it stands for, any other text as it is.
    text = F.col("record_hash")
    packed = F.when((F.length(text) == 64) & (F.lower(text) == text), F.unhex(text))
    tagged = _tagged(validated, ["batch_id", packed.alias("_packed"), F.when(packed.isNull(), text).alias("_text"), "processed_timestamp", PASSED])
    # Counting per hash first leaves each hash once for the distinct count.
    hashes = tagged.groupBy(*_GROUP, "_packed", "_text").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("processed_timestamp").alias("_start"), F.count_if(F.col(PASSED)).alias("_passed")
    )
    return hashes.groupBy(*_GROUP).agg(
        F.sum("_rows").alias("records_received"),
        F.count_if(F.col("_packed").isNotNull() | F.col("_text").isNotNull()).alias("records_distinct"),
        F.min("_start").alias("processing_start"),
        F.sum("_passed").alias("_valid_before"),
    )


def newest_counts(validated: Mapping[str, DataFrame]) -> DataFrame:
    """How many keys of the passing rows have their newest row in a batch, per feed and batch."""
    feeds = {d.name: d for d in DATASETS if d.name in validated}
    keyed = union_by_name(
        [
            passing(validated[name], d.all_rules).select(
                F.lit(name).alias("dataset_name"), F.to_json(F.struct(*d.keys)).alias("_key"), "batch_id", *RECENCY, TIE_BREAKER
            )
            for name, d in feeds.items()
        ]
    )
    return latest_by(keyed, ["dataset_name", "_key"]).groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_newest"))


def data_quality_metrics(
    validated: Mapping[str, DataFrame], silver: Mapping[str, DataFrame], quarantine: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per feed and batch: received = valid + quarantined + duplicates removed.

    Each term is counted where it stands: received in ``validated``, valid in the silver table,
    quarantined in the quarantine table, and duplicates among the keys of the passing rows. Rows
    lost from either table therefore fail the reconciliation. The feeds, keyed by dataset name, are united
    first, so each term is one aggregate over narrow columns.
    """
    return reconciled(received_counts(validated), newest_counts(validated), silver, quarantine)


def reconciled(
    received: DataFrame, newest: DataFrame, silver: Mapping[str, DataFrame], quarantine: Mapping[str, DataFrame]
) -> DataFrame:
    """The metrics, from what ``received_counts`` and ``newest_counts`` found before the tables were written."""
    rejected = _tagged(quarantine, ["batch_id", "rejection_timestamp"]).groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("_rejected"), F.max("rejection_timestamp").alias("_rejected_end")
    )
    kept = _tagged(silver, ["batch_id", "silver_processed_timestamp"]).groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("_valid"), F.max("silver_processed_timestamp").alias("_silver_end")
    )

    def share(count: str):
        return F.round(
            F.when(F.col("records_received") == 0, F.lit(0.0)).otherwise(F.col(count) / F.col("records_received")), 4
        )

    # ``greatest`` skips NULLs, so it also serves when only one side has an end time.
    parts = received.join(kept, _GROUP, "left").join(rejected, _GROUP, "left").join(newest, _GROUP, "left")
    counted = parts.select(
        "batch_id",
        "dataset_name",
        "records_received",
        F.coalesce("_valid", F.lit(0)).alias("records_valid"),
        F.coalesce("_rejected", F.lit(0)).alias("records_quarantined"),
        "records_distinct",
        (F.col("_valid_before") - F.coalesce("_newest", F.lit(0))).alias("duplicates_removed"),
        "processing_start",
        F.coalesce(F.greatest("_silver_end", "_rejected_end"), F.col("processing_start")).alias("processing_end"),
    )
    accounted = F.col("records_valid") + F.col("records_quarantined") + F.col("duplicates_removed")
    return counted.withColumns(
        {
            "duration_seconds": F.unix_timestamp("processing_end") - F.unix_timestamp("processing_start"),
            "success_rate": share("records_valid"),
            "failure_rate": share("records_quarantined"),
            "reconciliation_passed": F.col("records_received") == accounted,
        }
    )


def duplicate_recount(validated: Mapping[str, DataFrame], metrics: DataFrame) -> DataFrame:
    """Duplicates per dataset counted a second way: valid rows less distinct valid keys.

    ``quality_metrics`` counts them per batch, by the newest row of each key; this one by keys alone.
    """
    recounts = []
    for d in DATASETS:
        keys = passing(validated[d.name], d.all_rules).groupBy(*d.keys).agg(F.count(F.lit(1)).alias("_rows"))
        recounts.append(
            keys.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("recounted")).select(
                F.lit(d.name).alias("dataset_name"), "recounted"
            )
        )
    reported = metrics.groupBy("dataset_name").agg(F.sum("duplicates_removed").alias("reported"))
    return (
        union_by_name(recounts)
        .join(reported, "dataset_name", "left")
        .select(
            "dataset_name",
            F.coalesce("reported", F.lit(0)).alias("reported"),
            "recounted",
            (F.coalesce("reported", F.lit(0)) == F.col("recounted")).alias("passed"),
        )
    )


def file_inventory(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One row per landed file and bronze table, from the file columns of the four bronze tables."""
    columns = [
        "file_name",
        "file_path",
        "file_size",
        "file_modification_time",
        "source_format",
        "ingestion_timestamp",
        "processed_timestamp",
        "batch_id",
    ]
    tagged = [
        bronze[d.name].select(
            *columns, F.lit(d.bronze_table).alias("bronze_table"), F.lit(d.silver_table).alias("silver_table")
        )
        for d in DATASETS
    ]
    file = [*columns[:5], "bronze_table", "silver_table"]
    # Counts and times per batch first: a hash aggregate over all rows. The largest batch id, a
    # text, would make it a sort; it is taken from the few rows left.
    per_batch = union_by_name(tagged).groupBy(*file, "batch_id").agg(
        F.min("ingestion_timestamp").alias("arrival_time"),
        F.max("processed_timestamp").alias("processing_end_time"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return (
        per_batch.groupBy(*file)
        .agg(
            F.min("arrival_time").alias("arrival_time"),
            F.max("processing_end_time").alias("processing_end_time"),
            F.sum("record_count").alias("record_count"),
            F.max("batch_id").alias("batch_id"),
        )
        .select(
            F.md5(joined_key("file_path", "bronze_table")).alias("file_id"),
            "file_name",
            "file_path",
            F.md5("file_path").alias("file_path_hash"),
            "source_format",
            "arrival_time",
            F.col("arrival_time").alias("processing_start_time"),
            "processing_end_time",
            F.lit("COMPLETED").alias("process_status"),
            "record_count",
            "bronze_table",
            "silver_table",
            "file_size",
            "file_modification_time",
            "batch_id",
        )
    )


def serialization_errors(spark: SparkSession, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One row per bronze row that kept rescued text; empty with the full schema if none can."""
    rescued = [
        bronze[d.name]
        .filter(F.col(RESCUED).isNotNull())
        .select(
            "batch_id",
            F.lit(d.name).alias("dataset"),
            F.lit("SERIALIZATION_ERROR").alias("error_type"),
            F.col(RESCUED).alias("error_message"),
            F.lit("Malformed JSON/CSV record rescued at ingestion").alias("stacktrace"),
            F.col("processed_timestamp").alias("timestamp"),
            F.lit("BRONZE").alias("pipeline_stage"),
        )
        for d in DATASETS
        if d.name in bronze and RESCUED in bronze[d.name].columns
    ]
    return union_by_name(rescued) if rescued else spark.createDataFrame([], SERIALIZATION_ERRORS)
