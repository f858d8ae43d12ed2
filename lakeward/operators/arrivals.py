"""Did today's files arrive? Status per dataset, summary, anomalies and audit rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.schemas import FILE_MONITORING_AUDIT

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ABSENT = "N/A"


def files_of_day(files: DataFrame, as_of: date) -> DataFrame:
    """Files modified on one day, written as a range so that it can prune and push down."""
    start = F.lit(as_of).cast("timestamp")
    end = F.date_add(F.lit(as_of), 1).cast("timestamp")
    return files.filter((F.col("modified_time") >= start) & (F.col("modified_time") < end))


def arrival_status(
    expected: DataFrame, files: DataFrame, as_of: date, base_path: str, allow_multiple: bool = False
) -> DataFrame:
    """Compare the files of a day with the number each dataset expects.

    ``expected`` has ``dataset``, ``expected_count`` and ``error_message`` (why the listing
    failed, or NULL). Files are counted per dataset before the join.
    """
    received = (
        files_of_day(files, as_of)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("_received"),
            F.max("modified_time").alias("_newest"),
            F.max_by("file_name", F.struct("modified_time", "file_name")).alias("_newest_name"),
        )
    )
    joined = expected.join(received, "dataset", "left").withColumns(
        {
            # A failed listing has no files to report.
            "received_count": F.when(F.col("error_message").isNull(), F.coalesce("_received", F.lit(0)))
            .otherwise(F.lit(0))
            .cast("bigint"),
        }
    )
    count, wanted = F.col("received_count"), F.col("expected_count")
    failed = F.col("error_message").isNotNull()
    # The status and reason texts that readers of the audit table expect.
    status = (
        F.when(failed, "Error")
        .when(count == wanted, "Received")
        .when(count == 0, "Missing")
        .when(count < wanted, "Incomplete")
        .otherwise("Received (Multiple)" if allow_multiple else "Multiple Files")
    )
    reason = (
        F.when(failed, F.col("error_message"))
        .when(count == wanted, "Expected file received today")
        .when(count == 0, "No file received today")
        .when(count < wanted, F.format_string("Only %d/%d expected files received today", count, wanted))
        .otherwise(F.format_string("Multiple files received today (%d files arrived)", count))
    )
    newest = F.when(count > 0, F.date_format("_newest", TIME_FORMAT))
    root = base_path.rstrip("/")
    return joined.select(
        "dataset",
        F.concat(F.lit(f"{root}/"), "dataset", F.lit("/")).alias("s3_path"),
        "expected_count",
        "received_count",
        status.alias("status"),
        (~failed & ((count == wanted) | (F.lit(allow_multiple) & (count > wanted)))).alias("is_received"),
        F.coalesce(F.when(count > 0, F.col("_newest_name")), F.lit(ABSENT)).alias("latest_file_name"),
        F.coalesce(newest, F.lit(ABSENT)).alias("last_modified_time"),
        reason.alias("reason"),
        "error_message",
    )


def arrival_anomalies(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("is_received"))


def arrival_summary(status: DataFrame, run_ts: datetime, notify_on_success: bool = True) -> DataFrame:
    """One row over all datasets, with the overall result, the decision to notify and a subject."""
    missing = F.count_if(~F.col("is_received"))
    totals = status.agg(
        F.coalesce(F.sum("expected_count"), F.lit(0)).alias("total_expected_files"),
        F.coalesce(F.sum("received_count"), F.lit(0)).alias("total_received_files"),
        F.count(F.lit(1)).alias("total_expected_datasets"),
        F.count_if(F.col("is_received")).alias("total_received_datasets"),
        missing.alias("missing_datasets_count"),
        F.when(missing == 0, "SUCCESS").otherwise("ALERT").alias("overall_status"),
    )
    return totals.select(
        F.date_format(F.lit(run_ts), TIME_FORMAT).alias("execution_timestamp"),
        F.date_format(F.lit(run_ts), "yyyy-MM-dd").alias("monitoring_date"),
        "*",
        (F.lit(notify_on_success) | (F.col("overall_status") != "SUCCESS")).alias("notify"),
        F.format_string(
            "File Monitoring - %s (%d/%d Files Received)",
            "overall_status",
            "total_received_datasets",
            "total_expected_datasets",
        ).alias("subject"),
    )


def arrival_audit(
    status: DataFrame,
    run_ts: datetime,
    job_id: str = ABSENT,
    run_id: str = ABSENT,
    duration_seconds: float = 0.0,
    notify_on_success: bool = True,
) -> DataFrame:
    """One audit row per dataset; the overall result joins as a scalar subquery."""
    summary = arrival_summary(status, run_ts, notify_on_success)
    values = {
        "execution_timestamp": F.date_format(F.lit(run_ts), TIME_FORMAT),
        "monitoring_date": F.date_format(F.lit(run_ts), "yyyy-MM-dd"),
        "job_id": F.lit(job_id),
        "run_id": F.lit(run_id),
        "expected_files": F.col("expected_count"),
        "received_files": F.col("received_count"),
        "overall_result": summary.select("overall_status").scalar(),
        "execution_duration_seconds": F.round(F.lit(duration_seconds), 2),
        "email_sent": summary.select("notify").scalar(),
    }
    audit = status.withColumns(values)
    return audit.select(*[F.col(f.name).cast(f.dataType) for f in FILE_MONITORING_AUDIT])
