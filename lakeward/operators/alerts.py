"""Services that need attention, and the counts behind a notification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.kpis import SEVERITY_DEFAULT, SEVERITY_LADDER, severity_rank

# The lines of a service's digest and the column behind each.
DIGEST_LINES = (
    ("Service", "service"),
    ("Severity", "severity"),
    ("Occupancy Percentage", "occupancy_pct"),
    ("Attendance Rate", "attendance_rate"),
    ("Refusal Rate Percentage", "refusal_rate_pct"),
    ("Staff Morale", "staff_morale"),
    ("Average Length Of Stay", "avg_length_of_stay"),
    ("Capacity Gap", "capacity_gap"),
)


def _of_batch(efficiency: DataFrame, batch_id: str | None) -> DataFrame:
    return efficiency if batch_id is None else efficiency.filter(F.col("batch_id") == batch_id)


def alert_services(efficiency: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Every service above NORMAL with its eight display values, a sort rank and a text digest."""
    lines = [
        F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for label, c in DIGEST_LINES
    ]
    return (
        _of_batch(efficiency, batch_id)
        .filter(F.col("severity") != SEVERITY_DEFAULT)
        .select(
            "batch_id",
            severity_rank().alias("severity_rank"),
            *[c for _, c in DIGEST_LINES],
            F.concat_ws("\n\n", *lines).alias("digest"),
        )
    )


def alert_summary(efficiency: DataFrame, batch_id: str | None = None, title: str = "Operational Alert") -> DataFrame:
    """Counts per severity level in one pass, and a subject line."""
    levels = [F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count") for s, _ in SEVERITY_LADDER]
    counted = _of_batch(efficiency, batch_id).agg(
        *levels, F.count_if(F.col("severity") != SEVERITY_DEFAULT).alias("total_attention_count")
    )
    return counted.withColumn(
        "subject",
        F.format_string(
            f"{title} - %d Critical Services | %d Total Alerts", "critical_count", "total_attention_count"
        ),
    )
