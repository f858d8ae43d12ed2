"""The five gold tables. Each aggregates silver rows per service (and role) and batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import mean2, mean_percent2
from lakeward.operators.kpis import bottleneck, severity

GROUP = ("service", "batch_id")


def _stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns({"processed_timestamp": F.lit(run_ts), "pipeline_stage": F.lit("GOLD")})


def _attendance():
    # ``present`` is 0 or 1 in silver, so both sums are exact.
    return F.round(F.avg("present") * 100, 2).alias("attendance_rate")


def patient_flow(silver_patients: DataFrame, run_ts: datetime) -> DataFrame:
    out = silver_patients.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("total_patients"),
        mean2("length_of_stay").alias("avg_length_of_stay"),
        mean2("satisfaction").alias("avg_patient_satisfaction"),
        F.min("length_of_stay").alias("min_los"),
        F.max("length_of_stay").alias("max_los"),
    )
    return _stamp(out, run_ts)


def staff_efficiency(silver_schedule: DataFrame, run_ts: datetime) -> DataFrame:
    out = silver_schedule.groupBy("service", "role", "batch_id").agg(
        F.count(F.lit(1)).alias("total_schedule_records"),
        F.sum("present").alias("days_present"),
        _attendance(),
    )
    return _stamp(out, run_ts)


def bed_utilization(silver_services: DataFrame, run_ts: datetime) -> DataFrame:
    out = silver_services.groupBy(*GROUP).agg(
        mean2("occupancy_pct").alias("avg_occupancy_pct"),
        mean2("capacity_gap").alias("avg_capacity_gap"),
        mean_percent2("admission_rate").alias("avg_admission_rate_pct"),
        mean_percent2("refusal_rate").alias("avg_refusal_rate_pct"),
    )
    return _stamp(out, run_ts)


def operational_efficiency(
    silver_services: DataFrame,
    silver_schedule: DataFrame,
    silver_patients: DataFrame,
    run_ts: datetime,
) -> DataFrame:
    """Service, attendance and patient measures side by side, with the severity label.

    All three inputs are reduced to one row per group before they are joined, and the
    aggregates are already partitioned by the join keys.
    """
    services = silver_services.groupBy(*GROUP).agg(
        mean2("occupancy_pct").alias("occupancy_pct"),
        mean_percent2("admission_rate").alias("admission_rate_pct"),
        mean_percent2("refusal_rate").alias("refusal_rate_pct"),
        mean2("staff_morale").alias("staff_morale"),
        mean2("patient_satisfaction").alias("weekly_patient_satisfaction"),
        mean2("capacity_gap").alias("capacity_gap"),
    )
    attendance = silver_schedule.groupBy(*GROUP).agg(_attendance())
    patients = silver_patients.groupBy(*GROUP).agg(
        mean2("satisfaction").alias("patient_satisfaction"),
        mean2("length_of_stay").alias("avg_length_of_stay"),
        F.count(F.lit(1)).alias("total_patients"),
    )
    joined = services.join(attendance, list(GROUP), "left").join(patients, list(GROUP), "left")
    return _stamp(joined.withColumn("severity", severity()), run_ts)


def bottleneck_analysis(efficiency: DataFrame, run_ts: datetime) -> DataFrame:
    """Efficiency rows with refusal and admission as fractions and a YES/NO bottleneck flag.

    The fractions are rounded before the test: 20.49 % becomes 0.20 and is not flagged.
    """
    scaled = efficiency.withColumns(
        {
            "avg_occupancy_pct": F.col("occupancy_pct"),
            "avg_capacity_gap": F.col("capacity_gap"),
            "avg_refusal_rate": F.round(F.col("refusal_rate_pct") / 100, 2),
            "avg_admission_rate": F.round(F.col("admission_rate_pct") / 100, 2),
        }
    )
    return _stamp(scaled.withColumn("bottleneck_flag", bottleneck()), run_ts)
