"""Per-row service indicators and the label ladders built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import ladder, ratio


def service_kpis(df: DataFrame) -> DataFrame:
    """Add the three rates, the capacity gap and the occupancy percentage of a service week.

    ``occupancy_pct`` starts from the already rounded rate, so it is a whole percent.
    """
    beds_short = F.col("patients_request") - F.col("available_beds")
    return df.withColumns(
        {
            "occupancy_rate": F.round(ratio("patients_admitted", "available_beds"), 2),
            "admission_rate": F.round(ratio("patients_admitted", "patients_request"), 2),
            "refusal_rate": F.round(ratio("patients_refused", "patients_request"), 2),
            "capacity_gap": F.when(beds_short > 0, beds_short).otherwise(F.lit(0)),
        }
    ).withColumn("occupancy_pct", F.round(F.col("occupancy_rate") * 100, 2))


# Labels and thresholds of the two ladders, first match wins.
SEVERITY_LADDER = (
    ("CRITICAL", "occupancy_pct > 90 OR capacity_gap > 30"),
    ("HIGH", "refusal_rate_pct > 30"),
    ("MEDIUM", "attendance_rate < 70"),
    ("LOW", "staff_morale < 50"),
)
SEVERITY_DEFAULT = "NORMAL"
BOTTLENECK_LADDER = (("YES", "avg_occupancy_pct > 90 OR avg_refusal_rate > 0.20D"),)
BOTTLENECK_DEFAULT = "NO"


def severity() -> Column:
    return ladder(SEVERITY_LADDER, SEVERITY_DEFAULT)


def severity_rank() -> Column:
    """1 for the most severe label, one more for each step below it."""
    labels = [label for label, _ in SEVERITY_LADDER] + [SEVERITY_DEFAULT]
    return F.array_position(F.array(*[F.lit(label) for label in labels]), F.col("severity")).cast("int")


def bottleneck() -> Column:
    return ladder(BOTTLENECK_LADDER, BOTTLENECK_DEFAULT)
