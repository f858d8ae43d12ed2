"""Small hand-made rows for the four feeds."""

from datetime import date, datetime

from pyspark.sql.types import StructType

from lakeward import schemas
from lakeward.datasets import PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE

RUN_TS = datetime(2026, 1, 7)

GOOD = {
    PATIENTS.name: dict(
        patient_id="p1", name="A", age=40, arrival_date=date(2025, 1, 1), departure_date=date(2025, 1, 4),
        service="icu", satisfaction=80,
    ),
    STAFF.name: dict(staff_id="s1", staff_name="B", role="nurse", service="icu"),
    STAFF_SCHEDULE.name: dict(week=1, staff_id="s1", staff_name="B", role="nurse", service="icu", present=1),
    SERVICES.name: dict(
        week=1, month=1, service="icu", available_beds=20, patients_request=20, patients_admitted=15,
        patients_refused=5, patient_satisfaction=80, staff_morale=70, event="none",
    ),
}

TAIL = dict(
    file_name="f.csv", file_path="/landing/f.csv", file_size=10, file_modification_time=datetime(2026, 1, 1),
    source_format="csv", ingestion_timestamp=datetime(2026, 1, 5), _rescued_data=None, batch_id="20260105000000",
    processed_timestamp=datetime(2026, 1, 5), pipeline_stage="BRONZE", record_hash="h",
)


def rows(spark, dataset, changes):
    """Bronze rows: the good row of the feed with each change applied, hashed by position."""
    schema: StructType = schemas.bronze(dataset)
    data = []
    for i, change in enumerate(changes):
        row = GOOD[dataset.name] | TAIL | {"record_hash": f"h{i:03d}"} | change
        data.append(tuple(row[f.name] for f in schema))
    return spark.createDataFrame(data, schema)
