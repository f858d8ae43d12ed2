"""Table schemas of every layer, derived from the feed descriptions so they cannot drift."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from lakeward.datasets import DATASETS, SERVICES, Dataset

_KINDS = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
    "strings": ArrayType(StringType()),
}


def _fields(text: str) -> list[StructField]:
    pairs = [item.split(":") for item in text.split()]
    return [StructField(name, _KINDS[kind], True) for name, kind in pairs]


def _struct(text: str) -> StructType:
    return StructType(_fields(text))


FILE_COLUMNS = _fields("file_name:string file_path:string file_size:bigint file_modification_time:timestamp")
SOURCE_COLUMNS = _fields("source_format:string ingestion_timestamp:timestamp")
RESCUE_COLUMNS = _fields("_rescued_data:string")
LINEAGE_COLUMNS = _fields(
    "batch_id:string processed_timestamp:timestamp pipeline_stage:string record_hash:string"
)
_INDICATORS = _fields(
    "occupancy_rate:double admission_rate:double refusal_rate:double capacity_gap:int occupancy_pct:double"
)
_LENGTH_OF_STAY = _fields("length_of_stay:int")


def bronze(dataset: Dataset) -> StructType:
    return StructType([*dataset.schema, *FILE_COLUMNS, *SOURCE_COLUMNS, *RESCUE_COLUMNS, *LINEAGE_COLUMNS])


def _refined(dataset: Dataset) -> list[StructField]:
    extra = _LENGTH_OF_STAY if dataset.derived else []
    return [*extra, *(_INDICATORS if dataset is SERVICES else [])]


def _carried() -> list[StructField]:
    """Bronze columns below the declared ones, without the time that the later layers rename."""
    tail = [*FILE_COLUMNS, *SOURCE_COLUMNS, *RESCUE_COLUMNS, *LINEAGE_COLUMNS]
    return [f for f in tail if f.name != "processed_timestamp"]


def silver(dataset: Dataset) -> StructType:
    stamp = _fields("bronze_processed_timestamp:timestamp silver_processed_timestamp:timestamp validation_version:string")
    return StructType([*dataset.schema, *_carried(), *_refined(dataset), *stamp])


def quarantine(dataset: Dataset) -> StructType:
    payload = [StructField("record_payload", bronze(dataset), True)]
    stamp = _fields(
        "failed_rules:strings rejection_reasons:strings unknown_rules:strings quarantine_id:string "
        "source_table:string rejection_timestamp:timestamp bronze_processed_timestamp:timestamp "
        "validation_version:string"
    )
    return StructType([*dataset.schema, *_carried(), *_refined(dataset), *payload, *stamp])


FILE_INVENTORY = _struct(
    "file_id:string file_name:string file_path:string file_path_hash:string source_format:string "
    "arrival_time:timestamp processing_start_time:timestamp processing_end_time:timestamp process_status:string "
    "record_count:bigint bronze_table:string silver_table:string file_size:bigint file_modification_time:timestamp "
    "batch_id:string"
)

DATA_QUALITY_METRICS = _struct(
    "batch_id:string dataset_name:string records_received:bigint records_valid:bigint records_quarantined:bigint "
    "records_distinct:bigint duplicates_removed:bigint processing_start:timestamp processing_end:timestamp "
    "duration_seconds:bigint success_rate:double failure_rate:double reconciliation_passed:boolean"
)

SERIALIZATION_ERRORS = _struct(
    "batch_id:string dataset:string error_type:string error_message:string stacktrace:string timestamp:timestamp "
    "pipeline_stage:string"
)

_GOLD_STAMP = "processed_timestamp:timestamp pipeline_stage:string"

PATIENT_FLOW = _struct(
    "service:string batch_id:string total_patients:bigint avg_length_of_stay:double avg_patient_satisfaction:double "
    f"min_los:int max_los:int {_GOLD_STAMP}"
)

STAFF_EFFICIENCY = _struct(
    "service:string role:string batch_id:string total_schedule_records:bigint days_present:bigint "
    f"attendance_rate:double {_GOLD_STAMP}"
)

BED_UTILIZATION = _struct(
    "service:string batch_id:string avg_occupancy_pct:double avg_capacity_gap:double avg_admission_rate_pct:double "
    f"avg_refusal_rate_pct:double {_GOLD_STAMP}"
)

_EFFICIENCY = (
    "service:string batch_id:string occupancy_pct:double admission_rate_pct:double refusal_rate_pct:double "
    "staff_morale:double weekly_patient_satisfaction:double capacity_gap:double attendance_rate:double "
    "patient_satisfaction:double avg_length_of_stay:double total_patients:bigint severity:string"
)

OPERATIONAL_EFFICIENCY = _struct(f"{_EFFICIENCY} {_GOLD_STAMP}")

BOTTLENECK_ANALYSIS = _struct(
    f"{_EFFICIENCY} {_GOLD_STAMP} avg_occupancy_pct:double avg_capacity_gap:double avg_refusal_rate:double "
    "avg_admission_rate:double bottleneck_flag:string"
)

BATCH_EVENTS = _struct(
    "batch_id:string pipeline_name:string event_time:timestamp status:string source_files:int processed_records:bigint"
)

PIPELINE_BATCHES = _struct(
    "batch_id:string pipeline_name:string start_time:timestamp end_time:timestamp status:string source_files:int "
    "processed_records:bigint"
)

FILE_MONITORING_AUDIT = _struct(
    "execution_timestamp:string monitoring_date:string job_id:string run_id:string dataset:string s3_path:string "
    "expected_files:int received_files:bigint status:string latest_file_name:string last_modified_time:string "
    "reason:string error_message:string overall_result:string execution_duration_seconds:double email_sent:boolean"
)

GOLD_TABLES = {
    "patient_flow": PATIENT_FLOW,
    "staff_efficiency": STAFF_EFFICIENCY,
    "bed_utilization": BED_UTILIZATION,
    "operational_efficiency": OPERATIONAL_EFFICIENCY,
    "bottleneck_analysis": BOTTLENECK_ANALYSIS,
}


def layers() -> dict[str, dict[str, StructType]]:
    """Schema of every table, by layer name."""
    return {
        "control": {"batch_events": BATCH_EVENTS},
        "bronze": {d.bronze_table: bronze(d) for d in DATASETS} | {"file_inventory": FILE_INVENTORY},
        "silver": {d.silver_table: silver(d) for d in DATASETS}
        | {d.quarantine_table: quarantine(d) for d in DATASETS}
        | {"data_quality_metrics": DATA_QUALITY_METRICS, "serialization_errors": SERIALIZATION_ERRORS},
        "gold": dict(GOLD_TABLES),
        "monitoring": {"file_monitoring_audit": FILE_MONITORING_AUDIT},
    }
