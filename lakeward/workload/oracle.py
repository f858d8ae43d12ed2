"""The SQL each registered query must equal, on the same tables, in DuckDB's dialect.

Written as one chain of named subqueries per layer. ``oracle_sql`` resolves the ones a result
needs. Shown columns are listed per query; dates, times and booleans are shown as text, as
``registry.presentable`` does.
"""

from __future__ import annotations

import re

from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE, Dataset
from lakeward.workload import feed_sql

RUN = "TIMESTAMP '2026-01-07 00:00:00'"
BATCH_ID = "20260107000000"
ROWS_PER_DOCUMENT = 50_000

FILE = "file_name file_path file_size file_modification_time source_format"
TAIL = f"{FILE} ingestion_timestamp batch_id pipeline_stage record_hash"
KPIS = "occupancy_rate admission_rate refusal_rate capacity_gap occupancy_pct"

_AS_TEXT = set(
    "file_modification_time ingestion_timestamp processed_timestamp bronze_processed_timestamp "
    "silver_processed_timestamp rejection_timestamp arrival_date departure_date raw_arrival_date "
    "raw_departure_date processing_start processing_end arrival_time processing_start_time processing_end_time "
    "start_time end_time event_time timestamp passed reconciliation_passed is_received notify email_sent "
    "validation_passed".split()
) | {r.flag for d in DATASETS for r in d.all_rules}


def r2(x: str) -> str:
    """Round a double half-up on its decimal form, as Spark does."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), 2) AS DOUBLE)"


def show(source: str, columns: str) -> str:
    shown = [f"CAST({c} AS VARCHAR) AS {c}" if c in _AS_TEXT else c for c in columns.split()]
    return f"SELECT {', '.join(shown)} FROM {source}"


def _presence(column: str) -> str:
    return f"{column} IS NOT NULL AND length(trim(both ' ' from {column})) > 0"


_ROLES = "role IN ('doctor', 'nurse', 'technician', 'administrator')"

PREDICATES = {
    PATIENTS.name: {
        "valid_patient_id": "patient_id IS NOT NULL",
        "valid_arrival_date": "arrival_date IS NOT NULL",
        "valid_departure_date": "departure_date IS NOT NULL",
        "valid_patient_name": "name IS NOT NULL",
        "valid_service": _presence("service"),
        "valid_age": "age >= 0 AND age <= 110",
        "valid_satisfaction": "satisfaction >= 0 AND satisfaction <= 100",
        "valid_dates": "NOT (arrival_date > departure_date)",
        "valid_length_of_stay": "length_of_stay >= 0 AND length_of_stay <= 180",
    },
    STAFF.name: {
        "valid_staff_id": "staff_id IS NOT NULL",
        "valid_staff_name": _presence("staff_name"),
        "valid_role": _presence("role"),
        "valid_service": _presence("service"),
        "valid_role_value": _ROLES,
    },
    STAFF_SCHEDULE.name: {
        "valid_staff_id": "staff_id IS NOT NULL",
        "valid_presence": "present = 0 OR present = 1",
        "valid_week": "week >= 1",
        "valid_role": _presence("role"),
        "valid_service": _presence("service"),
        "valid_role_value": _ROLES,
    },
    SERVICES.name: {
        "valid_service": _presence("service"),
        "valid_week": "week >= 1 AND week <= 53",
        "valid_month": "month >= 1 AND month <= 12",
        "valid_available_beds": "available_beds >= 1",
        "valid_patients_request": "NOT (patients_request < 0)",
        "valid_patients_admitted": "NOT (patients_admitted < 0)",
        "valid_patients_refused": "NOT (patients_refused < 0)",
        "valid_patient_satisfaction": "patient_satisfaction >= 0 AND patient_satisfaction <= 100",
        "valid_staff_morale": "staff_morale >= 0 AND staff_morale <= 100",
        "valid_admitted_vs_beds": "available_beds >= patients_admitted",
        "valid_requests_vs_admitted": "patients_admitted <= patients_request",
        "valid_requests_vs_refused": "patients_refused <= patients_request",
        "valid_request_balance": "patients_request - patients_admitted - patients_refused = 0",
        "valid_event": _presence("event"),
        "valid_occupancy_rate": "coalesce(occupancy_rate <= 1, false)",
        "valid_admission_rate": "coalesce(admission_rate >= 0 AND admission_rate <= 1, false)",
        "valid_refusal_rate": "coalesce(refusal_rate >= 0 AND refusal_rate <= 1, false)",
    },
}


def _rate(numerator: str, denominator: str) -> str:
    return r2(f"CASE WHEN {denominator} <> 0 THEN CAST({numerator} AS DOUBLE) / {denominator} END")


def _layer_subqueries(d: Dataset) -> dict[str, str]:
    flags = PREDICATES[d.name]
    clean = ", ".join(f"lower(trim(both ' ' from {c})) AS {c}" for c in d.text_columns)
    derived = ", CAST(departure_date - arrival_date AS INT) AS length_of_stay" if d is PATIENTS else ""
    measured = "SELECT * FROM "
    if d is SERVICES:
        measured = f"""SELECT *, CAST(floor(occupancy_rate * 100 + 0.5) AS DOUBLE) AS occupancy_pct FROM (SELECT *,
 {_rate("patients_admitted", "available_beds")} AS occupancy_rate,
 {_rate("patients_admitted", "patients_request")} AS admission_rate,
 {_rate("patients_refused", "patients_request")} AS refusal_rate,
 coalesce(greatest(patients_request - available_beds, 0), 0) AS capacity_gap FROM """
    close = ")" if d is SERVICES else ""
    keys = ", ".join(d.keys)
    base = [r.flag for r in d.rules]

    def verdict(names):
        return "coalesce(" + " AND ".join(f"({n})" for n in names) + ", false)"

    def listed(text):
        return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT {r.flag} THEN '{text(r)}' END" for r in d.all_rules) + ")"

    unknown = "concat_ws(',', " + ", ".join(f"CASE WHEN {r.flag} IS NULL THEN '{r.flag}' END" for r in d.all_rules) + ")"
    source = f"bronze.{d.bronze_table}"
    return {
        f"keyed_{d.feed}": feed_sql.render(
            {
                PATIENTS.name: feed_sql.PATIENTS,
                STAFF.name: feed_sql.STAFF,
                STAFF_SCHEDULE.name: feed_sql.STAFF_SCHEDULE,
                SERVICES.name: feed_sql.SERVICES_WEEKLY,
            }[d.name],
            "duckdb",
        ),
        d.bronze_table: f"""SELECT *, processed_timestamp AS ingestion_timestamp, 'BRONZE' AS pipeline_stage,
 sha256(concat_ws('|', batch_id, file_name, row_key)) AS record_hash FROM keyed_{d.feed}""",
        f"norm_{d.name}": f"SELECT * REPLACE ({clean}){derived} FROM {d.bronze_table}",
        f"measured_{d.name}": f"{measured}norm_{d.name}{close}",
        f"flagged_{d.name}": f"SELECT *, {', '.join(f'({p}) AS {n}' for n, p in flags.items())} FROM measured_{d.name}",
        f"val_{d.name}": f"SELECT *, {verdict(flags)} AS validation_passed, {verdict(base)} AS base_passed "
        f"FROM flagged_{d.name}",
        d.silver_table: f"""SELECT * EXCLUDE (pipeline_stage, processed_timestamp),
 processed_timestamp AS bronze_processed_timestamp, {RUN} AS silver_processed_timestamp, 'SILVER' AS pipeline_stage,
 'v1.2' AS validation_version FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY
  file_modification_time DESC, processed_timestamp DESC, file_name DESC, record_hash) AS place
 FROM val_{d.name} WHERE validation_passed) WHERE place = 1""",
        d.quarantine_table: f"""SELECT * EXCLUDE (pipeline_stage, processed_timestamp),
 processed_timestamp AS bronze_processed_timestamp, {RUN} AS rejection_timestamp, 'QUARANTINE' AS pipeline_stage,
 'v1.2' AS validation_version, '{source}' AS source_table,
 sha256(batch_id || '|{source}|' || record_hash) AS quarantine_id,
 {listed(lambda r: r.flag)} AS failed_rules, {listed(lambda r: r.message)} AS rejection_reasons,
 {unknown} AS unknown_rules FROM val_{d.name} WHERE NOT validation_passed""",
        f"explained_{d.name}": f"""SELECT record_hash, {listed(lambda r: r.flag)} AS failed_rules,
 {listed(lambda r: r.message)} AS rejection_reasons, {unknown} AS unknown_rules FROM val_{d.name}""",
        f"metrics_{d.name}": f"""SELECT batch_id, '{d.name}' AS dataset_name, records_received,
 coalesce(kept, 0) AS records_valid, records_quarantined, records_distinct,
 greatest(0, passing - coalesce(kept, 0)) AS duplicates_removed, processing_start,
 CASE WHEN kept IS NOT NULL OR records_quarantined > 0 THEN {RUN} ELSE processing_start END AS processing_end
 FROM (SELECT batch_id, count(*) AS records_received, count(DISTINCT record_hash) AS records_distinct,
  min(processed_timestamp) AS processing_start, count(*) FILTER (WHERE validation_passed) AS passing,
  count(*) FILTER (WHERE NOT validation_passed) AS records_quarantined FROM val_{d.name} GROUP BY batch_id)
 LEFT JOIN (SELECT batch_id, count(*) AS kept FROM {d.silver_table} GROUP BY batch_id) USING (batch_id)""",
    }


def _mean(x: str) -> str:
    return r2(f"avg({x})")


def _mean_percent(x: str) -> str:
    return r2(f"CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS DOUBLE) / count({x})")


_GOLD_STAMP = f"{RUN} AS processed_timestamp, 'GOLD' AS pipeline_stage"

_BRONZE_TABLES = [d.bronze_table for d in DATASETS]
_SILVER_TABLES = [d.silver_table for d in DATASETS]
_GOLD_TABLES = ["patient_flow", "staff_efficiency", "bed_utilization", "operational_efficiency", "bottleneck_analysis"]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _subqueries() -> dict[str, str]:
    s: dict[str, str] = {}
    for d in DATASETS:
        s |= _layer_subqueries(d)
    s["patient_flow"] = f"""SELECT service, batch_id, count(*) AS total_patients,
 {_mean("length_of_stay")} AS avg_length_of_stay, {_mean("satisfaction")} AS avg_patient_satisfaction,
 min(length_of_stay) AS min_los, max(length_of_stay) AS max_los, {_GOLD_STAMP}
 FROM silver_patients GROUP BY service, batch_id"""
    s["staff_efficiency"] = f"""SELECT service, role, batch_id, count(*) AS total_schedule_records,
 CAST(sum(present) AS BIGINT) AS days_present, {r2("avg(present) * 100")} AS attendance_rate, {_GOLD_STAMP}
 FROM silver_staff_schedule GROUP BY service, role, batch_id"""
    s["bed_utilization"] = f"""SELECT service, batch_id, {_mean("occupancy_pct")} AS avg_occupancy_pct,
 {_mean("capacity_gap")} AS avg_capacity_gap, {_mean_percent("admission_rate")} AS avg_admission_rate_pct,
 {_mean_percent("refusal_rate")} AS avg_refusal_rate_pct, {_GOLD_STAMP} FROM silver_services GROUP BY service, batch_id"""
    s["operational_efficiency"] = f"""SELECT *, CASE WHEN occupancy_pct > 90 THEN 'CRITICAL'
 WHEN capacity_gap > 30 THEN 'CRITICAL' WHEN refusal_rate_pct > 30 THEN 'HIGH' WHEN attendance_rate < 70 THEN 'MEDIUM'
 WHEN staff_morale < 50 THEN 'LOW' ELSE 'NORMAL' END AS severity, {_GOLD_STAMP} FROM
 (SELECT service, batch_id, {_mean("occupancy_pct")} AS occupancy_pct,
   {_mean_percent("admission_rate")} AS admission_rate_pct, {_mean_percent("refusal_rate")} AS refusal_rate_pct,
   {_mean("staff_morale")} AS staff_morale, {_mean("patient_satisfaction")} AS weekly_patient_satisfaction,
   {_mean("capacity_gap")} AS capacity_gap FROM silver_services GROUP BY service, batch_id) w
 LEFT JOIN (SELECT service, batch_id, {r2("avg(present) * 100")} AS attendance_rate FROM silver_staff_schedule
   GROUP BY service, batch_id) a USING (service, batch_id)
 LEFT JOIN (SELECT service, batch_id, {_mean("satisfaction")} AS patient_satisfaction,
   {_mean("length_of_stay")} AS avg_length_of_stay, count(*) AS total_patients FROM silver_patients
   GROUP BY service, batch_id) p USING (service, batch_id)"""
    s["bottleneck_analysis"] = f"""SELECT *, CASE WHEN avg_occupancy_pct > 90 OR avg_refusal_rate > 0.20 THEN 'YES'
 ELSE 'NO' END AS bottleneck_flag FROM (SELECT *, occupancy_pct AS avg_occupancy_pct,
  capacity_gap AS avg_capacity_gap, {r2("refusal_rate_pct / 100")} AS avg_refusal_rate,
  {r2("admission_rate_pct / 100")} AS avg_admission_rate FROM operational_efficiency)"""
    s["metrics"] = _union(f"SELECT * FROM metrics_{d.name}" for d in DATASETS)
    s["data_quality"] = """SELECT *, CAST(epoch(processing_end) - epoch(processing_start) AS BIGINT) AS duration_seconds,
 CAST(round(CAST(records_valid AS DECIMAL(38,12)) / records_received, 4) AS DOUBLE) AS success_rate,
 CAST(round(CAST(records_quarantined AS DECIMAL(38,12)) / records_received, 4) AS DOUBLE) AS failure_rate,
 records_received = records_valid + records_quarantined + duplicates_removed AS reconciliation_passed FROM metrics"""
    s["inventory"] = " UNION ALL ".join(
        f"""SELECT md5(file_path || '|{d.bronze_table}') AS file_id, file_name, file_path,
 md5(file_path) AS file_path_hash, source_format, min(ingestion_timestamp) AS arrival_time,
 min(ingestion_timestamp) AS processing_start_time, max(processed_timestamp) AS processing_end_time,
 'COMPLETED' AS process_status, count(*) AS record_count, '{d.bronze_table}' AS bronze_table,
 '{d.silver_table}' AS silver_table, file_size, file_modification_time, max(batch_id) AS batch_id
 FROM {d.bronze_table} GROUP BY file_name, file_path, file_size, file_modification_time, source_format"""
        for d in DATASETS
    )
    s["control"] = feed_sql.render(feed_sql.CONTROL, "duckdb")
    s["ranked_events"] = """SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_time DESC,
 (status <> 'RUNNING') DESC, status DESC, source_files DESC, processed_records DESC) AS place,
 min(event_time) OVER (PARTITION BY batch_id) AS start_time FROM control"""
    s["state"] = """SELECT batch_id, pipeline_name, start_time, CASE WHEN status <> 'RUNNING' THEN event_time END AS end_time,
 status, source_files, processed_records FROM ranked_events WHERE place = 1"""
    s["current"] = "SELECT * FROM state WHERE status = 'RUNNING' ORDER BY start_time DESC, batch_id DESC LIMIT 1"
    s["bronze_files"] = _union(f"SELECT batch_id, file_path FROM {t}" for t in _BRONZE_TABLES)
    s["totals"] = """SELECT batch_id, count(*) AS processed_records, count(DISTINCT file_path) AS source_files
 FROM bronze_files GROUP BY batch_id"""
    s["landed"] = feed_sql.render(feed_sql.LANDED_FILES, "duckdb")
    s["expected"] = feed_sql.render(feed_sql.EXPECTED_FILES, "duckdb")
    s["received"] = """SELECT dataset, count(*) AS n, max(modified_time) AS newest,
 arg_max(file_name, (modified_time, file_name)) AS newest_name FROM landed
 WHERE CAST(modified_time AS DATE) = DATE '1998-06-15' GROUP BY dataset"""
    s["arrived"] = """SELECT dataset, '/landing/' || dataset || '/' AS s3_path, expected_count,
 CASE WHEN error_message IS NULL THEN coalesce(n, 0) ELSE 0 END AS received_count, error_message, newest, newest_name
 FROM expected LEFT JOIN received USING (dataset)"""
    s["arrival"] = """SELECT dataset, s3_path, expected_count, received_count,
 CASE WHEN error_message IS NOT NULL THEN 'Error' WHEN received_count = expected_count THEN 'Received'
  WHEN received_count = 0 THEN 'Missing' WHEN received_count < expected_count THEN 'Incomplete'
  ELSE 'Multiple Files' END AS status,
 error_message IS NULL AND received_count = expected_count AS is_received,
 CASE WHEN received_count > 0 THEN newest_name ELSE 'N/A' END AS latest_file_name,
 CASE WHEN received_count > 0 THEN strftime(newest, '%Y-%m-%d %H:%M:%S') ELSE 'N/A' END AS last_modified_time,
 CASE WHEN error_message IS NOT NULL THEN error_message
  WHEN received_count = expected_count THEN 'Expected file received today'
  WHEN received_count = 0 THEN 'No file received today'
  WHEN received_count < expected_count
   THEN concat('Only ', received_count, '/', expected_count, ' expected files received today')
  ELSE concat('Multiple files received today (', received_count, ' files arrived)') END AS reason,
 error_message FROM arrived"""
    s["arrival_totals"] = """SELECT CAST(sum(expected_count) AS BIGINT) AS total_expected_files,
 CAST(sum(received_count) AS BIGINT) AS total_received_files, count(*) AS total_expected_datasets,
 count(*) FILTER (WHERE is_received) AS total_received_datasets,
 count(*) FILTER (WHERE NOT is_received) AS missing_datasets_count,
 CASE WHEN bool_and(is_received) THEN 'SUCCESS' ELSE 'ALERT' END AS overall_status FROM arrival"""
    for d, text in (
        (PATIENTS, feed_sql.RAW_PATIENTS),
        (STAFF, feed_sql.RAW_STAFF),
        (STAFF_SCHEDULE, feed_sql.RAW_STAFF_SCHEDULE),
        (SERVICES, feed_sql.RAW_SERVICES_WEEKLY),
    ):
        s[f"raw_{d.feed}"] = re.sub(rf"\b{d.bronze_table}\b", f"keyed_{d.feed}", text)
    return s


def _field(name: str, unreadable: str | None = None) -> str:
    """The JSON text of one rescued field, or NULL if there is nothing to rescue."""
    condition = unreadable or f"{name} IS NOT NULL"
    return f"""CASE WHEN {condition} THEN concat('"{name}":"', {name}, '"') END"""


def _object(*fields: str) -> str:
    return f"'{{' || concat_ws(',', {', '.join(fields)}) || '}}'"


def _not_int(c: str) -> str:
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS INT) IS NULL"


_RESCUED = {
    PATIENTS: (
        _field("age", _not_int("age")),
        _field("arrival_date", "arrival_date IS NOT NULL AND TRY_CAST(arrival_date AS DATE) IS NULL"),
        _field("ward"),
    ),
    STAFF: (_field("note"),),
    STAFF_SCHEDULE: (_field("week", _not_int("week")),),
    SERVICES: (_field("month", _not_int("month")), _field("patients_request", _not_int("patients_request"))),
}


def _rescued(d: Dataset) -> str:
    return f"nullif({_object(*_RESCUED[d])}, '{{}}')"


def _results() -> dict[str, str]:
    q: dict[str, str] = {}
    for d in DATASETS:
        names, flags = " ".join(d.columns), " ".join(r.flag for r in d.all_rules)
        base = " ".join(r.flag for r in d.rules)
        derived = " length_of_stay" if d is PATIENTS else ""
        kpis = f" {KPIS}" if d is SERVICES else ""
        q[d.bronze_table] = show(d.bronze_table, f"{names} {TAIL} processed_timestamp")
        typed = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in _AS_TEXT else c for c in d.columns)
        q[f"stream_ingest_{d.name}"] = (
            f"SELECT {typed}, source_format, '{BATCH_ID}' AS batch_id, 'BRONZE' AS pipeline_stage FROM keyed_{d.feed}"
        )
        q[f"normalize_{d.name}"] = show(f"norm_{d.name}", f"{names}{derived} record_hash")
        q[f"validate_{d.name}"] = (
            show(f"val_{d.name}", f"record_hash {base}").replace(
                " FROM ", ", CAST(base_passed AS VARCHAR) AS validation_passed FROM "
            )
        )
        q[f"process_{d.name}"] = show(
            f"val_{d.name}", f"record_hash {names}{derived}{kpis} {flags} validation_passed"
        )
        q[f"failed_rules_{d.name}"] = f"SELECT * FROM explained_{d.name}"
        q[d.silver_table] = show(
            d.silver_table,
            f"{names}{derived}{kpis} {TAIL} bronze_processed_timestamp silver_processed_timestamp validation_version",
        )
        q[d.quarantine_table] = show(
            d.quarantine_table,
            f"{names}{derived}{kpis} {TAIL} bronze_processed_timestamp validation_version failed_rules "
            "rejection_reasons unknown_rules quarantine_id source_table rejection_timestamp",
        )

    typed = "patient_id, name, age, CAST(arrival_date AS VARCHAR) AS arrival_date, " \
        "CAST(departure_date AS VARCHAR) AS departure_date, service, satisfaction"
    q["ingest_csv"] = f"SELECT {typed}, source_format FROM keyed_patients WHERE source_format = 'csv'"
    q["ingest_json"] = f"SELECT {typed}, source_format FROM keyed_patients WHERE source_format = 'json'"
    q["ingest_union"] = f"SELECT {typed}, source_format, '{BATCH_ID}' AS batch_id FROM keyed_patients"
    q["project_declared_schema"] = """SELECT TRY_CAST(week AS INT) AS week, staff_id, staff_name, role, service,
 CAST(NULL AS INT) AS present, source_format FROM raw_staff_schedule"""
    # The first column is in every file, the last in the newer ones only, and those name a ward.
    first_last = {"patients": ("patient_id", "satisfaction"), "staff": ("staff_id", "service"),
                  "staff_schedule": ("week", "present"), "services_weekly": ("week", "event")}
    typed_as = {"week": "INT", "present": "INT", "satisfaction": "INT"}
    evolved = []
    ward = "CASE WHEN source_format = 'json' AND length(row_key) % 2 = 0 THEN concat('w', length(row_key)) END"
    for d in DATASETS:
        first, last = (f"TRY_CAST({c} AS {typed_as.get(c, 'VARCHAR')})" for c in first_last[d.feed])
        evolved.append(f"""SELECT '{d.name}' AS dataset_name, count(*) AS rows, count({first}) AS with_first,
 count({last}) FILTER (source_format = 'json') AS with_last, count({ward}) AS with_ward,
 count(DISTINCT concat_ws('|', CAST({first} AS VARCHAR), {ward})) AS pairs FROM raw_{d.feed}""")
    q["schema_evolution_union"] = q["stream_ingest_evolved"] = _union(evolved)
    q["stream_restarted"] = _union(
        f"""SELECT '{d.name}' AS dataset_name, source_format, count(*) AS rows, count({d.columns[0]}) AS with_first,
 count(DISTINCT CAST(({", ".join(d.columns)}) AS VARCHAR)) AS different_rows, 'true' AS died FROM keyed_{d.feed} GROUP BY source_format"""
        for d in DATASETS
    )
    q["ingest_json_deep"] = _union(
        f"""SELECT '{d.name}' AS dataset_name, layout, CAST(CAST('0x' || substr(md5(row_key), 1, 4) AS BIGINT) % 12 + 1 AS INT) AS depth,
 count(*) AS rows, count(service) AS with_service, CAST(0 AS BIGINT) AS unread
 FROM keyed_{d.feed}, (VALUES ('array'), ('lines')) t(layout) WHERE source_format = 'json' GROUP BY ALL"""
        for d in DATASETS
    )
    q["rescued_data"] = f"""SELECT patient_id, name, TRY_CAST(age AS INT) AS age,
 CAST(TRY_CAST(arrival_date AS DATE) AS VARCHAR) AS arrival_date, departure_date, service,
 CAST(satisfaction AS INT) AS satisfaction, {_rescued(PATIENTS)} AS _rescued_data FROM raw_patients"""
    q["serialization_errors"] = _union(
        f"""SELECT '{BATCH_ID}' AS batch_id, '{d.name}' AS dataset, 'SERIALIZATION_ERROR' AS error_type,
 {_rescued(d)} AS error_message, 'Malformed JSON/CSV record rescued at ingestion' AS stacktrace,
 CAST({RUN} AS VARCHAR) AS timestamp, 'BRONZE' AS pipeline_stage
 FROM raw_{d.feed} WHERE {_rescued(d)} IS NOT NULL"""
        for d in DATASETS
    )
    q["file_metadata"] = "SELECT row_key AS staff_id, source_format, 'true' AS file_columns_filled FROM keyed_staff"
    q["arrival_listing"] = _union(
        f"SELECT '{d.feed}' AS dataset, CAST(ceil(count(*) FILTER (source_format = 'json') / {ROWS_PER_DOCUMENT}.0) AS BIGINT) "
        f"AS json_documents, 'true' AS files_read_are_listed FROM keyed_{d.feed} HAVING count(*) > 0"
        for d in DATASETS
    )
    hashed = ["file_name", "file_modification_time", *STAFF_SCHEDULE.columns, "copy_number"]
    pieces = ", ".join(
        f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':') || CAST({c} AS VARCHAR), 'NULL')" for c in hashed
    )
    same = ", ".join([*STAFF_SCHEDULE.columns, "file_name", "file_modification_time"])
    q["lineage_record_hash"] = f"""SELECT week, staff_id, '{BATCH_ID}' AS batch_id, 'BRONZE' AS pipeline_stage,
 CAST({RUN} AS VARCHAR) AS processed_timestamp,
 sha256(concat_ws('|', '{len(BATCH_ID)}:{BATCH_ID}', {pieces})) AS record_hash
 FROM (SELECT *, row_number() OVER (PARTITION BY {same}) AS copy_number FROM keyed_staff_schedule)"""

    service_flags = " ".join(r.flag for r in SERVICES.all_rules)
    q["validate_services_kpis"] = show("val_services", f"record_hash {service_flags} validation_passed")
    q["service_kpis"] = show("measured_services", f"record_hash {KPIS}")
    raw = ", ".join(
        f"CAST(b.{c} AS VARCHAR) AS raw_{c}" if c in _AS_TEXT else f"b.{c} AS raw_{c}" for c in PATIENTS.columns
    )
    q["quarantine_payload"] = f"""SELECT quarantine_id, {raw} FROM quarantine_patients
 JOIN bronze_patients b USING (record_hash)"""
    q["quarantine_id"] = _union(f"SELECT quarantine_id, source_table FROM {d.quarantine_table}" for d in DATASETS)
    q["file_inventory"] = show(
        "inventory",
        "file_id file_name file_path file_path_hash source_format arrival_time processing_start_time "
        "processing_end_time process_status record_count bronze_table silver_table file_size file_modification_time "
        "batch_id",
    )
    stamp = "processed_timestamp pipeline_stage"
    q["patient_flow"] = show(
        "patient_flow",
        f"service batch_id total_patients avg_length_of_stay avg_patient_satisfaction min_los max_los {stamp}",
    )
    q["staff_efficiency"] = show(
        "staff_efficiency", f"service role batch_id total_schedule_records days_present attendance_rate {stamp}"
    )
    q["bed_utilization"] = show(
        "bed_utilization",
        f"service batch_id avg_occupancy_pct avg_capacity_gap avg_admission_rate_pct avg_refusal_rate_pct {stamp}",
    )
    efficiency = (
        "service batch_id occupancy_pct admission_rate_pct refusal_rate_pct staff_morale weekly_patient_satisfaction "
        "capacity_gap attendance_rate patient_satisfaction avg_length_of_stay total_patients severity"
    )
    q["operational_efficiency"] = show("operational_efficiency", f"{efficiency} {stamp}")
    q["bottleneck_analysis"] = show(
        "bottleneck_analysis",
        f"{efficiency} {stamp} avg_occupancy_pct avg_capacity_gap avg_refusal_rate avg_admission_rate bottleneck_flag",
    )
    q["refreshed_bottlenecks"] = q["bottleneck_analysis"]
    q["data_quality_metrics"] = show(
        "data_quality",
        "batch_id dataset_name records_received records_valid records_quarantined records_distinct duplicates_removed "
        "processing_start processing_end duration_seconds success_rate failure_rate reconciliation_passed",
    )
    # Each silver or quarantine row of the lost format is one that the batch's reconciliation misses.
    lost = []
    for d in DATASETS:
        for name in ("none", "silver", "quarantine"):
            silver, rejected = (
                f"(SELECT count(*) FROM {t} t WHERE t.batch_id = m.batch_id AND t.source_format = 'json')" if n == name else "0"
                for n, t in (("silver", d.silver_table), ("quarantine", d.quarantine_table))
            )
            lost.append(f"""SELECT '{name}' AS lost, '{d.name}' AS dataset_name, batch_id, records_valid - {silver} AS records_valid,
 records_quarantined - {rejected} AS records_quarantined,
 CAST({silver} + {rejected} = 0 AS VARCHAR) AS reconciliation_passed FROM metrics_{d.name} m""")
    q["reconciliation_detects_loss"] = _union(lost)
    derived = {t: t for t in (*_SILVER_TABLES, *(d.quarantine_table for d in DATASETS), *_GOLD_TABLES)}
    derived |= {"data_quality_metrics": "data_quality", "file_inventory": "inventory"}
    q["refreshed_tables"] = _union(
        [f"SELECT '{name}' AS table_name, count(*) AS rows, count(DISTINCT batch_id) AS batches FROM {source}" for name, source in derived.items()]
        # No feed rescues anything here.
        + ["SELECT 'serialization_errors' AS table_name, CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS batches"]
    )
    q["ingest_json_mixed"] = _union(
        f"SELECT '{d.name}' AS dataset_name, count(*) AS rows, CAST(count(*) > 0 AS VARCHAR) AS broken_rescued "
        f"FROM keyed_{d.feed} WHERE source_format = 'json'"
        for d in DATASETS
    )
    q["duplicate_recount"] = _union(
        f"""SELECT '{d.name}' AS dataset_name,
 (SELECT CAST(sum(duplicates_removed) AS BIGINT) FROM metrics_{d.name}) AS reported,
 (SELECT count(*) FROM val_{d.name} WHERE validation_passed)
  - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(d.keys)} FROM val_{d.name} WHERE validation_passed)) AS recounted,
 'true' AS passed"""
        for d in DATASETS
    )

    state = "batch_id pipeline_name start_time end_time status source_files processed_records"
    moment = f"CAST({RUN} AS VARCHAR)"
    q["batch_state"] = show("state", state)
    q["batch_history"] = q["batch_state"]
    q["batch_open"] = f"""SELECT batch_id, pipeline_name, CAST(start_time AS VARCHAR) AS start_time,
 coalesce(CAST(end_time AS VARCHAR), {moment}) AS end_time,
 CASE status WHEN 'RUNNING' THEN 'FAILED' ELSE status END AS status, source_files, processed_records FROM state
 UNION ALL SELECT '{BATCH_ID}', 'hospital_feeds', {moment}, NULL, 'RUNNING', 0, 0"""
    q["batch_stale_recovery"] = f"""SELECT batch_id, pipeline_name, {moment} AS event_time, 'FAILED' AS status,
 source_files, processed_records FROM state WHERE status = 'RUNNING'"""
    closing = """SELECT c.batch_id, c.pipeline_name, {moment} AS {time}, '{status}' AS status,
 CAST(coalesce(t.source_files, 0) AS INT) AS source_files, coalesce(t.processed_records, 0) AS processed_records{more}
 FROM current c LEFT JOIN totals t USING (batch_id)"""
    q["batch_fail"] = closing.format(moment=moment, time="event_time", status="FAILED", more="")
    closed = closing.format(
        moment=moment, time="end_time", status="COMPLETED", more=", CAST(c.start_time AS VARCHAR) AS start_time"
    )
    q["batch_close"] = (
        show("state", state) + " WHERE batch_id NOT IN (SELECT batch_id FROM current) UNION ALL BY NAME " + closed
    )
    q["batch_close_catalog"] = q["batch_close"]
    q["batch_log"] = f"""SELECT batch_id, pipeline_name, start_time, coalesce(end_time, {moment}) AS end_time,
 CASE status WHEN 'RUNNING' THEN 'FAILED' ELSE status END AS status, source_files, processed_records FROM ({q["batch_close"]})
 UNION ALL SELECT '20260107000000', 'hospital_feeds', {moment}, NULL, 'RUNNING', 0, 0"""
    q["current_batch"] = show("current", state)
    q["latest_batch"] = show(
        "(SELECT * FROM state ORDER BY start_time DESC, batch_id DESC LIMIT 1)", "batch_id status start_time end_time"
    )
    q["batch_totals"] = "SELECT * FROM totals"
    q["batch_files"] = "SELECT DISTINCT batch_id, file_path FROM bronze_files"

    status = (
        "dataset s3_path expected_count received_count status is_received latest_file_name last_modified_time reason "
        "error_message"
    )
    q["arrival_status"] = show("arrival", status)
    q["arrival_anomalies"] = show("arrival", status) + " WHERE NOT is_received"
    q["arrival_summary"] = """SELECT '2026-01-07 00:00:00' AS execution_timestamp, '2026-01-07' AS monitoring_date, *,
 'true' AS notify, concat('File Monitoring - ', overall_status, ' (', total_received_datasets, '/',
  total_expected_datasets, ' Files Received)') AS subject FROM arrival_totals"""
    q["arrival_audit"] = """SELECT '2026-01-07 00:00:00' AS execution_timestamp, '2026-01-07' AS monitoring_date,
 'job-1' AS job_id, 'run-1' AS run_id, dataset, s3_path, expected_count AS expected_files,
 received_count AS received_files, status, latest_file_name, last_modified_time, reason, error_message,
 (SELECT overall_status FROM arrival_totals) AS overall_result, CAST(1.25 AS DOUBLE) AS execution_duration_seconds,
 'true' AS email_sent FROM arrival"""

    q["arrival_audit_appended"] = (
        q["arrival_audit"] + " UNION ALL BY NAME " + q["arrival_audit"].replace("'run-1'", "'run-2'")
    )
    documents = _union(
        f"SELECT '{d.feed}' AS dataset, CAST(ceil(count(*) FILTER (source_format = 'json') / {ROWS_PER_DOCUMENT}.0) AS BIGINT) AS n "
        f"FROM keyed_{d.feed}"
        for d in DATASETS
    )
    q["arrival_path"] = f"""SELECT 'run-1' AS run_id, dataset, concat('/landing/', dataset, '/') AS s3_path, CAST(2 AS INT) AS expected_files,
 coalesce(n, 0) AS received_files,
 CASE WHEN n IS NULL THEN 'Error' WHEN n = 2 THEN 'Received' WHEN n = 0 THEN 'Missing' WHEN n < 2 THEN 'Incomplete'
  ELSE 'Multiple Files' END AS status,
 CASE WHEN n IS NULL THEN 'listing failed: PATH_NOT_FOUND' WHEN n = 2 THEN 'Expected file received today'
  WHEN n = 0 THEN 'No file received today' WHEN n < 2 THEN concat('Only ', n, '/2 expected files received today')
  ELSE concat('Multiple files received today (', n, ' files arrived)') END AS reason,
 CASE WHEN n IS NULL THEN 'listing failed: PATH_NOT_FOUND' END AS error_message, 'ALERT' AS overall_result
 FROM ({documents} UNION ALL SELECT 'transfers', NULL)"""

    q["alert_services"] = """SELECT batch_id, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2
  WHEN 'MEDIUM' THEN 3 ELSE 4 END AS severity_rank, service, severity, occupancy_pct, attendance_rate, refusal_rate_pct,
 staff_morale, avg_length_of_stay, capacity_gap,
 'Service: ' || service || chr(10) || chr(10) || 'Severity: ' || severity || chr(10) || chr(10) ||
 'Occupancy Percentage: ' || coalesce(CAST(occupancy_pct AS VARCHAR), 'None') || chr(10) || chr(10) ||
 'Attendance Rate: ' || coalesce(CAST(attendance_rate AS VARCHAR), 'None') || chr(10) || chr(10) ||
 'Refusal Rate Percentage: ' || coalesce(CAST(refusal_rate_pct AS VARCHAR), 'None') || chr(10) || chr(10) ||
 'Staff Morale: ' || coalesce(CAST(staff_morale AS VARCHAR), 'None') || chr(10) || chr(10) ||
 'Average Length Of Stay: ' || coalesce(CAST(avg_length_of_stay AS VARCHAR), 'None') || chr(10) || chr(10) ||
 'Capacity Gap: ' || coalesce(CAST(capacity_gap AS VARCHAR), 'None') AS digest
 FROM operational_efficiency WHERE severity <> 'NORMAL'"""
    q["alert_summary"] = """SELECT *, concat('Operational Alert - ', critical_count, ' Critical Services | ',
 total_attention_count, ' Total Alerts') AS subject FROM (SELECT
 count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count, count(*) FILTER (WHERE severity = 'HIGH') AS high_count,
 count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_count, count(*) FILTER (WHERE severity = 'LOW') AS low_count,
 count(*) FILTER (WHERE severity <> 'NORMAL') AS total_attention_count FROM operational_efficiency)"""

    for layer in ("bronze", "silver"):
        q[f"duplicate_keys_{layer}"] = (
            f"SELECT patient_id, count(*) AS duplicate_count FROM {layer}_patients GROUP BY patient_id HAVING count(*) > 1"
        )
    q["distinct_service"] = "SELECT DISTINCT service FROM silver_patients"
    q["distinct_batches"] = _union(
        f"SELECT DISTINCT '{t}' AS table_name, batch_id FROM {t}" for t in _BRONZE_TABLES
    )
    q["preview_patients"] = show(
        "(SELECT * FROM silver_patients ORDER BY patient_id, arrival_date LIMIT 10)",
        "patient_id arrival_date departure_date length_of_stay",
    )
    q["lineage_layers"] = _union(
        f"SELECT '{layer}' AS layer, max(batch_id) AS batch_id FROM {t}"
        for layer, t in (("Bronze", "bronze_patients"), ("Silver", "silver_patients"), ("Gold", "patient_flow"))
    )
    present = ", ".join(
        f"CAST(batch_id IN (SELECT batch_id FROM {t}) AS BIGINT) AS {layer}_batches"
        for layer, t in (("bronze", "bronze_patients"), ("silver", "silver_patients"), ("gold", "patient_flow"))
    )
    q["lineage_e2e"] = f"SELECT batch_id, status, CAST(start_time AS VARCHAR) AS start_time, {present} FROM state"
    q["batch_consistency"] = _union(
        f"""SELECT '{t}' AS table_name, count(DISTINCT batch_id) AS batch_count,
 CAST(count(DISTINCT batch_id) = 1 AS VARCHAR) AS passed FROM {t}"""
        for t in _BRONZE_TABLES + _SILVER_TABLES + _GOLD_TABLES
    )
    q["running_batch_count"] = "SELECT count(*) AS running_batch_count FROM state WHERE status = 'RUNNING'"

    def check(name: str, expected: int, actual: str, source: str) -> str:
        return f"""SELECT '{name}' AS "check", CAST({expected} AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
 CAST(actual = {expected} AS VARCHAR) AS passed FROM (SELECT {actual} AS actual FROM {source})"""

    q["check_batch_open"] = check(
        "running batches without a sound opening",
        0,
        "count(*)",
        "state WHERE status = 'RUNNING' AND (NOT regexp_full_match(batch_id, '[0-9]{14}') OR start_time IS NULL "
        "OR end_time IS NOT NULL)",
    )
    q["check_stale"] = check(
        "running batches beyond the first", 0, "greatest(count(*) - 1, 0)", "state WHERE status = 'RUNNING'"
    )
    q["check_batch_bronze"] = _union(
        check(
            f"{t}: batches unknown upstream",
            0,
            "count(DISTINCT batch_id)",
            f"{t} WHERE batch_id NOT IN (SELECT batch_id FROM state)",
        )
        for t in _BRONZE_TABLES
    )
    q["check_batch_silver"] = _union(
        check(
            f"{d.silver_table}: batches unknown upstream",
            0,
            "count(DISTINCT batch_id)",
            f"{d.silver_table} WHERE batch_id NOT IN (SELECT batch_id FROM {d.bronze_table})",
        )
        for d in DATASETS
    )
    everywhere = " UNION ".join(f"SELECT batch_id FROM {t}" for t in _GOLD_TABLES)
    q["check_batch_gold"] = check("gold: distinct batches", 1, "count(*)", f"({everywhere})")
    q["check_metadata"] = _union(
        check(
            f"{t}: rows without lineage",
            0,
            "count(*)",
            f"{t} WHERE batch_id IS NULL OR processed_timestamp IS NULL OR pipeline_stage IS DISTINCT FROM 'BRONZE'",
        )
        for t in _BRONZE_TABLES
    )
    q["check_inventory"] = check(
        "inventory rows incomplete",
        0,
        "count(*)",
        "inventory WHERE batch_id IS NULL OR record_count IS NULL OR record_count <= 0 OR process_status IS NULL",
    )
    ranges = [(1, 10), (11, 25), (26, 50), (100, 200)]
    q["avg_by_range_udf"] = "SELECT " + ", ".join(
        r2(f"avg(l_extendedprice) FILTER (WHERE l_quantity BETWEEN {low} AND {high})") + f" AS avg_{low}_{high}"
        for low, high in ranges
    ) + " FROM lineitem"
    return q


def _resolve(text: str, subqueries: dict[str, str]) -> str:
    """Prefix the subqueries a text refers to, in an order where each follows what it uses."""
    words = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
    ordered: list[str] = []

    def visit(body: str, within: str | None) -> None:
        # Names inside string literals are not references.
        for word in words.findall(re.sub(r"'[^']*'", "", body)):
            if word in subqueries and word not in ordered and word != within:
                visit(subqueries[word], word)
                if word not in ordered:
                    ordered.append(word)

    visit(text, None)
    if not ordered:
        return text
    return "WITH " + ",\n".join(f"{name} AS ({subqueries[name]})" for name in ordered) + f"\n{text}"


def oracle_sql() -> dict[str, str]:
    subqueries = _subqueries()
    return {name: _resolve(text, subqueries) for name, text in _results().items()}
