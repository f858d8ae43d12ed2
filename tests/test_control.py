"""Batch control, arrivals, alerts, checks, tables and the full refresh on small frames."""

from datetime import date, datetime

import pytest

from helpers import GOOD, RUN_TS, rows
from lakeward import schemas
from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE
from lakeward.functions.sql_functions import register_range_average
from lakeward.operators import alerts, arrivals, batches, checks, gold, kpis
from lakeward.plans.refresh import current_tables, refresh
from lakeward.plans.scratch import scratch_database
from lakeward.sources import files, tables


def at(day, hour=0):
    return datetime(2026, 1, day, hour)


def event(batch, status, when, files=0, records=0):
    return (batch, "feeds", when, status, files, records)


@pytest.fixture(scope="module")
def events(spark):
    data = [
        event("20260101000000", "RUNNING", at(1)),
        event("20260101000000", "COMPLETED", at(1, 1), 4, 100),
        event("20260102000000", "RUNNING", at(2)),
        event("20260102000000", "FAILED", at(3)),
        event("20260103000000", "RUNNING", at(3)),
    ]
    return spark.createDataFrame(data, schemas.BATCH_EVENTS)


def states(df):
    return {r.batch_id: (r.status, r.start_time, r.end_time) for r in df.collect()}


def test_state_is_the_newest_event(events):
    assert states(batches.batch_state(events)) == {
        "20260101000000": ("COMPLETED", at(1), at(1, 1)),
        "20260102000000": ("FAILED", at(2), at(3)),
        "20260103000000": ("RUNNING", at(3), None),
    }
    assert batches.batch_state(events).schema.fieldNames() == schemas.PIPELINE_BATCHES.fieldNames()


def test_closing_outranks_opening_at_the_same_time(spark):
    data = [event("b", "RUNNING", at(1)), event("b", "COMPLETED", at(1), 1, 2)]
    for order in (data, data[::-1]):
        assert states(batches.batch_state(spark.createDataFrame(order, schemas.BATCH_EVENTS)))["b"][0] == "COMPLETED"


def test_current_batch_and_its_absence(spark, events):
    state = batches.batch_state(events)
    assert batches.require_current_batch(state) == "20260103000000"
    done = batches.batch_state(events.filter("batch_id < '20260103'"))
    assert batches.current_batch(done).count() == 0
    with pytest.raises(LookupError):
        batches.require_current_batch(done)


def test_starting_fails_stale_batches_and_opens_one(spark, events):
    after = events.unionByName(batches.start_batch(spark, events, at(4), "feeds"))
    found = states(batches.batch_state(after))
    assert found["20260103000000"] == ("FAILED", at(3), at(4))
    assert found["20260104000000"] == ("RUNNING", at(4), None)
    assert batches.running(batches.batch_state(after)).count() == 1


def test_a_taken_id_is_not_opened_twice(spark, events):
    with pytest.raises(Exception, match="20260103000000 exists"):
        batches.start_batch(spark, events, at(3), "feeds").collect()


def test_closing_counts_rows_and_files_of_the_batch_only(spark, events):
    mine = {"batch_id": "20260103000000"}
    bronze = {
        "staff": rows(spark, STAFF, [mine, mine | {"file_path": "/x"}, {"batch_id": "other", "file_path": "/y"}]),
        "services": rows(spark, SERVICES, [mine | {"file_path": "/x"}]),
    }
    closing = batches.close_events(batches.batch_state(events), bronze, "COMPLETED", at(5)).collect()
    assert [(r.batch_id, r.status, r.source_files, r.processed_records) for r in closing] == [
        ("20260103000000", "COMPLETED", 2, 3)
    ]
    with pytest.raises(ValueError):
        batches.close_events(batches.batch_state(events), bronze, "RUNNING", at(5))


def test_closing_an_empty_batch_gives_zeros_and_closing_nothing_gives_no_event(spark, events):
    bronze = {"staff": rows(spark, STAFF, [{}])}
    row = batches.close_events(batches.batch_state(events), bronze, "FAILED", at(5)).first()
    assert (row.source_files, row.processed_records) == (0, 0)
    done = batches.batch_state(events.filter("batch_id < '20260103'"))
    assert batches.close_events(done, bronze, "FAILED", at(5)).count() == 0


def test_arrival_statuses(spark):
    expected = spark.createDataFrame(
        [("patients", 1, None), ("staff", 1, None), ("staff_schedule", 2, None), ("services_weekly", 1, None),
         ("lab", 1, "listing failed")],
        "dataset string, expected_count int, error_message string",
    )
    files = spark.createDataFrame(
        [("patients", "p1.csv", at(4, 6), 100), ("staff", "s0.csv", at(3, 6), 100),
         ("staff_schedule", "h1.csv", at(4, 6), 100), ("services_weekly", "w1.csv", at(4, 6), 100),
         ("services_weekly", "w2.json", at(4, 7), 100), ("lab", "l.csv", at(4, 7), 100)],
        "dataset string, file_name string, modified_time timestamp, size bigint",
    )
    status = arrivals.arrival_status(expected, files, date(2026, 1, 4), "/landing/")
    found = {r.dataset: r for r in status.collect()}
    assert {k: r.status for k, r in found.items()} == {
        "patients": "Received", "staff": "Missing", "staff_schedule": "Incomplete",
        "services_weekly": "Multiple Files", "lab": "Error",
    }
    assert found["services_weekly"].latest_file_name == "w2.json"
    assert found["services_weekly"].last_modified_time == "2026-01-04 07:00:00"
    assert found["services_weekly"].reason == "Multiple files received today (2 files arrived)"
    assert found["staff_schedule"].reason == "Only 1/2 expected files received today"
    assert (found["lab"].received_count, found["lab"].latest_file_name, found["lab"].reason) == (0, "N/A", "listing failed")
    summary = arrivals.arrival_summary(status, RUN_TS).first()
    assert (summary.overall_status, summary.missing_datasets_count, summary.total_received_files) == ("ALERT", 4, 4)
    assert summary.subject == "File Monitoring - ALERT (1/5 Files Received)"
    assert arrivals.arrival_anomalies(status).count() == 4

    allowed = arrivals.arrival_status(expected, files, date(2026, 1, 4), "/landing", allow_multiple=True)
    row = allowed.filter("dataset = 'services_weekly'").first()
    assert (row.status, row.is_received) == ("Received (Multiple)", True)
    quiet = arrivals.arrival_summary(allowed.filter("is_received"), RUN_TS, notify_on_success=False).first()
    assert (quiet.overall_status, quiet.notify) == ("SUCCESS", False)

    audit = arrivals.arrival_audit(status, RUN_TS, "j", "r", 1.234)
    assert [(f.name, f.dataType) for f in audit.schema] == [
        (f.name, f.dataType) for f in schemas.FILE_MONITORING_AUDIT
    ]
    assert {(r.overall_result, r.job_id, r.execution_duration_seconds, r.email_sent) for r in audit.collect()} == {
        ("ALERT", "j", 1.23, True)
    }


def test_ladders_fall_through_null_and_take_the_first_match(spark):
    data = [(91.0, 0.0, 0.0, 90.0, 80.0), (90.0, 31.0, 0.0, 90.0, 80.0), (90.0, 30.0, 30.1, 60.0, 40.0),
            (None, None, 30.0, 69.9, 40.0), (1.0, 1.0, 1.0, None, 49.9), (1.0, 1.0, 1.0, 70.0, 50.0)]
    df = spark.createDataFrame(
        data, "occupancy_pct double, capacity_gap double, refusal_rate_pct double, attendance_rate double, staff_morale double"
    )
    assert [r.s for r in df.select(kpis.severity().alias("s")).collect()] == [
        "CRITICAL", "CRITICAL", "HIGH", "MEDIUM", "LOW", "NORMAL",
    ]


def test_bottleneck_compares_the_rounded_fraction(spark):
    shape = "occupancy_pct double, capacity_gap double, refusal_rate_pct double, admission_rate_pct double"
    df = spark.createDataFrame([(50.0, 0.0, 20.49, 79.5), (50.0, 0.0, 20.5, 79.5), (90.01, 0.0, 0.0, 100.0)], shape)
    found = gold.bottleneck_analysis(df, RUN_TS).collect()
    assert [r.bottleneck_flag for r in found] == ["NO", "YES", "YES"]
    assert [r.avg_refusal_rate for r in found] == [0.2, 0.21, 0.0]


def test_alerts(spark):
    shape = ("service string, batch_id string, severity string, occupancy_pct double, attendance_rate double, "
             "refusal_rate_pct double, staff_morale double, avg_length_of_stay double, capacity_gap double")
    data = [("icu", "b1", "CRITICAL", 95.5, None, 1.0, 2.0, 3.0, 4.0), ("er", "b1", "NORMAL", *[1.0] * 6),
            ("er", "b2", "LOW", *[1.0] * 6)]
    df = spark.createDataFrame(data, shape)
    found = {r.service: r for r in alerts.alert_services(df).collect()}
    assert found["icu"].severity_rank == 1 and found["er"].severity_rank == 4
    assert found["icu"].digest.split("\n\n")[2:4] == ["Occupancy Percentage: 95.5", "Attendance Rate: None"]
    summary = alerts.alert_summary(df).first()
    assert (summary.critical_count, summary.low_count, summary.total_attention_count) == (1, 1, 2)
    assert summary.subject == "Operational Alert - 1 Critical Services | 2 Total Alerts"
    assert alerts.alert_services(df, "b2").count() == 1


def test_checks_report_what_is_wrong(spark, events):
    state = batches.batch_state(events.unionByName(
        spark.createDataFrame([event("odd", "RUNNING", at(6))], schemas.BATCH_EVENTS)))
    assert checks.check_batch_open(state).first().actual == 1
    assert checks.check_stale(state).first().actual == 1
    bronze = rows(spark, STAFF, [{"batch_id": "20260101000000"}, {"batch_id": "lost"}])
    known = checks.check_known_batches({"bronze_staff": bronze}, state).first()
    assert (known.actual, known.passed) == (1, False)
    assert checks.check_metadata({"t": rows(spark, STAFF, [{}, {"pipeline_stage": None}])}, "BRONZE").first().actual == 1
    assert checks.batch_consistency({"t": bronze}).first().batch_count == 2
    assert checks.batch_consistency({"t": bronze.limit(0)}).first().batch_count == 0
    end = {r.batch_id: (r.bronze_batches, r.silver_batches) for r in
           checks.lineage_end_to_end(state, bronze, bronze.limit(0), bronze.limit(0)).collect()}
    assert end["20260101000000"] == (1, 0) and end["20260102000000"] == (0, 0)


def test_declared_tables_are_created_once_with_their_schema(spark):
    names = tables.create_tables(spark)
    assert tables.create_tables(spark) == names and len(names) == 22
    for layer, of_layer in schemas.layers().items():
        for table, schema in of_layer.items():
            stored = spark.table(f"{layer}.{table}").schema
            assert {(f.name, f.dataType) for f in stored} == {(f.name, f.dataType) for f in schema}
    tables.write_table(rows(spark, STAFF, [{}]), "bronze.staff_by_key", bucket_by=(4, ["staff_id"]))
    from lakeward.operators import refine

    judged = refine.process(spark.table("bronze.staff_by_key"), STAFF)
    kept = refine.silver(judged, STAFF, RUN_TS)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 1


def test_audit_rows_append(spark, tmp_path):
    df = spark.createDataFrame([event("b", "RUNNING", at(1))], schemas.BATCH_EVENTS)
    tables.append_rows(df, str(tmp_path / "events"))
    tables.append_rows(df, str(tmp_path / "events"))
    assert spark.read.parquet(str(tmp_path / "events")).count() == 2


def test_refresh_writes_every_table_and_can_run_again(spark, tmp_path):
    bronze = {
        PATIENTS.name: rows(spark, PATIENTS, [{}, {}, {"age": 200}]),
        STAFF.name: rows(spark, STAFF, [{}]),
        STAFF_SCHEDULE.name: rows(spark, STAFF_SCHEDULE, [{}, {"week": 2, "present": 0}]),
        SERVICES.name: rows(spark, SERVICES, [{}, {"_rescued_data": '{"x":"1"}', "month": 13}]),
    }
    root = str(tmp_path / "tables")
    for _ in range(2):
        out = refresh(spark, bronze, RUN_TS, root)
        assert {f"{d.silver_table}" for d in DATASETS} | set(schemas.GOLD_TABLES) <= set(out)
        assert out["silver_patients"].count() == 1 and out["quarantine_patients"].count() == 1
        row = out["operational_efficiency"].first()
        assert (row.severity, row.attendance_rate, row.total_patients) == ("MEDIUM", 50.0, 1)
        assert out["serialization_errors"].count() == 1
        metrics = {r.dataset_name: r for r in out["data_quality_metrics"].collect()}
        assert metrics["patients"].duplicates_removed == 1 and all(m.reconciliation_passed for m in metrics.values())
        payload = out["quarantine_patients"].first().record_payload
        assert payload.age == 200 and payload.service == GOOD[PATIENTS.name]["service"]


def test_readers_see_one_version_or_the_next(spark, tmp_path, monkeypatch):
    def bronze(ages):
        return {
            PATIENTS.name: rows(spark, PATIENTS, [{"age": a, "patient_id": f"p{a}"} for a in ages]),
            STAFF.name: rows(spark, STAFF, [{}]),
            STAFF_SCHEDULE.name: rows(spark, STAFF_SCHEDULE, [{}]),
            SERVICES.name: rows(spark, SERVICES, [{}]),
        }

    root = str(tmp_path / "tables")
    with pytest.raises(LookupError):
        current_tables(spark, root)
    refresh(spark, bronze([1, 2]), RUN_TS, root)
    before = current_tables(spark, root)
    assert len(before) == 16 and before["silver_patients"].count() == 2
    assert before["patient_flow"].first().total_patients == 2

    # A run that dies after silver is written, before gold is.
    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(gold, "patient_flow", dies)
    with pytest.raises(RuntimeError, match="lost"):
        refresh(spark, bronze([1, 2, 3]), RUN_TS, root)
    monkeypatch.undo()
    after = current_tables(spark, root)
    assert {n: df.count() for n, df in after.items()} == {n: df.count() for n, df in before.items()}
    refresh(spark, bronze([1, 2, 3]), RUN_TS, root)
    assert current_tables(spark, root)["silver_patients"].count() == 3
    # Who began before still reads the version found then.
    assert before["silver_patients"].count() == 2
    refresh(spark, bronze([4]), RUN_TS, root)
    assert current_tables(spark, root)["silver_patients"].first().age == 4
    assert len(list((tmp_path / "tables" / "published").glob("0*"))) == 2


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "0001")
    assert files.create_if_absent(spark, path, "é one") and not files.create_if_absent(spark, path, "two")
    assert files.text_of(spark, path) == "é one" and files.names_in(spark, str(tmp_path / "log")) == ["0001"]
    assert files.names_in(spark, str(tmp_path / "none")) == []


def test_range_average(spark):
    trips = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (5.0, 90.0)], "distance double, fare double")
    name = register_range_average(spark, "avg_fare", trips, "fare", "distance", "It's an average.")
    row = spark.sql(f"SELECT {name}(1, 2) AS a, {name}(8, 9) AS b").first()
    assert (row.a, row.b) == (15.0, None)
    rows_ = spark.sql(f"SELECT lo, {name}(lo, 5) AS a FROM VALUES (1D), (2D) AS t(lo) ORDER BY lo").collect()
    assert [r.a for r in rows_] == [40.0, 55.0]
    with pytest.raises(ValueError):
        register_range_average(spark, "f; drop", trips, "fare", "distance")


def test_batches_are_counted_in_one_pass(spark, tmp_path):
    schema = "batch_id string, n int"
    held = {"two": [("b1", 1), ("b2", 1), ("b2", 2)], "one": [("b1", 1), ("b1", 2)], "none": [], "unknown": [(None, 1)]}
    frames = {}
    for name, data in held.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.schema(schema).parquet(str(tmp_path / name))
    result = checks.batch_consistency(frames)
    found = {r.table_name: (r.batch_count, r.passed) for r in result.collect()}
    assert found == {"two": (2, False), "one": (1, True), "none": (0, False), "unknown": (0, False)}
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan") == len(held) and plan.count("Exchange hashpartitioning") == 2


def test_closing_over_catalog_tables_reads_the_current_batch_only(spark):
    events = spark.createDataFrame([event("20260105000000", "RUNNING", at(1))], schemas.BATCH_EVENTS)
    bronze = rows(spark, STAFF, [{}, {"file_path": "/landing/g.csv"}, {"batch_id": "20250101000000"}])
    saved = tables.saved_tables({"bronze_staff": bronze}, scratch_database(spark, "test"))
    closing = batches.close_events(batches.batch_state(events), saved, batches.COMPLETED, RUN_TS)
    assert [(r.batch_id, r.source_files, r.processed_records) for r in closing.collect()] == [("20260105000000", 2, 2)]
    scan = next(line for line in closing._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "bronze_staff" in line)
    assert "dynamicpruning" in scan
