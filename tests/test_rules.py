"""Both ends of every range, NULL and blank, for all rules; and what a failure lists."""

from datetime import date, timedelta

import pytest

from helpers import GOOD, rows
from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE
from lakeward.operators import refine
from lakeward.operators import rules as R

ARRIVAL = GOOD[PATIENTS.name]["arrival_date"]


def stay(days):
    return {"departure_date": ARRIVAL + timedelta(days=days)}


def balanced(**change):
    """A service week whose request equals admitted plus refused, so that one rule is tested alone."""
    week = GOOD[SERVICES.name] | change
    return change | {"patients_request": week["patients_admitted"] + week["patients_refused"]}


# (feed, change, false flags, unknown flags)
CASES = [
    (PATIENTS, {}, "", ""),
    (PATIENTS, {"patient_id": None}, "valid_patient_id", ""),
    (PATIENTS, {"name": None}, "valid_patient_name", ""),
    (PATIENTS, {"name": " "}, "", ""),
    (PATIENTS, {"service": None}, "valid_service", ""),
    (PATIENTS, {"service": "  "}, "valid_service", ""),
    (PATIENTS, {"service": " ICU "}, "", ""),
    (PATIENTS, {"age": -1}, "valid_age", ""),
    (PATIENTS, {"age": 0}, "", ""),
    (PATIENTS, {"age": 110}, "", ""),
    (PATIENTS, {"age": 111}, "valid_age", ""),
    (PATIENTS, {"age": None}, "", "valid_age"),
    (PATIENTS, {"satisfaction": -1}, "valid_satisfaction", ""),
    (PATIENTS, {"satisfaction": 0}, "", ""),
    (PATIENTS, {"satisfaction": 100}, "", ""),
    (PATIENTS, {"satisfaction": 101}, "valid_satisfaction", ""),
    (PATIENTS, {"satisfaction": None}, "", "valid_satisfaction"),
    (PATIENTS, stay(0), "", ""),
    (PATIENTS, stay(180), "", ""),
    (PATIENTS, stay(181), "valid_length_of_stay", ""),
    (PATIENTS, stay(-1), "valid_dates,valid_length_of_stay", ""),
    (PATIENTS, {"arrival_date": None}, "valid_arrival_date", "valid_dates,valid_length_of_stay"),
    (PATIENTS, {"departure_date": None}, "valid_departure_date", "valid_dates,valid_length_of_stay"),
    (STAFF, {}, "", ""),
    (STAFF, {"staff_id": None}, "valid_staff_id", ""),
    (STAFF, {"staff_name": " "}, "valid_staff_name", ""),
    (STAFF, {"staff_name": None}, "valid_staff_name", ""),
    (STAFF, {"role": None}, "valid_role", "valid_role_value"),
    (STAFF, {"role": " "}, "valid_role,valid_role_value", ""),
    (STAFF, {"role": "porter"}, "valid_role_value", ""),
    (STAFF, {"role": " Doctor "}, "", ""),
    (STAFF, {"service": " "}, "valid_service", ""),
    (STAFF_SCHEDULE, {}, "", ""),
    (STAFF_SCHEDULE, {"staff_id": None}, "valid_staff_id", ""),
    (STAFF_SCHEDULE, {"present": 0}, "", ""),
    (STAFF_SCHEDULE, {"present": 2}, "valid_presence", ""),
    (STAFF_SCHEDULE, {"present": None}, "", "valid_presence"),
    (STAFF_SCHEDULE, {"week": 0}, "valid_week", ""),
    (STAFF_SCHEDULE, {"week": 99}, "", ""),
    (STAFF_SCHEDULE, {"week": None}, "", "valid_week"),
    (STAFF_SCHEDULE, {"role": "porter"}, "valid_role_value", ""),
    (STAFF_SCHEDULE, {"role": ""}, "valid_role,valid_role_value", ""),
    (STAFF_SCHEDULE, {"service": ""}, "valid_service", ""),
    (SERVICES, {}, "", ""),
    (SERVICES, {"service": " "}, "valid_service", ""),
    (SERVICES, {"event": None}, "valid_event", ""),
    (SERVICES, {"event": " "}, "valid_event", ""),
    (SERVICES, {"week": 0}, "valid_week", ""),
    (SERVICES, {"week": 53}, "", ""),
    (SERVICES, {"week": 54}, "valid_week", ""),
    (SERVICES, {"week": None}, "", "valid_week"),
    (SERVICES, {"month": 0}, "valid_month", ""),
    (SERVICES, {"month": 12}, "", ""),
    (SERVICES, {"month": 13}, "valid_month", ""),
    (SERVICES, {"patient_satisfaction": 101}, "valid_patient_satisfaction", ""),
    (SERVICES, {"patient_satisfaction": -1}, "valid_patient_satisfaction", ""),
    (SERVICES, {"staff_morale": 101}, "valid_staff_morale", ""),
    (SERVICES, {"staff_morale": -1}, "valid_staff_morale", ""),
    (SERVICES, {"available_beds": 0}, "valid_available_beds,valid_admitted_vs_beds,valid_occupancy_rate", ""),
    (SERVICES, balanced(patients_admitted=20), "", ""),
    (SERVICES, balanced(patients_admitted=21), "valid_admitted_vs_beds,valid_occupancy_rate", ""),
    (SERVICES, {"patients_request": 21}, "valid_request_balance", ""),
    (
        SERVICES,
        {"patients_request": 0, "patients_admitted": 0, "patients_refused": 0},
        "valid_admission_rate,valid_refusal_rate",
        "",
    ),
    (
        SERVICES,
        {"patients_request": -1},
        "valid_patients_request,valid_requests_vs_admitted,valid_requests_vs_refused,valid_request_balance,"
        "valid_admission_rate,valid_refusal_rate",
        "",
    ),
    (SERVICES, balanced(patients_admitted=-1), "valid_patients_admitted,valid_requests_vs_refused,valid_admission_rate,valid_refusal_rate", ""),
    (SERVICES, balanced(patients_refused=-1), "valid_patients_refused,valid_requests_vs_admitted,valid_admission_rate,valid_refusal_rate", ""),
    (
        SERVICES,
        {"patients_request": None},
        "valid_admission_rate,valid_refusal_rate",
        "valid_patients_request,valid_requests_vs_admitted,valid_requests_vs_refused,valid_request_balance",
    ),
]


@pytest.mark.parametrize("dataset", DATASETS, ids=lambda d: d.name)
def test_boundaries(spark, dataset):
    cases = [c for c in CASES if c[0] is dataset]
    judged = R.explain_failures(refine.process(rows(spark, dataset, [c[1] for c in cases]), dataset), dataset.all_rules)
    found = {r.record_hash: r for r in judged.collect()}
    for i, (_, change, false_flags, unknown) in enumerate(cases):
        row = found[f"h{i:03d}"]
        assert (",".join(row.failed_rules), ",".join(row.unknown_rules)) == (false_flags, unknown), change
        assert row.validation_passed == (not false_flags and not unknown), change
        assert len(row.rejection_reasons) == len(row.failed_rules), change


def test_every_rule_is_broken_by_some_case():
    for dataset in DATASETS:
        broken = {f for d, _, false_flags, _ in CASES if d is dataset for f in false_flags.split(",")}
        assert {r.flag for r in dataset.all_rules} <= broken


def test_rule_count():
    assert sum(len(d.all_rules) for d in DATASETS) == 37


def test_passing_rows_are_those_with_a_true_verdict(spark):
    for dataset in DATASETS:
        cases = [c[1] for c in CASES if c[0] is dataset]
        judged = refine.process(rows(spark, dataset, cases), dataset)
        kept = {r.record_hash for r in R.passing(judged, dataset.all_rules).collect()}
        assert kept == {r.record_hash for r in judged.filter(R.PASSED).collect()}


def test_extended_validation_runs_the_base_rules_when_missing(spark):
    from lakeward.operators.kpis import service_kpis

    normal = refine.normalize(rows(spark, SERVICES, [{}, {"month": 13}]), SERVICES)
    judged = R.extend_validation(service_kpis(normal), SERVICES.rules, SERVICES.indicator_rules)
    assert {r.record_hash: r.validation_passed for r in judged.collect()} == {"h000": True, "h001": False}


def test_unreadable_text_is_rejected_not_raised(spark):
    raw = spark.createDataFrame(
        [("p1", "A", "x12", "2025-01-01", "soon", "icu", "80")], PATIENTS.columns
    )
    row = refine.normalize(raw, PATIENTS).first()
    assert (row.age, row.arrival_date, row.departure_date, row.satisfaction) == (None, date(2025, 1, 1), None, 80)


def test_messages_follow_flags(spark):
    judged = refine.process(rows(spark, STAFF, [{"staff_id": None, "role": "porter"}]), STAFF)
    row = R.explain_failures(judged, STAFF.rules).first()
    assert row.rejection_reasons == [
        "Staff ID cannot be null",
        "Role must be one of: doctor, nurse, technician, administrator",
    ]


def test_indicators_guard_zero_and_missing_values(spark):
    changes = [{}, {"available_beds": 0}, {"patients_request": 0}, {"patients_request": None}, {"patients_request": 29}]
    from lakeward.operators.kpis import service_kpis

    found = {r.record_hash: r for r in service_kpis(rows(spark, SERVICES, changes)).collect()}
    first = found["h000"]
    assert (first.occupancy_rate, first.admission_rate, first.refusal_rate) == (0.75, 0.75, 0.25)
    assert (first.capacity_gap, first.occupancy_pct) == (0, 75.0)
    assert found["h001"].occupancy_rate is None and found["h001"].occupancy_pct is None
    assert found["h002"].admission_rate is None and found["h002"].refusal_rate is None
    assert found["h003"].capacity_gap == 0
    assert found["h004"].capacity_gap == 9
