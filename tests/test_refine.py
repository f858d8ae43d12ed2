"""Deduplication, quarantine, copies and reconciliation on small frames, and the plans they get."""

from collections import Counter
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import RUN_TS, rows
from lakeward import schemas
from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF
from lakeward.operators import quality, refine
from lakeward.operators import rules as R
from lakeward.operators.lineage import add_batch_lineage, number_copies


def metrics_of(judged, silver, quarantine):
    return quality.data_quality_metrics(*({STAFF.name: df} for df in (judged, silver, quarantine)))



def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_wins_then_processing_time_then_file_then_hash(spark):
    day = [datetime(2026, 1, d) for d in range(1, 5)]
    changes = [
        dict(staff_id="a", file_modification_time=day[0], processed_timestamp=day[3]),
        dict(staff_id="a", file_modification_time=day[1], processed_timestamp=day[2]),
        dict(staff_id="b", processed_timestamp=day[1], file_name="z"),
        dict(staff_id="b", processed_timestamp=day[2], file_name="a"),
        dict(staff_id="c", file_name="a"),
        dict(staff_id="c", file_name="b"),
        dict(staff_id="d"),
        dict(staff_id="d"),
        dict(staff_id="e", file_modification_time=None),
        dict(staff_id="e", file_modification_time=day[0]),
    ]
    judged = refine.process(rows(spark, STAFF, changes), STAFF)
    for parts in (1, 3):
        kept = refine.silver(judged.repartition(parts), STAFF, RUN_TS).collect()
        assert {r.staff_id: r.record_hash for r in kept} == {
            "a": "h001", "b": "h003", "c": "h005", "d": "h006", "e": "h009",
        }


def test_silver_and_quarantine_have_the_declared_columns(spark):
    for d in DATASETS:
        bronze = rows(spark, d, [{}, {"service": None}])
        kept = refine.silver(refine.process(bronze, d), d, RUN_TS)
        dropped = refine.quarantine(refine.process(refine.with_payload(bronze), d), d, RUN_TS)
        for df, schema in ((kept, schemas.silver(d)), (dropped, schemas.quarantine(d))):
            assert {(f.name, f.dataType.typeName()) for f in df.schema} == {
                (f.name, f.dataType.typeName()) for f in schema
            }
        assert kept.count() == 1 and dropped.count() == 1


def test_payload_is_the_row_before_normalisation(spark):
    bronze = rows(spark, STAFF, [{"role": " PORTER "}])
    row = refine.quarantine(refine.process(refine.with_payload(bronze), STAFF), STAFF, RUN_TS).first()
    assert (row.role, row.record_payload.role) == ("porter", " PORTER ")
    assert row.source_table == "bronze.bronze_staff" and len(row.quarantine_id) == 64


def test_a_row_with_only_unknown_rules_is_quarantined_without_reasons(spark):
    judged = refine.process(refine.with_payload(rows(spark, PATIENTS, [{"age": None}])), PATIENTS)
    row = refine.quarantine(judged, PATIENTS, RUN_TS).first()
    assert (row.failed_rules, row.rejection_reasons, row.unknown_rules) == ([], [], ["valid_age"])


staff_rows = st.lists(
    st.fixed_dictionaries(
        {
            "staff_id": st.sampled_from(["a", "b", "c", None]),
            "role": st.sampled_from(["nurse", "porter", None, " Doctor"]),
            "file_name": st.sampled_from(["f1", "f2"]),
            "batch_id": st.sampled_from(["20260101000000", "20260102000000"]),
        }
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=staff_rows)
def test_every_row_is_kept_superseded_or_quarantined(spark, changes):
    bronze = rows(spark, STAFF, changes)
    judged = refine.process(bronze, STAFF)
    kept = refine.silver(judged, STAFF, RUN_TS)
    dropped = refine.quarantine(refine.process(refine.with_payload(bronze), STAFF), STAFF, RUN_TS)
    kept_rows, dropped_rows = kept.collect(), dropped.collect()
    keys = [r.staff_id for r in kept_rows]
    assert len(keys) == len(set(keys))
    assert len({r.quarantine_id for r in dropped_rows}) == len(dropped_rows)
    metrics = metrics_of(judged, kept, dropped).collect()
    assert sum(m.records_received for m in metrics) == len(changes)
    assert sum(m.records_valid for m in metrics) == len(kept_rows)
    assert sum(m.records_quarantined for m in metrics) == len(dropped_rows)
    assert all(m.reconciliation_passed for m in metrics)
    valid = [c for c in changes if c["staff_id"] and c["role"] in ("nurse", " Doctor")]
    assert sum(m.duplicates_removed for m in metrics) == len(valid) - len({c["staff_id"] for c in valid})


def both_tables(judged):
    return refine.silver(judged, STAFF, RUN_TS), refine.quarantine(judged, STAFF, RUN_TS)


def test_lost_rows_fail_the_reconciliation(spark):
    judged = refine.process(rows(spark, STAFF, [{"staff_id": "a"}, {"staff_id": "a"}, {"staff_id": "b"}, {"staff_id": None}]), STAFF)
    kept, dropped = both_tables(judged)

    def passed(silver, quarantine):
        return metrics_of(judged, silver, quarantine).first().reconciliation_passed

    assert passed(kept, dropped)
    assert not passed(kept.filter("staff_id = 'a'"), dropped)
    assert not passed(kept.limit(0), dropped)
    assert not passed(kept, dropped.limit(0))


def test_metrics_of_a_batch_without_valid_rows(spark):
    judged = refine.process(rows(spark, STAFF, [{"staff_id": None}]), STAFF)
    row = metrics_of(judged, *both_tables(judged)).first()
    assert (row.records_valid, row.records_quarantined, row.success_rate, row.failure_rate) == (0, 1, 0.0, 1.0)
    assert row.processing_end == RUN_TS and row.duration_seconds == 2 * 86400


def test_metrics_match_the_declared_schema(spark):
    judged = refine.process(rows(spark, STAFF, [{}]), STAFF)
    df = metrics_of(judged, *both_tables(judged))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.DATA_QUALITY_METRICS]


def test_copies_are_numbered_whatever_their_count(spark):
    data = [("hot", 1)] * 1003 + [("two", 2)] * 2 + [("one", None)]
    df = spark.createDataFrame(data, "k string, v int").repartition(3)
    numbered = number_copies(df, group=100)
    found = Counter((r.k, r.v, r.copy_number) for r in numbered.collect())
    expected = Counter([("hot", 1, i) for i in range(1, 1004)] + [("two", 2, 1), ("two", 2, 2), ("one", None, 1)])
    assert found == expected


def test_record_hashes_are_repeatable_and_unique_with_copy_numbers(spark):
    df = rows(spark, STAFF, [{}, {}, {"staff_id": None}, {"staff_name": None}]).drop("record_hash")
    content = STAFF.columns

    def hashes(frame):
        return sorted(r.record_hash for r in add_batch_lineage(frame, "20260101000000", RUN_TS, content).collect())

    plain = hashes(df)
    assert plain == hashes(df.repartition(3)) and len(set(plain)) == 3
    numbered = number_copies(df)
    assert len(set(hashes(numbered))) == 4 and hashes(numbered) == hashes(number_copies(df.repartition(2)))


def test_a_key_that_holds_most_rows_is_deduplicated_like_any_other(spark):
    # One key has four fifths of the rows; compare with a plain loop over them.
    changes = [
        {"staff_id": "hot" if i % 5 else f"s{i}", "processed_timestamp": datetime(2026, 1, 1 + (i * 7) % 25)}
        for i in range(400)
    ]
    best = {}
    for i, c in enumerate(changes):
        place = (c["processed_timestamp"], -i)
        best[c["staff_id"]] = max(best.get(c["staff_id"], place), place)
    judged = refine.process(rows(spark, STAFF, changes).repartition(4), STAFF)
    kept = refine.silver(judged, STAFF, RUN_TS).collect()
    assert {r.staff_id: r.record_hash for r in kept} == {k: f"h{-i:03d}" for k, (_, i) in best.items()}


def test_deduplication_limits_groups_before_the_shuffle(spark):
    plan = plan_of(refine.silver(refine.process(rows(spark, PATIENTS, [{}]), PATIENTS), PATIENTS, RUN_TS))
    before, after = plan.index("Final"), plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2 and before < plan.index("Exchange") < after


def test_rules_reach_the_scan_and_no_python_runs(spark, tmp_path):
    rows(spark, PATIENTS, [{}]).write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    kept = refine.silver(refine.process(bronze, PATIENTS), PATIENTS, RUN_TS)
    plan = plan_of(kept)
    assert "IsNotNull(patient_id)" in plan and "GreaterThanOrEqual(age,0)" in plan
    assert "Python" not in plan
    rejected = refine.quarantine(refine.process(bronze, PATIENTS), PATIENTS, RUN_TS)
    assert "Exchange" not in plan_of(rejected)


def test_serialization_errors_without_rescued_columns_is_an_empty_table(spark):
    df = quality.serialization_errors(spark, {STAFF.name: rows(spark, STAFF, [{}]).drop("_rescued_data")})
    assert df.schema == schemas.SERIALIZATION_ERRORS and df.count() == 0


def test_kpi_verdict_tightens_the_base_verdict(spark):
    zero = {"patients_request": 0, "patients_admitted": 0, "patients_refused": 0}
    normal = refine.normalize(rows(spark, SERVICES, [zero]), SERVICES)
    assert R.validate(normal, SERVICES.rules).first().validation_passed
    assert not refine.process(rows(spark, SERVICES, [zero]), SERVICES).first().validation_passed
