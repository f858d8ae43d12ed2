"""Landed files through the batch and the streaming reader."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import RUN_TS
from lakeward import schemas
from lakeward.datasets import PATIENTS, STAFF, STAFF_SCHEDULE
from lakeward.operators.arrivals import files_of_day
from lakeward.operators.lineage import add_batch_lineage
from lakeward.operators.quality import serialization_errors
from lakeward.plans.scratch import scratch_root
from lakeward.sources.headers import files_by_header
from lakeward.sources.json_objects import objects_of
from lakeward.sources.landing import read_landing
from lakeward.sources.listing import landed_files
from lakeward.streaming.ingest import bronze_stream, content_columns, ingest_available
from lakeward.workload import feeds, registry

BATCH = "20260107000000"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def rescued(row):
    return json.loads(row._rescued_data) if row._rescued_data else None


def test_csv_casts_rescues_and_keeps_blanks(spark, tmp_path):
    put(
        tmp_path / "csv" / "a.csv",
        "patient_id,name,age,arrival_date,service,satisfaction,ward\n"
        "p1,Ann,41,2025-01-02, ICU ,80,\n"
        "p2,,x1,someday,icu,,w7\n"
        'p3,"Last, First",,,,,\n',
    )
    df = read_landing(spark, PATIENTS.schema, RUN_TS, csv_path=str(tmp_path / "csv"))
    found = {r.patient_id: r for r in df.collect()}
    p1, p2, p3 = found["p1"], found["p2"], found["p3"]
    assert (p1.age, p1.arrival_date, p1.departure_date, p1.service) == (41, date(2025, 1, 2), None, " ICU ")
    assert rescued(p1) is None and rescued(p3) is None
    assert (p2.name, p2.age, p2.arrival_date) == (None, None, None)
    assert rescued(p2) == {"age": "x1", "arrival_date": "someday", "ward": "w7"}
    assert p3.name == "Last, First"
    assert (p1.file_name, p1.source_format, p1.file_size > 0) == ("a.csv", "csv", True)
    assert p1.file_path.endswith("/csv/a.csv") and p1.file_modification_time is not None


def test_csv_row_of_the_wrong_length_is_kept(spark, tmp_path):
    put(tmp_path / "csv" / "a.csv", "staff_id,staff_name,role,service\ns1,Bo,nurse,icu,surplus\ns2,Cy,nurse,icu\n")
    df = read_landing(spark, STAFF.schema, RUN_TS, csv_path=str(tmp_path / "csv"))
    found = {r.staff_id: rescued(r) for r in df.collect()}
    assert found == {"s1": {"_corrupt_record": "s1,Bo,nurse,icu,surplus"}, "s2": None}


HEADERS = {
    "a.csv": "staff_id,staff_name,role,service\ns1,Bo,nurse,icu\n",
    "b.csv": "staff_name,staff_id,service\n\"Cy, B\",s2,er\n\nDi,s3\n",
    "c.csv": "\ufeffstaff_id,ward,role,staff_name,ward\ns4,w1,nurse,Ed,w2\n s5 ,,,\"\",\n",
    "d.csv": "",
}
PLACED = {
    "s1": ("Bo", "nurse", "icu", None),
    "s2": ("Cy, B", None, "er", None),
    "s3": ("Di", None, None, {"_corrupt_record": "Di,s3"}),
    "s4": ("Ed", "nurse", None, {"ward1": "w1", "ward4": "w2"}),
}


@pytest.mark.parametrize("streaming", [False, True])
def test_values_are_placed_by_each_files_own_header(spark, tmp_path, streaming):
    for name, text in HEADERS.items():
        put(tmp_path / "csv" / name, text)
    if streaming:
        stream = bronze_stream(spark, STAFF, BATCH, RUN_TS, csv_path=str(tmp_path / "csv"), max_files_per_trigger=2)
        ingest_available(stream, str(tmp_path / "t"), str(tmp_path / "c"))
        found = spark.read.schema(stream.schema).parquet(str(tmp_path / "t")).collect()
    else:
        found = read_landing(spark, STAFF.schema, RUN_TS, csv_path=str(tmp_path / "csv")).collect()
    assert {r.staff_id: (r.staff_name, r.role, r.service, rescued(r)) for r in found if r.staff_id in PLACED} == PLACED
    assert sorted(r.staff_id for r in found) == [" s5 ", "s1", "s2", "s3", "s4"], found
    assert {r.file_name for r in found} == {"a.csv", "b.csv", "c.csv"}


def test_stream_takes_up_a_grown_header(spark, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run(batch):
        stream = bronze_stream(spark, STAFF, batch, RUN_TS, csv_path=str(tmp_path / "in"))
        ingest_available(stream, table, checkpoint)
        return {r.staff_id: (r.role, rescued(r), r.batch_id) for r in spark.read.schema(stream.schema).parquet(table).collect()}

    put(tmp_path / "in" / "a.csv", "staff_id,role\ns1,nurse\n")
    first = run("20260107000000")
    assert first == {"s1": ("nurse", None, "20260107000000")}
    put(tmp_path / "in" / "b.csv", "ward,role,staff_id\nw1,doctor,s2\n")
    assert run("20260108000000") == first | {"s2": ("doctor", {"ward": "w1"}, "20260108000000")}


def test_file_without_known_header_fails_before_it_is_stored(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "staff_id,role\ns1,nurse\n")
    stream = bronze_stream(spark, STAFF, BATCH, RUN_TS, csv_path=str(tmp_path / "in"))
    put(tmp_path / "in" / "b.csv", "role,staff_id\nnurse,s2\n")
    with pytest.raises(Exception, match="header was not known yet"):
        ingest_available(stream, str(tmp_path / "t"), str(tmp_path / "c"))
    stream = bronze_stream(spark, STAFF, BATCH, RUN_TS, csv_path=str(tmp_path / "in"))
    ingest_available(stream, str(tmp_path / "t"), str(tmp_path / "c"))
    stored = spark.read.schema(stream.schema).parquet(str(tmp_path / "t")).collect()
    assert sorted((r.staff_id, r.role) for r in stored) == [("s1", "nurse"), ("s2", "nurse")]


def nested(depth):
    return '{"d": ' * depth + "1" + "}" * depth


def test_objects_are_found_at_any_depth():
    for depth in (1, 6, 7, 9, 50, 5000):
        text = f'[{{"a": 1}}, {nested(depth)},\n{{"b": [{nested(depth)}, 2]}}]'
        assert list(objects_of(text)) == [('{"a": 1}', True), (nested(depth), True), (f'{{"b": [{nested(depth)}, 2]}}', True)]
    assert list(objects_of('x {"a": "} \\" {"} y ["b"] {}')) == [('{"a": "} \\" {"}', True), ("{}", True), ('x  y ["b', False)][:2] + [('x  y ["b"', False)]
    assert list(objects_of(" \n[ ]")) == []


@pytest.mark.parametrize(
    "torn", ['{"a": {"b": 1}', '{"a": "x', '{"a": ', '{"a"', '{"a": [1, {"b": 2}', '{"a": "x}', "{"]
)
def test_torn_object_takes_no_other_with_it(torn):
    """Rows in = rows out + rescued: no inner object becomes a row, and lines after a torn one stay rows."""
    text = f'{{"n": 1}}\n{torn}\n{{"n": 2}}\n{{"n": 3, "x": {{"y": [{{}}]}}}}\n'
    found = list(objects_of(text))
    whole = [json.loads(t) for t, ok in found if ok]
    assert [o for o in whole if "n" in o] == [{"n": 1}, {"n": 2}, {"n": 3, "x": {"y": [{}]}}] and len(whole) == 3
    assert [t.strip() for t, ok in found if not ok] == [torn.strip()]


def test_inner_objects_of_a_torn_one_are_no_rows():
    text = '[\n  {"n": 1},\n  {"n": 2, "list": [\n    {"i": 1},\n    {"i": 2}\n  ,\n  {"n": 3}\n]'
    assert list(objects_of(text)) == [('{"n": 1}', True), ('{"n": 3}', True), ('{"n": 2, "list": [\n    {"i": 1},\n    {"i": 2}', False)]


def test_json_lines_are_read_by_several_tasks(spark, tmp_path):
    rows = "".join(f'{{"staff_id": "s{n}", "staff_name": {nested(9)}}}\n' for n in range(20_000))
    put(tmp_path / "json" / "a.json", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        read = read_landing(spark, STAFF.schema, RUN_TS, json_path=str(tmp_path / "json"), multi_line=False)
        assert read.rdd.getNumPartitions() > 3
        assert read.where("_rescued_data is null and staff_name like '{\"d\":%'").select("staff_id").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_documents_of_every_shape(spark, tmp_path):
    put(
        tmp_path / "json" / "array.json",
        '[\n {"staff_id": "s1", "staff_name": "Bo",\n  "role": "nurse", "service": "icu"},\n'
        ' {"staff_id": "s2", "extra": {"a": 1}, "none": null}\n]',
    )
    put(tmp_path / "json" / "object.json", '\n{"staff_id": "s3",\n "service": " er "}')
    put(tmp_path / "json" / "empty.json", "  \n")
    put(tmp_path / "json" / "none.json", "\n[ ]\n")
    put(tmp_path / "json" / "broken.json", '[{"staff_id": "s9"')
    df = read_landing(spark, STAFF.schema, RUN_TS, json_path=str(tmp_path / "json"))
    found = {r.staff_id: r for r in df.collect()}
    assert set(found) == {"s1", "s2", "s3", None}
    assert found["s1"].role == "nurse" and rescued(found["s1"]) is None
    assert rescued(found["s2"]) == {"extra": '{"a":1}'}
    assert found["s3"].service == " er " and found["s3"].role is None
    assert rescued(found[None]) == {"_corrupt_record": '[{"staff_id": "s9"'}


def test_json_files_of_several_roots_lose_no_row(spark, tmp_path):
    put(tmp_path / "json" / "lines.json", '{"staff_id": "s1"}\n{"staff_id": "s2", "staff_name": "a } b \\\\"}\n')
    put(tmp_path / "json" / "roots.json", '[{"staff_id": "s3"}, 5] [{"staff_id": "s4"}]\n{"staff_id": "s5", "x": {"y": {"z": "}"}}}')
    put(tmp_path / "json" / "broken.json", '[{"staff_id": "s6"}, {"staff_id": }, {"staff_id": "s7"}]')
    put(tmp_path / "json" / "long.json", '{"staff_id": "s8", "staff_name": "' + '\\\\n{' * 50_000 + '"}')
    found = read_landing(spark, STAFF.schema, RUN_TS, json_path=str(tmp_path / "json")).collect()
    assert sorted(r.staff_id for r in found if r.staff_id) == [f"s{i}" for i in range(1, 9)]
    assert {r.staff_name[:5] for r in found if r.staff_id == "s2"} == {"a } b"}
    assert sorted(rescued(r)["_corrupt_record"] for r in found if not r.staff_id) == ["5", '{"staff_id": }']


def test_whole_numbers_may_have_a_point(spark, tmp_path):
    put(tmp_path / "csv" / "a.csv", "week,staff_id,present\n5.0,s1,1.\n5.5,s2, 1 \n1e9.0,s3,-0.00\n")
    df = read_landing(spark, STAFF_SCHEDULE.schema, RUN_TS, csv_path=str(tmp_path / "csv"))
    assert {r.staff_id: (r.week, r.present) for r in df.collect()} == {"s1": (5, 1), "s2": (None, 1), "s3": (None, 0)}


def test_json_lines(spark, tmp_path):
    put(tmp_path / "json" / "a.json", '{"week": 3, "staff_id": "s1", "present": 1}\n{"week": "w4"}\nnot json\n')
    df = read_landing(spark, STAFF_SCHEDULE.schema, RUN_TS, json_path=str(tmp_path / "json"), multi_line=False)
    found = {(r.week, r.present): rescued(r) for r in df.collect()}
    assert found[(3, 1)] is None
    assert [r._rescued_data for r in df.collect()].count(None) == 1
    assert sorted(json.loads(r._rescued_data).popitem() for r in df.collect() if r._rescued_data) == [
        ("_corrupt_record", "not json"),
        ("week", "w4"),
    ]


def test_feeds_of_both_formats_unite(spark, tmp_path):
    put(tmp_path / "csv" / "a.csv", "staff_id,role\ns1,nurse\n")
    put(tmp_path / "json" / "a.json", '[{"staff_id": "s2", "staff_name": "Cy"}]')
    df = read_landing(
        spark, STAFF.schema, RUN_TS, csv_path=str(tmp_path / "csv"), json_path=str(tmp_path / "json")
    )
    stamped = add_batch_lineage(df, BATCH, RUN_TS, content_columns(STAFF))
    assert {(f.name, f.dataType) for f in stamped.schema} == {(f.name, f.dataType) for f in schemas.bronze(STAFF)}
    assert {(r.staff_id, r.staff_name, r.role, r.source_format) for r in stamped.collect()} == {
        ("s1", None, "nurse", "csv"),
        ("s2", "Cy", None, "json"),
    }


def test_no_folder_is_an_error(spark):
    with pytest.raises(ValueError):
        read_landing(spark, STAFF.schema, RUN_TS)


def test_stream_takes_each_file_once(spark, tmp_path):
    put(tmp_path / "in" / "csv" / "a.csv", "staff_id,staff_name,role,service,note\ns1,Bo,nurse,icu,hm\n")
    put(tmp_path / "in" / "json" / "a.json", '[{"staff_id": "s2"}, {"staff_id": "s3"}]')
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run(batch):
        stream = bronze_stream(
            spark, STAFF, batch, RUN_TS,
            csv_path=str(tmp_path / "in" / "csv"), json_path=str(tmp_path / "in" / "json"), max_files_per_trigger=1,
        )
        ingest_available(stream, table, checkpoint)
        stored = spark.read.schema(stream.schema).parquet(table)
        return sorted((r.staff_id, r.batch_id) for r in stored.collect())

    first = run("20260107000000")
    assert [s for s, _ in first] == ["s1", "s2", "s3"]
    assert run("20260108000000") == first
    put(tmp_path / "in" / "csv" / "b.csv", "staff_id,staff_name,role,service,note\ns4,Di,nurse,er,\n")
    assert run("20260109000000") == first + [("s4", "20260109000000")]
    schema = schemas.bronze(STAFF)
    stored = spark.read.schema(schema).parquet(table)
    errors = serialization_errors(spark, {STAFF.name: stored}).collect()
    assert [(e.batch_id, e.dataset, json.loads(e.error_message)) for e in errors] == [
        ("20260107000000", "staff", {"note": "hm"})
    ]


def test_listing_finds_files_at_any_depth(spark, tmp_path):
    put(tmp_path / "patients" / "csv" / "a.csv", "12345")
    put(tmp_path / "patients" / "json" / "deep" / "b.json", "1")
    put(tmp_path / "staff" / "c.csv", "123")
    listed = landed_files(spark, str(tmp_path))
    assert {(r.dataset, r.file_name, r["size"]) for r in listed.collect()} == {
        ("patients", "a.csv", 5), ("patients", "b.json", 1), ("staff", "c.csv", 3),
    }
    today = listed.selectExpr("to_date(max(modified_time)) AS d").first().d
    assert files_of_day(listed, today).count() == 3
    assert files_of_day(listed, date(2001, 1, 1)).count() == 0


def test_scratch_follows_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark, "x").startswith(shared) and scratch_root(spark, "x") != scratch_root(spark, "x")


def test_run_time_is_stamped(spark, tmp_path):
    put(tmp_path / "csv" / "a.csv", "staff_id\ns1\n")
    df = read_landing(spark, STAFF.schema, datetime(2026, 1, 7, 1), csv_path=str(tmp_path / "csv"))
    assert df.first().ingestion_timestamp == datetime(2026, 1, 7, 1)


def test_csv_folder_may_be_empty_at_first(spark, tmp_path):
    rows = read_landing(spark, STAFF.schema, RUN_TS, csv_path=str(tmp_path))
    assert rows.count() == 0
    assert rows.columns[: len(STAFF.columns)] == list(STAFF.columns)
    (tmp_path / "a.csv").write_text(",".join(STAFF.columns) + "\n")
    assert list(files_by_header(spark, str(tmp_path))) == [tuple(STAFF.columns)]


def test_a_run_that_died_is_done_again_and_only_that(spark):
    session = registry.Session(spark, "/root/testdata/sf0.001")
    table, died = registry._restarted(session, STAFF_SCHEDULE)
    landed = feeds.clean_text_feed(spark, session.sf_dir, STAFF_SCHEDULE)
    columns = [F.col(c).cast("string") for c in STAFF_SCHEDULE.columns]
    assert died and sorted(map(str, table.select(*columns).collect())) == sorted(map(str, landed.select(*STAFF_SCHEDULE.columns).collect()))
    # The first delivery and the second; the batch that died kept its number.
    checkpoint = Path(table.inputFiles()[0].removeprefix("file://").partition("/bronze/")[0]) / "checkpoint"
    for kind in ("offsets", "commits"):
        assert {p.name for p in (checkpoint / kind).iterdir() if p.name.isdigit()} == {"0", "1"}
