"""What runs leave on disk while they work: files are landed, counted and dropped feed by feed."""

import time
from pathlib import Path

import pytest

from helpers import RUN_TS, rows
from lakeward.datasets import DATASETS, STAFF
from lakeward.operators import quality, refine
from lakeward.plans.scratch import scratch_database
from lakeward.sources.tables import saved_tables, shuffles_freed, write_path
from lakeward.streaming.ingest import bronze_stream, ingest_available
from lakeward.workload import feeds, registry

LINES = 240
SMALL = {
    "customer": "SELECT id AS c_custkey, concat('c', id) AS c_name, CAST(id % 25 AS INT) AS c_nationkey FROM range(30)",
    "orders": "SELECT id AS o_orderkey, id % 30 AS o_custkey, TIMESTAMP '1995-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) AS o_orderdate,"
    " CAST(id * 10 AS DOUBLE) AS o_totalprice FROM range(60)",
    "lineitem": "SELECT id % 60 AS l_orderkey, id % 50 AS l_partkey, id % 7 AS l_suppkey, CAST(id / 60 AS INT) AS l_linenumber,"
    f" CAST(id AS DOUBLE) AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice FROM range({LINES})",
    "events": "SELECT id AS event_id, TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT)) AS ts, id % 9 AS user_id,"
    " CASE WHEN id % 5 = 0 THEN 'purchase' ELSE 'view' END AS event_type FROM range(80)",
}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("small")
    for name, text in SMALL.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def run(spark, small, tmp_path):
    """Runs a query over a data folder that no query has read, and gives its rows and the scratch files it left."""
    (tmp_path / "data").symlink_to(small)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))

    def files():
        return {str(p.relative_to(shared)) for p in shared.rglob("part-*")}

    def of(name):
        before = files()
        result = registry.queries()[name](spark, str(tmp_path / "data"))
        left = files() - before
        return result.collect(), left

    return of


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in manager.getAllBlocks().mkString(" ").split() if name.startswith("shuffle_")}

    before = shuffled()
    df = spark.range(1000).repartition(3, "id")
    with shuffles_freed(spark):
        write_path(df, str(tmp_path / "t"))
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_deep_json_stands_on_disk_in_one_layout_of_one_feed(run):
    found, left = run("ingest_json_deep")
    assert left and all("/counted/" in f for f in left), left
    patients = sum(1 for i in range(LINES) if i % 7 % 2)
    for layout in ("array", "lines"):
        assert sum(r.rows for r in found if (r.dataset_name, r.layout) == ("patients", layout)) == patients
    assert all(r.unread == 0 for r in found)


@pytest.mark.parametrize("name", ["stream_ingest_evolved", "schema_evolution_union"])
def test_evolved_feeds_are_dropped_once_counted(run, name):
    found, left = run(name)
    assert left and all("/counted/" in f for f in left), left
    assert {r.dataset_name: r.rows for r in found} == {"patients": LINES, "staff": 30, "staff_schedule": 80, "services": 60}


def test_a_csv_stream_does_not_shuffle_its_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("staff_id,role\ns1,nurse\n")
    stream = bronze_stream(spark, STAFF, "20260107000000", RUN_TS, csv_path=str(tmp_path))
    query = ingest_available(stream, str(tmp_path / "t"), str(tmp_path / "c"))
    plan = query._jsq.explainInternal(False)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_restarted_stream_is_dropped_once_counted(run):
    found, left = run("stream_restarted")
    assert left and all("/counted/" in f for f in left), left
    counted = {d: sum(r.rows for r in found if r.dataset_name == d) for d in {r.dataset_name for r in found}}
    assert counted == {"patients": LINES, "staff": 30, "staff_schedule": 80, "services": 60}
    assert {r.died for r in found} == {"true"}
    # The copies of a key with the same values are one row, the others differ.
    assert all(0 < r.different_rows <= r.rows for r in found)


def test_errors_are_read_from_packed_files_and_no_table_beside_them(run):
    found, left = run("serialization_errors")
    assert left and all(f.endswith(".gz") for f in left), left
    assert found and {r.error_type for r in found} == {"SERIALIZATION_ERROR"}
    assert {r.dataset for r in found} == {"patients", "staff", "staff_schedule", "services"}


def test_judged_rows_do_not_stand_beside_their_tables(run):
    found, left = run("data_quality_metrics")
    tables = {f"{layer}_{d.name}" for d in DATASETS for layer in ("silver", "quarantine")}
    assert {f.split("/")[-2] for f in left if "/tables/" in f} == tables
    others = {tuple(f.split("/")[-3:-1]) for f in left if "/tables/" not in f}
    assert others == {(count, d.name) for d in DATASETS for count in ("received", "newest")}
    received = {d: sum(r.records_received for r in found if r.dataset_name == d) for d in {r.dataset_name for r in found}}
    assert received == {"patients": LINES, "staff": 30, "staff_schedule": 80, "services": 60}
    assert {r.reconciliation_passed for r in found} == {"true"}


def test_hashes_that_are_hex_or_not_are_told_apart_as_texts(spark):
    digest = "0123456789abcdef" * 4
    texts = [digest, digest, digest.upper(), digest[:-1], digest[:-1] + "g", "0" + digest, "", "h", "h", None, None]
    judged = refine.process(rows(spark, STAFF, [{"record_hash": t} for t in texts]), STAFF)
    counts = quality.received_counts({STAFF.name: judged}).collect()
    assert [(r.records_received, r.records_distinct) for r in counts] == [(len(texts), len({t for t in texts if t is not None}))]


@pytest.mark.parametrize("name", ["refreshed_bottlenecks", "refreshed_tables"])
def test_a_full_run_leaves_its_tables_and_no_copy_of_the_feeds(run, name):
    found, left = run(name)
    assert left and all("/versions/" in f for f in left), left
    # Four silver, four quarantine, and eight other tables.
    assert len({f.split("/versions/")[1].split("/")[1] for f in left}) == 16
    if name == "refreshed_tables":
        counted = {r.table_name: r.rows for r in found}
        patients = counted["silver_patients"] + counted["quarantine_patients"]
        assert 0 < counted["silver_patients"] and patients <= LINES and counted["quarantine_staff"] + counted["silver_staff"] <= 30
    else:
        assert found and {r.bottleneck_flag for r in found} <= {"YES", "NO"}


def test_catalog_tables_are_saved_in_parts_and_the_feed_is_dropped(run):
    found, left = run("batch_close_catalog")
    # The control events are made of the stored staff feed.
    assert left and all("/batch_id=" in f or "/bronze_staff/" in f for f in left), left
    closed = [r for r in found if r.batch_id == "20260102000000"]
    assert [r.status for r in closed] == ["COMPLETED"] and closed[0].processed_records > 0


def test_parts_of_a_feed_are_the_feed(spark, small):
    for d in DATASETS:
        parts = [sorted(map(str, part.collect())) for part in feeds.bronze_parts(spark, str(small), d, 3)]
        assert 1 <= len(parts) <= 3
        assert sorted(row for part in parts for row in part) == sorted(map(str, feeds.bronze(spark, str(small), d).collect()))


def test_parts_are_appended_to_one_table(spark):
    frame = rows(spark, STAFF, [{"batch_id": f"2026010{i % 2}", "staff_id": f"s{i}"} for i in range(10)])
    parts = (frame.filter(f"pmod(xxhash64(staff_id), 3) = {i}") for i in range(3))
    saved = saved_tables({"bronze_staff": parts}, scratch_database(spark, "parts"))["bronze_staff"]
    assert sorted((r.batch_id, r.staff_id) for r in saved.collect()) == sorted((r.batch_id, r.staff_id) for r in frame.collect())
