"""The stored control table, repeated appends, and listings with failing folders."""

from datetime import datetime

import pytest

from helpers import rows
from lakeward.datasets import DATASETS
from lakeward.operators import batches
from lakeward.sources import batch_log
from lakeward.sources.batch_log import BatchLog, BatchMoved
from lakeward.sources.listing import listed_folders
from lakeward.sources.tables import append_run


def at(day):
    return datetime(2026, 1, day)


def statuses(log):
    return {r.batch_id[:8]: r.status for r in log.state().collect()}


def test_open_stale_close_are_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batch_log, "MERGE_AFTER", 2)
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.events().count() == 0
    assert log.open(at(1), "feeds") == "20260101000000"
    log.open(at(2), "feeds")
    assert statuses(log) == {"20260101": "FAILED", "20260102": "RUNNING"}
    bronze = {d.name: rows(spark, d, [{"batch_id": "20260102000000"}] * 2) for d in DATASETS}
    log.close(bronze, batches.COMPLETED, at(3))
    log.close(bronze, batches.COMPLETED, at(4))  # nothing runs any more
    state = {r.batch_id: r for r in log.state().collect()}
    closed = state["20260102000000"]
    assert (closed.status, closed.processed_records, closed.source_files, closed.end_time) == ("COMPLETED", 8, 1, at(3))
    assert log.events().count() == 4
    assert len(log._folders(batch_log.names_in(spark, f"{log.root}/entries"))) <= 3
    with pytest.raises(Exception, match="exists already"):
        log.open(at(2), "feeds")
    assert log.events().count() == 4


def test_of_two_that_open_at_once_one_is_told(spark, tmp_path):
    log, other = (BatchLog(spark, str(tmp_path / "log")) for _ in range(2))
    log.open(at(1), "feeds")

    def late(events):
        other.open(at(2), "feeds")
        return batches.start_batch(spark, events, at(3), "feeds")

    with pytest.raises(BatchMoved):
        log.append(late, retry=False)
    assert statuses(log) == {"20260101": "FAILED", "20260102": "RUNNING"}


def test_a_change_that_lost_its_number_is_decided_anew(spark, tmp_path):
    log, calls = BatchLog(spark, str(tmp_path / "log")), []
    log.open(at(1), "feeds")

    def fail_running(events):
        if not calls:
            BatchLog(spark, log.root).open(at(2), "feeds")
        calls.append(1)
        return batches.stale_events(batches.batch_state(events), at(3))

    log.append(fail_running)
    assert len(calls) == 2
    assert statuses(log) == {"20260101": "FAILED", "20260102": "FAILED"}
    assert log.events().filter("batch_id = '20260101000000' AND status = 'FAILED'").count() == 1


def test_a_run_that_dies_between_events_and_entry_changes_nothing(spark, tmp_path, monkeypatch):
    log = BatchLog(spark, str(tmp_path / "log"))
    log.open(at(1), "feeds")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(batch_log, "create_if_absent", dies)
        with pytest.raises(OSError):
            log.open(at(2), "feeds")
    assert statuses(log) == {"20260101": "RUNNING"}
    log.open(at(2), "feeds")
    assert statuses(log) == {"20260101": "FAILED", "20260102": "RUNNING"}


def test_a_run_appended_again_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "audit")
    run = lambda name, n: spark.createDataFrame([(i, name) for i in range(n)], "n int, run_id string")
    for name, n in (("a", 3), ("b", 2), ("a", 3), ("a", 4)):
        append_run(run(name, n), path, "run_id")
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"a": 4, "b": 2}


def test_a_missing_folder_is_a_row_and_an_empty_one_is_not(spark, tmp_path):
    (tmp_path / "full").mkdir()
    (tmp_path / "full" / "x.csv").write_text("a\n1\n")
    (tmp_path / "empty").mkdir()
    files, failures = listed_folders(spark, {n: str(tmp_path / n) for n in ("full", "empty", "gone")})
    assert [(r.dataset, r.file_name, r.size) for r in files.collect()] == [("full", "x.csv", 4)]
    assert [tuple(r) for r in failures.collect()] == [("gone", "listing failed: PATH_NOT_FOUND")]
    none, all_failed = listed_folders(spark, {"gone": str(tmp_path / "gone")})
    assert none.count() == 0 and all_failed.count() == 1
