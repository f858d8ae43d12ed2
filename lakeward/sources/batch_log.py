"""The batch control table as files: every change of state is one numbered entry that only one writer can make.

``root/entries`` holds one small file per change, named by its number. It names the folder of the change's
events below ``root/events``. An entry appears whole or not at all, so events of a run that died, or lost its number
to another, are in a folder nothing points to.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lakeward.operators import batches
from lakeward.plans.scratch import drop_folder
from lakeward.schemas import BATCH_EVENTS
from lakeward.sources.files import create_if_absent, names_in, text_of
from lakeward.sources.tables import write_path

# Changes after which the next one writes all events anew, so that reading opens few folders.
MERGE_AFTER = 50


class BatchMoved(RuntimeError):
    """Another writer changed the control table after it was read."""


class BatchLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _folders(self, entries: list[str]) -> list[str]:
        """Folders that together hold all events: back to the last entry that holds them by itself."""
        folders = []
        for name in reversed(entries):
            entry = json.loads(text_of(self.spark, f"{self.root}/entries/{name}"))
            folders.append(f"{self.root}/events/{entry['folder']}")
            if entry["whole"]:
                break
        return folders

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], BATCH_EVENTS)
        return self.spark.read.schema(BATCH_EVENTS).parquet(*folders)

    def events(self) -> DataFrame:
        return self._read(self._folders(names_in(self.spark, f"{self.root}/entries")))

    def state(self) -> DataFrame:
        return batches.batch_state(self.events())

    def append(self, decide: Callable[[DataFrame], DataFrame], retry: bool = True) -> None:
        """Append the events that ``decide`` makes of those there are.

        If another writer takes the number first, the events are decided anew from what it wrote, or
        ``BatchMoved`` is raised without ``retry``.
        """
        while True:
            entries = names_in(self.spark, f"{self.root}/entries")
            folders = self._folders(entries)
            events, number = self._read(folders), int(entries[-1]) + 1 if entries else 1
            new = decide(events)
            whole = len(folders) >= MERGE_AFTER
            folder = uuid4().hex
            write_path(events.unionByName(new) if whole else new, f"{self.root}/events/{folder}", mode="error")
            text = json.dumps({"folder": folder, "whole": whole})
            if create_if_absent(self.spark, f"{self.root}/entries/{number:012d}", text):
                return
            drop_folder(self.spark, f"{self.root}/events/{folder}")
            if not retry:
                raise BatchMoved(f"change {number} of {self.root} was made by another writer")

    def open(self, run_ts: datetime, pipeline_name: str) -> str:
        """Fail the batches still running and open a new one; of two that open at once, one raises ``BatchMoved``."""
        self.append(lambda events: batches.start_batch(self.spark, events, run_ts, pipeline_name), retry=False)
        return run_ts.strftime("%Y%m%d%H%M%S")

    def close(self, bronze: Mapping[str, DataFrame], status: str, run_ts: datetime) -> None:
        """Close the newest running batch with its totals over the bronze tables; nothing changes if none runs."""
        self.append(lambda events: batches.close_events(batches.batch_state(events), bronze, status, run_ts))
