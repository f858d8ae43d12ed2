"""Full recompute of the silver, quarantine, quality and gold tables from bronze."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF_SCHEDULE, Dataset
from lakeward.operators import gold, quality
from lakeward.operators.refine import process, quarantine, silver, with_payload
from lakeward.plans.scratch import drop_folder, scratch_root
from lakeward.sources import versions
from lakeward.sources.tables import write_path

CONCURRENT_WRITES = 4


def side_by_side(spark: SparkSession, calls: list[Callable[[], None]]) -> None:
    """Submit independent writes together, so that small jobs share the cluster; raise the first failure."""
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]:
            done.result()


def stored(df: DataFrame, path: str, **layout) -> DataFrame:
    """Write a frame and read it back: later steps start from the files, not from its lineage."""
    write_path(df, path, **layout)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Layers(NamedTuple):
    """The counts of the judged rows, and the silver and quarantine tables by dataset name."""

    received: DataFrame
    newest: DataFrame
    silver: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]

    def metrics(self) -> DataFrame:
        return quality.reconciled(*self)


def store_layers(
    spark: SparkSession, bronze: Mapping[str, DataFrame], run_ts: datetime, root: str, staging: str
) -> Layers:
    """Counts of the validated rows below ``staging``, silver and quarantine tables below ``root``.

    Judging is narrow, so every step judges the rows as it reads them: judged rows, which are larger than bronze,
    never stand on disk beside the tables made of them. The counts, which shuffle every hash, come first and a
    feed at a time, while there are no tables yet. Quarantine tables, the largest, are written one after the other, so
    that what one needs to read its feed is gone when the next begins.
    """
    counts: dict[str, list[DataFrame]] = {"received": [], "newest": []}
    kept: dict[str, DataFrame] = {}
    rejected: dict[str, DataFrame] = {}
    feeds = [d for d in DATASETS if d.name in bronze]

    def keep(d: Dataset) -> None:
        kept[d.name] = stored(silver(process(bronze[d.name], d), d, run_ts), f"{root}/{d.silver_table}")

    for d in feeds:
        judged = {d.name: process(bronze[d.name], d)}
        for name, count in (("received", quality.received_counts), ("newest", quality.newest_counts)):
            counts[name].append(stored(count(judged), f"{staging}/{name}/{d.name}"))
    side_by_side(spark, [lambda d=d: keep(d) for d in feeds])
    for d in feeds:
        rows = quarantine(process(with_payload(bronze[d.name]), d), d, run_ts)
        rejected[d.name] = stored(rows, f"{root}/{d.quarantine_table}")
    return Layers(*map(quality.union_by_name, counts.values()), kept, rejected)


def refresh(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    run_ts: datetime,
    root: str,
    staging: str | None = None,
) -> dict[str, DataFrame]:
    """Write every derived table of one version below ``root`` and return readers for them.

    Silver is written before gold reads it, so each deduplication runs once. The tables go to a new
    folder, and only when all are there the version is published (see ``sources.versions``):
    readers see the tables of one run or of the one before, never some of each, and a run that fails
    changes nothing for them. A lost executor costs the tasks it held; a failed run is
    simply run again. Staging in a folder of its own is dropped at the end; a folder that was given stays.
    """
    own_staging = staging is None
    staging = staging or scratch_root(spark, "counted")
    version, folder = versions.new_version(root)
    layers = store_layers(spark, bronze, run_ts, folder, staging)
    kept, rejected = layers.silver, layers.quarantine
    tables = {d.silver_table: kept[d.name] for d in DATASETS} | {d.quarantine_table: rejected[d.name] for d in DATASETS}

    def store(name: str, df: DataFrame, **layout) -> None:
        tables[name] = stored(df, f"{folder}/{name}", **layout)

    services, schedule, patients = kept[SERVICES.name], kept[STAFF_SCHEDULE.name], kept[PATIENTS.name]
    layout = {"partition_by": ("batch_id",), "sort_by": ("service",)}

    def efficiency() -> None:
        store("operational_efficiency", gold.operational_efficiency(services, schedule, patients, run_ts), **layout)
        store("bottleneck_analysis", gold.bottleneck_analysis(tables["operational_efficiency"], run_ts), **layout)

    side_by_side(
        spark,
        [
            lambda: store("data_quality_metrics", layers.metrics()),
            lambda: store("file_inventory", quality.file_inventory(bronze)),
            lambda: store("serialization_errors", quality.serialization_errors(spark, bronze)),
            lambda: store("patient_flow", gold.patient_flow(patients, run_ts), **layout),
            lambda: store("staff_efficiency", gold.staff_efficiency(schedule, run_ts), **layout),
            lambda: store("bed_utilization", gold.bed_utilization(services, run_ts), **layout),
            efficiency,
        ],
    )
    versions.publish(spark, root, version, {name: df.schema for name, df in tables.items()})
    if own_staging:
        drop_folder(spark, staging)
    return tables


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Readers of the tables of the version published last, by name."""
    folder, tables = versions.current(spark, root)
    return {name: spark.read.schema(StructType.fromJson(schema)).parquet(f"{folder}/{name}") for name, schema in tables.items()}
