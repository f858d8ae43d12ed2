"""The feeds as Spark frames, and the same rows as landed files."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from datetime import date, datetime
from functools import cache
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE, Dataset
from lakeward.plans.refresh import stored
from lakeward.plans.scratch import drop_folder, exists, scratch_root
from lakeward.sources.files import names_in
from lakeward.sources.tables import shuffles_freed
from lakeward.workload import feed_sql

# Stated instead of read from the clock, so results can be compared.
RUN_TS = datetime(2026, 1, 7)
AS_OF = date(1998, 6, 15)

BRONZE_SQL = {
    PATIENTS.name: feed_sql.PATIENTS,
    STAFF.name: feed_sql.STAFF,
    STAFF_SCHEDULE.name: feed_sql.STAFF_SCHEDULE,
    SERVICES.name: feed_sql.SERVICES_WEEKLY,
}
RAW_SQL = {
    PATIENTS.name: feed_sql.RAW_PATIENTS,
    STAFF.name: feed_sql.RAW_STAFF,
    STAFF_SCHEDULE.name: feed_sql.RAW_STAFF_SCHEDULE,
    SERVICES.name: feed_sql.RAW_SERVICES_WEEKLY,
}
_TABLES = ("nation", "customer", "orders", "lineitem", "events")
# Small row groups let several tasks read a small table of one file.
ROW_GROUP_BYTES = 8 << 20
ROWS_PER_DOCUMENT = 50_000
# A feed that is written with a shuffle is written in so many parts.
PARTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _with_arguments(text: str, names: tuple[str, ...]) -> str:
    for name in names:
        text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return text


def _query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    used = {n: f for n, f in frames.items() if f"FROM {n}" in text or f"JOIN {n}" in text}
    return spark.sql(_with_arguments(feed_sql.render(text, "spark"), tuple(used)), **used)


def _from_tables(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    named = [t for t in re.findall(r"\b(?:FROM|JOIN) (\w+)", text) if t in _TABLES]
    return _query(spark, text, **{t: table(spark, sf_dir, t) for t in named}, **frames)


# Paths of the bronze tables that a session has stored, by application, data folder and feed.
_stored: dict[tuple[str, str, str], str] = {}
_ADDED = ("ingestion_timestamp", "pipeline_stage", "record_hash")


def _with_lineage(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "ingestion_timestamp": F.col("processed_timestamp"),
            "pipeline_stage": F.lit("BRONZE"),
            "record_hash": F.sha2(F.concat_ws("|", "batch_id", "file_name", "row_key"), 256),
        }
    )


def _bronze_table(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """The feed as a stored table, written once per session and data folder: bronze is what all other layers read."""
    key = (spark.sparkContext.applicationId, sf_dir, dataset.name)
    if key not in _stored or not exists(spark, _stored[key]):
        rows = _with_lineage(_from_tables(spark, sf_dir, BRONZE_SQL[dataset.name]))
        path = f"{scratch_root(spark, 'bronze')}/{dataset.bronze_table}"
        out = stored(rows, path, row_group_bytes=ROW_GROUP_BYTES)
        _stored[key] = path
        return out
    return spark.read.parquet(_stored[key])


def _unstored(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """The same rows for runs that write them elsewhere: the stored table if there is one, else made from the given
    tables as they are read, so that they do not stand on disk twice."""
    path = _stored.get((spark.sparkContext.applicationId, sf_dir, dataset.name))
    if path and exists(spark, path):
        return spark.read.parquet(path)
    rows = _with_lineage(_from_tables(spark, sf_dir, BRONZE_SQL[dataset.name]))
    # Always true, but the optimizer does not look through it: without it the feed's formulas would be written into each
    # rule above that uses them, over and over, which grows beyond what is compiled.
    return rows.withColumn("_any", F.rand(0)).filter("_any >= 0").drop("_any")


def keyed_feed(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """Feed rows with ``row_key``, unique per row."""
    return _bronze_table(spark, sf_dir, dataset).drop(*_ADDED)


def bronze(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """Feed rows as a bronze table: declared and file columns, lineage, record hash."""
    return _bronze_table(spark, sf_dir, dataset).drop("row_key")


def bronze_rows(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """The rows of ``bronze``, for runs that write derived tables of all feeds: see ``_unstored``."""
    return _unstored(spark, sf_dir, dataset).drop("row_key")


def bronze_parts(spark: SparkSession, sf_dir: str, dataset: Dataset, parts: int = PARTS) -> Iterator[DataFrame]:
    """The rows of ``bronze`` in at most so many parts, for a write that shuffles them: at least one, be it empty.

    While parts are taken, the feed is kept without what follows from its other columns; then it is dropped.
    """
    path = scratch_root(spark, "feed")
    rows = stored(_from_tables(spark, sf_dir, BRONZE_SQL[dataset.name]), path)
    files = [f"{path}/{name}" for name in names_in(spark, path)]
    for part in [files[i::parts] for i in range(min(parts, len(files)))] or [[path]]:
        yield _with_lineage(spark.read.schema(rows.schema).parquet(*part)).drop("row_key")
    drop_folder(spark, path)


def raw_feed(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """The feed as text with unreadable values and undeclared fields."""
    return _query(spark, RAW_SQL[dataset.name], **{dataset.bronze_table: _unstored(spark, sf_dir, dataset).drop(*_ADDED)})


def clean_text_feed(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    columns = [F.col(c).cast("string").alias(c) for c in dataset.columns]
    return _unstored(spark, sf_dir, dataset).select(*columns, "source_format", "row_key")


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, feed_sql.CONTROL, bronze_staff=keyed_feed(spark, sf_dir, STAFF))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, feed_sql.LANDED_FILES)


def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, feed_sql.EXPECTED_FILES)


def write_csv(rows: DataFrame, path: str, mode: str = "error", compression: str = "none") -> str:
    with shuffles_freed(rows.sparkSession):
        (
            rows.write.mode(mode).option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("compression", compression)
            .csv(path)
        )
    return path


def write_json_documents(rows: DataFrame, key: str, columns: Sequence[str], path: str, compression: str = "none") -> str:
    """Write one JSON array per file, each of about ``ROWS_PER_DOCUMENT`` rows."""
    return _write_documents(rows, key, columns, path, "[\n", ",\n", "\n]", compression)


def write_json_lines(rows: DataFrame, key: str, columns: Sequence[str], path: str) -> str:
    """Write files of one JSON object per line, each after an object that was not finished."""
    return _write_documents(rows, key, columns, path, '{"unfinished": }\n', "\n", "\n")


def _write_documents(
    rows: DataFrame, key: str, columns: Sequence[str], path: str, start: str, between: str, end: str, compression: str = "none"
) -> str:
    lines = rows.select(key, F.to_json(F.struct(*columns)).alias("_line"))
    return write_json_texts(lines, path, start, between, end, compression)


def write_json_texts(lines: DataFrame, path: str, start: str, between: str, end: str, compression: str = "none") -> str:
    """Write files that hold the texts ``_line`` of some rows between the given texts.

    Rows are dealt to documents by a hash of their other column, a unique key, so documents are alike in
    size and a task that runs again deals its rows the same way.
    """
    key = next(c for c in lines.columns if c != "_line")
    with shuffles_freed(lines.sparkSession):
        documents = max(1, ceil(lines.count() / ROWS_PER_DOCUMENT))
        dealt = lines.select(F.pmod(F.xxhash64(key), F.lit(documents)).alias("_document"), "_line")
        body = F.concat(F.lit(start), F.array_join(F.collect_list("_line"), between), F.lit(end))
        texts = dealt.groupBy("_document").agg(body.alias("value")).select("value")
        texts.write.option("maxRecordsPerFile", 1).option("compression", compression).text(path)
    return path


def land(rows: DataFrame, columns: Sequence[str], root: str, feed: str, compression: str = "none") -> dict[str, str]:
    """Write feed rows to ``root/feed/csv`` and ``root/feed/json`` by their source format."""
    of_format = {f: rows.filter(F.col("source_format") == f) for f in ("csv", "json")}
    # JSON first: its texts are shuffled, which takes the most disk while there are no CSV files yet.
    return {
        "json_path": write_json_documents(of_format["json"], "row_key", columns, f"{root}/{feed}/json", compression),
        "csv_path": write_csv(of_format["csv"].select(*columns), f"{root}/{feed}/csv", compression=compression),
    }
