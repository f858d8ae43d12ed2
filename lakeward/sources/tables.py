"""Table sinks, layout on write, and creation of the declared tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from lakeward import schemas

# Hashes are hex text, of which this codec stores half and the default one all.
COMPRESSION = "zstd"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = Lock()
# By application: how many writes are under way, and the setting as it was before the first.
_writing: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, not when the driver happens to collect its garbage.

    For writes and other actions whose plan nothing runs again; several threads may be inside at once.
    """
    app = spark.sparkContext.applicationId
    with _lock:
        inside, before = _writing.get(app) or (0, spark.conf.get(_FREE_SHUFFLES, None))
        _writing[app] = inside + 1, before
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _writing.pop(app)
            if inside > 1:
                _writing[app] = inside - 1, before
            elif before is None:
                spark.conf.unset(_FREE_SHUFFLES)
            else:
                spark.conf.set(_FREE_SHUFFLES, before)


def _arranged(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Cluster rows for the write.

    The rebalance hint lets adaptive execution merge small and split large partitions, so one
    batch that holds most of the rows is still written by many tasks.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    return out.sortWithinPartitions(*partition_by, *sort_by) if sort_by else out


def write_path(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> None:
    writer = _arranged(df, partition_by, sort_by).write.mode(mode).option("compression", COMPRESSION)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Save a catalog table. Bucketing on the deduplication keys lets ``latest_by`` skip its shuffle."""
    writer = _arranged(df, partition_by, () if bucket_by else sort_by).write.mode(mode).format("parquet").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, keys = bucket_by
        writer = writer.bucketBy(count, *keys).sortBy(*(sort_by or keys))
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(name)


def saved_tables(
    tables: Mapping[str, DataFrame | Iterable[DataFrame]], database: str, partition_by: Sequence[str] = ("batch_id",)
) -> dict[str, DataFrame]:
    """Save frames as catalog tables of ``database`` and read them back by name.

    Partitioned by batch, a join to the current batch prunes their scans at run time. A table may come in
    parts, which are saved one after the other: the shuffle that deals rows to batches then holds one part.
    """
    saved = {}
    for name, frames in tables.items():
        for number, part in enumerate([frames] if isinstance(frames, DataFrame) else frames):
            write_table(part, f"{database}.{name}", "append" if number else "overwrite", partition_by)
        saved[name] = part.sparkSession.read.table(f"{database}.{name}")
    return saved


def append_rows(df: DataFrame, path: str) -> None:
    """Append to an audit or event table kept as files."""
    df.write.mode("append").parquet(path)


def append_run(df: DataFrame, path: str, run_column: str) -> None:
    """Append the rows of a run so that doing it again changes nothing: they replace what the same run wrote before.

    ``run_column`` names the run and partitions the table; partitions of other runs are not touched. A run
    that repeats without any row leaves its earlier rows.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(run_column).parquet(path)


def create_tables(spark: SparkSession, prefix: str = "", partition_by: str = "batch_id") -> list[str]:
    """Create every schema and table that does not exist yet, from the declared schemas."""
    created = []
    for layer, tables in schemas.layers().items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}")
        for table, schema in tables.items():
            name = f"{prefix}{layer}.{table}"
            layout = f" PARTITIONED BY ({partition_by})" if layer == "bronze" and table.startswith("bronze_") else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet{layout}")
            created.append(name)
    return created


def preview(df: DataFrame, order_by: Sequence[str], rows: int) -> DataFrame:
    """The first rows in a stated order; planned as a top-k, not as a full sort."""
    return df.orderBy(*order_by).limit(rows)
