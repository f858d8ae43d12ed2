"""Helpers shared by the text operators: row keys, staged tables, fixed-size filters, Arrow buffers."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.plans.scratch import drop_folder, scratch_root

# Bits of a filter: FILTER_BITS, or some 16 for each value if their number is given, within bounds. A
# fuller filter only lets more rows through to the exact step after it.
FILTER_BITS = 1 << 26
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 20, 1 << 28
_BITS_PER_ROW = 32768


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back: one evaluation, no lineage."""
    path = scratch_root(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and the shuffle files of plans that are gone.

    Spark deletes those once the driver has collected the plans; a long job asks for it between its steps.
    """
    for table in tables:
        drop_folder(table.sparkSession, table._staged_at)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


# A key with more than one in HOT_SHARE of all rows is hot; fewer than HOT_SHARE keys can be.
HOT_SHARE = 10_000


def hot_and_cold(table: DataFrame, weight: str) -> tuple[DataFrame, DataFrame]:
    """A table of keys, ``weight`` counting the rows of each, as (hot keys to broadcast, the others).

    At most HOT_SHARE keys are hot at any size of the input, so the broadcast is bounded; what joins
    the others by shuffle brings at most one in HOT_SHARE of all rows to a task for one key.
    ``table`` is read three times: stage it.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col(weight) > total // HOT_SHARE
    return F.broadcast(table.where(is_hot)), table.where(~is_hot)


def row_key(*columns: str) -> list[Column]:
    """Two columns, 96 bits, that stand for the values of ``columns``; equal rows have equal keys."""
    return [F.xxhash64(*columns).alias("_a"), F.hash(*reversed(columns)).alias("_b")]


KEY = ["_a", "_b"]


def filter_of(values: DataFrame, column: str, count: int | None = None) -> np.ndarray:
    """A bit for each value of a bigint column, at its low bits: MOST_FILTER_BITS / 8 bytes at most, whatever the input."""
    size = FILTER_BITS
    if count is not None:
        size = min(max(LEAST_FILTER_BITS, 1 << (16 * count).bit_length()), MOST_FILTER_BITS)
    slot = F.col(column).bitwiseAND(size - 1) + 1  # bitmap functions count bits from 1
    rows = (
        values.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = np.zeros(size // 8, np.uint8)
    for bucket, bits in rows.toLocalIterator():
        at = (bucket - 1) * _BITS_PER_ROW // 8
        out[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.view(np.int64) & np.int64(8 * len(bits) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after another, and their bounds. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


# Text that a task holds as Python objects at once, where nothing else bounds it.
TEXT_AT_ONCE = 1 << 21


def sliced(batches: Iterator[pa.RecordBatch], size: int = TEXT_AT_ONCE, columns: Sequence[str] = ("text",)) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows whose texts together have about ``size`` bytes; a longer row comes by itself."""
    for batch in batches:
        bounds = sum((text_buffer(batch[c])[1] for c in columns), np.int64(0))
        start = 0
        while start < len(batch):
            end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
