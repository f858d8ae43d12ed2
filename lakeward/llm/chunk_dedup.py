"""Exact deduplication by content-defined chunk recipes.

A text, its white space normalised, is cut where a rolling hash of its own bytes says so. A chunk is
named by a digest, and the names are verified: every distinct chunk crosses the network once, beside
its name, and a name that stands for two contents makes all chunks be named anew by longer digests.
A text is then the ordered list of its chunks' names, its recipe; only recipes are compared, so a
long text never moves as a whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import hot_and_cold, sliced, staged, text_buffer

# A chunk ends after a byte whose rolling hash has CUT_BITS leading zeros, one in 2**CUT_BITS.
CUT_BITS = 10
LEAST_BYTES, MOST_BYTES = 256, 8192
DIGEST_BYTES, LONGEST_DIGEST = 16, 64
COPIES_PER_GROUP = 100_000
# Text a task works on at once; the arrays for it take some 40 times as much.
BYTES_AT_ONCE = 1 << 21

_WINDOW = 32  # bytes the rolling hash depends on
_GEAR = np.random.default_rng(20240607).integers(0, 1 << 32, 256, dtype=np.uint32)
_RECIPE = "doc_id bigint, recipe binary, text_digest binary"
_CHUNK = "name binary, chunk binary"


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of the texts with each run of space and the controls 9 to 13 as one space."""
    data, bounds = text_buffer(column)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    follows = np.zeros(len(data), bool)
    follows[1:] = blank[:-1]
    follows[bounds[:-1][bounds[:-1] < len(data)]] = False
    kept = ~(blank & follows)
    places = np.concatenate([[0], np.cumsum(kept)])
    return np.where(blank, np.uint8(32), data)[kept], places[bounds]


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> Iterator[list[int]]:
    """Where the chunks of each text end. A cut depends on the 32 bytes before it, all of the same chunk."""
    rolling = _GEAR[data]
    step = 1
    while step < _WINDOW:
        rolling[step:] += rolling[:-step] << np.uint32(step)
        step *= 2
    cuts = (np.flatnonzero(rolling >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        ends = []
        while end - start > LEAST_BYTES:
            last = min(start + MOST_BYTES, end)
            at = bisect_left(cuts, start + LEAST_BYTES)
            start = cuts[at] if at < len(cuts) and cuts[at] < last else last
            ends.append(start)
        if end > start:
            ends.append(end)
        yield ends


def _name(chunk: bytes, size: int) -> bytes:
    return blake2b(chunk, digest_size=size).digest()


def _recipes(size: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BYTES_AT_ONCE):
            data, bounds = normalised(batch["text"])
            view = memoryview(np.ascontiguousarray(data))
            recipes, digests = [], []
            for start, end, ends in zip(bounds[:-1].tolist(), bounds[1:].tolist(), chunk_ends(data, bounds)):
                recipes.append(b"".join(_name(view[a:b], size) for a, b in zip([start, *ends], ends)))
                digests.append(sha256(view[start:end]).digest())
            columns = [batch["doc_id"].cast(pa.int64()), pa.array(recipes, pa.binary()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "recipe", "text_digest"])

    return mapped


def _chunks(size: int):
    """Names and contents of the chunks, each once per run of texts."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BYTES_AT_ONCE):
            data, bounds = normalised(batch["text"])
            view = memoryview(np.ascontiguousarray(data))
            found = set()
            for start, ends in zip(bounds[:-1].tolist(), chunk_ends(data, bounds)):
                found.update(bytes(view[a:b]) for a, b in zip([start, *ends], ends))
            contents = sorted(found)
            for at in range(0, len(contents), 2048):
                part = contents[at : at + 2048]
                names = pa.array([_name(c, size) for c in part], pa.binary())
                yield pa.RecordBatch.from_arrays([names, pa.array(part, pa.binary())], ["name", "chunk"])

    return mapped


def verified_recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, recipe and text_digest of every row; equal recipes mean equal texts, byte by byte.

    Distinct chunks are combined before the shuffle, so a chunk that a third of all texts hold
    brings one row per map task. The names are made longer until each has a single content.
    """
    size = digest_bytes
    while True:
        contents = docs.select("text").mapInArrow(_chunks(size), _CHUNK).groupBy("name", "chunk").agg(F.count(F.lit(1)).alias("n"))
        clashes = contents.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if clashes.isEmpty():
            return docs.select("doc_id", "text").mapInArrow(_recipes(size), _RECIPE)
        if size == LONGEST_DIGEST:
            raise ValueError("two chunks share the longest digest")
        size = min(2 * size, LONGEST_DIGEST)


def exact_duplicates(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after normalising white space; a null text is empty. Of equal texts
    the row with the smallest doc_id stays, null last: keep_id is null only if all of them lack
    an id. If several rows have that id, one of them stays. Texts may be empty (all equal) or very
    long. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    recipes = verified_recipes(docs, digest_bytes)
    counted = staged(recipes.groupBy("recipe", "text_digest", "doc_id").agg(F.count(F.lit(1)).alias("copies")), "recipes")
    groups = counted.groupBy("recipe").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("rows")
    )
    groups = staged(groups.where("group_size > 1"), "groups")
    hot, cold = hot_and_cold(groups.drop("rows"), "group_size")
    # A hot text's rows stay where they are; many copies of one row are dealt out below.
    starts = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(COPIES_PER_GROUP).cast("bigint")))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded = counted.join(hot, "recipe").withColumn("start", starts).repartition(tasks, "text_digest", "doc_id", "start")
    others = counted.join(hot, "recipe", "left_anti").join(cold, "recipe", "left").withColumn("start", starts)
    rows = crowded.unionByName(others)
    last = F.least(F.col("copies"), F.col("start") + (COPIES_PER_GROUP - 1))
    rows = rows.withColumn("copy", F.explode(F.sequence("start", last)))
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("text_digest")).alias("text_sha256"),
    )
