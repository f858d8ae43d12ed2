"""Benchmark items inside documents: MinHash containment search by size, verified on exact sets.

Items are partitioned by their number of shingles, [2**c, 2**(c+1)). For each size in use,
a document's shingles are cut into overlapping windows of twice the size's upper bound, so
that a passage as long as an item lies whole in a window of like size, however long
the document is. Item and window then have a Jaccard similarity of about 0.2 or more, and
share one of ``FUNCTIONS`` MinHash values but for one case in a million. A fixed-size filter of the items' values
keeps all others from being written. Items met are compared with the document's whole set. MinHash values are
taken only of documents that have shingles enough in common with all items together.
The whole sequence of an item of fewer than five words is its one shingle, found among a document's
sequences of as many words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import KEY, filter_of, in_filter, row_key, sliced, staged
from lakeward.llm.shingles import (
    WORDS_PER_SHINGLE,
    block_minima,
    hashes_of_runs,
    letter_tokens,
    letter_words,
    minhash,
    mix,
    shingle_hashes,
    word_hashes,
)

FUNCTIONS = 64
CONTAINMENT = 0.8


# Size classes of items of one to four words lie above those of shingle counts.
SHORT = 64
# Text whose words a task holds at once.
BYTES_AT_ONCE = 1 << 21
# Bits of the filter of the items' shingles for one of its values are some 16 times this.
SHINGLE_BITS = 8


def _width(words: list[str]) -> int:
    """Words in a shingle of an item."""
    return min(WORDS_PER_SHINGLE, len(words))


def size_class(n: int) -> int:
    return n.bit_length() - 1


def _keys(minima: np.ndarray, size: int) -> np.ndarray:
    return mix(minima + mix(np.array([size], np.uint64))).view(np.int64)


def _item_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        for i, text in enumerate(batch["text"].to_pylist()):
            words = letter_words(text or "")
            if words:
                width = _width(words)
                hashes = np.unique(shingle_hashes(words, width))
                size = size_class(len(hashes)) if width == WORDS_PER_SHINGLE else SHORT + width
                keys = _keys(hashes, size) if size > SHORT else np.unique(_keys(minhash(hashes, FUNCTIONS), size))
                at = pa.array(np.full(len(keys), i))
                columns = [batch[k].take(at) for k in ("ia", "ib")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.full(len(keys), size, np.int32)), pa.array(keys)], ["ia", "ib", "size", "key"]
                )


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each shingle in the filter of the items' shingles."""
    return hashes.view(np.int64), mix(hashes).view(np.int64)


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [np.zeros(0, np.uint64)]
        for text in batch["text"].to_pylist():
            held.append(shingle_hashes(letter_words(text or "")))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_probes(np.unique(np.concatenate(held)))))], ["value"])


def window_keys(hashes: np.ndarray, sizes: Sequence[int]) -> Iterator[np.ndarray]:
    """Keys of all windows of a document's shingles, for each size in use, in ascending order.

    Blocks double from one size to the next, so coarser minima are those of finer blocks merged.
    """
    minima, block = None, 0
    for size in sizes:
        if minima is None:
            minima = block_minima(hashes, FUNCTIONS, 2 << size)
        else:
            minima = np.minimum.reduceat(minima, np.arange(0, len(minima), (2 << size) // block))
        block = 2 << size
        yield _keys(np.minimum(minima[:-1], minima[1:]) if len(minima) > 1 else minima, size)


def _distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def _met(sizes: Sequence[int], items, shingles, least: float):
    """Documents and the items' keys they meet. What holds ``least`` of an item has that many of the items' shingles."""
    short, windowed = [s for s in sizes if s > SHORT], [s for s in sizes if s < SHORT]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BYTES_AT_ONCE):
            words = [letter_tokens(text or "") for text in batch["text"].to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
            row = np.repeat(np.arange(len(words)), np.diff(bounds))
            hashes = word_hashes(chain.from_iterable(words), len(row))
            found, rows = [], []
            for size in short:
                width = size - SHORT
                keys = _keys(hashes_of_runs(hashes, width), size)
                at = np.flatnonzero(in_filter(items.value, keys))
                at = at[row[at] == row[at + width - 1]]
                of, hits = _distinct(row[at], keys[at])
                found.append(hits)
                rows.append(of)
            if windowed:
                runs = hashes_of_runs(hashes, WORDS_PER_SHINGLE)
                first, _ = _probes(runs)
                at = np.flatnonzero(in_filter(shingles.value, first))
                at = at[row[at] == row[at + WORDS_PER_SHINGLE - 1]]
                _, second = _probes(runs[at])
                at = at[in_filter(shingles.value, second)]
                shared = np.bincount(_distinct(row[at], runs[at])[0], minlength=len(words))
                own = np.diff(bounds) >= WORDS_PER_SHINGLE
                for i in np.flatnonzero(own & (shared >= least * (1 << windowed[0]))).tolist():
                    fit = [s for s in windowed if shared[i] >= least * (1 << s)]
                    for keys in window_keys(runs[bounds[i] : bounds[i + 1] - WORDS_PER_SHINGLE + 1], fit):
                        keys = keys.ravel()
                        hits = np.unique(keys[in_filter(items.value, keys)])
                        found.append(hits)
                        rows.append(np.full(len(hits), i))
            if any(map(len, found)):
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*(batch[k].take(at) for k in KEY), pa.array(np.concatenate(found))], [*KEY, "key"])

    return mapped


def _in(places):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(places.value, batch["_a"].to_numpy())))

    return mapped


def _contained(least: float):
    """Rows come sorted by document, whose sets are kept from one to the next."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, own = None, [], {}
        for batch in sliced(batches, columns=("text", "item")):
            rows = []
            columns = ("_a", "_b", "doc_id", "text", "item_id", "item")
            for a, b, doc_id, text, item_id, item in zip(*(batch[c].to_pylist() for c in columns)):
                if (a, b) != held:
                    held, words, own = (a, b), letter_words(text or ""), {}
                wanted = letter_words(item)
                width = _width(wanted)
                if width not in own:
                    own[width] = np.unique(shingle_hashes(words, width))
                wanted = np.unique(shingle_hashes(wanted, width))
                both = len(np.intersect1d(own[width], wanted, assume_unique=True))
                if both >= least * len(wanted):
                    rows.append((a, b, doc_id, item_id, both, len(wanted)))
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _FOUND)

    return mapped


_FOUND = [*KEY, "doc_id", "item_id", "n_shared", "n_shingles"]


def contaminations(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT) -> DataFrame:
    """A row for each item (item_id, text) and document that holds at least ``least`` of the item's shingles.

    Columns: _a, _b (the document row's key), doc_id, item_id, n_shared, n_shingles, containment.
    Words are runs of letters, digits and underscores in lower case; a shingle is five words. An item
    of fewer words is one shingle, its whole sequence; items or documents without words, empty or null match nothing. The shared shingles must
    include those of one passage about as long as the item; an item whose shingles are strewn over a long
    document is no match. Equal rows are reported once; rows that share or lack an id are
    items or documents of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    keyed = docs.select(*row_key("doc_id", "text"), "doc_id", "text")
    named = benchmark.select(
        F.xxhash64("item_id", "text").alias("ia"), F.hash("text", "item_id").alias("ib"), "item_id", F.col("text").alias("item")
    ).dropDuplicates(["ia", "ib"])
    keys = staged(
        named.select("ia", "ib", F.col("item").alias("text")).mapInArrow(_item_keys, "ia bigint, ib int, size int, key bigint"), "item-keys"
    )
    # Sizes are powers of two, or below five words: at most some forty.
    sizes = sorted(r.size for r in keys.select("size").distinct().collect())
    items = spark.sparkContext.broadcast(filter_of(keys, "key"))
    held = staged(named.select(F.col("item").alias("text")).mapInArrow(_item_shingles, "value bigint"), "item-shingles")
    shingles = spark.sparkContext.broadcast(filter_of(held, "value", SHINGLE_BITS * held.count()))
    met = keyed.select(*KEY, "text").mapInArrow(_met(sizes, items, shingles, least), "_a bigint, _b int, key bigint")
    candidates = staged(met.join(keys.select("ia", "ib", "key"), "key").select(*KEY, "ia", "ib").distinct(), "candidates")

    places = spark.sparkContext.broadcast(filter_of(candidates, "_a"))
    texts = keyed.mapInArrow(_in(places), keyed.schema).dropDuplicates(KEY)
    pairs = candidates.join(named, ["ia", "ib"]).join(texts, KEY).sortWithinPartitions(*KEY)
    found = pairs.select("_a", "_b", "doc_id", "text", "item_id", "item").mapInArrow(
        _contained(least), "_a bigint, _b int, doc_id bigint, item_id bigint, n_shared bigint, n_shingles bigint"
    )
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs``, all columns, without the documents that ``contaminations`` reports."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    held = docs.select(*row_key("doc_id", "text"), row.alias("row"))
    bad = contaminations(docs, benchmark, least).select(*KEY).distinct()
    return held.join(bad, KEY, "left_anti").select("row.*")
