"""Removal of byte strings that also start elsewhere, by a depth-limited radix sort of suffixes.

Suffixes are told apart only through their first ``width`` bytes, most significant digit
first, and a suffix that is alone in its group is dropped at once:

1. The first digit is the hash of the suffix's anchor (see ``windows``). Runs of neighbouring
   suffixes share one, so this pass counts runs, not bytes. A fixed-size filter of the hashes
   that occur twice lets the next pass write only runs that may repeat.
2. The second digit is the whole text that a run's windows cover. If that repeats, each of the
   run's windows does.
3. What is left are runs whose anchor repeats in differing surroundings. One run for each
   differing surrounding is sorted further, digit by digit. Surroundings of one anchor are few
   as a rule and are sorted in one task, up to ``GROUP`` of them. Those of an anchor with more
   are sorted over all tasks, in two digits: what ``PART`` neighbouring windows cover, then
   single windows of the covers that differ but share their core.

Texts are moved once, to meet the ranges that go; until then they are only scanned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import KEY, filter_of, in_filter, row_key, staged, text_buffer
from lakeward.llm.windows import digests, runs

WIDTH = 200
GROUP = 2048
DIGIT = 40
PART = 12

_RUN = "_a bigint, _b int, v bigint, u1 bigint, u2 bigint, first bigint, last bigint"
_CUT = "_a bigint, _b int, v bigint, first bigint, place bigint, cut binary"
_RANGE = "_a bigint, _b int, first bigint, last bigint"
_WINDOW = "w1 bigint, w2 bigint, _a bigint, _b int, first bigint"
_PART = "w1 bigint, w2 bigint, core bigint, _a bigint, _b int, first bigint, last bigint, cut binary"
_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"

Batches = Iterator[pa.RecordBatch]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _anchor_counts(width: int):
    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            for anchor, _, _, _ in runs(*text_buffer(batch["text"]), width):
                yield _batch("v bigint, n bigint", *np.unique(anchor, return_counts=True))

    return mapped


def _placed_runs(batch: pa.RecordBatch, width: int):
    """Runs of a batch with the keys of their texts, and where in its text each begins."""
    data, bounds = text_buffer(batch["text"])
    a, b = (batch[k].to_numpy() for k in KEY)
    for anchor, place, first, last in runs(data, bounds, width):
        text = np.searchsorted(bounds, first, "right") - 1
        yield memoryview(data), a[text], b[text], bounds[text], anchor, place, first, last


def _repeating_runs(width: int, anchors):
    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            for view, a, b, start, anchor, _, first, last in _placed_runs(batch, width):
                hit = np.flatnonzero(in_filter(anchors.value, anchor))
                first, last, start = first[hit], last[hit], start[hit]
                u = digests(view, first.tolist(), (last + width).tolist())
                yield _batch(_RUN, a[hit], b[hit], anchor[hit], u[:, 0], u[:, 1], first - start, last - start)

    return mapped


def _cuts(width: int, places):
    """The bytes under the runs whose place is in the filter. A false hit adds a true run, which does no harm."""

    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            for view, a, b, start, anchor, place, first, last in _placed_runs(batch, width):
                hit = np.flatnonzero(in_filter(places.value, a ^ (first - start)))
                first, last = first[hit], last[hit]
                cut = [bytes(view[i : j + width]) for i, j in zip(first.tolist(), last.tolist())]
                yield _batch(
                    _CUT, a[hit], b[hit], anchor[hit], first - start[hit], place[hit] - first, pa.array(cut, pa.binary())
                )

    return mapped


def repeated_starts(cuts: list[bytes], places: list[int], width: int = WIDTH) -> list[list[int]]:
    """For each cut, the starts of the windows that also start elsewhere in ``cuts``.

    Windows are parted by the offset of their anchor, then by ``DIGIT`` bytes at a time; a
    part with one window is dropped.
    """
    by_offset = defaultdict(list)
    for i, cut in enumerate(cuts):
        for start in range(len(cut) - width + 1):
            by_offset[places[i] - start].append((i, start))
    parts = [part for part in by_offset.values() if len(part) > 1]
    for depth in range(0, width, DIGIT):
        end = min(depth + DIGIT, width)
        finer = []
        for part in parts:
            digits = defaultdict(list)
            for i, start in part:
                digits[cuts[i][start + depth : start + end]].append((i, start))
            finer += [p for p in digits.values() if len(p) > 1]
        parts = finer
    found: list[list[int]] = [[] for _ in cuts]
    for part in parts:
        for i, start in part:
            found[i].append(start)
    return found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open ranges in order, with those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _sorted_groups(width: int):
    """Rows come sorted by anchor; a group is sorted further as soon as it is whole."""

    def finish(group: list[tuple]) -> pa.RecordBatch:
        starts = repeated_starts([g[3] for g in group], [g[4] for g in group], width)
        rows = [
            (a, b, first + start, first + end - 1)
            for (a, b, first, _, _), own in zip(group, starts)
            for start, end in merged([(s, s + 1) for s in own])
        ]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return _batch(_RANGE, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types)))

    def mapped(batches: Batches) -> Batches:
        group, anchor = [], None
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("v", "_a", "_b", "first", "cut", "place")]
            for v, *row in zip(*columns):
                if v != anchor and group:
                    yield finish(group)
                    group = []
                anchor = v
                group.append(row)
        if group:
            yield finish(group)

    return mapped


def _parts(width: int):
    """Cuts in parts of ``PART`` windows with neighbouring anchor offsets, the same offsets in every cut.

    w1, w2 digest all that the windows of a part cover, core what they all share.
    """

    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            for a, b, first, place, cut in zip(*(batch[c].to_pylist() for c in ("_a", "_b", "first", "place", "cut"))):
                most = len(cut) - width
                lows, highs, cores = [], [], []
                for part in range((place - most) // PART, place // PART + 1):
                    low, high = place - part * PART - PART + 1, place - part * PART
                    lows.append(max(low, 0))
                    highs.append(min(high, most))
                    cores.append(cut[high : low + width])
                w = digests(memoryview(cut), lows, [h + width for h in highs])
                core = digests(memoryview(b"".join(cores)), *_bounds(cores))[:, 0]
                n = len(lows)
                held = pa.array([cut[i : j + width] for i, j in zip(lows, highs)], pa.binary())
                ends = (np.array(x) + first for x in (lows, highs))
                yield _batch(_PART, w[:, 0], w[:, 1], core, np.full(n, a, np.int64), np.full(n, b, np.int32), *ends, held)

    return mapped


def _bounds(pieces: list[bytes]) -> tuple[list[int], list[int]]:
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return [0, *ends[:-1]], ends


def _window_digests(width: int):
    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            for a, b, first, cut in zip(*(batch[c].to_pylist() for c in ("_a", "_b", "first", "cut"))):
                starts = range(len(cut) - width + 1)
                w = digests(memoryview(cut), list(starts), [s + width for s in starts])
                n = len(w)
                yield _batch(_WINDOW, w[:, 0], w[:, 1], np.full(n, a, np.int64), np.full(n, b, np.int32), first + np.arange(n))

    return mapped


def _cut_out(width: int):
    def mapped(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for doc_id, text, ranges in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "ranges"))):
                data = (text or "").encode()
                spans = merged([(r["first"], r["last"] + width) for r in ranges or ()])
                edges = [0, *(e for span in spans for e in span), len(data)]
                kept = b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(data), len(data) - len(kept), [dict(zip(("start", "end"), s)) for s in spans], kept))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            types = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return mapped


def remove_repeated_strings(docs: DataFrame, width: int = WIDTH, group: int = GROUP) -> DataFrame:
    """Each row's text without the bytes covered by a ``width``-byte string that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, spans (removed byte ranges, half-open, maximal) and kept
    (bytes; a cut may split a character). A null text is an empty one. Texts shorter than
    ``width`` are kept whole. Rows that repeat, or share or lack a doc_id, are texts like any
    other: a text that stands in two rows goes from both. Other columns are not read. ``group``
    only decides where the third pass works, not what it finds.
    """
    spark = docs.sparkSession
    texts = docs.select(*row_key("doc_id", "text"), "doc_id", "text")
    keyed = texts.select(*KEY, "text").where(F.octet_length("text") >= width)

    counts = keyed.select("text").mapInArrow(_anchor_counts(width), "v bigint, n bigint")
    twice = counts.groupBy("v").agg(F.sum("n").alias("n")).where("n > 1")
    anchors = spark.sparkContext.broadcast(filter_of(twice, "v"))
    runs_ = staged(keyed.mapInArrow(_repeating_runs(width, anchors), _RUN), "suffix-runs")

    covers = runs_.groupBy("v", "u1", "u2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("_a").bitwiseXOR(F.col("first"))).alias("place")
    )
    mixed = covers.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    places = spark.sparkContext.broadcast(filter_of(covers.join(mixed, "v", "left_semi"), "place"))
    cuts = staged(keyed.mapInArrow(_cuts(width, places), _CUT).join(mixed, "v"), "suffix-cuts")

    repeated = covers.where("n > 1").select("v", "u1", "u2")
    whole = runs_.join(repeated, ["v", "u1", "u2"], "left_semi").select(*KEY, "first", "last")
    few = cuts.where(F.col("m") <= group).repartition("v").sortWithinPartitions("v").mapInArrow(_sorted_groups(width), _RANGE)
    parts = staged(cuts.where(F.col("m") > group).mapInArrow(_parts(width), _PART), "suffix-parts")
    same = parts.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alike = parts.join(same, ["w1", "w2"], "left_semi").select(*KEY, "first", "last")
    # One of each cover whose core stands in another cover too is sorted to its windows.
    covering = parts.dropDuplicates(["w1", "w2"])
    shared = parts.groupBy("core").agg(F.min("w1").alias("low"), F.max("w1").alias("high")).where("low <> high")
    mixed_parts = staged(covering.join(shared, "core", "left_semi").select(*KEY, "first", "cut"), "suffix-parts")
    windows = mixed_parts.mapInArrow(_window_digests(width), _WINDOW)
    again = windows.groupBy("w1", "w2").count().where("count > 1")
    many = windows.join(again, ["w1", "w2"], "left_semi").select(*KEY, "first", F.col("first").alias("last"))

    ranges = whole.unionByName(few).unionByName(alike).unionByName(many).groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    return texts.join(ranges, KEY, "left").select("doc_id", "text", "ranges").mapInArrow(_cut_out(width), _RESULT)
