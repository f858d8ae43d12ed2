"""Substring deduplication by lines or paragraphs, and by passages inside them.

Texts are cut into units; a unit is normalised and digested; digests are grouped over all texts;
the occurrence that ranks first stays, and the others are cut out of their texts, with the
offsets they had. Units are the lines (or paragraphs) and, inside longer ones, segments that end
where their own words say so: a passage that stands in two different lines has the same segments in
both. A segment goes only as part of a run of repeated words, so a phrase that two texts happen
to share stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import KEY, filter_of, in_filter, row_key, sliced, staged

LINE, PARAGRAPH = r"[^\n]*(?:\n|$)", r"(?s).+?(?:\n[ \t]*\n\s*|$)"
# Every unit with a word counts, however short.
MIN_WORDS = 1
# Units of at least so many words are also cut into segments. A segment ends after each word
# whose digest starts with one of these digits, 3 of 16, and at the end of its unit.
SEGMENTED_WORDS = 16
LAST_WORDS = "012"
# Repeated segments go where the repeated words around them, without a gap, are at least so many.
RUN_WORDS = 16

_UNIT = "d1 bigint, d2 bigint, doc_id bigint, _a bigint, _b int, start bigint, end bigint, w0 bigint, w1 bigint, whole boolean"
_WORD = re.compile(r"\S+")
_WORDS_KNOWN = 1 << 18
# Text whose units a task holds at once, and words of it that are cut at once; a line is never parted.
BYTES_AT_ONCE = 1 << 21
WORDS_AT_ONCE = 1 << 18


class _LastWords(dict):
    """Whether a segment ends after a word; words met lately are remembered."""

    def __missing__(self, word: str) -> bool:
        if len(self) >= _WORDS_KNOWN:
            self.clear()
        self[word] = last = md5(word.encode()).hexdigest()[0] in LAST_WORDS
        return last


_ends_segment = _LastWords()


def _lines(texts: list[str], pattern: re.Pattern) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The lines with words and their words, in lower case; for each line its text's number, start and end in characters,
    number of its first word in the text, how many it has, and its length without blanks at the end (-1 if lower case is longer)."""
    lines, words = [], []
    for row, text in enumerate(texts):
        before = 0
        for match in pattern.finditer(text):
            line = match.group().lower()
            own = line.split()
            if own:
                start, end = match.span()
                lines.append((row, start, end, before, len(own), len(line.rstrip()) if len(line) == end - start else -1))
                words += own
                before += len(own)
                if len(words) >= WORDS_AT_ONCE:
                    yield np.array(lines), words
                    lines, words = [], []
    if lines:
        yield np.array(lines), words


def _bounds(texts: list[str], lines: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in their texts; by their lengths in lines where single blanks part them."""
    row, start, end, _, n, length = lines.T
    first = np.cumsum(n) - n
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    ends += np.repeat(start - (ends - sizes)[first], n)
    starts = ends - sizes
    for i in np.flatnonzero(np.add.reduceat(sizes, first) + n - 1 != length).tolist():
        spans = [m.span() for m in _WORD.finditer(texts[row[i]], start[i], end[i])]
        starts[first[i] : first[i] + n[i]], ends[first[i] : first[i] + n[i]] = zip(*spans)
    return starts, ends


def units(texts: list[str], pattern: re.Pattern, min_words: int, run_words: int, bits: np.ndarray | None = None) -> Iterator[dict[str, np.ndarray]]:
    """The units of texts as arrays: digest in two halves, number of the text. Given a filter of digests, only those it lets
    through, with start and end in characters, number of the first word and of the first one after the unit, and
    whether it is a whole line (which ends with what follows it) or a segment.

    Units are alike if they have the same words in lower case, whatever the white space. There are
    no segments if ``run_words`` is 0.
    """
    for lines, words in _lines(texts, pattern):
        row, start, end, before, n, _ = lines.T
        first = np.cumsum(n) - n
        # A blank before each word: no unit begins with one, so lines and segments have digests apart.
        buffer = " ".join(["", *words]).encode()
        blanks = np.append(np.flatnonzero(np.frombuffer(buffer, np.uint8) == ord(" ")), len(buffer))
        line = np.flatnonzero(n >= max(min_words, 1))
        begin, after = first[line], first[line] + n[line]
        whole = np.ones(len(line), bool)
        if run_words:
            last = np.fromiter(map(_ends_segment.__getitem__, words), bool, len(words))
            last[first + n - 1] = True
            stops = np.flatnonzero(last) + 1
            starts = np.concatenate([[0], stops[:-1]])
            of = np.repeat(np.arange(len(n)), n)[starts]
            long = n[of] >= SEGMENTED_WORDS
            line, begin, after = (np.concatenate(v) for v in ((line, of[long]), (begin, starts[long]), (after, stops[long])))
            whole = np.arange(len(line)) < len(whole)
        pieces = zip((blanks[begin] + whole).tolist(), blanks[after].tolist())
        halves = np.frombuffer(b"".join([blake2b(buffer[a:b], digest_size=16).digest() for a, b in pieces]), np.int64).reshape(-1, 2)
        if bits is None:
            yield {"d1": halves[:, 0], "d2": halves[:, 1], "row": row[line]}
            continue
        hit = np.flatnonzero(in_filter(bits, np.ascontiguousarray(halves[:, 0])))
        line, begin, after, whole = line[hit], begin[hit], after[hit], whole[hit]
        starts, ends = _bounds(texts, lines, words)
        # A segment ends where the next word of its line begins.
        stop = np.where(after < first[line] + n[line], np.append(starts, 0)[after], ends[after - 1])
        shift = before[line] - first[line]
        yield {
            "d1": halves[hit, 0], "d2": halves[hit, 1], "row": row[line],
            "start": np.where(whole, start[line], starts[begin]), "end": np.where(whole, end[line], stop),
            "w0": begin + shift, "w1": after + shift, "whole": whole,
        }


def _found(unit: str, min_words: int, run_words: int, bits: np.ndarray | None = None):
    """Digests and doc_ids of all units; or, given a filter of digests, all columns of those it lets through."""
    pattern = re.compile(unit)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BYTES_AT_ONCE):
            for found in units(batch["text"].to_pylist(), pattern, min_words, run_words, bits):
                rows = pa.array(found.pop("row"))
                named = ("doc_id",) if bits is None else ("doc_id", *KEY)
                columns = {"d1": found.pop("d1"), "d2": found.pop("d2")} | {c: batch[c].take(rows) for c in named} | found
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))

    return mapped


def _unbroken(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges in order of row and start: which begin one apart from all before, and the furthest end so far."""
    apart = (int(end.max(initial=0)) + 2) * row
    furthest = np.maximum.accumulate(end + apart) if len(end) else end
    begins = np.ones(len(row), bool)
    begins[1:] = (start + apart)[1:] > furthest[:-1]
    return begins, furthest - apart


def _merged(run_words: int):
    """What goes of each text: whole units, and segments in runs of at least ``run_words`` repeated words."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["repeated"]
            row = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            unit = {f: lists.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("start", "end", "w0", "w1", "whole")}
            order = np.lexsort((-unit["w1"], unit["w0"], row))
            row, unit = row[order], {f: v[order] for f, v in unit.items()}
            begins, furthest = _unbroken(row, unit["w0"], unit["w1"])
            firsts = np.flatnonzero(begins)
            lasts = np.append(firsts[1:], len(row))[: len(firsts)] - 1
            enough = (furthest[lasts] - unit["w0"][firsts] >= run_words)[np.cumsum(begins) - 1]
            gone = unit["whole"] | enough
            row, start, end = row[gone], unit["start"][gone], unit["end"][gone]
            order = np.lexsort((end, start, row))
            row, start, end = row[order], start[order], end[order]
            begins, furthest = _unbroken(row, start, end)
            firsts = np.flatnonzero(begins)
            lasts = np.append(firsts[1:], len(row))[: len(firsts)] - 1
            counts = np.bincount(row[firsts], minlength=len(batch))
            spans = pa.StructArray.from_arrays([pa.array(start[firsts]), pa.array(furthest[lasts])], ["start", "end"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in KEY), pa.ListArray.from_arrays(offsets, spans)], [*KEY, "spans"])

    return mapped


def repeated_units(docs: DataFrame, unit: str = LINE, min_words: int = MIN_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """What goes: _a, _b (the row's key) and spans, an ordered array of separate (start, end) in characters.

    Occurrences rank by doc_id (null last), the row's key and place. Digests are counted first, combined before
    the shuffle, so one that a third of all texts hold is no hot key; only units whose digest may
    repeat are then joined, and adaptive execution splits that join.
    """
    keyed = docs.select(*row_key("doc_id", "text"), F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    keyed = keyed.withColumn("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    digests = keyed.mapInArrow(_found(unit, min_words, run_words), "d1 bigint, d2 bigint, doc_id bigint")
    # The first occurrence, one column at a time: plain minima are combined without sorting.
    counted = digests.groupBy("d1", "d2").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    again = staged(counted.where("n > 1").select("d1", "d2", "least_id"), "repeated")
    bits = filter_of(again, "d1", again.count())
    # Read three times below.
    repeats = staged(keyed.mapInArrow(_found(unit, min_words, run_words, bits), _UNIT).join(again, ["d1", "d2"]), "repeats")
    place = ["start", "end", "w0", "w1", "whole"]
    later = repeats.where("doc_id > least_id").select(*KEY, *place)
    # Occurrences in texts of the least doc_id: a few texts, or copies within one.
    first = F.min(F.struct("_a", "_b", "start"))
    ties = repeats.where("doc_id = least_id")
    kept = ties.groupBy("d1", "d2").agg(first.alias("kept"))
    tied = ties.join(kept, ["d1", "d2"]).where(F.struct("_a", "_b", "start") != F.col("kept")).select(*KEY, *place)
    each = later.unionByName(tied).groupBy(*KEY).agg(F.collect_set(F.struct(*place)).alias("repeated"))
    return each.mapInArrow(_merged(run_words), "_a bigint, _b int, spans array<struct<start:bigint,end:bigint>>")


def remove_repeated_units(docs: DataFrame, unit: str = LINE, min_words: int = MIN_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """Every row of ``docs`` with ``text`` cut and ``removed_spans``, the separate ranges cut from it.

    Offsets are in characters of the original text; a line goes with the line end after it, a
    segment with the blanks before the next word of its line. A null text stays null. Rows with the same doc_id and text are one text here and are cut alike:
    the unit stays in all of them or in none. Rows that share a doc_id but not the text, or lack
    one, rank by a hash of the row. A unit that repeats within a text stays at its first place.
    All columns are kept, whatever their names; one named removed_spans is replaced.
    """
    held = docs.select(*row_key("doc_id", "text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = held.join(repeated_units(docs, unit, min_words, run_words), KEY, "left")
    text = F.col("row.text")
    # Kept pieces lie between the cuts.
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.char_length(text).cast("bigint")))
    pieces = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda z: F.substr(text, (z["b"] + 1).cast("int"), (z["e"] - z["b"]).cast("int")),
    )
    cut = F.when(F.col("spans").isNull(), text).otherwise(F.array_join(pieces, ""))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    columns = [cut.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c != "removed_spans"]
    return joined.select(*columns, F.coalesce("spans", none).alias("removed_spans"))
