"""Phrase collocations by direct-address tiling of pairs of frequency-ranked ids.

Texts are cut into pieces and words, and stored once as blocks of id streams per language. A block's
distinct words are counted over all blocks; the frequent ones are ranked by frequency, and the blocks
that hold them learn their ranks. Neighbouring ranks of a stream fall into tiles of TILE x TILE pairs: a
tile that a block fills well is counted by one bincount over its addresses, what lies in thin tiles by
sorting. Longer phrases are rows of a block's pairs, counted the same way.

Only a language's best phrases are wanted, so a floor of their score spares most longer ones. Let a phrase
of count a reach the floor s (as a share: a / (l + r) >= s at every cut). Cut after its first word, r >= a, so
its first word is at most a * (1 - s) / s times there, and so for its last word. The pair at either end, which
stands there a times or more, thus has at least s / (1 - s) of its outer word's occurrences; and what a
longer phrase needs to cover one that reaches the floor is COVERED_PERCENT of that, of the word it adds to.
Pairs with so large a share of their rarer word are useful; a phrase is counted if its first and its last pair are, or
if a longer one needs its count. Every counted phrase is counted in all texts. The floor is guessed from the
scores of pairs and verified: a language with too few phrases above it is done again with a lower one, at last with none.

Nothing but counts, ranks and the streams, four bytes a word, is shuffled, and no vocabulary is held by
one task or the driver. To Spark a block's pairs are one packed value, and rows only where they are counted, some at a
time: as arrays a block's hundreds of thousands of pairs would be as many objects at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import discard, filter_of, hot_and_cold, in_filter, staged
from lakeward.llm.shingles import mix

LEAST_COUNT = 30
LONGEST = 4
PER_LANGUAGE = 2000
# A phrase goes if a longer one that holds it has at least so many of 100 of its occurrences.
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
# The first floor is the score of the pair at so many times the wanted number, then of a later one, then none.
FLOOR_PAIRS = (1.5, 6, None)
NO_LANGUAGE = "und"

# Words per block of a language, and of all that a task holds; a block ends with a document.
BLOCK_WORDS, HELD_WORDS = 1 << 20, 1 << 22
BATCH_CHARS = 1 << 21
TILE = 512
# A tile with at least one pair for so many addresses is counted directly.
DENSE = 16
# Counted rows that a task hands to Spark at once.
ROWS_AT_ONCE = 1 << 16

# A-Z in lower case, tab as space, and the ends of pieces as a byte no UTF-8 text has.
_BREAK = b"\xff"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS,
    b"abcdefghijklmnopqrstuvwxyz " + _BREAK * len(_ENDS),
)

_WORDS = "block bigint, lang string, words array<string>, counts array<bigint>, stream binary"
_PAIRS = "pairs binary, stream binary"


def words_of(text: str) -> list[bytes]:
    """Lower-cased words of a text; _BREAK stands between pieces."""
    return text.encode().translate(_BYTES).replace(_BREAK, b" \xff ").split()


def _packed(numbers: np.ndarray) -> pa.Array:
    return pa.array([zstandard.compress(numbers, 1)], pa.binary())


def _unpacked(stream: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(stream.as_buffer()), np.int32)


def _unpacked_pairs(pairs: pa.Scalar) -> np.ndarray:
    """Left ranks, right ranks and counts."""
    return np.frombuffer(zstandard.decompress(pairs.as_buffer()), np.int64).reshape(3, -1)


def _rows(arrays: Sequence[np.ndarray], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(arrays[0]), ROWS_AT_ONCE):
        yield pa.RecordBatch.from_arrays([pa.array(a[start : start + ROWS_AT_ONCE]) for a in arrays], names)


def _number() -> Iterator[int]:
    number = TaskContext.get().partitionId() << 32
    while True:
        number += 1
        yield number


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = _number()
    held: dict[str, list[pa.DictionaryArray]] = {}
    waiting: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    chars = 0

    def number_waiting() -> None:
        for lang, texts in waiting.items():
            # Words are numbered as they come, and first comes the break between pieces.
            words = pa.array(words_of("\n".join(["", *texts, ""])), pa.binary())
            held.setdefault(lang, []).append(words.dictionary_encode())
            sizes[lang] = sizes.get(lang, 0) + len(words)
        waiting.clear()

    def block(lang: str) -> Iterator[pa.RecordBatch]:
        parts = pa.chunked_array(held.pop(lang)).unify_dictionaries().chunks
        del sizes[lang]
        stream = np.concatenate([part.indices.to_numpy() for part in parts])
        words = parts[-1].dictionary[1:].cast(pa.string())
        counts = np.bincount(stream, minlength=len(words) + 1)[1:]
        if len(words):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers)]), pa.array([lang]),
                    *(pa.ListArray.from_arrays([0, len(words)], values) for values in (words, pa.array(counts))), _packed(stream),
                ],
                [f.split()[0] for f in _WORDS.split(", ")],
            )

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            waiting.setdefault(lang, []).append(text)
            chars += len(text) + 1
            if chars >= BATCH_CHARS:
                number_waiting()
                chars = 0
                full = sum(sizes.values()) >= HELD_WORDS
                for known in [lang for lang, n in sizes.items() if full or n >= BLOCK_WORDS]:
                    yield from block(known)
    number_waiting()
    for lang in list(held):
        yield from block(lang)
    # The worker lives on beside later steps; what Arrow keeps for it would count there.
    pa.default_memory_pool().release_unused()


def tiled_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ranks: their left and right ranks, counts, and each given pair's place among them."""
    place = np.empty(len(left), np.int32)
    lefts, rights, counts = [], [], []
    held = 0
    # Ranks below 2**40 have tile numbers below 2**31.
    tiles = left.astype(np.int64) // TILE << 31
    tiles |= right // TILE
    order = np.argsort(tiles, kind="stable")
    tiles = tiles[order]
    changes = np.flatnonzero(tiles[1:] != tiles[:-1]) + 1
    del tiles
    bounds = np.concatenate([[0], changes, [len(left)]]) if len(left) else np.zeros(1, np.int64)
    dense = np.diff(bounds) >= TILE * TILE // DENSE
    for start, end in zip(bounds[:-1][dense].tolist(), bounds[1:][dense].tolist()):
        rows = order[start:end]
        address = left[rows] % TILE * TILE + right[rows] % TILE
        counted = np.bincount(address, minlength=TILE * TILE)
        used = np.flatnonzero(counted)
        among = np.empty(TILE * TILE, np.int32)
        among[used] = np.arange(held, held + len(used))
        place[rows] = among[address]
        lefts.append(left[rows[0]] // TILE * TILE + used // TILE)
        rights.append(right[rows[0]] // TILE * TILE + used % TILE)
        counts.append(counted[used])
        held += len(used)
    rows = order[~np.repeat(dense, np.diff(bounds))]
    del order
    if len(rows):
        rows = rows[np.lexsort((right[rows], left[rows]))]
        new = np.zeros(len(rows), bool)
        new[0] = True
        for ranks in (left[rows], right[rows]):
            new[1:] |= ranks[1:] != ranks[:-1]
        starts = np.flatnonzero(new)
        lefts.append(left[rows[starts]])
        rights.append(right[rows[starts]])
        counts.append(np.diff(np.append(starts, len(rows))))
        place[rows] = np.cumsum(new, dtype=np.int32) + np.int32(held - 1)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(lefts or none), np.concatenate(rights or none), np.concatenate(counts or none), place


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams of local symbols and the ranks of the frequent ones, to the pairs of neighbours that both have a rank."""
    for batch in batches:
        for i in range(len(batch)):
            stream = _unpacked(batch["stream"][i])
            known = batch["known"][i].values
            rank = known.field("rank").to_numpy()
            # A symbol without a rank ends the phrases around it.
            ranks = np.full(int(stream.max(initial=0)) + 1, -1, np.int32 if rank.max(initial=0) < 1 << 31 else np.int64)
            ranks[known.field("place").to_numpy()] = rank
            symbols = ranks[stream]
            del stream
            paired = (symbols[:-1] >= 0) & (symbols[1:] >= 0)
            left, right = symbols[:-1][paired], symbols[1:][paired]
            del symbols
            if not len(left):
                continue
            *pairs, place = tiled_pairs(left, right)
            after = np.zeros(len(paired), np.int32)
            after[paired] = place + 1
            yield pa.RecordBatch.from_arrays(
                [_packed(np.concatenate(pairs, dtype=np.int64)), _packed(after)], [f.split()[0] for f in _PAIRS.split(", ")]
            )


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of pairs to one row per pair of a block."""
    for batch in batches:
        for pairs in batch["pairs"]:
            yield from _rows(_unpacked_pairs(pairs), [*_ranks(2), "counts"])


def _ranked(frequent: DataFrame, label: str) -> DataFrame:
    """The rows with ``rank``, their place by lang, falling count and phrase: sorted by range, numbered per partition."""
    order = [F.col("lang"), F.col("f").desc(), F.col("phrase")]
    placed = frequent.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(placed, label).withColumn("_part", F.shiftright("_at", 33))
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return staged(placed.join(F.broadcast(starts), "_part").withColumn("rank", rank).drop("_at", "_part", "_start"), label)


def _ranks(length: int, first: int = 1) -> list[str]:
    """The columns that hold the ranks of a phrase's words."""
    return [f"w{i}" for i in range(first, first + length)]


def _schema(length: int) -> str:
    return ", ".join(f"{c} bigint" for c in (*_ranks(length), "counts"))


def _slot(*ranks: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = ranks[0].astype(np.uint64)
        for rank in ranks[1:]:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rank.astype(np.uint64))
    return h.view(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_slot(*(c.to_numpy() for c in batch.columns)))], ["slot"])


def _filter(phrases: DataFrame) -> np.ndarray:
    """A filter of phrases given as ranks. It only spares rows: what it lets through wrongly is counted in all texts too."""
    return filter_of(phrases.mapInArrow(_slots, "slot bigint"), "slot", phrases.count())


def _phrases(length: int, useful: np.ndarray, frequent: np.ndarray, wanted: np.ndarray | None):
    """Blocks of pairs to counts of the phrases of ``length`` words whose first and last pair are useful, or that are wanted."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                left, right, _ = _unpacked_pairs(batch["pairs"][i])
                stream = _unpacked(batch["stream"][i])
                slots = _slot(left, right)
                # 0 in the stream is no pair.
                outer, inner = (np.concatenate([[False], in_filter(bits, slots)])[stream] for bits in (useful, frequent))
                n = len(stream) - (length - 2)
                if n < 1:
                    continue
                whole = inner[:n].copy()
                for k in range(1, length - 1):
                    whole &= inner[k : k + n]
                at = np.flatnonzero(whole)
                hit = outer[at] & outer[at + length - 2]
                if wanted is not None:
                    rest = at[~hit]
                    words = [left[stream[rest] - 1], *(right[stream[rest + k] - 1] for k in range(length - 1))]
                    hit[~hit] = in_filter(wanted, _slot(*words))
                at = at[hit]
                if not len(at):
                    continue
                place = stream[at]
                for k in range(1, length - 1):
                    *_, counts, place = tiled_pairs(place, stream[at + k])
                # Any occurrence of each phrase names its words.
                one = np.empty(len(counts), np.int64)
                one[place] = at
                words = [left[stream[one] - 1], *(right[stream[one + k] - 1] for k in range(length - 1))]
                yield from _rows([*words, counts], [*_ranks(length), "counts"])

    return mapped


def _told(blocks: DataFrame, asked: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """The blocks' streams with ``known``: place and rank of their symbols that ``table`` has."""
    hot, cold = hot_and_cold(table.select(*keys, "rank", "f"), "f")
    hot, cold = hot.drop("f"), cold.drop("f")
    asked = asked.select("block", "place", *keys)
    found = asked.join(hot, keys).unionByName(asked.join(hot, keys, "left_anti").join(cold, keys))
    known = found.groupBy("block").agg(F.collect_list(F.struct("place", "rank")).alias("known"))
    return blocks.select("block", "lang", "stream").join(known, "block")


def _symbols(blocks: DataFrame) -> DataFrame:
    """One row per block and distinct word; ``place`` is its number in the stream, from 1."""
    each = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "s")
    return blocks.select("block", "lang", each).select("block", "lang", (F.col("place") + 1).alias("place"), F.col("s.words").alias("phrase"), "s.counts")


def _frequent(counts: DataFrame, length: int, least: int) -> DataFrame:
    return counts.groupBy(*_ranks(length)).agg(F.sum("counts").alias("f")).where(F.col("f") >= least)


def _parts(table: DataFrame, length: int, *columns: str) -> DataFrame:
    """The beginnings and the ends of phrases, one word shorter than they are."""
    ends = [F.col(w).alias(k) for w, k in zip(_ranks(length - 1, 2), _ranks(length - 1))]
    return table.select(*_ranks(length - 1), *columns).unionByName(table.select(*ends, *columns))


def _decimal(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def _phrased(counted: DataFrame, table: DataFrame, length: int) -> DataFrame:
    """Counted phrases with their words, the counts of all their beginnings and ends, longest last, and the
    lowest-scoring cut; ``table`` has the phrases of one word less. Decimals hold what 64 bits cannot."""
    shorter, later = _ranks(length - 1), _ranks(length - 1, 2)
    x = table.select(*shorter, "lang", F.col("phrase").alias("_x"), F.col("firsts").alias("_firsts"))
    y = table.select(*(F.col(w).alias(k) for w, k in zip(shorter, later)), F.col("phrase").alias("_y"), F.col("lasts").alias("_lasts"))
    cuts = []
    for k in range(1, length):
        left, right = F.col("_firsts")[k - 1], F.col("_lasts")[length - k - 1]
        whole = _decimal("f") * F.lit(SCORE_SCALE).cast("decimal(10,0)")
        score = F.call_function("div", whole, _decimal(left) + _decimal(right))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    own = F.array("f")
    return counted.join(x, shorter).join(y, later).select(
        "lang", *_ranks(length), "f",
        F.concat("_x", F.lit(" "), F.substring_index("_y", " ", -1)).alias("phrase"),
        F.concat("_firsts", own).alias("firsts"), F.concat("_lasts", own).alias("lasts"),
        F.array_min(F.array(*cuts)).alias("cut"),
    )


def _floors(pairs: DataFrame, number: int | None) -> DataFrame:
    """lang and floor: the score of the pair at place ``number``; 0 if the language has fewer pairs."""
    if number is None:
        return pairs.select("lang", F.lit(0).cast("bigint").alias("floor")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
    first = pairs.select("lang", F.col("cut.score").alias("score")).withColumn("_place", place).where(F.col("_place") <= number)
    floor = F.when(F.count(F.lit(1)) < number, 0).otherwise(F.min("score"))
    return first.groupBy("lang").agg(floor.alias("floor"))


def _useful(pairs: DataFrame, floors: DataFrame) -> DataFrame:
    """The pairs that may begin or end a phrase above its language's floor, or one that covers such a phrase."""
    rarer = F.least(F.col("firsts")[0], F.col("lasts")[0]).cast("double")
    share = F.col("floor") / (SCORE_SCALE - F.col("floor")) * (COVERED_PERCENT / 100)
    # Slightly less than that, for rounding: a pair too many is only counted in vain.
    return pairs.join(floors, "lang").where(F.col("f").cast("double") >= rarer * share * (1 - 1e-9)).select("w1", "w2")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's highest-scoring phrases of 2 to 4 words.

    A-Z count as lower case; words are runs of other than space and tab within pieces, which end at
    ``.,;:!?`` and the controls 10 to 13. Everything is counted per lang (null: und) over all rows, repeated ones
    too. A phrase with a = f(phrase) >= ``least`` is cut in two parts with counts l and r where 2000000 * a / (l + r),
    rounded down, is lowest, at the first such place. It goes if a longer phrase holds it and has
    80 of 100 of its occurrences. The first ``per_language`` by score, a (both falling) and phrase (UTF-8 order) are given;
    n is the number of words of the language. Null and empty texts have no words; a text may be as
    long as a task's memory allows. Other columns are not read; an empty table gives no rows.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").where("text is not null")
    blocks = staged(texts.mapInArrow(_streams, _WORDS), "words")
    symbols = _symbols(blocks)
    words = symbols.groupBy("lang", "phrase").agg(F.sum("counts").alias("f"))
    sizes = staged(symbols.groupBy("lang").agg(F.sum("counts").alias("n")), "sizes")
    frequent = words.where(F.col("f") >= least).withColumns({"firsts": F.array("f"), "lasts": F.array("f")})
    ranked = _ranked(frequent, "ranks")
    streams = staged(_told(blocks, symbols, ranked, ["lang", "phrase"]).mapInArrow(_pairs, _PAIRS), "pairs")
    discard(blocks)
    counts = streams.select("pairs").mapInArrow(_pair_counts, _schema(2))
    pairs = staged(_phrased(_frequent(counts, 2, least), ranked.withColumnRenamed("rank", "w1"), 2), "phrases")
    inner = _filter(pairs.select(*_ranks(2)))

    done, wanted_langs = None, None
    for times in FLOOR_PAIRS:
        floors = _floors(pairs, None if times is None else int(times * per_language))
        floors = staged(floors if wanted_langs is None else floors.join(wanted_langs, "lang"), "floors")
        useful = _filter(staged(_useful(pairs, floors), "useful"))
        longer, parts = {}, None
        for length in range(LONGEST, 2, -1):
            counts = streams.mapInArrow(_phrases(length, useful, inner, parts), _schema(length))
            longer[length] = staged(_frequent(counts, length, least), "counts")
            parts = _filter(_parts(longer[length], length)) if length > 3 else None
        table, found = pairs, []
        for length in range(2, LONGEST + 1):
            left = table
            if length < LONGEST:
                table = staged(_phrased(longer[length + 1], table, length + 1), "phrases")
                # Words inside a longer phrase are inside one longer by a word that is no rarer.
                over = _parts(table, length + 1, "f").groupBy(*_ranks(length)).agg(F.max("f").alias("over"))
                covered = _decimal("over") * 100 >= _decimal("f") * COVERED_PERCENT
                left = left.join(over, _ranks(length), "left").where(~F.coalesce(covered, F.lit(False)))
            found.append(left.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
        # Below the floor not all phrases are counted.
        scored = reduce(DataFrame.unionByName, found).join(floors, "lang").where("score >= floor").drop("floor")
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
        best = staged(scored.withColumn("rank", place).where(F.col("rank") <= per_language), "best")
        held = best.groupBy("lang").agg(F.count(F.lit(1)).alias("held"))
        few = (F.col("floor") > 0) & (F.coalesce("held", F.lit(0)) < per_language)
        wanted_langs = staged(floors.join(held, "lang", "left").where(few).select("lang"), "languages")
        best = best.join(wanted_langs, "lang", "left_anti")
        done = best if done is None else done.unionByName(best)
        if wanted_langs.isEmpty():
            break
    discard(streams)
    return done.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
