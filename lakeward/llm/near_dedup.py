"""Near-duplicate documents by MinHash bands, odd sketches and exact comparison of shingle sets.

1. Documents with equal shingle sets are one class.
2. A class has bands of MinHash samples, as many as ``scheme`` gives for the threshold. Classes
   that agree on all samples of a band share its bucket.
3. Each sample also flips one bit of a bitmap, its odd sketch. The bits in which two sketches
   differ estimate how many samples differ; pairs that are clearly apart are dropped.
4. The other pairs are compared on their full sets.

Within a bucket not all pairs are made. Its first member is compared with every other; the
links found make components, and members outside the first one's are still waiting.

* In a bucket with at most ``FEW`` waiting members, each of them is compared with all members
  of other components.
* The members of larger buckets are, for the most part, variants of one text that differ too
  much from each other. The frequency of each shingle among all of them sorts the links that
  can still exist into two kinds. Order the shingles of a set from rare to frequent: linked
  sets share one in the first few (as many as the sets may differ by, and one). If the rarest
  they share lies in at most ``RARE`` sets, the sets of that shingle give the pair. If not,
  they share frequent shingles only, and a member without enough of these has no such link.
  The one richest in frequent shingles is compared with the others of its bucket, then those
  still waiting with every member whose size and frequent shingles allow a link, ``CENTERS``
  members a round, until none is left.

Every pair of a bucket is then within one component, compared, or shown to have no link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import KEY, filter_of, in_filter, row_key, sliced, staged
from lakeward.llm.components import components, relabelled
from lakeward.llm.shingles import minhash, mix, shingle_set

# Samples of a band and of all bands, at most.
ROWS, SAMPLES = 5, 192
SKETCH_WORDS = 4
FEW, RARE, CENTERS = 16, 16, 64
# Probabilities to miss a pair at the threshold, at most; below 1e-6 together.
MISSED_BY_BANDS, MISSED_BY_SKETCH = 8e-7, 1.5e-7

_SKETCH = [f"k{i}" for i in range(SKETCH_WORDS)]
_SIGNED = (
    "doc_id bigint, _a bigint, _b int, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>, "
    + ", ".join(f"{k} bigint" for k in _SKETCH)
)


class Scheme(NamedTuple):
    bands: int
    rows: int  # samples of a band
    most: int  # bits in which the sketches of compared pairs differ, at most


@cache
def scheme(percent: int) -> Scheme:
    """Bands of as many samples as ``SAMPLES`` allow, and the sketch's cut, to miss no more than the probabilities above."""
    share = percent / 100
    for rows in range(ROWS, 0, -1):
        alike = share**rows
        bands = math.ceil(math.log(MISSED_BY_BANDS) / math.log1p(-alike)) if 0 < alike < 1 else 1
        if share > 0 and bands * rows <= SAMPLES:
            return Scheme(bands, rows, _cut(share, bands * rows))
    raise ValueError(f"{percent} % is too low a threshold for {SAMPLES} samples")


def _cut(share: float, samples: int) -> int:
    """The least number of bits that the sketches of a pair at the threshold exceed with ``MISSED_BY_SKETCH`` at most.

    A sample differs with probability 1 - share, and flips a bit in each sketch then.
    """
    bits = SKETCH_WORDS * 64
    odd, apart, k = np.zeros(bits + 1), np.zeros(bits + 1), np.arange(bits + 1)
    odd[0] = 1
    for differ in range(samples + 1):
        apart += math.comb(samples, differ) * (1 - share) ** differ * share ** (samples - differ) * odd
        for _ in range(2):
            up, down = odd * (bits - k) / bits, odd * k / bits
            odd = np.append(0, up[:-1]) + np.append(down[1:], 0)
    beyond = apart[::-1].cumsum()[::-1]  # of at least so many bits
    return int(np.argmax(np.append(beyond[1:], 0) <= MISSED_BY_SKETCH))


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    """One key for each band of samples; keys of different bands differ."""
    grid = samples.reshape(bands, -1)
    key = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(grid.shape[1]):
        key = mix(key + grid[:, i])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: each flips the bit that its value and place hash to."""
    bits = SKETCH_WORDS * 64
    places = mix(samples + mix(np.arange(len(samples), dtype=np.uint64))) % np.uint64(bits)
    odd = np.bincount(places.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(n_bands: int, rows: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts, sets, bands, sketches = [], [], [], []
            for text in batch["text"].to_pylist():
                hashes = shingle_set(text)
                counts.append(len(hashes))
                sets.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                samples = minhash(hashes, n_bands * rows)
                bands.append(band_keys(samples, n_bands))
                sketches.append(odd_sketch(samples))
            halves = np.frombuffer(b"".join(sets), np.int64).reshape(-1, 2)
            sketch = np.array(sketches, np.int64).reshape(-1, SKETCH_WORDS)
            offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * n_bands)
            flat = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()), batch["_a"], batch["_b"], pa.array(counts, pa.int64()),
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.ListArray.from_arrays(offsets, flat),
                    *(pa.array(sketch[:, i]) for i in range(SKETCH_WORDS)),
                ],
                [field.split()[0] for field in _SIGNED.split(", ")],
            )

    return mapped


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        for node, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist()):
            hashes = shingle_set(text).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), node, np.int64)), pa.array(hashes)], ["node", "token"])


def _in(places):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(places.value, batch["_a"].to_numpy())))

    return mapped


def _linked(percent: int):
    """Pairs whose sets share at least ``percent`` of their union. Rows come sorted by a, whose set is kept."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for batch in sliced(batches, columns=("text_a", "text_b")):
            hits = []
            for a, text_a, text_b in zip(*(batch[c].to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != held:
                    held, own = a, shingle_set(text_a)
                other = shingle_set(text_b)
                both = len(np.intersect1d(own, other, assume_unique=True))
                hits.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

    return mapped


def _alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose odd sketches don't put them far below the threshold."""
    for end in ("a", "b"):
        own = sketches.select(F.col("node").alias(end), *(F.col(k).alias(f"{k}_{end}") for k in _SKETCH))
        pairs = pairs.join(own, end)
    apart = sum((F.bit_count(F.col(f"{k}_a").bitwiseXOR(F.col(f"{k}_b"))) for k in _SKETCH), F.lit(0))
    return pairs.where(apart <= scheme(percent).most).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    for end in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")), end)
    return pairs.sortWithinPartitions("a").select("a", "b", "text_a", "text_b").mapInArrow(_linked(percent), "a bigint, b bigint")


def _sized(percent: int, n: str, m: str) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _rich(percent: int) -> Column:
    """Whether sets with n and m shingles, ``common`` and ``common_x`` of them frequent, can be linked by frequent ones."""
    return (100 + percent) * F.least("common", "common_x") >= percent * (F.col("n") + F.col("n_x"))


def _frequencies(texts: DataFrame, percent: int) -> DataFrame:
    """node, its number of frequent shingles, and the repeated rare ones among its first, rare before frequent."""
    tokens = staged(texts.mapInArrow(_tokens, "node bigint, token bigint"), "tokens")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rare = F.when(F.col("df") <= RARE, F.struct("df", "token"))
    of_node = tokens.join(counts, "token").groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("df") > RARE).alias("common"), F.sort_array(F.collect_list(rare)).alias("rare")
    )
    first = F.slice("rare", F.lit(1), F.expr(f"cast(n - ceil({percent} * n / 100) + 1 as int)"))
    repeated = F.transform(F.filter(first, lambda r: r["df"] > 1), lambda r: r["token"])
    return staged(of_node.select("node", "common", repeated.alias("first")), "frequencies")


def judged_rows(docs: DataFrame, percent: int = 85) -> DataFrame:
    """What ``near_duplicates`` says of every row, with the row's key (_a, _b) and its component's number.

    Rows are linked if they have one component; it is null in rows without shingles.
    """
    keyed = docs.select("doc_id", *row_key("doc_id", "text"), "text")
    n_bands, rows, _ = scheme(percent)
    signed = staged(keyed.mapInArrow(_sign(n_bands, rows), _SIGNED), "signed")
    shingled = signed.where("n_shingles > 0")
    classes = staged(
        shingled.drop("doc_id").dropDuplicates(["s1", "s2"]).withColumn("node", F.monotonically_increasing_id()), "classes"
    )

    entries = classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    entries = staged(entries.join(shared.select("bucket", "first"), "bucket"), "buckets")
    members = classes.join(entries.select("node").distinct(), "node", "left_semi")
    sketches = members.select("node", *_SKETCH)

    places = docs.sparkSession.sparkContext.broadcast(filter_of(members, "_a"))
    candidates = keyed.select(*KEY, "text").mapInArrow(_in(places), "_a bigint, _b int, text string")
    texts = candidates.join(members.select(*KEY, "node"), KEY).dropDuplicates(["node"]).select("node", "text")
    texts = staged(texts, "candidates")

    def compared(pairs: DataFrame) -> DataFrame:
        return staged(_verified(_alike(pairs, sketches, percent), texts, percent), "links")

    def placed(entries: DataFrame, labels: DataFrame) -> DataFrame:
        return entries.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def ordered(met: DataFrame) -> DataFrame:
        return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))

    tested = entries.where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    tested = staged(tested, "pairs")
    labels = components(compared(tested))

    now = staged(placed(entries, labels), "placed")
    main = now.where("node = first").select("bucket", F.col("component").alias("main"))
    waiting = staged(now.join(main, "bucket").where("component <> main").drop("main"), "waiting")
    open_buckets = waiting.groupBy("bucket").agg(F.count(F.lit(1)).alias("waiting"))
    open_buckets = staged(open_buckets, "open")
    x = [F.col(c).alias(f"{c}_x") for c in ("n", "component")]
    few = waiting.join(open_buckets.where(F.col("waiting") <= FEW), "bucket").select("bucket", F.col("node").alias("x"), *x)
    pairs = ordered(now.join(few, "bucket").where((F.col("component") != F.col("component_x")) & _sized(percent, "n", "n_x")))

    many = open_buckets.where(F.col("waiting") > FEW).select("bucket")
    crowded = not many.isEmpty()
    if crowded:
        entries = staged(now.join(many, "bucket", "left_semi"), "many")
        own = _frequencies(texts.join(entries.select("node").distinct(), "node", "left_semi"), percent)
        # Links whose rarest shared shingle is rare, in whatever buckets.
        nodes = entries.select("node", "n", "component").distinct()
        firsts = own.select("node", F.explode("first").alias("token")).join(nodes, "node")
        others = firsts.select("token", F.col("node").alias("x"), *x)
        kin = firsts.join(others, "token").where((F.col("x") < F.col("node")) & (F.col("component") != F.col("component_x")))
        pairs = pairs.unionByName(ordered(kin.where(_sized(percent, "n", "n_x"))))
        # Links by frequent shingles, within buckets.
        able = entries.drop("component").join(own.select("node", "common"), "node").where(100 * F.col("common") >= percent * F.col("n"))
        richest = able.groupBy("bucket").agg(F.max_by(F.struct("node", "n", "common"), F.struct(F.col("common") / F.col("n"), "node")).alias("top"))
        richest = richest.select("bucket", F.col("top.node").alias("x"), F.col("top.n").alias("n_x"), F.col("top.common").alias("common_x"))
        able = staged(able.drop("first"), "able")
        richest = staged(richest, "richest")
        star = able.join(richest, "bucket").where((F.col("x") != F.col("node")) & _rich(percent))
        pairs = pairs.unionByName(ordered(star))

    pairs = staged(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        tested = tested.unionByName(pairs)
        labels = relabelled(labels, compared(pairs))
    if crowded:
        done = richest.select("bucket", "x")
    while crowded:
        now = staged(placed(able, labels), "placed")
        main = now.join(richest, (now["bucket"] == richest["bucket"]) & (now["node"] == richest["x"])).select(now["bucket"], F.col("component").alias("main"))
        x = [F.col(c).alias(f"{c}_x") for c in ("n", "common", "component")]
        outside = now.join(main, "bucket").where("component <> main").select("bucket", F.col("node").alias("x"), *x)
        # Members with a partner by size and number of frequent shingles; they count as their own if another is like them.
        kinds = now.groupBy("bucket", "n", "common").agg(F.count(F.lit(1)).alias("alike")).alias("k")
        another = (F.col("alike") > 1) | (F.col("n") != F.col("n_x")) | (F.col("common") != F.col("common_x"))
        same = outside.alias("o").join(kinds, (F.col("o.bucket") == F.col("k.bucket")) & _rich(percent) & another, "left_semi")
        left = same.select("bucket", "x", "n_x", "common_x", "component_x").join(done, ["bucket", "x"], "left_anti")
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("x"))
        centers = staged(left.withColumn("place", place).where(F.col("place") <= CENTERS).drop("place"), "centers")
        if centers.isEmpty():
            break
        done = done.unionByName(centers.select("bucket", "x"))
        met = now.join(centers, "bucket").where((F.col("component") != F.col("component_x")) & _rich(percent))
        pairs = staged(ordered(met).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            labels = relabelled(labels, compared(pairs))

    named = shingled.select("doc_id", *KEY, "n_shingles", "s1", "s2").join(classes.select("s1", "s2", "node"), ["s1", "s2"])
    named = named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    columns = ["doc_id", *KEY, "n_shingles", "component", "component_id"]
    judged = named.join(least, "component").select(*columns)
    alone = {"component": F.lit(None).cast("bigint"), "component_id": F.col("doc_id")}
    empty = signed.where("n_shingles = 0").withColumns(alone).select(*columns)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return judged.unionByName(empty).withColumn("kept", kept)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Words are cut as in ``ascii_words``; a document's set is its distinct five-word shingles, or
    the whole sequence if it has fewer words. Documents whose intersection is at least
    ``percent`` / 100 of their union are linked. component_id is the smallest doc_id reachable
    by links, itself included, and kept tells whether it is the row's own. A null or wordless
    text has no shingles, is linked with nothing and has its own doc_id. A null doc_id is
    larger than any other: such a row is kept only if its component has no doc_id at all. Rows
    that repeat, or share a doc_id, are copies or texts like any other. Other columns are not read.

    Bands and sketches together miss a pair at the threshold with a probability below 1e-6, whatever ``percent``;
    if that is too low for it, ValueError.
    """
    return judged_rows(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")
