"""Chunk recipes, collocations and hard negatives against brute force, with odd rows."""

import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from lakeward.llm import chunk_dedup, collocations, hard_negatives

# --- exact duplicates --------------------------------------------------------------------


def brute_copies(rows):
    plain = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in rows]
    out = []
    for text in sorted({t for _, t in plain}):
        ids = sorted((i for i, t in plain if t == text), key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), n == 0, sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(map(str, out))


@pytest.mark.parametrize("digest_bytes", [1, 16])
def test_exact_duplicates_equal_brute_force(spark, digest_bytes):
    """Digests of one byte clash between these chunks; longer ones then have to tell them apart."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["lo", "är", "日本", "x1"]) + str(rng.randrange(500)) for _ in range(40_000))
    texts = ["", None, " ", "\t\n", "a b", "a  b", "a b", " a b", "a b ", "A b", long, long.replace(" ", "\n\n"), long + "!", "x" + long]
    texts += [f"text number {n // 2}" for n in range(600)]
    rows = [(n * 37 % 641, t) for n, t in enumerate(texts)]
    rows += [rows[4]] * 3 + [(None, "a b"), (None, "only without an id"), (None, "only without an id"), (-5, long), (4, "text number 7")]
    docs = spark.createDataFrame([(*r, "r", 1) for r in rows], "doc_id bigint, text string, recipe string, copies int")
    result = chunk_dedup.exact_duplicates(docs, digest_bytes)
    assert sorted(str(tuple(r)) for r in result.collect()) == brute_copies(rows)
    assert chunk_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "COPIES_PER_GROUP", 7)
    docs = spark.range(100).select(F.expr("id div 90").alias("doc_id"), F.lit("same").alias("text"))
    result = chunk_dedup.exact_duplicates(docs).groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()
    assert sorted(map(tuple, result)) == [(0, 0, 100, False, 89), (0, 0, 100, True, 1), (1, 0, 100, False, 10)]


def test_cuts_follow_content():
    rng = np.random.default_rng(3)
    body = bytes(rng.integers(33, 127, 60_000, dtype=np.uint8)).decode()
    texts = ["", "short", body, "some words before " + body, "z" * 30_000]
    data, bounds = chunk_dedup.normalised(pa.array(texts))
    chunks = []
    for start, end, ends in zip(bounds, bounds[1:], chunk_dedup.chunk_ends(data, bounds)):
        cuts = [start, *ends]
        chunks.append([bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])])
        sizes = [len(c) for c in chunks[-1]]
        assert sum(sizes) == end - start
        assert all(chunk_dedup.LEAST_BYTES <= n <= chunk_dedup.MOST_BYTES for n in sizes[:-1])
    assert [b"".join(c).decode() for c in chunks] == texts
    # Text put before the body changes the first chunks only.
    assert len(set(chunks[2]) - set(chunks[3])) <= 3 < len(chunks[2])


# --- collocations ------------------------------------------------------------------------


def brute_phrases(rows, least, per_language):
    counts, out = {}, []
    for lang, text in rows:
        of_lang = counts.setdefault("und" if lang is None else lang, Counter())
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            of_lang.update(tuple(words[i : i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    for lang, f in counts.items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        candidates = {w: c for w, c in f.items() if len(w) > 1 and c >= least}
        left = []
        for w, a in candidates.items():
            holds = [c for v, c in candidates.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if any(100 * c >= 80 * a for c in holds):
                continue
            score, _, l, r = min((floor(Fraction(2_000_000 * a, f[w[:k]] + f[w[k:]])), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            left.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(left)[:per_language], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def test_collocations_equal_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{n}" for n in range(30)] + ["Été", "NEW", "york", "İx", " ", "a b", "x\x00y"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    rows = []
    for n in range(300):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        if n % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = ["New", "York", "city", "hall"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n", " ;; "]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    rows += [("fr", "la la la la la la " * 40), ("long", "one two three " * 50_000), ("en", None), (None, ""), ("de", " .,\n"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, block int, rank int").repartition(3)
    for least, per_language in ((8, 2000), (3, 25)):
        result = collocations.collocations(docs, least, per_language)
        assert sorted(tuple(r) for r in result.collect()) == brute_phrases(rows, least, per_language)
    for empty in (docs.limit(0), docs.where("text is null"), docs.limit(1)):
        assert collocations.collocations(empty).count() == 0


def test_only_phrases_that_may_be_among_the_best_are_counted(spark, monkeypatch):
    rng = random.Random(12)
    frequent = [f"w{n}" for n in range(12)]
    rows = [("en", " ".join(rng.choices(frequent, k=200))) for _ in range(300)]
    # As good as can be: they stand alone, and no longer phrase holds them.
    rows += [("en", f"{rng.choice(frequent)} north{n} star{n} {rng.choice(frequent)}") for n in range(10) for _ in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    staged, sizes = collocations.staged, []

    def watched(df, label):
        out = staged(df, label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(collocations, "staged", watched)
    result = collocations.collocations(docs, 5, 5)
    assert sorted(tuple(r) for r in result.collect()) == brute_phrases(rows, 5, 5)
    # 1,728 phrases of three of the 12 words are frequent.
    assert max(sizes) < 500


def test_languages_with_too_few_phrases_above_the_first_floor_are_done_again(spark, monkeypatch):
    rng = random.Random(13)
    rows = []
    # The best pairs are all covered: three and two triples by each phrase of four words.
    for n in range(40):
        words = [f"{c}{n}" for c in "abcd"]
        rows += [("en", " ".join(words))] * (10 + n) + [("en", rng.choice(words)) for _ in range(rng.randrange(3 * n + 1))]
    rows += [("de", text) for _, text in rows[:300]] + [("fr", "sur le pont " * 9), ("fr", "a b. " * 20)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    staged, labels = collocations.staged, []
    monkeypatch.setattr(collocations, "staged", lambda df, label: labels.append(label) or staged(df, label))
    for tried, attempts in ((collocations.FLOOR_PAIRS, 2), ((1.1, 1.5, None), 3)):
        monkeypatch.setattr(collocations, "FLOOR_PAIRS", tried)
        labels.clear()
        result = collocations.collocations(docs, 5, 20)
        assert sorted(tuple(r) for r in result.collect()) == brute_phrases(rows, 5, 20)
        assert labels.count("floors") == attempts


@pytest.mark.parametrize("size, ranks", [(0, 5), (1, 5), (200_000, 700), (50_000, (1 << 40) - 1), (120_000, 1600)])
def test_tiles_count_every_pair(size, ranks):
    rng = np.random.default_rng(size)
    left, right = (np.minimum((rng.pareto(0.8, size) * 20).astype(np.int64), ranks - 1) for _ in range(2))
    lefts, rights, counts, place = collocations.tiled_pairs(left, right)
    pairs = list(zip(lefts.tolist(), rights.tolist()))
    assert dict(zip(pairs, counts.tolist())) == Counter(zip(left.tolist(), right.tolist())) and len(set(pairs)) == len(pairs)
    assert (lefts[place] == left).all() and (rights[place] == right).all()


@pytest.mark.parametrize("first_rank", [0, 1 << 33])
def test_pairs_of_a_block_take_little_memory_and_are_rows_only_some_at_a_time(monkeypatch, first_rank):
    rng = np.random.default_rng(14)
    # 0 is the break between pieces; places above 15,000 have no rank.
    stream = np.minimum(rng.pareto(0.7, 1_000_000) * 100, 20_000).astype(np.int32)
    rank = np.concatenate([[-1], first_rank + rng.permutation(15_000), np.full(5_000, -1)])
    known = pa.StructArray.from_arrays([pa.array(np.arange(1, 15_001)), pa.array(rank[1:15_001])], ["place", "rank"])
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(known)], known), collocations._packed(stream)], ["known", "stream"])
    tracemalloc.start()
    blocks = list(collocations._pairs(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 80 * len(stream)
    monkeypatch.setattr(collocations, "ROWS_AT_ONCE", 1000)
    found = list(collocations._pair_counts(iter(blocks)))
    assert max(map(len, found)) == 1000 and all(pa.types.is_binary(t) for b in blocks for t in b.schema.types)
    left, right = rank[stream[:-1]], rank[stream[1:]]
    both = (left >= 0) & (right >= 0)
    rows = [(w1, w2, n) for b in found for w1, w2, n in zip(*(c.to_pylist() for c in b.columns))]
    wanted = Counter(zip(left[both].tolist(), right[both].tolist()))
    assert len(rows) == len(wanted) and {(w1, w2): n for w1, w2, n in rows} == wanted


# --- hard negatives ----------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=10, percents=(30, 90)):
    first = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not isfinite(x) for x in vector):
            continue
        first[vec_id] = min(first.get(vec_id, (label, vector)), (label, vector))
    whole = {i: (label, [floor(256 * x) for x in v]) for i, (label, v) in first.items()}
    out = []
    for anchor, (label, a) in whole.items():
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other) for i, (other, v) in whole.items() if i != anchor and len(v) == len(a))
        for ps, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(i, -ns) for ns, i, other in scored if other != label and percents[0] * -ps <= 100 * -ns <= percents[1] * -ps]
            out += [(anchor, positive, rank, i, -ps, ns) for rank, (i, ns) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def vectors_around(centres, per_centre, dim, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    rows = []
    for n in range(centres * per_centre):
        vector = middle[n % centres] + spread * rng.normal(size=dim)
        rows.append((n * 25, [float(np.float32(x)) for x in vector], int(rng.integers(0, 3))))
    return rows


_VECTORS = "vec_id bigint, embedding array<double>, label int, block int, score string"


def test_hard_negatives_equal_brute_force(spark):
    rows = vectors_around(7, 60, 8, 0.2, 1)
    # Ties, repeats, shared ids, other lengths, and rows that take no part.
    rows += [(7_000_000 + n, rows[n][1], rows[n][2]) for n in range(40)] + rows[:3]
    rows += [(100, [9.0] * 8, 0), (101, [-1.5] * 8, 1), (200_000, [1.0, 2.0], 1), (200_001, [1.0, 2.0], 1), (200_002, [0.5, 0.5], 2)]
    rows += [(300_000, [], 1), (300_001, [], 1), (300_002, [], 2), (400_000, [0.0] * 8, 1), (-500, [1.0] * 8, 2)]
    rows += [(None, [1.0] * 8, 1), (500_000, None, 1), (600_000, [1.0] * 8, None), (700_000, [None] + [1.0] * 7, 1), (800_000, [float("nan")] * 8, 1), (900_000, [float("inf")] * 8, 1)]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], _VECTORS)
    result = hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in result.collect()) == brute_negatives(rows)
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_scores_beyond_64_bits_stop_the_run(spark):
    for size, message in ((3e15, "score"), (3e17, "component")):
        frame = spark.createDataFrame([(0, [size] * 8, 1, 1, ""), (1, [size] * 8, 1, 1, ""), (2, [1.0] * 8, 2, 1, "")], _VECTORS)
        with pytest.raises(PythonException, match=message):
            hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0).collect()


def test_large_scores_are_exact(spark):
    rng = random.Random(2)
    rows = [(n * 50, [rng.uniform(-1, 1) * 1e6 for _ in range(6)], n % 2) for n in range(60)]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], _VECTORS)
    result = hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in result.collect()) == brute_negatives(rows)


def test_bounds_spare_most_scores():
    """Around 20 centres, far fewer scores are computed than there are pairs of anchor and candidate."""
    rows = vectors_around(20, 100, 16, 0.01, 4)
    vectors = hard_negatives.whole_components([r[1] for r in rows], 256)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])

    def row(at, **more):
        return {"dim": 16, "ids": ids[at].tobytes(), "labels": labels[at].tobytes(), "vectors": vectors[at].tobytes()} | more

    at = np.flatnonzero(ids % 100 == 0)[:200]
    order, parents, edges = hard_negatives.spanning_tree(vectors[at])
    assert sorted(order) == list(range(len(at))) and (parents[1:] < np.arange(1, len(at))).all() and parents[0] == -1
    anchors = hard_negatives.Anchors(row(at[order], parents=parents.tobytes(), edges=edges.tobytes()))
    candidates = hard_negatives.Block(row(np.arange(len(ids))))
    for a in range(1, len(at)):
        step = anchors.doubles[a] - anchors.doubles[anchors.parents[a]]
        assert (np.abs(candidates.doubles @ step) <= anchors.edges[a] * candidates.norms).all()
    exact = candidates.vectors @ anchors.vectors.T
    looked_at = 0

    def wanted(place, low, high):
        assert (low <= exact[:, place]).all() and (exact[:, place] <= high).all()
        return np.flatnonzero(high >= np.sort(exact[:, place])[-10])

    looked_at = hard_negatives.walk(anchors, candidates, wanted, lambda *_: None)
    assert looked_at < 0.2 * exact.size
