import random
import tracemalloc
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeward.llm import decontamination, language_id, near_dedup, topk
from lakeward.llm.common import read
from lakeward.llm.shingles import ascii_words, letter_tokens, letter_words, shingle_hashes, shingle_set

SF = "/root/testdata/sf0.001"
WORDS = ["the", "of", "zwölf", "b", "See", "den", "x1", "au", "ç", "lo", "ti", "om"]


def brute_near(rows, percent):
    def shingles(text):
        w = ascii_words(text or "")
        return {tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, least is None or doc_id == least))
    return out


@pytest.mark.parametrize("percent,centers,few,rare", [(85, 16, 16, 16), (85, 1, 0, 3), (80, 2, 0, 1), (80, 4, 1, 200)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, percent, centers, few, rare):
    monkeypatch.setattr(near_dedup, "CENTERS", centers)
    monkeypatch.setattr(near_dedup, "FEW", few)
    monkeypatch.setattr(near_dedup, "RARE", rare)
    rng = random.Random(percent + centers)
    rows = []
    for group in range(6):
        text = rng.choices(WORDS, k=rng.choice([3, 40, 90, 400]))
        for _ in range(14):
            # A chain: each copy changes a word or two of the one before.
            rows.append((len(rows) * 3 % 97 + group * 100, " ".join(text)))
            text = list(text)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(WORDS)
    # Variants of one text, most of them too far from each other, some shortened.
    text = [f"{rng.choice(WORDS)}{i}" for i in range(80)]
    for _ in range(40):
        variant = text[: rng.choice([60, 70, 80, 80, 80])]
        for at in rng.sample(range(len(variant)), rng.randint(0, 6)):
            variant[at] += rng.choice("ab")
        rows.append((1000 + len(rows), " ".join(variant)))
    rows += [(900 + i, " ".join(rng.choices(WORDS, k=30))) for i in range(20)]
    rows += [rows[0], (rows[0][0], "another text with the same id here"), (None, rows[5][1]), (None, "no id at all in this one"), (990, None),
             (991, ""), (992, " \n\t"), (993, "One two"), (994, "one two"), (995, "ONE TWO"), (996, "w " * 30_000)]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id bigint, text string, node string, _a int")
    result = [tuple(r) for r in near_dedup.near_duplicates(docs, percent).collect()]
    assert sorted(map(str, result)) == sorted(map(str, brute_near(rows, percent)))
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_odd_sketches_estimate():
    rng = np.random.default_rng(1)
    for share in (0.95, 0.85, 0.5, 0.0):
        common = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        own = int(1000 * (1 - share) / share / 2) if share else 1000
        a, b = (np.concatenate([common if share else [], rng.integers(0, 1 << 63, own, dtype=np.uint64)]).astype(np.uint64) for _ in "ab")
        sketches = [near_dedup.odd_sketch(near_dedup.minhash(x, 120)) for x in (a, b)]
        apart = sum(int(x).bit_count() for x in (sketches[0] ^ sketches[1]).view(np.uint64))
        estimate = 1 + 256 / 480 * np.log(max(1e-9, 1 - 2 * apart / 256))
        assert abs(estimate - share) < 0.15 or (share < 0.6 and estimate < 0.65)


@pytest.mark.parametrize("percent", [8, 50, 80, 85, 99, 100])
def test_pairs_at_the_threshold_are_hardly_missed(percent):
    bands, rows, most = near_dedup.scheme(percent)
    share, bits = percent / 100, near_dedup.SKETCH_WORDS * 64
    by_bands = (1 - share**rows) ** bands
    # Bits apart after each sample, by their probability.
    apart = {0: 1.0}
    for _ in range(bands * rows):
        after = {k: p * share for k, p in apart.items()}
        for k, p in apart.items():
            once = ((k + 1, (bits - k) / bits), (k - 1, k / bits))
            for j, q in once:
                for i, r in ((j + 1, (bits - j) / bits), (j - 1, j / bits)):
                    if q and r:
                        after[i] = after.get(i, 0) + p * (1 - share) * q * r
        apart = after
    by_sketch = sum(p for k, p in apart.items() if k > most)
    assert abs(sum(apart.values()) - 1) < 1e-9 and by_bands + by_sketch < 1e-6
    if percent < 100:
        assert sum(p for k, p in apart.items() if k > most - 2) > near_dedup.MISSED_BY_SKETCH
    with pytest.raises(ValueError, match="too low"):
        near_dedup.scheme(2)


def brute_contained(docs, items, least=0.8):
    def shingles(text, size):
        w = letter_words(text or "")
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()

    found = set()
    for doc_id, text in docs:
        own = [shingles(text, size) for size in range(6)]
        for item_id, item in items:
            size = min(5, len(letter_words(item or "")))
            wanted = shingles(item, size)
            both = len(own[size] & wanted)
            if wanted and both >= least * len(wanted):
                found.add((doc_id, item_id, both, len(wanted)))
    return found


def test_contaminations_equal_brute_force(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate([5, 6, 9, 14, 20, 33, 40, 70, 130, 300])]
    items += [(20, "four words or less"), (23, "Two, words"), (24, "xylem"), (25, "!?"), (21, None), (22, ""), (3, items[3][1]), (None, prose(30)), (3, prose(25))]
    docs = []
    for i in range(60):
        text = prose(rng.choice([0, 3, 50, 400, 3000]))
        if i % 2:
            words = (rng.choice(items)[1] or "").split()
            if i % 6 == 1 and len(words) > 20:
                words[len(words) // 2] = "changed"
            text = f"{text} {' '.join(words).upper()}, {prose(30)}"
        docs.append((i, text))
    docs += [(61, "two words"), (62, f"{prose(40)} Xylem {prose(9)}"), (63, f"{prose(20000)} {items[6][1]} {prose(500)}")]
    docs += [docs[1], (None, docs[3][1]), (70, None), (71, ""), (5, docs[7][1])]
    d = spark.createDataFrame([(*r, "k") for r in docs], "doc_id bigint, text string, key string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, size int")
    found = decontamination.contaminations(d, b)
    result = {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in found.collect()}
    assert result == brute_contained(docs, items) and len(result) > 20
    assert {(61, 23, 1, 1), (62, 24, 1, 1)} <= result and any(r[:2] == (63, 6) for r in result)
    bad = {r for r in docs if brute_contained([r], items)}
    kept = decontamination.remove_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(r) for r in docs if r not in bad)
    assert decontamination.contaminations(d, b.limit(0)).count() == decontamination.contaminations(d.limit(0), b).count() == 0


def test_only_documents_with_shingles_of_items_are_searched(monkeypatch):
    rng = random.Random(10)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))
    item = prose(30)
    texts = [prose(900), f"{prose(300)} {item.upper()}, {prose(5)}", None, "", item[: len(item) // 3], "two words", prose(20)]
    batch = pa.RecordBatch.from_pydict({"_a": list(range(7)), "_b": [0] * 7, "text": texts})
    given = pa.RecordBatch.from_pydict({"ia": [1], "ib": [2], "text": [item]})
    (keys,), (values,) = decontamination._item_keys(iter([given])), decontamination._item_shingles(iter([given]))
    filters = []
    for column in (keys["key"], values["value"]):
        slots = column.to_numpy() & ((1 << 20) - 1)
        bits = np.zeros(1 << 17, np.uint8)
        np.bitwise_or.at(bits, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
        filters.append(SimpleNamespace(value=bits))
    searched, window_keys = [], decontamination.window_keys
    monkeypatch.setattr(decontamination, "window_keys", lambda h, sizes: searched.append(len(h)) or window_keys(h, sizes))
    met = list(decontamination._met([4], *filters, 0.8)(iter([batch])))
    assert searched == [331] and {row for part in met for row in part["_a"].to_pylist()} == {1}


def most_held(task, columns):
    """Bytes of Python objects and arrays that a task over one batch of 32 MB of text holds at most, besides the batch."""
    n = 2000
    texts = pa.array([str(i) * (16_000 // len(str(i))) for i in range(n)])
    whole = {"_a": pa.array(range(n)), "_b": pa.array(np.zeros(n, np.int32)), "item": pa.array(["one two three four five six"] * n)}
    batch = pa.record_batch({c: texts if c.startswith("text") else whole.get(c, whole["_a"]) for c in columns})
    tracemalloc.start()
    try:
        rows = sum(len(b) for b in task(iter([batch])))
        return rows, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_contained_holds_few_texts_at_once():
    rows, held = most_held(decontamination._contained(0.8), ["_a", "_b", "doc_id", "text", "item_id", "item"])
    assert rows == 0 and held < 12_000_000


def test_near_dedup_holds_few_texts_at_once():
    signed, held = most_held(near_dedup._sign(24, 5), ["doc_id", "_a", "_b", "text"])
    assert signed == 2000 and held < 12_000_000
    linked, held = most_held(near_dedup._linked(85), ["a", "b", "text_a", "text_b"])
    assert linked == 2000 and held < 12_000_000
    tokens, held = most_held(near_dedup._tokens, ["node", "text"])
    assert tokens == 2000 and held < 12_000_000


def test_letter_tokens_are_hashed_like_letter_words():
    odd = ["Two, words\x00a_b\x0b9", "ÀÉ été—ça «oui» 日本語 x\u0301y", "İstanbul ß ǅ", "naïve Straße über", "٣ ² a\xa0b", "", "\ufeffa"]
    for text in odd:
        words = letter_words(text)
        tokens = letter_tokens(text)
        assert [w if isinstance(w, str) else w.decode() for w in tokens] == words
        for size in (1, 2, 5):
            assert (shingle_hashes(tokens, size) == shingle_hashes(words, size)).all()


def test_language_sample_is_bounded_in_rows(spark):
    hot = next(i for i in range(50) if spark.range(1).select(language_id.fold(F.lit(i))).first()[0] != 0)
    repeated = [(hot, "one and the same text", "en")] * 300
    shared = [(hot, f"another text of that id {i}", "de") for i in range(300)]
    others = [(i, f"text number {i}", "en") for i in range(100, 160)]
    d = spark.createDataFrame(repeated + shared + others, "doc_id bigint, text string, lang string")
    rows = language_id.training_rows(d, 40)
    assert len(rows) == len(set(rows)) and sum(lang == "de" for _, lang in rows) == 40
    assert 0 < sum(lang == "en" for _, lang in rows) <= 40


def test_language_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = language_id.identify(docs.select("doc_id", "text"), docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(language_id.fold(F.col("doc_id")) == 0).collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in held)
    assert sum(r.rejected for r in found.collect()) < 0.02 * docs.count()


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_texts_of_a_language_never_learned_are_rejected(spark, left_out):
    docs = read(spark, "/root/testdata/sf0.01", "documents").where("lang is not null and text is not null")
    learned = docs.withColumn("lang", F.when(F.col("lang") != left_out, F.col("lang")))
    found = language_id.identify(docs.select("doc_id", "text"), learned).join(docs.select("doc_id", "lang"), "doc_id").collect()
    unknown = [r.rejected for r in found if r.lang == left_out]
    known = [r.rejected for r in found if r.lang != left_out]
    assert np.mean(unknown) > 0.9 and np.mean(known) < 0.02


def test_junk_is_rejected_and_a_text_of_two_learned_languages_is_not(spark):
    rows = read(spark, "/root/testdata/sf0.01", "documents").where("length(text) > 1500").select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: r.doc_id)
    model = language_id.train([(r.text, r.lang) for r in rows[:400]])
    rng = random.Random(3)
    typed = ["asdf qwer zxcv jkl poiu mnbv wert yuio", "日本語の文章はここにあります。", "Это русский текст, который не был выучен."]
    assert all(model.predict(text)[1] < 0.5 for text in typed)
    # Short words often stay what they were: some nine in a hundred such texts pass.
    junk = [" ".join("".join(rng.sample(w, len(w))) for w in r.text.split()) for r in rows[400:440]]
    assert np.mean([model.predict(text)[1] < 0.5 for text in junk]) > 0.85
    pairs = [(a.text, b.text) for a, b in zip(rows[400:440], rows[440:480]) if a.lang != b.lang]
    assert pairs and np.mean([model.predict(f"{a} {b}")[1] >= 0.5 for a, b in pairs]) > 0.9


def test_lead_is_the_mean_over_spans_and_the_language_that_of_the_whole_text():
    rng = np.random.default_rng(5)
    model = language_id.Model(["a", "b", "c"], rng.normal(size=(language_id.BUCKETS, 3)).astype(np.float32), np.array([0.1, 0.0, -0.1], np.float32))
    for size in (2, 3, 4, 50, 1_199, 1_200, 90_001):
        word = "".join(rng.choice(list("abcdefgh"), size=size - 2)) if size > 2 else ""
        codes = np.frombuffer(f" {word} ".encode("utf-32-le"), np.uint32)
        buckets = language_id.features(word)
        best, lead = model.judge(buckets) if len(buckets) else (0, 0.0)
        if not len(buckets):
            continue
        whole = model.table[buckets].astype(float).mean(axis=0) + model.bias
        assert best == whole.argmax()
        spans = max(1, len(codes) // language_id.SPAN)
        if spans == 1:
            top = np.sort(whole)[::-1]
            assert lead == pytest.approx(top[0] - top[1])
        else:
            leads, sizes = [], [len(codes) - n + 1 for n in (2, 3, 4)]
            assert sum(sizes) == len(buckets)
            for i in range(spans):
                low, high = len(codes) * i // spans, len(codes) * (i + 1) // spans
                chosen = [buckets[sum(sizes[:k]) + low : sum(sizes[:k]) + min(high, sizes[k])] for k in range(3)]
                top = np.sort(model.table[np.concatenate(chosen)].astype(float).mean(axis=0) + model.bias)[::-1]
                leads.append(top[0] - top[1])
            assert lead == pytest.approx(np.mean(leads))


def test_language_odd_rows(spark):
    rows = [(i, t, lang, 0.5) for i, (t, lang) in enumerate([("the house of the man", "aa"), ("das haus der frau", "bb")] * 20)]
    rows += [(100, None, "aa", None), (101, "", None, None), (102, "12 %% 3", None, 1.0), (None, "the man", None, None), (7, rows[7][1], "bb", 0.5),
             (103, "haus " * 40_000, None, None), (104, "ñ", None, None), (105, "日本", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    result = language_id.identify(docs)
    assert result.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    by = {r.doc_id: r for r in result.collect()}
    assert result.count() == len(rows)
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and all(by[i].rejected for i in (100, 101, 102))
    assert by[103].lang_pred == "bb" and by[None].lang_pred == "aa" and by[104].lang_pred in ("aa", "bb")
    nothing = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in nothing} == {("und", 0.0, True)}
    single = language_id.identify(docs.withColumn("lang", F.lit("aa"))).where("text rlike '[a-z]'").collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in single} == {("aa", 0.5, False)}
    assert language_id.identify(docs.limit(0)).count() == 0


def brute_top(rows, asks, k):
    def sound(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    vectors = [(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in rows if i is not None and sound(v)]
    out = []
    for q, own in sorted({r for r in vectors if asks(r[0])}):
        scores = [(-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q and len(v) == len(own)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 10])
def test_top_k_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(topk, "DATA_BLOCK", 150)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(k)
    centres = rng.normal(0, 3, (5, 8))
    vectors = [(centres[i % 5] + rng.normal(0, 0.2, 8)).astype("float32").tolist() for i in range(500)]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0]) for i in range(120)]  # ties
    rows += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (None, vectors[1]), (2010, []),
             (2020, [1.0, 2.0]), (2021, [0.5, -1.0]), (20, vectors[20]), (40, vectors[3]), (3000, [1e5] * 8), (3010, [0.0] * 8)]
    table = spark.createDataFrame([(*r, 3) for r in rows], "vec_id bigint, embedding array<float>, rank int")
    result = topk.top_k(table, F.col("vec_id") % 10 == 0, k)
    assert sorted(tuple(r) for r in result.collect()) == brute_top(rows, lambda i: i % 10 == 0, k)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_top_k_refuses_scores_beyond_64_bits(spark):
    def found(x):
        rows = [(i, [x] * 64) for i in range(4)]
        vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        return topk.top_k(vectors, F.col("vec_id") == 0).collect()

    assert [r.score for r in found(2.0**18)] == [64 * 2**56] * 3
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        found(3e15)
