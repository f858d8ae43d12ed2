"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are the hashed two-, three- and four-letter strings of its words, with word
ends. Their embeddings are averaged and a linear layer gives a score for each language. Both
are trained by stochastic gradient descent in numpy, on a bounded sample of labelled rows.
Rejection is calibrated on rows kept back from training against texts of languages left out of
it and words with shuffled letters: what tells them apart is the lead of the best language over the
second, taken in spans of the text, so that a text of two learned languages is not rejected. A text
is rejected if its lead, as a share of the usual one, lies below the threshold found there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import KEY, row_key, sliced

# Labelled rows a language gives at most, the first by hash of doc_id; every fifth calibrates.
SAMPLE_PER_LANGUAGE = 400
BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 15, 16, 6, 0.5
# Pieces of a training text, in words, besides the whole: short texts occur too.
PIECES = (3, 12, 40)
# Letters of a span, and the most groups of languages that are left out in turn to calibrate rejection.
SPAN, LEFT_OUT = 600, 4
# Share of the known rows kept back that rejection may cost, and of texts taken to be in a learned language.
REJECTED_SHARE, KNOWN_SHARE = 0.001, 0.9
FOLDS = 5
UNDETERMINED = "und"


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@cache
def _letters() -> np.ndarray:
    """For each code point, itself lower-cased if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            table[code] = ord(character.lower()[0])
    return table


def features(text: str) -> np.ndarray:
    """Buckets of the two- to four-letter strings of the words of a text; empty if it has no letter."""
    codes = _letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)]
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    codes = codes[keep].astype(np.uint64)  # words, one zero after each
    if len(codes) < 2:
        return np.zeros(0, np.int64)
    codes = np.concatenate(([np.uint64(0)], codes))
    out = []
    h = codes
    for n in (2, 3, 4):
        if len(codes) < n:
            break
        h = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ codes[n - 1 :]
        out.append(((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 15)).astype(np.int64))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # for each bucket, its share in each language's score
    bias: np.ndarray
    usual: float = 1.0  # the lead of known texts, its median
    threshold: float = 0.0  # the share of it that parts known texts from others
    slope: float = 1.0

    def judge(self, buckets: np.ndarray) -> tuple[int, float]:
        """The best language of a text with letters, and its mean lead over the second in spans of the text."""
        letters = len(buckets) // 3 + 2  # the grams of two, three and four letters are one fewer each
        spans = max(1, letters // SPAN)
        total = np.zeros(len(self.languages))
        lead = 0.0
        for first in range(0, spans, 64):
            last = min(first + 64, spans)
            edges = np.array([letters * i // spans for i in range(first, last + 1)])
            sums, counts = np.zeros((last - first, len(total))), np.zeros(last - first)
            at = 0
            for n in (2, 3, 4) if spans > 1 else (0,):
                size = letters - n + 1 if n else len(buckets)
                ends = np.minimum(edges, size) if n else np.array([0, size])
                part = self.table[buckets[at + ends[0] : at + ends[-1]]]
                sums += np.add.reduceat(part, ends[:-1] - ends[0], axis=0, dtype=np.float64)
                counts += np.diff(ends)
                at += size
            total += sums.sum(axis=0)
            ordered = np.sort(sums / counts[:, None] + self.bias, axis=1)
            if len(total) > 1:
                lead += float((ordered[:, -1] - ordered[:, -2]).sum())
        return int((total / len(buckets) + self.bias).argmax()), lead / spans

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability that it is right; ``und`` and 0 without letters or languages."""
        buckets = features(text) if text else np.zeros(0, np.int64)
        if not len(buckets) or not self.languages:
            return UNDETERMINED, 0.0
        best, lead = self.judge(buckets)
        return self.languages[best], float(sigmoid(self.slope * (lead / self.usual - self.threshold)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(rows: list[tuple[str, str]], seed: int) -> Model:
    """Embeddings and linear layer of (text, language) rows, multiplied out; not calibrated."""
    languages = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    examples = []
    for text, lang in rows:
        words = text.split()
        parts = [text]
        for n in PIECES:
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            parts.append(" ".join(words[at : at + n]))
        for part in parts:
            buckets, n = np.unique(features(part), return_counts=True)
            if len(buckets):
                examples.append((buckets, (n / n.sum()).astype(np.float32), languages.index(lang)))
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        for i in rng.permutation(len(examples)):
            buckets, share, label = examples[i]
            mean = share @ embedding[buckets]
            error = softmax(mean @ layer + bias)
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * error
            # A bucket's share of a text is small, so its step is scaled up.
            embedding[buckets] -= (rate * 8 * share)[:, None] * back
    return Model(languages, embedding @ layer, bias)


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """A calibrated model of (text, language) rows. The same rows in the same order give the same model."""
    kept_back = [r for i, r in enumerate(rows) if i % 5 == 4] or rows
    own = [r for i, r in enumerate(rows) if i % 5 != 4] or rows
    model = fit(own, seed)
    leads = _leads(model, [text for text, _ in kept_back])
    if len(model.languages) < 2 or not len(leads) or np.median(leads) <= 0:
        return model
    model.usual = float(np.median(leads))
    _calibrate(model, leads / model.usual, own, kept_back, seed)
    return model


def _leads(model: Model, texts: list[str]) -> np.ndarray:
    return np.array([model.judge(b)[1] for text in texts if len(b := features(text))])


def _pieces(texts: list[str], rng: np.random.Generator) -> list[str]:
    """The texts and a short piece of each, as short texts occur too."""
    short = []
    for i, text in enumerate(texts):
        words = text.split()
        n = PIECES[i % len(PIECES)]
        at = int(rng.integers(0, max(1, len(words) - n + 1)))
        short.append(" ".join(words[at : at + n]))
    return [*texts, *short]


def _shuffled(text: str, rng: np.random.Generator) -> str:
    return " ".join("".join(rng.permutation(list(word))) for word in text.split()[:200])


def _calibrate(model: Model, known: np.ndarray, own: list, kept_back: list, seed: int) -> None:
    """Threshold and slope of the leads, as shares of the usual lead, of known and unknown texts.

    Unknown are texts of languages left out, judged by a model of the others, and known words with their
    letters shuffled. A logistic curve is fitted to both kinds, weighted as ``KNOWN_SHARE`` says, and passes
    one half at the threshold, unless that would cost more than ``REJECTED_SHARE`` of the known texts.
    """
    rng = np.random.default_rng(seed)
    texts = [text for text, _ in kept_back]
    unknown = [_leads(model, [_shuffled(text, rng) for text in texts]) / model.usual]
    yes = [known, _leads(model, _pieces(texts, rng)[len(texts) :]) / model.usual]
    groups = min(LEFT_OUT, len(model.languages)) if len(model.languages) > 2 else 0
    for g in range(groups):
        out = set(model.languages[g::groups])
        if len(model.languages) - len(out) < 2:
            continue
        part = fit([r for r in own if r[1] not in out], seed)
        inside = _leads(part, [text for text, lang in kept_back if lang not in out])
        usual = np.median(inside) if len(inside) else 0.0
        if usual > 0:
            unknown.append(_leads(part, [text for text, lang in kept_back if lang in out]) / usual)
    x = np.concatenate([*yes, *unknown])
    n_yes = sum(map(len, yes))
    n_no = len(x) - n_yes
    if not n_yes or not n_no:
        return
    # Targets a little inside 0 and 1, so that kinds that do not overlap have a finite curve.
    target = np.concatenate([np.full(n_yes, (n_yes + 1) / (n_yes + 2)), np.full(n_no, 1 / (n_no + 2))])
    weight = np.concatenate([np.full(n_yes, KNOWN_SHARE / n_yes), np.full(n_no, (1 - KNOWN_SHARE) / n_no)])
    design = np.stack([x, np.ones_like(x)], axis=1)
    curve = np.zeros(2)
    for _ in range(50):
        p = sigmoid(design @ curve)
        slope = design.T @ (weight * (p - target)) + 1e-6 * curve
        bend = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        curve -= np.clip(np.linalg.solve(bend, slope), -5, 5)
    if curve[0] <= 0:
        return
    model.slope = float(curve[0])
    model.threshold = float(min(-curve[1] / curve[0], np.quantile(known, REJECTED_SHARE)))


def training_rows(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` rows of each language whose fold is not 0, whole texts, in order of a hash.

    Only keys are ranked, so a language that most rows have costs one row for each task and rank. Rows
    that repeat are taken once, and rows that share an id count by themselves, so the bound holds for rows.
    """
    from pyspark.sql import Window

    labelled = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    labelled = labelled.where(fold(F.col("doc_id")) != 0).withColumn("o", F.xxhash64("doc_id"))
    keyed = labelled.select("*", *row_key("doc_id", "text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("o", "doc_id", *KEY))
    chosen = keyed.select("o", "doc_id", "lang", *KEY).withColumn("place", place).where(F.col("place") <= per_language)
    picked = [*KEY, "lang"]
    sample = keyed.join(F.broadcast(chosen.select(*picked).distinct()), picked, "left_semi").dropDuplicates(picked)
    rows = sample.select("text", "lang", "o", "doc_id").collect()
    rows.sort(key=lambda r: (r.o, r.doc_id, r.lang, r.text))
    return [(r.text, r.lang) for r in rows]


def identify(docs: DataFrame, labelled: DataFrame | None = None, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Every row of ``docs``, all columns, with lang_pred, score and rejected.

    Learns from ``labelled`` (``docs`` itself if not given): doc_id, text, lang. lang_pred is a language met there, or
    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. score is
    the calibrated probability, 0 to 1. rejected: ``und``, or a score below one half: the text is
    less likely in a learned language than not. With one learned language nothing can be told
    from it: texts with letters have score one half and are not rejected.
    A prediction reads the text alone, whole. Columns of these three names are replaced.
    """
    spark = docs.sparkSession
    rows = training_rows(docs if labelled is None else labelled, per_language)
    model = train(rows) if rows else Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    shared = spark.sparkContext.broadcast(model)
    added = ["lang_pred", "score", "rejected"]
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["lang_pred string", "score double", "rejected boolean"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            found = [model.predict(text) for text in batch["text"].to_pylist()]
            lang = [f[0] for f in found]
            score = [f[1] for f in found]
            rejected = [f[0] == UNDETERMINED or f[1] < 0.5 for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*batch.schema.names, *added],
            )

    return kept.mapInArrow(mapped, schema)
