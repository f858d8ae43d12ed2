"""Token counts by byte-pair merging on a heap and a linked list.

The symbols of a word are a linked list; a heap holds adjacent pairs by rank. The pair of
lowest rank is merged until none is left, so the count is the number of symbols minus the
number of merges. No identifiers are made. A symbol the vocabulary lacks counts its UTF-8
bytes.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # stands for a space in pieces
SIGNS = string.punctuation
# Words remembered in a worker, and their longest length: bounds its memory.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48

_RESULT = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def merged_count(word: str, ranks: dict[str, int]) -> int:
    """Tokens of a word: its characters minus merges, unknown symbols as bytes."""
    n = len(word)
    symbols = list(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(ranks[pair], i, pair) for i in range(n - 1) if (pair := word[i : i + 2]) in ranks]
    heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heappop(heap)
        j = after[i]
        # Gone or grown since it was pushed.
        if symbols[i] is None or j >= n or symbols[i] + symbols[j] != pair:
            continue
        symbols[i], symbols[j] = pair, None
        merges += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (right := pair + symbols[k]) in ranks:
                heappush(heap, (ranks[right], i, right))
        if (h := before[i]) >= 0 and (left := symbols[h] + pair) in ranks:
            heappush(heap, (ranks[left], h, left))
    unknown = sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in ranks)
    return n - merges + unknown


class Counts(dict):
    """Counts of words seen, computed when first asked for."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks

    def __missing__(self, word: str) -> int:
        count = merged_count(word, self.ranks)
        if len(word) <= LONGEST_REMEMBERED:
            self[word] = count
        return count


@lru_cache(maxsize=2)
def piece_counter(path: str) -> tuple[Counts, re.Pattern]:
    """Counts by the pieces of a sentencepiece BPE model, and a pattern of the words it never merges across.

    A word is a run of spaces with what follows up to the next space or line end and, if no piece
    joins letters or digits to ``SIGNS``, up to the next change between these. The model must
    have byte fallback, the identity normalizer with a space put before the text, and no
    piece that would cross words; anything else is refused.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    # Within sentencepiece, byte, control and unknown pieces take no part in merging.
    pieces = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(size)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    sample = " AÅＡ  b\n"
    plain = model.normalize(sample) == SPACE + sample.replace(" ", SPACE)
    crossing = any(SPACE in p.lstrip(SPACE) or (len(p) > 1 and "\n" in p) for p, _ in pieces)
    if not plain or crossing or not any(map(model.is_byte, range(size))) or any(map(model.is_unused, range(size))):
        raise ValueError(f"{path}: a model of this kind is not supported")
    order = sorted({score for _, score in pieces}, reverse=True)
    rank = {score: i for i, score in enumerate(order)}
    joined = any(a.isalnum() and b in SIGNS or a in SIGNS and b.isalnum() for p, _ in pieces for a, b in zip(p, p[1:]))
    signs, end = f"[{re.escape(SIGNS)}]", f"[{SPACE}\n]|$"
    words = [] if joined else [f"[^\\W_]+(?={signs}|{end})", f"{signs}+(?=[^\\W_]|{end})"]
    pattern = "|".join(f"{SPACE}*{w}" for w in [*words, f"[^{SPACE}\n]+"])
    return Counts({p: rank[s] for p, s in pieces}), re.compile(f"{pattern}|\n|{SPACE}+")


def count_pieces(text: str, counts: Counts, words: re.Pattern) -> int:
    if not text:
        return 0
    return sum(map(counts.__getitem__, words.findall(SPACE + text.replace(" ", SPACE))))


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row, as the sentencepiece model gives without begin and end.

    A null text is empty and has no tokens. Rows are counted one by one, so rows that repeat
    or share or lack a doc_id need no rule. Other columns are not read. Work is narrow: no
    shuffle, and a worker remembers at most ``REMEMBERED`` words.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words = piece_counter(model_path)
        for batch in batches:
            if len(counts) > REMEMBERED:
                counts.clear()
            texts = batch["text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                    pa.array([count_pieces(t or "", counts, words) for t in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(mapped, _RESULT)
