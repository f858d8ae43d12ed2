"""BPE encoding and decoding with a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that byte-pair encoding makes. It starts as
one state with an arc back to itself for each base symbol; each merge (u, v) -> w, in order of
rank, applies a merge gadget:

* the state that u leads to becomes a copy without the arc v, so that u, v is no longer accepted;
* every state with an arc u gets an arc w, which leads where v led from the state before the copy.

A state is told by the label of the arcs into it, so there is one for each token. It is kept as
what the gadgets did to it: the arcs taken out and when, and the state it was copied from and
when. ``arc`` reads the final automaton from that; arcs met are kept in a table.

A word is read from the left, longest arc first. Every prefix has exactly one accepted
tokenization, so a position is reached in one state only, and one from which the word cannot be
finished is tried once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Words remembered in a worker, and their longest length: bounds its memory.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 48
_ARCS = 1 << 20

_NEVER = 1 << 60
_RESULT = "doc_id bigint, ids binary, decoded string"


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.labels = [""] * (max(vocab.values()) + 1)
        for label, i in vocab.items():
            self.labels[i] = label
        results = [vocab[u + v] for u, v in merges]
        if len(set(results)) < len(results):
            raise ValueError("two merges make the same token")
        made = set(results)
        n = len(self.labels)
        # When a token's state was copied and from which token's state; base symbols never were.
        self.born = [-1] * n
        self.left = [-1] * n
        self.right = [-1] * n
        self.taken: list[dict[int, int]] = [{} for _ in range(n)]
        self.tokens = {label: i for label, i in vocab.items() if i not in made}
        self.arcs: dict[tuple[int, int], bool] = {}
        for when, ((a, b), w) in enumerate(zip(merges, results)):
            u, v = vocab[a], vocab[b]
            if self._has(u, v, when):
                self.born[w], self.left[w], self.right[w] = when, u, v
                self.taken[u][v] = when
                self.tokens[a + b] = w
        # Characters of the longest token that begins with these two: bounds what is looked up.
        self.reach: dict[str, int] = {}
        for token in self.tokens:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))

    def _has(self, state: int, label: int, when: int) -> bool:
        """Whether the state had the arc just before gadget ``when``."""
        while True:
            if self.taken[state].get(label, _NEVER) < when:
                return False
            if self.born[label] < self.born[state]:
                state, when = self.right[state], self.born[state]
            elif self.born[label] < 0:
                return True
            else:
                label, when = self.left[label], self.born[label] + 1  # the copy without v counts

    def arc(self, state: int, label: int) -> bool:
        key = (state, label)
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) > _ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self._has(state, label, _NEVER)
        return found

    def tokenize(self, word: str, end_of_word: str) -> list[int]:
        """Labels of the accepted path of a word written in base symbols, the last with its ending."""
        n, reach = len(word), self.reach.get
        find, arcs, arc = self.tokens.get, self.arcs, self.arc
        path: list[int] = []
        starts: list[int] = []
        stuck = set()  # no accepted path passes these positions
        at, last, end = 0, -1, min(n, reach(word[:2], 1))
        while True:
            while end > at:
                label = find(word[at:end] if end < n else word[at:] + end_of_word)
                if label is not None and end not in stuck:
                    # None: not met yet
                    step = True if last < 0 else arcs.get((last, label))
                    if step or (step is None and arc(last, label)):
                        break
                end -= 1
            else:
                if not path:
                    raise ValueError(f"no accepted path spells {word!r}")
                stuck.add(at)
                end = at - 1
                at = starts.pop()
                path.pop()
                last = path[-1] if path else -1
                continue
            path.append(label)
            starts.append(at)
            if end == n:
                return path
            at, last, end = end, label, min(n, end + reach(word[end : end + 2], 1))


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


# How this kind of tokenizer file cuts words.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPLIT = _CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(_CONTRACTIONS + r"|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_ASCII_WORDS = re.compile(_CONTRACTIONS + r"|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+")


class WordTokenizer:
    """Encoding and decoding by a tokenizer file with lower case, word ends and byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if (
            steps != ["NFC", "Replace", "Lowercase"]
            or split["pattern"] != {"Regex": SPLIT}
            or (byte_level["type"], byte_level["add_prefix_space"], byte_level["use_regex"]) != ("ByteLevel", False, False)
            or spec["decoder"] is not None
            or any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
            or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        ):
            raise ValueError(f"{path}: a tokenizer of this kind is not supported")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.ending = model["end_of_word_suffix"]
        self.symbols = dict(enumerate(byte_symbols()))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {content: np.array([i], "<u4").tobytes() for content, i in added.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.labels = self.automaton.labels + [""] * (max(added.values()) + 1 - len(self.automaton.labels))
        for content, i in added.items():
            self.labels[i] = content
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        plain = word.isascii() and word.isalnum()
        spelled = word if plain else word.encode().decode("latin-1").translate(self.symbols)
        path = self.automaton.tokenize(spelled, self.ending)
        ids = pack(f"<{len(path)}I", *path)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for k, part in enumerate(self.specials.split(text)):
            if k % 2:
                out.append(self.added[part])
                continue
            if part.isascii():
                words = _ASCII_WORDS.findall(part.lower())
            else:
                # str.lower() gives a final sigma its own form; the tokenizer lowers letter by letter.
                words = _WORDS.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
            known = self.words.get
            out += [known(w) or self._word(w) for w in words]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, with a space between; the file names no decoder that would join them."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _per_text(docs: DataFrame, path: str, schema: str, row) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    types = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrow = [types[field.split()[1]] for field in schema.split(", ")][1:]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in batches:
            texts = batch["text"]
            # A few rows at a time: ids and decoded text are larger than the text they come from.
            for at in range(0, len(batch), 256):
                rows = [row(words, t or "") for t in texts.slice(at, 256).to_pylist()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, 256).cast(pa.int64()), *columns], names)

    return docs.select("doc_id", "text").mapInArrow(mapped, schema)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the text decoded from them, for every row.

    As the tokenizers library gives for the file without special tokens added; special strings
    inside a text are the tokens they name. A null text is empty and has no ids. Rows are taken
    one by one, so rows that repeat or share or lack a doc_id need no rule. Other columns are
    not read. Work is narrow: no shuffle.
    """

    def row(words: WordTokenizer, text: str):
        ids = words.encode(text)
        return ids, words.decode(ids)

    return _per_text(docs, path, _RESULT, row)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_texts``, with digests in place of ids and text: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def row(words: WordTokenizer, text: str):
        ids = words.encode(text)
        return len(ids) // 4, sha256(ids).hexdigest(), sha256(words.decode(ids).encode()).hexdigest()

    return _per_text(docs, path, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row)
