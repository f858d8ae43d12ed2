import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeward.llm.bpe_automaton import encode_digests, encode_texts, tokenizer
from lakeward.llm.common import read
from lakeward.llm.token_counts import count_pieces, count_tokens, piece_counter

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "a", "  a  b\n\n c", "tab\tand\r\nline", "<s> </s> <unk> <0x0A>", "▁x ▁▁", "aaaaaaaaaaaaaaaaaaaa",
    "<|startoftext|>x<|endoftext|> <|ENDOFTEXT|>", "I'll it's WE'VE can't", "ΑΣ İstanbul ǅ ﬁ Å", "é 가 क़",
    "12345 3½ Ⅷ ٣", "\U0001f600‍\U0001f525 あ亜", "a b c\u0085d\x1ce​f", "\x00\x01\x7f", "x" * 5000, "!?" * 700, " " * 300,
]


def random_texts(n):
    rng = random.Random(11)
    pool = "aabcdeeefghiilmnoorsttuvwyz ABC  '\n.,!0123éèüßİΣ▁中\U0001f600\t" * 3 + "the and ing "
    return ["".join(rng.choices(pool, k=rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    corpus = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").select("text").collect()]
    return ODD + random_texts(1500) + corpus


def test_counts_equal_the_library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts, words = piece_counter(PIECES)
    for text in texts:
        assert count_pieces(text, counts, words) == len(model.encode(text)), text


def test_ids_and_decoding_equal_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    own = tokenizer(WORDS)
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", None), (3, "Zoë " * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    counted = {(r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(docs, PIECES).collect()}
    assert {(1, 3, 2), (None, 0, 0), (2, 0, 0)} <= counted and len(counted) == 4
    encoded = {r.doc_id: r for r in encode_texts(docs, WORDS).collect()}
    digests = encode_digests(docs, WORDS).collect()
    assert len(digests) == 5
    for r in digests:
        assert r.ids_sha256 == sha256(encoded[r.doc_id].ids).hexdigest()
        assert r.decoded_sha256 == sha256(encoded[r.doc_id].decoded.encode()).hexdigest()
        assert r.n_tokens * 4 == len(encoded[r.doc_id].ids)
    assert encoded[1].decoded == "a</w> b</w>"
    empty = docs.limit(0)
    assert count_tokens(empty, PIECES).count() == encode_texts(empty, WORDS).count() == 0
