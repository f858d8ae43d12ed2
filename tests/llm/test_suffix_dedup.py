import random
from collections import Counter

import pytest

from lakeward.llm.suffix_dedup import merged, remove_repeated_strings

SCHEMA = "doc_id bigint, text string, v string, _a int"


def brute(texts, width):
    counts = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        spans = merged([(i, i + width) for i in range(len(t) - width + 1) if counts[t[i : i + width]] > 1])
        gone = {i for a, b in spans for i in range(a, b)}
        out.append((len(t), len(gone), spans, bytes(c for i, c in enumerate(t) if i not in gone)))
    return out


def check(spark, rows, width, group):
    result = remove_repeated_strings(spark.createDataFrame(rows, SCHEMA), width, group).collect()
    expected = [(r[0], *b) for r, b in zip(rows, brute([(r[1] or "").encode() for r in rows], width))]
    actual = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in result]
    assert sorted(actual, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("width,group", [(200, 256), (200, 1), (70, 2)])
def test_equals_brute_force(spark, width, group):
    rng = random.Random(width + group)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passages = [prose(60) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(rng.randint(0, 40)) for _ in range(3)]
        if i % 2:
            parts.insert(rng.randint(0, 3), rng.choice(passages))
        text = " ".join(parts)
        if i % 7 == 3:
            text = texts[-1][: len(texts[-1]) // 2] + "x" + texts[-1][len(texts[-1]) // 2 :]
        texts.append(text)
    texts += ["a" * 900, "ab" * 300, "", "short", prose(20), passages[0] * 3]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "x", 1), (None, texts[5], None, None), (None, None, None, None), (7, "other", None, 2)]
    check(spark, rows, width, group)


def test_long_text_and_empty_table(spark):
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh ", k=150_000))
    check(spark, [(1, text, None, None), (2, text[70_000:71_000], None, None)], 200, 256)
    assert remove_repeated_strings(spark.createDataFrame([], SCHEMA)).count() == 0
