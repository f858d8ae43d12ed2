import base64
import random
import re
from hashlib import blake2b, md5
from hashlib import sha1
from uuid import uuid4

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import line_dedup, warc
from lakeward.llm.line_dedup import PARAGRAPH, remove_repeated_units
from lakeward.llm.url_rules import judge_urls
from lakeward.plans.scratch import scratch_root

PAGES = "page_id bigint, url string, html string, address string, payload int"


def archive(spark, rows, **options):
    path = scratch_root(spark, "warc")
    warc.write_archive(spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES), path, **options)
    return path


@pytest.mark.parametrize("least", [0, 5])
def test_archive_round_trip(spark, least):
    rows = [
        (5, "http://a/x", "<p>é</p>"), (2, "http://a/y", "<p>é</p>"), (9, None, ""), (3, "u\r\nv", None), (7, "http://b", "z" * 99_999),
        (None, "http://c", "<p>é</p>"), (None, "http://d", "alone"), (2, "http://a/y", "<p>é</p>"), (8, "http://e", "abc"), (1, "e", "abc"),
    ]
    path = archive(spark, rows, min_payload=least)
    payloads = [r.payload for r in warc.verified_payloads(spark, path).collect()]
    assert len(payloads) == len(set(map(bytes, payloads))) == 5
    smallest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            smallest[html or ""] = min(page_id, smallest.get(html or "", page_id))
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = smallest.get(html or "")
        again = len(data) >= least and first is not None and page_id != first
        digest = base64.b32encode(sha1(data).digest()).decode()
        expected.append((page_id, len(data), digest, "revisit" if again else "response", first if again else None))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in warc.read_back(spark, path).collect())
    whole = warc.reconstruct(spark, path).collect()
    assert sorted(bytes(r.payload) for r in whole) == sorted((h or "").encode() for _, _, h in rows)
    for r in whole:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert block[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        assert (block[:length].partition(b"\r\n\r\n")[2] == bytes(r.payload)) == (r.record_type == "response" or not r.payload)


def test_damage_is_found_and_empty_archive(spark):
    path = archive(spark, [(1, "u", "text")])
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("address", "encode('texts', 'UTF-8') payload")
    other = f"{path}-{uuid4().hex}"
    bad.write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.verified_payloads(spark, other).collect()
    assert warc.read_back(spark, archive(spark, [])).count() == 0


@pytest.mark.parametrize(
    "pattern, text, message",
    [
        ("sha1:.", "sha1:1", "wrong digest"),
        ("Content-Length: 4", "Content-Length: 5", "wrong payload length"),
        (r"(msgtype=response\r\nContent-Length: )\d+", "$12", "wrong block length"),
    ],
)
@pytest.mark.parametrize("page_id", [1, 2])
def test_headers_that_disagree_with_what_is_held_fail(spark, pattern, text, message, page_id):
    path = archive(spark, [(1, "u", "text"), (2, "v", "text")])
    record = f"decode(header, 'UTF-8') like '%Record-ID: <urn:page:{page_id}>%'"
    changed = spark.read.parquet(f"{path}/records").withColumn("_text", F.decode("header", "UTF-8"))
    changed = changed.withColumn("header", F.when(F.expr(record), F.encode(F.regexp_replace("_text", pattern, text), "UTF-8")).otherwise(F.col("header")))
    other = f"{path}-{uuid4().hex}"
    changed.drop("_text").write.parquet(f"{other}/records")
    spark.read.parquet(f"{path}/payloads").write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match=message):
        warc.read_back(spark, other).collect()


def test_missing_payload_fails(spark):
    path = archive(spark, [(1, "u", "text"), (2, "v", "other")])
    other = f"{path}-{uuid4().hex}"
    spark.read.parquet(f"{path}/payloads").where("payload <> encode('other', 'UTF-8')").write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    for read in (warc.read_back, warc.reconstruct):
        with pytest.raises(Exception, match="no payload of page 2"):
            read(spark, other).collect()


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def brute_rule(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for verdict, rule in rules:
        at = rule.find("/")
        h, p = (rule[:at], rule[at:]) if at >= 0 else (rule, "")
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = min(best or (0, "", ""), (-len(rule), rule, verdict))
    return host, path, best[1] if best else None, best[2] if best else "allow"


def test_rules_equal_brute_force(spark):
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.net", "net", "xnet", "example.com:80", "b.example.org", "com", "", ".com", "é.net", "a.b.c.com"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/x/y", "/EN/", "//en/", "/en/a?b=/es/", "/fr/#/x", "?/en/", "/a.b/\\E/c", "/english/z"]
    urls = [f"{rng.choice(['http', 'https', 'x://y'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "example.com/en/", "://", "http:/x", "http://a\nb.net/es/\n", "http://net/es/" + "x" * 50_000]
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(0, urls[0], "h", "r"), (None, urls[1], None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    for rules in (RULES, [*RULES, ("block", "/fr/"), ("block", "a.net/e"), ("block", "org"), ("allow", "c.com/a.b/\\E/"), ("block", "/")], []):
        result = [tuple(r) for r in judge_urls(pages, rules).collect()]
        assert sorted(map(str, result)) == sorted(str((i, u, *brute_rule(u, rules))) for i, u, _, _ in rows)
    assert judge_urls(pages.limit(0), RULES).count() == 0


def brute_lines(rows, least, cut, run_words=0):
    """Rows are (doc_id, text); equal rows are one text. Works word by word on lists of units (words, characters)."""
    def units_of(text):
        out, at, n = [], 0, 0
        for line in cut(text):
            spans = [m.span() for m in re.finditer(r"\S+", line)]
            words = [line[a:b].lower() for a, b in spans]
            if len(words) >= least:
                out.append((True, " ".join(words), range(n, n + len(words)), range(at, at + len(line))))
            if run_words and len(words) >= 16:
                ends = [i for i, w in enumerate(words[:-1]) if md5(w.encode()).hexdigest()[0] in "012"] + [len(words) - 1]
                for first, last in zip([0, *(e + 1 for e in ends)], ends):
                    stop = spans[last + 1][0] if last + 1 < len(words) else spans[last][1]
                    out.append((False, " ".join(words[first : last + 1]), range(n + first, n + last + 1), range(at + spans[first][0], at + stop)))
            at, n = at + len(line), n + len(words)
        return out

    first = {}
    texts = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    for doc in texts:
        for unit in units_of(doc[1]):
            first.setdefault(unit[:2], (doc, unit[3].start))
    out = []
    for doc in rows:
        if doc[1] is not None:
            repeated = [u for u in units_of(doc[1]) if first[u[:2]] != (doc, u[3].start)]
            words = {w for u in repeated for w in u[2]}
            gone = set()
            for whole, _, own, chars in repeated:
                low, high = own[0], own[-1]
                while low - 1 in words:
                    low -= 1
                while high + 1 in words:
                    high += 1
                if whole or high + 1 - low >= run_words:
                    gone |= set(chars)
            doc = (doc[0], "".join(c for i, c in enumerate(doc[1]) if i not in gone))
        out.append(doc)
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    lines = [" ".join(rng.choices(["The", "of", "zwölf", "b", "c"], k=rng.randint(0, 6))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(50)]
    rows += [rows[3], rows[3], (None, "\n".join(lines)), (60, None), (61, ""), (62, "\n\n"), (63, (lines[0] + " x y z\n") * 3000)]
    docs = spark.createDataFrame([(*r, "s", 7, None) for r in rows], "doc_id bigint, text string, start string, _a int, removed_spans string")
    result = remove_repeated_units(docs, min_words=3, run_words=0)
    assert result.columns == docs.columns
    collected = result.collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in collected))) == sorted(map(str, brute_lines(rows, 3, lambda t: t.splitlines(True))))
    texts = dict(rows)
    for r in collected:
        edges = [0, *(e for s in r.removed_spans for e in s), len(texts[r.doc_id] or "")]
        assert r.text is None or r.text == "".join((texts[r.doc_id] or "")[a:b] for a, b in zip(edges[::2], edges[1::2]))
    assert remove_repeated_units(docs.limit(0)).count() == 0


def test_passages_inside_lines_equal_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"Wort{n}" for n in range(400)] + ["the", "é", "x1"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [words(n) for n in (20, 52, 60, 80, 300)]
    rows = []
    for n in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += words(rng.randint(0, 40)) + (rng.choice(passages) if rng.random() < 0.6 else [])
        text = "".join(w + rng.choice([" ", " ", " ", " ", "  ", "\t", ".\n" if rng.random() < 0.3 else " "]) for w in parts)
        rows.append((n, text))
    # A passage of 200 words, in the middle of unlike lines and over their ends.
    long = words(200)
    planted = [(100 + n, f"unlike beginning {n} of this line {n}{n} " + " ".join(long[:120]) + "\n" + " ".join(long[120:]) + f" and its end {n} is so") for n in range(4)]
    rows += planted + [rows[3], rows[3], (None, rows[5][1]), (None, rows[6][1] + " z"), (200, None), (201, ""), (202, " ".join(passages[4]) * 30)]
    docs = spark.createDataFrame([(*r, "s", 7, None) for r in rows], "doc_id bigint, text string, whole string, _a int, removed_spans string")
    for run_words in (16, 40):
        result = remove_repeated_units(docs, run_words=run_words).collect()
        expected = brute_lines(rows, 1, lambda t: t.splitlines(True), run_words)
        assert sorted(map(str, ((r.doc_id, r.text) for r in result))) == sorted(map(str, expected))
    texts = {r.doc_id: r.text for r in result}
    assert texts[100] == planted[0][1]
    for doc_id, text in planted[1:]:
        assert len(texts[doc_id].split()) < 60 and texts[doc_id].startswith(text[:20]) and texts[doc_id].endswith(text[-10:])
    # A phrase that texts share by chance stays.
    docs = spark.createDataFrame([(n, f"{' '.join(words(20))} this short phrase here {' '.join(words(20))}") for n in range(5)], "doc_id bigint, text string")
    assert sorted(map(tuple, remove_repeated_units(docs).select("doc_id", "text").collect())) == sorted(map(tuple, docs.collect()))


def test_paragraphs(spark):
    docs = spark.createDataFrame([(1, "one two\nthree\n\nfour five\n"), (2, "x y\n\nONE  two three\n \nz w")], "doc_id bigint, text string")
    assert [r.text for r in remove_repeated_units(docs, PARAGRAPH, 2, 0).orderBy("doc_id").collect()] == ["one two\nthree\n\nfour five\n", "x y\n\nz w"]


def test_short_lines_are_units_too(spark):
    docs = spark.createDataFrame([(1, "}\na b\n\n"), (2, "x\n}\n\n A  B\n"), (3, "}"), (4, "\n \n")], "doc_id bigint, text string")
    result = remove_repeated_units(docs).orderBy("doc_id").collect()
    assert [r.text for r in result] == ["}\na b\n\n", "x\n\n", "", "\n \n"]
    assert [[tuple(s) for s in r.removed_spans] for r in result] == [[], [(2, 4), (5, 11)], [(0, 1)], []]


@pytest.mark.parametrize("at_once", [1, 40, 1 << 18])
def test_units_of_many_texts_at_once_equal_those_cut_one_by_one(monkeypatch, at_once):
    rng = random.Random(21)
    vocabulary = [f"w{n}" for n in range(60)] + ["Été", "NEW", "İx", "日本", "ß", "x\u00a0y", "tab\tbed"]
    blanks = [" "] * 30 + ["  ", "\t", "\u2003", "\n", "\n\n", " \n "]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(blanks) for _ in range(rng.randrange(120))) for _ in range(60)]
    texts += ["", "\n", "  one  ", " ".join(f"w{n}" for n in range(50)), "\u00a0 " + " ".join(vocabulary)]
    # Every digest passes.
    every = np.full(1 << 17, 255, np.uint8)
    monkeypatch.setattr(line_dedup, "WORDS_AT_ONCE", at_once)
    for unit, min_words, run_words in ((line_dedup.LINE, 1, 16), (PARAGRAPH, 2, 16), (line_dedup.LINE, 3, 0)):
        pattern, expected = re.compile(unit), []
        for row, text in enumerate(texts):
            before = 0
            for m in pattern.finditer(text):
                spans = [w.span() for w in re.finditer(r"\S+", text[: m.end()]) if w.start() >= m.start()]
                words = [text[a:b].lower() for a, b in spans]
                if len(words) >= min_words:
                    expected.append((" ".join(words), row, *m.span(), before, before + len(words), True))
                first = 0
                for i, word in enumerate(words if run_words and len(words) >= 16 else []):
                    if md5(word.encode()).hexdigest()[0] in "012" or i + 1 == len(words):
                        end = spans[i + 1][0] if i + 1 < len(words) else spans[i][1]
                        expected.append((" " + " ".join(words[first : i + 1]), row, spans[first][0], end, before + first, before + i + 1, False))
                        first = i + 1
                before += len(words)
        columns = ("row", "start", "end", "w0", "w1", "whole")
        found, digests = [], []
        for part in line_dedup.units(texts, pattern, min_words, run_words, every):
            found += [(a.tobytes() + b.tobytes(), *r) for a, b, r in zip(part["d1"], part["d2"], zip(*(part[c].tolist() for c in columns)))]
        for part in line_dedup.units(texts, pattern, min_words, run_words):
            digests += [(a.tobytes() + b.tobytes(), row) for a, b, row in zip(part["d1"], part["d2"], part["row"].tolist())]
        expected = [(blake2b(words.encode(), digest_size=16).digest(), *rest) for words, *rest in expected]
        assert sorted(found) == sorted(expected) and sorted(digests) == sorted(e[:2] for e in expected)
