"""The registered text queries equal their SQL; the pipeline equals a replay by brute force and the tokenizers library."""

from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeward.llm import language_id, queries
from lakeward.llm.common import read
from lakeward.llm.line_dedup import MIN_WORDS, RUN_WORDS
from test_archive_rules_lines import brute_lines
from test_search_and_learning import brute_contained, brute_near

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, name, sf):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    result, expected = queries.queries()[name](spark, sf), duck.sql(queries.oracle_sql()[name])
    columns = sorted(result.columns)
    assert sorted(expected.columns) == columns
    assert {c: TYPES[t] for c, t in result.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    places = [expected.columns.index(c) for c in columns]
    assert sorted(str(tuple(row[c] for c in columns)) for row in result.collect()) == sorted(
        str(tuple(row[i] for i in places)) for row in expected.fetchall()
    )


def replay(spark, docs, rejects, items):
    rows = [r for r in docs if r not in rejects]
    kept = {r[0] for r in brute_near(rows, 80) if r[3]}
    rows = sorted({r for r in rows if r[0] in kept}, key=str)
    rows = brute_lines(rows, MIN_WORDS, lambda t: t.splitlines(True), RUN_WORDS)
    rows = [r for r in rows if not brute_contained([r], items)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest()))
    return sorted(out)


def test_pipeline_equals_replay(spark):
    docs = read(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rejects = {(r.doc_id, r.text) for r in language_id.identify(docs).where("rejected").collect()}
    items = [tuple(r) for r in read(spark, SF, "benchmark").select("item_id", "text").collect()]
    result = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in result.collect()) == replay(spark, rows, rejects, items)


def test_stages_on_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, _a bigint, _kept_id int, lang_pred string"
    rows = [(i, f"the house of man number {i} is red", "en", "s", 1, "r", 2, 3, "p") for i in range(9)]
    rows += [(i, f"das haus der frau nummer {i} ist rot", "de", "s", 1, "r", 2, 3, "p") for i in range(20, 29)]
    rows += [rows[0], (None, rows[1][1], *rows[1][2:]), (None,) * 9, (50, "", *rows[0][2:]), (51, None, *rows[0][2:]), (52, "haus " * 30_000, *[None] * 7)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            docs = out
        assert docs.count() == (19 if rows and docs.head() else 0)
        assert corpus_pipeline.encode(spark, docs, SF).count() == docs.count()


def test_near_duplicate_stage_loses_no_unlinked_row(spark):
    def text(word):
        return " ".join(f"{word}{i}" for i in range(30))

    unlinked = [(3, text("a")), (7, text("b")), (8, text("c")), (8, text("d")), (None, text("e")), (None, text("f")), (-1, text("g")), (-1, text("h"))]
    linked = [(7, text("a")), (None, text("b")), (9, text("c") + " more"), (None, text("f")), (3, text("a"))]
    empty = [(7, None), (None, None), (None, " \n"), (8, ""), (None, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(unlinked + linked + empty)], "doc_id bigint, text string, _a int")
    out = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, unlinked + empty))
    # A component that has one id in two linked texts, or none at all, keeps one row.
    pairs = [(5, text("a")), (5, text("a") + " z"), (None, text("b")), (None, text("b") + " z")]
    out = corpus_pipeline.keep_one_of_near_duplicates(spark, spark.createDataFrame(pairs, "doc_id bigint, text string"), SF)
    assert sorted((str(r.doc_id), r.text[0]) for r in out.collect()) == [("5", "a"), ("None", "b")]
