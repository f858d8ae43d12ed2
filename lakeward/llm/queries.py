"""The registered queries of the text operators: each applied to its whole table with its usual parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import bpe_automaton, chunk_dedup, collocations, decontamination, hard_negatives, language_id, line_dedup
from lakeward.llm import near_dedup, suffix_dedup, token_counts, topk, url_rules, warc
from lakeward.llm.common import read
from lakeward.plans.scratch import scratch_root

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
MAX_TOKENS = 4096


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_root(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_back(spark, path)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_repeated_units(read(spark, sf_dir, "documents"))
    shown = F.transform("removed_spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return cut.select("doc_id", "text", F.size("removed_spans").alias("n_removed"), F.array_join(shown, ",").alias("removed_spans"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language_id.fold(F.col("doc_id")) == 0, F.lit(False))
    found = language_id.identify(docs.select("doc_id", "text"), docs)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_strings(read(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("bigint")
    return cut.select("doc_id", "n_bytes", "n_removed", n_spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (
        op1_warc, op2_decontamination, op3_substring_dedup, op4_url_filters, op5_token_counts,
        op6_bpe, op7_language_id, op8_suffix_dedup, op9_topk, op10_near_dedup,
        op11_collocations, op12_exact_dedup, op13_hard_negatives,
    )
    return {query.__name__: query for query in own} | {"pipeline": corpus_pipeline.run}


_RULES = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express at a bearable cost; tests hold the others against brute force."""
    base32 = " || ".join(
        f"translate(lpad(to_base(CAST('0x' || substr(h, {1 + 5 * i}, 5) AS BIGINT), 32), 4, '0'), "
        f"'0123456789ABCDEFGHIJKLMNOPQRSTUV', '{warc.BASE32}')"
        for i in range(8)
    )
    return {
        "op1_warc": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
 d AS (SELECT page_id, b, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first_id FROM p)
SELECT page_id, octet_length(b) AS payload_bytes, {base32} AS payload_digest,
 CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d""",
        "op2_decontamination": """
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents),
 iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM benchmark),
 iw5 AS (SELECT item_id, w, least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
 ds AS (SELECT DISTINCT doc_id, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM iw5))),
 its AS (SELECT DISTINCT item_id, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM iw5)),
 n AS (SELECT item_id, count(*) AS n_shingles FROM its GROUP BY item_id),
 c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN its USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM c JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
        "op3_substring_dedup": """
WITH l AS (SELECT doc_id, i, lines[i] || CASE WHEN i < len(lines) THEN chr(10) ELSE '' END AS line
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))),
 p AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l),
 t AS (SELECT doc_id, i, j, s, length(line) AS size, pieces[j] AS piece, lower(regexp_extract(pieces[j], '\\S+')) AS word,
  length(regexp_extract(pieces[j], '\\S+')) AS n FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS j
   FROM (SELECT *, regexp_extract_all(line, '\\s*\\S+') AS pieces FROM p))),
 w AS (SELECT *, s + sum(length(piece)) OVER line_so_far AS e, s + sum(length(piece)) OVER line_so_far - n AS b,
  row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS pos, count(*) OVER (PARTITION BY doc_id, i) AS n_words,
  coalesce(sum(CAST(md5(word)[1] IN ('0', '1', '2') AS INT)) OVER (PARTITION BY doc_id, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment
  FROM t WINDOW line_so_far AS (PARTITION BY doc_id, i ORDER BY j)),
 f AS (SELECT *, coalesce(lead(b) OVER (PARTITION BY doc_id, i ORDER BY j), e) AS next_b FROM w),
 u AS (SELECT doc_id, true AS whole, string_agg(word, ' ' ORDER BY j) AS unit, min(s) AS b, min(s) + min(size) AS e, min(pos) AS w0, max(pos) + 1 AS w1
   FROM f GROUP BY doc_id, i
  UNION ALL SELECT doc_id, false, string_agg(word, ' ' ORDER BY j), min(b), max(next_b), min(pos), max(pos) + 1 FROM f WHERE n_words >= 16 GROUP BY doc_id, i, segment),
 r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY whole, unit ORDER BY doc_id, b) AS place FROM u) WHERE place > 1),
 r2 AS (SELECT *, CAST(w0 > coalesce(max(w1) OVER (PARTITION BY doc_id ORDER BY w0, w1 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS new FROM r),
 r3 AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY w0, w1 DESC ROWS UNBOUNDED PRECEDING) AS run FROM r2),
 r4 AS (SELECT *, max(w1) OVER (PARTITION BY doc_id, run) - min(w0) OVER (PARTITION BY doc_id, run) AS run_words FROM r3),
 c AS (SELECT *, CAST(b > coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS INT) AS new_cut
  FROM r4 WHERE whole OR run_words >= 16),
 c2 AS (SELECT doc_id, min(b) AS b, max(e) AS e FROM (SELECT *, sum(new_cut) OVER (PARTITION BY doc_id ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS cut FROM c) GROUP BY doc_id, cut),
 k AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS from_c FROM c2),
 o AS (SELECT doc_id, count(*) AS n, max(k.e) AS last_e, string_agg(CAST(b AS BIGINT) || '-' || CAST(k.e AS BIGINT), ',' ORDER BY b) AS spans,
  string_agg(substr(text, CAST(from_c + 1 AS BIGINT), CAST(b - from_c AS BIGINT)), '' ORDER BY b) AS kept FROM k JOIN documents USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CASE WHEN n IS NULL THEN text ELSE kept || substr(text, CAST(last_e + 1 AS BIGINT)) END AS text,
 CAST(coalesce(n, 0) AS INT) AS n_removed, coalesce(spans, '') AS removed_spans FROM documents LEFT JOIN o USING (doc_id)""",
        "op4_url_filters": f"""
WITH u AS (SELECT row_number() OVER () AS k, page_id,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{url_rules.UPPER}', '{url_rules.UPPER.lower()}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
 r AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS p
  FROM (VALUES {_RULES}) t(verdict, rule)),
 f AS (SELECT k, rule, r.verdict, row_number() OVER (PARTITION BY k ORDER BY length(rule) DESC, rule) AS place FROM u JOIN r
  ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM f WHERE place = 1) USING (k)""",
        "op9_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
 FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
        "op11_collocations": """
WITH p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM
  (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents)),
 g AS (SELECT lang, w[i:i + m - 1] AS w, m, count(*) AS f FROM
  (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) t(m)) GROUP BY ALL),
 n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang),
 c AS (SELECT * FROM g WHERE m > 1 AND f >= 30),
 inner_parts AS (SELECT lang, w[i:i + k - 1] AS w, max(f) AS over FROM
  (SELECT lang, w, f, k, unnest(range(1, m - k + 2)) AS i FROM c, (VALUES (2), (3)) t(k) WHERE k < m) GROUP BY ALL),
 cut AS (SELECT lang, w, m, f, unnest(range(1, m)) AS k FROM c),
 s AS (SELECT cut.*, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * cut.f // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score FROM cut
  JOIN g l ON l.lang = cut.lang AND l.w = cut.w[1:k] JOIN g r ON r.lang = cut.lang AND r.w = cut.w[k + 1:cut.m]),
 best AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS place FROM s),
 left_over AS (SELECT lang, array_to_string(w, ' ') AS phrase, f AS a, l, r, score FROM best LEFT JOIN inner_parts USING (lang, w)
  WHERE place = 1 AND NOT coalesce(100 * CAST(over AS HUGEINT) >= 80 * CAST(f AS HUGEINT), false)),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
        "op12_exact_dedup": """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS x FROM documents),
 g AS (SELECT doc_id, x, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM g""",
        "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, CAST(list_dot_product(a.e, d.e) AS BIGINT) AS score
  FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
  row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
 n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE place <= 5 AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
    }
