"""The corpus pipeline: each stage takes the documents its predecessor kept and applies one operator of lakeward.llm."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeward.llm import bpe_automaton, decontamination, language_id, line_dedup, near_dedup
from lakeward.llm.common import KEY, read, row_key
from lakeward.plans.scratch import scratch_root

# Near duplicates in the pipeline: five-word shingles, a similarity of 0.8.
SIMILAR_PERCENT = 80


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the rejected go. lang stays the table's own."""
    found = language_id.identify(docs.drop("lang_pred", "score", "rejected"), docs)
    return found.where("not rejected").select(*(F.col(f"`{c}`") for c in docs.columns if c in found.columns))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of those with its smallest doc_id; null is larger than any.

    Rows are told apart by doc_id and text, so rows that share an id or have none stay unless they are
    linked. Of several rows with a group's smallest id the first by key stays, once if it repeats. A
    text without words is linked with nothing: each such row stays.
    """
    judged = near_dedup.judged_rows(docs, SIMILAR_PERCENT).where("kept and component is not null")
    chosen = judged.groupBy("component").agg(F.min(F.struct(*KEY)).alias("key")).select("key.*")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    worded = F.coalesce(F.col("text").rlike(r"[^\t-\r ]"), F.lit(False))
    held = docs.where(worded).select(*row_key("doc_id", "text"), row)
    # Equal rows first: one that a third of the table repeats brings a row per map task to the join.
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("_a"))
    held = held.withColumn("_place", place).where("_place = 1").join(chosen, KEY, "left_semi")
    return held.select("_row.*").union(docs.where(~worded))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document has too; n_chars is counted anew."""
    cut = line_dedup.remove_repeated_units(docs)
    chars = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cut.withColumns(chars).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontamination.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return bpe_automaton.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_near_duplicates),
    ("substring_dedup", cut_repeated_lines),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Language models, MinHash samples and token automata have no SQL form; a test replays the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each stage's documents are written and read again."""
    docs = read(spark, sf_dir, "documents")
    root = scratch_root(spark, f"pipeline-{uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{root}/{name}")
            docs = spark.read.parquet(f"{root}/{name}")
    return docs
