"""From bronze rows to silver and quarantine rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeward.datasets import Dataset
from lakeward.functions.expressions import clean_text, joined_key, tolerant_cast
from lakeward.operators.rules import (
    VALIDATION_VERSION,
    drop_flags,
    explain_failures,
    extend_validation,
    failing,
    passing,
    validate,
)

# Newest first; the record hash settles what is still tied.
RECENCY = ("file_modification_time", "processed_timestamp", "file_name")
TIE_BREAKER = "record_hash"


def normalize(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Clean the text columns, give every other declared column its type, add derived columns."""
    # Only text needs the tolerant reading of numbers; a typed column keeps a cast that filters pass through.
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    typed = {
        f.name: tolerant_cast(f.name, f.dataType) if f.name in text else F.col(f.name).try_cast(f.dataType)
        for f in dataset.schema
        if not isinstance(f.dataType, StringType)
    }
    cleaned = {name: clean_text(name) for name in dataset.text_columns}
    out = df.withColumns(typed | cleaned)
    return out.withColumns({name: build() for name, build in dataset.derived.items()}) if dataset.derived else out


def process(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Normalise and validate bronze rows, with indicators and their rules where the feed has them."""
    out = validate(normalize(df, dataset), dataset.rules)
    if dataset.indicators is not None:
        out = extend_validation(dataset.indicators(out), dataset.rules, dataset.indicator_rules)
    return out


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = RECENCY,
    tie_breaker: str = TIE_BREAKER,
) -> DataFrame:
    """Keep the newest row per key.

    The filter sits directly on ``row_number`` so that Spark plans a group limit on both
    sides of the shuffle: each map task sends at most one row per key, which bounds what a
    hot key can bring to one task by the number of map tasks.
    """
    order = [F.col(c).desc_nulls_last() for c in recency] + [F.col(tie_breaker).asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def silver(validated: DataFrame, dataset: Dataset, run_ts: datetime) -> DataFrame:
    """Newest valid row per key, stamped for the silver layer.

    Rows are filtered before the window, so NULL keys and rejected rows never reach the shuffle.
    """
    valid = drop_flags(passing(validated, dataset.all_rules), dataset.all_rules)
    return (
        latest_by(valid, dataset.keys)
        .withColumnRenamed("processed_timestamp", "bronze_processed_timestamp")
        .withColumns(
            {
                "silver_processed_timestamp": F.lit(run_ts),
                "pipeline_stage": F.lit("SILVER"),
                "validation_version": F.lit(VALIDATION_VERSION),
            }
        )
    )


def with_payload(bronze: DataFrame) -> DataFrame:
    """Keep the untouched row beside the columns that normalisation will change."""
    return bronze.withColumn("record_payload", F.struct("*"))


def quarantine(validated: DataFrame, dataset: Dataset, run_ts: datetime) -> DataFrame:
    """Every rejected row with its reasons; no deduplication and no shuffle."""
    source = f"bronze.{dataset.bronze_table}"
    rejected = failing(explain_failures(validated, dataset.all_rules))
    return (
        drop_flags(rejected, dataset.all_rules)
        .withColumnRenamed("processed_timestamp", "bronze_processed_timestamp")
        .withColumns(
            {
                "quarantine_id": F.sha2(joined_key("batch_id", F.lit(source), "record_hash"), 256),
                "source_table": F.lit(source),
                "rejection_timestamp": F.lit(run_ts),
                "pipeline_stage": F.lit("QUARANTINE"),
                "validation_version": F.lit(VALIDATION_VERSION),
            }
        )
    )
