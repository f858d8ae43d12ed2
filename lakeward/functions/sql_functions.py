"""SQL functions a session can call by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


def _identifier(text: str) -> str:
    if not _IDENTIFIER.fullmatch(text):
        raise ValueError(f"not a plain SQL identifier: {text!r}")
    return text


def register_range_average(
    spark: SparkSession,
    name: str,
    table: str | DataFrame,
    value: str,
    range_column: str,
    comment: str = "",
    *,
    temporary: bool = True,
) -> str:
    """Create ``name(low DOUBLE, high DOUBLE)``: the average of ``value`` over an inclusive range.

    ``table`` is a catalog table, or a DataFrame that becomes a temporary view. An empty
    range gives NULL. The body is a scalar subquery that Spark inlines at analysis, so a call
    is one filtered aggregation with the range pushed to the scan.
    """
    if isinstance(table, DataFrame):
        view = f"{_identifier(name).replace('.', '_')}_source"
        table.createOrReplaceTempView(view)
        table = view
    note = comment.replace("\\", "\\\\").replace("'", "\\'")
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(
        f"CREATE OR REPLACE {kind} {_identifier(name)}(low DOUBLE, high DOUBLE) RETURNS DOUBLE "
        f"COMMENT '{note}' "
        f"RETURN (SELECT avg({_identifier(value)}) FROM {_identifier(table)} "
        f"WHERE {_identifier(range_column)} BETWEEN low AND high)"
    )
    return name
