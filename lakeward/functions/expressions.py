"""Small column builders shared by the operators.

Everything here is a composition of built-in Spark expressions, so plans stay
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: ColumnOrName) -> Column:
    """Lower-case text without surrounding blanks."""
    return F.lower(F.trim(as_column(value)))


def tolerant_cast(value: ColumnOrName, data_type: DataType) -> Column:
    """Cast that yields NULL for unreadable input; under ANSI mode a plain cast fails the job.

    A whole number may be written with a point (``5.0``); a fraction (``5.5``) is not one and yields NULL.
    """
    text = as_column(value)
    if isinstance(data_type, IntegralType):
        text = F.regexp_replace(text.cast("string"), r"^(\s*[+-]?\d+)\.0*(\s*)$", "$1$2")
    return text.try_cast(data_type)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator`` with NULL for a zero denominator."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def ladder(steps: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """First matching label of ``(label, SQL predicate)`` steps; a NULL predicate falls through."""
    chain = None
    for label, predicate in steps:
        condition = F.expr(predicate)
        chain = F.when(condition, F.lit(label)) if chain is None else chain.when(condition, F.lit(label))
    return F.lit(otherwise) if chain is None else chain.otherwise(F.lit(otherwise))


def mean2(value: ColumnOrName) -> Column:
    """Average rounded to two places."""
    return F.round(F.avg(as_column(value)), 2)


def mean_percent2(rate: ColumnOrName) -> Column:
    """Average of a two-place rate, as a percentage rounded to two places.

    The rate is summed in whole hundredths. An integer sum is exact, so the result does
    not change with partitioning, as a sum of doubles may when it falls on a rounding tie.
    """
    hundredths = F.round(as_column(rate) * 100).cast("bigint")
    return F.round(F.sum(hundredths) / F.count(hundredths), 2)


def joined_key(*parts: ColumnOrName) -> Column:
    return F.concat_ws("|", *[as_column(p) for p in parts])


def fingerprint(*parts: ColumnOrName) -> Column:
    """SHA-256 of the parts, each written with its length so that no two rows share a text."""
    pieces = []
    for part in parts:
        text = as_column(part).cast("string")
        pieces.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("NULL")))
    return F.sha2(F.concat_ws("|", *pieces), 256)
