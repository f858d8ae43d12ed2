"""URL rules, indexed by their rarest literal token; DataFrame functions only.

A rule is a host with an optional path prefix, such as ``example.com/en/``. Its literal tokens
are the labels of its host and the closed segments of its path: a URL that the rule fits has
them all. The rule is filed under the one that fewest URLs have. A URL asks for the rules filed
under its own tokens, and only those are tried as regular expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str]  # verdict and pattern

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# What a rule without literal tokens is filed under; every URL has it.
ANY = ""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _tokens(host: Column, closed_path: Column) -> Column:
    """Labels and segments, told apart by a mark, with ``ANY``."""
    labels = F.transform(F.split(host, r"\."), lambda t: F.concat(F.lit("."), t))
    segments = F.transform(F.split(closed_path, "/"), lambda t: F.concat(F.lit("/"), t))
    named = F.filter(F.concat(labels, segments), lambda t: F.length(t) > 1)
    return F.array_distinct(F.concat(F.array(F.lit(ANY)), named))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def rule_index(rules: DataFrame, token_counts: DataFrame) -> DataFrame:
    """Rules (rule, verdict) with the token each is filed under and the expression that tries it.

    Equal counts go to the longer token, then to the smaller one. A token that no URL has counts 0.
    """
    slash = F.instr("rule", "/")
    host = F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule"))
    path = F.when(slash > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("")
    host = F.translate(host, UPPER, UPPER.lower())
    closed = F.regexp_extract(path, r"(?s)^(.*/)", 1)  # the last segment may go on in the URL
    own = rules.select("rule", "verdict", host.alias("h"), path.alias("p"), F.explode(_tokens(host, closed)).alias("token"))
    counted = own.join(token_counts, "token", "left")
    n = F.when(F.col("token") == ANY, F.lit(1 << 62)).otherwise(F.coalesce("n", F.lit(0)))
    best = counted.groupBy("rule", "verdict", "h", "p").agg(
        F.min(F.struct(n.alias("n"), (-F.length("token")).alias("l"), "token"))["token"].alias("token")
    )
    tried = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), _quoted(F.col("h")), _quoted(F.col("p")))
    return best.select("rule", "verdict", "token", tried.alias("tried"), F.concat("h", "p").alias("fitted"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row of ``pages``.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; the path what follows up to ``?``, ``#`` or the end; both are empty for a null url
    or one without ``://``. A rule fits its host and all subdomains if the path starts with the
    rule's. The longest rule wins; of equally long ones, the smallest by (rule, verdict). Where
    none fits, rule is null and the verdict is ``default``. Rows are judged alike wherever they
    repeat. Extra columns are not read. Without rules, all get the default.

    Each distinct host and path is judged once. A host that a third of all rows share is
    reduced before the shuffle; the join back is split by adaptive execution.
    """
    parsed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    places = parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("rows"))
    tokens = places.select("host", "path", "rows", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    listed = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in sorted(set(rules))))
    table = pages.sparkSession.range(1).select(F.inline(listed.cast("array<struct<rule:string,verdict:string>>")))
    counts = tokens.groupBy("token").agg(F.sum("rows").alias("n"))
    index = rule_index(table, counts)
    fits = tokens.join(index, "token").where(F.regexp_like(F.concat("host", "path"), "tried"))
    longest = F.min(F.struct((-F.length("fitted")).alias("l"), "rule", "verdict"))
    best = fits.groupBy("host", "path").agg(longest.alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
