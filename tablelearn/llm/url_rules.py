"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens that any
match must contain as whole tokens.  How often these tokens occur in the table's
urls is counted first; each rule is filed under its rarest one (a rule without
tokens under the empty token, which every url has).  The distinct tokens of a url fetch the
candidate rules, and only those run their expressions.  Urls are collapsed to
distinct (host, path) before, so a hot url is judged once.

Two kinds of rules: site rules (host and path prefix; the longest that fits wins) and
patterns, which decide where no site rule fits (block, if any fits; else ``default``).

Defined results: null urls and urls without ``://`` have empty host and path and get the
default; repeated rows come back row by row; an empty table or no rules
give defaults; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower

MAX_BROADCAST_RULES = 20_000  # more rules are joined through the shuffle
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"

# (host, path, action)
SITE_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# (name, expression over host + path, literal tokens, action)
PATTERNS = [
    ("pills", r"^(?:[^/]*[.-])?cheap-pills\.", ("cheap", "pills"), "block"),
    ("casino", r"^(?:[^/]*[.-])?online-casino\.", ("online", "casino"), "block"),
    ("session", r"/(?:login|signup|logout)(?:/|$)", (), "block"),
    ("ads", r"^(?:[^/]*\.)?ads?\.[^/]+\.[a-z]+/", (), "block"),
]


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens(c: Column) -> Column:
    """Distinct lower-case runs of letters and digits (and characters beyond ASCII), and the empty token."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(ascii_lower(c), _SEPARATORS)))


def site_rule(host: str, path: str, action: str) -> tuple:
    """A site rule as (name, expression, whole literal tokens, action, priority)."""
    inner = re.split(_SEPARATORS, host) + re.split(_SEPARATORS, path)[:-1]  # the path may go on after its last token
    return (host + path, f"^(?:[^/]*\\.)?{_quoted(host)}{_quoted(path)}", _lower(inner), action, len(host + path))


def _lower(words: Sequence[str]) -> tuple[str, ...]:
    return tuple(w.translate(str.maketrans(UPPER, LOWER)) for w in words if w)


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in literal)


def judge_urls(pages: DataFrame, site_rules: Sequence[tuple] = SITE_RULES, patterns: Sequence[tuple] = PATTERNS,
               url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule, verdict and pattern (the first pattern that fits, by name)."""
    spark = pages.sparkSession
    results = ("host", "path", "rule", "verdict", "pattern")
    # the row travels as one struct, so no name of pages can clash
    rows = pages.select(F.struct("*").alias("row"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rules = [(*site_rule(*r), True) for r in site_rules]
    rules += [(name, expr, _lower(lits), action, 0, False) for name, expr, lits, action in patterns]
    table = spark.createDataFrame(
        [(i, *r[:2], list(r[2]) or [""], *r[3:]) for i, r in enumerate(rules)],
        "id int, name string, expr string, literals array<string>, action string, priority int, site boolean")

    small = (lambda df: F.broadcast(df)) if len(rules) <= MAX_BROADCAST_RULES else (lambda df: df)
    urls = rows.select("host", "path").distinct()
    asked = urls.select("host", "path", F.explode(tokens(F.concat("host", "path"))).alias("token"))
    literal = table.select("id", F.explode("literals").alias("token"))
    counts = asked.join(small(literal.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("seen"))
    filed = (literal.join(small(counts), "token", "left").groupBy("id")
             .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)), "token"))["token"].alias("token")).join(table, "id"))

    hit = asked.join(small(filed), "token").where(F.regexp_like(F.concat("host", "path"), F.col("expr")))
    best = hit.groupBy("host", "path").agg(
        F.max(F.when(F.col("site"), F.struct("priority", "name", "action"))).alias("_site"),
        F.max(F.when(~F.col("site") & (F.col("action") == "block"), True)).alias("_blocked"),
        F.min(F.when(~F.col("site"), F.col("name"))).alias("_pattern"))
    best = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "_site", "_blocked", "_pattern")
    judged = rows.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    verdict = F.coalesce(F.col("_site.action"), F.when(F.col("_blocked"), F.lit("block")), F.lit(default))
    return judged.select(*(F.col("row")[c].alias(c) for c in pages.columns if c not in results), "host", "path", F.col("_site.name").alias("rule"), verdict.alias("verdict"),
                         F.col("_pattern").alias("pattern"))
