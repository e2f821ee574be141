"""URL filters: host rules, and pattern rules indexed by their rarest literal token.

DataFrame functions only.  A rule table has any number of rows; distinct URLs are
exploded into lookup keys (the host's suffixes, no deeper than the deepest rule
host, and the URL's distinct tokens) and joined to the rules by key.  Host rules
then test the path prefix; only pattern rules fetched by a token run their regular
expression.

Pattern syntax: ``||`` stands for a host or label start, ``^`` for a character
that is no letter, digit, ``_ - . %`` or the end, ``*`` for anything; the rest is
literal.  A pattern without a complete literal token is looked up by the empty
token, which every URL has.

Defined results: NULL or a URL without ``://`` has an empty host and path and no
host rule, and its patterns see the empty text for NULL; equal URLs get equal
verdicts and repeated rows stay; other columns of the pages stay, but those with
the names of results give way.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The host rules of the query's contract.
HOST_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# Pattern rules of the query: unwanted hosts, and exceptions that win over them.
PATTERN_RULES = [
    ("||spam-farm.", "block"),
    ("||cheap-pills.", "block"),
    ("||casino-*.", "block"),
    ("-casino.", "block"),
    ("||link-farm.", "block"),
    ("/adserver/", "block"),
    ("?utm_source=spam^", "block"),
    ("||spam-farm.example.com/about^", "allow"),
]

RULE_COLUMNS = ["host", "path", "rule", "verdict"]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty without ``://``."""
    plain = F.coalesce(url, F.lit(""))
    at = F.locate("://", plain)
    rest = F.when(at > 0, F.substring(plain, at + 3, F.length(plain))).otherwise(F.lit(""))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(authority) + 1, F.greatest(F.length(rest), F.lit(1)))
    return lower_ascii(authority), F.regexp_extract(after, r"^[^?#]*", 0)


def pattern_regex(pattern: str) -> str:
    """Regular expression, for lower-case URLs, of a pattern."""
    out = ""
    body = pattern.lower()
    if body.startswith("||"):
        out, body = r"^[a-z0-9+.-]*://([^/?#]*\.)?", body[2:]
    for c in body:
        out += {"*": ".*", "^": r"([^a-z0-9_.%-]|$)"}.get(c, re.escape(c))
    return out


def literal_tokens(pattern: str) -> list[str]:
    """Runs of letters and digits that a matching URL has as whole tokens: both ends
    are fixed by a literal neighbour, ``^`` or the ``||`` start."""
    text = pattern.lower()
    if text.startswith("||"):
        text = text[1:]
    found = []
    for m in re.finditer(r"[a-z0-9]+", text):
        before = text[m.start() - 1] if m.start() else "*"
        after = text[m.end()] if m.end() < len(text) else "*"
        if before != "*" and after != "*":
            found.append(m.group())
    return found


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a lower-case URL, the empty one included."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(url, "[^a-z0-9]+")))


def rule_frames(
    spark: SparkSession, host_rules: Sequence[tuple[str, str, str]], pattern_rules: Sequence[tuple[str, str]]
) -> tuple[DataFrame, DataFrame]:
    hosts = spark.createDataFrame([tuple(r) for r in host_rules], "host string, path string, verdict string")
    patterns = spark.createDataFrame(
        [(p, pattern_regex(p), literal_tokens(p) or [""], v) for p, v in pattern_rules],
        "pattern string, regex string, tokens array<string>, verdict string",
    )
    return hosts, patterns


def rarest_tokens(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """Each pattern with the one of its literal tokens that the fewest URLs have."""
    wanted = patterns.select(F.explode("tokens").alias("token")).distinct()
    seen = (
        urls.select(F.explode("tokens").alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = patterns.withColumn("token", F.explode("tokens")).join(seen, "token", "left")
    chosen = ranked.groupBy("pattern", "regex", "verdict").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("rarest")
    )
    return chosen.select("pattern", "regex", "verdict", F.col("rarest.token").alias("token"))


def judge_urls(
    pages: DataFrame,
    host_rules: Sequence[tuple[str, str, str]] = tuple(HOST_RULES),
    pattern_rules: Sequence[tuple[str, str]] = tuple(PATTERN_RULES),
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the host rule that decided, else
    NULL), ``pattern`` (the pattern that decided, else NULL) and ``verdict``.

    The longest fitting host rule decides; without one, an allowing pattern that
    matches, then a blocking one, then ``default``.
    """
    spark = pages.sparkSession
    hosts, patterns = rule_frames(spark, host_rules, pattern_rules)
    depth = max([h.count(".") + 1 for h, _, _ in host_rules], default=1)

    host, path = host_and_path(F.col("_url"))
    distinct = pages.select(F.coalesce(F.col(url), F.lit("")).alias("_url")).distinct()
    parsed = distinct.select("_url", host.alias("_host"), path.alias("_path"))
    labels = F.split(F.col("_host"), r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))), lambda n: F.array_join(F.slice(labels, -n, n), ".")
    )
    urls = parsed.withColumn("_lower", lower_ascii(F.col("_url"))).withColumn("tokens", url_tokens(F.col("_lower")))

    host_index = hosts.select(
        F.lit("host").alias("kind"), F.col("host").alias("key"), F.concat("host", "path").alias("name"), F.col("path").alias("test"), "verdict"
    )
    pattern_index = rarest_tokens(urls, patterns).select(
        F.lit("token").alias("kind"), F.col("token").alias("key"), F.col("pattern").alias("name"), F.col("regex").alias("test"), "verdict"
    )
    as_keys = lambda kind, values: F.transform(values, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))
    keyed = urls.select(
        "_url", "_path", "_lower", F.explode(F.concat(as_keys("host", tails), as_keys("token", F.col("tokens")))).alias("k")
    ).select("_url", "_path", "_lower", "k.kind", "k.key")
    fetched = keyed.join(host_index.unionByName(pattern_index), ["kind", "key"])
    fits = F.when(F.col("kind") == "host", F.startswith(F.col("_path"), F.col("test"))).otherwise(F.expr("_lower rlike test"))
    matched = fetched.filter(fits)
    as_host, as_token = F.col("kind") == "host", F.col("kind") == "token"
    ranked = F.struct((F.col("verdict") == "allow").alias("first"), F.col("name"), F.col("verdict"))
    judged = matched.groupBy("_url").agg(
        F.max(F.when(as_host, F.struct(F.length("name").alias("n"), F.col("name"), F.col("verdict")))).alias("_host_rule"),
        F.max(F.when(as_token, ranked)).alias("_pattern_rule"),
    )
    page_host, page_path = host_and_path(F.col(url))
    results = ["host", "path", "rule", "pattern", "verdict"]
    kept = [F.col(c) for c in pages.columns if c not in results or c == url]
    return (
        pages.select(*kept, F.coalesce(F.col(url), F.lit("")).alias("_url"), page_host.alias("host"), page_path.alias("path"))
        .join(judged, "_url", "left")
        .select(
            *[F.col(c) for c in pages.columns if c not in results],
            "host",
            "path",
            F.col("_host_rule.name").alias("rule"),
            F.when(F.col("_host_rule").isNull(), F.col("_pattern_rule.name")).alias("pattern"),
            F.coalesce("_host_rule.verdict", "_pattern_rule.verdict", F.lit(default)).alias("verdict"),
        )
    )
