"""Secret scans with an incremental blob ledger.

DataFrame functions only.  Every version of every path is named by the SHA-256 of
its text.  The ledger holds one row per (blob, rule version) ever scanned, with
the spans found; a run scans each distinct blob that the ledger lacks once, and
joins the ledger back to all paths that hold the blob.

Spans are code points, end exclusive.  A rule finds its leftmost non-overlapping
matches: the texts between them (``split``) and the matches themselves
(``regexp_extract_all``) alternate, so running sums of their lengths give the
places; no marker is put into the text.

Defined results: NULL is the empty text, without spans; versions with equal texts
share one blob and one scan; repeated rows stay; other columns stay, but those
with the names of results give way.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.durable import written


@dataclass(frozen=True)
class Rule:
    """A match counts when ``group`` has ``least`` code points or more; ``base`` rules
    make up the base digest."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    base: bool = False


def either_case(words: str) -> str:
    """Letters of a pattern in either case."""
    return re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


def _private_key() -> str:
    """A private key from its BEGIN line: lines of information, then base64 and white space
    (or escaped line ends, quotes, commas) through the END line; without one, the base64 that follows,
    to the last run of 20 characters or more and one shorter line after it.

    Only character classes repeat without bound, so that long texts need no deep stack.
    """
    kind, white, code = r"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----", r"\x20\x09-\x0D\\", "A-Za-z0-9+/="
    information = r"(?:[\r\nrn\\]+[A-Z][A-Za-z-]*: [^\r\n\\]*){0,9}"
    ended = rf"[{code}{white}\"',]*-----END {kind}"
    open_ended = rf"[{white}]+[{code}]{{20,}}(?:[{code}{white}]*[{code}]{{20,}})?(?:\r?\n(?:[{code}]{{1,62}}=|[{code}]{{1,63}}(?m:$)))?"
    return rf"-----BEGIN {kind}(?:{information}(?:{ended}|{open_ended}))?"


_NAMES = either_case("(password|passwd|secret|token|api_?key)")

# The base rules of the query's contract.
BASE_RULES = [
    Rule("assign", _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
]
RULES = [
    *BASE_RULES,
    Rule("pem", _private_key()),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
]
RULE_VERSION = "1"

SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, text) to (blob, spans): one row per blob, also without spans; spans by start, then rule order."""
    parts = []
    for rank, rule in enumerate(rules):
        lengths = F.arrays_zip(
            F.transform(F.split("text", rule.regex, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0)), F.length).alias("size"),
            F.transform(F.regexp_extract_all("text", F.lit(rule.regex), F.lit(rule.group)), F.length).alias("tested"),
        )
        found = F.array(F.struct(F.lit(rank).alias("rank"), lengths.alias("lengths")))
        none = F.array().cast("array<struct<rank:int,lengths:array<struct<gap:int,size:int,tested:int>>>>")
        parts.append(F.when(F.col("text").rlike(rule.regex), found).otherwise(none))
    places = (
        blobs.select("blob", F.explode_outer(F.concat(*parts)).alias("m"))
        .select("blob", "m.rank", F.posexplode_outer("m.lengths").alias("i", "n"))
        .select("blob", "rank", "i", "n.gap", "n.size", "n.tested")
    )
    running = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce("size", F.lit(0))
    least = F.array(*[F.lit(r.least) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    counted = F.col("size").isNotNull() & (F.col("tested") >= least[F.col("rank")])
    span = F.struct((F.col("end") - F.col("size")).alias("start"), F.col("rank"), F.col("end"), kinds[F.col("rank")].alias("kind"))
    return (
        places.withColumn("end", F.sum(F.col("gap") + size).over(running).cast("int"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.when(counted, span))).cast(SPANS).alias("spans"))
    )


def scan_history(
    versions: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = tuple(RULES),
    rule_version: str = RULE_VERSION,
    ledger: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every version, and the grown ledger.

    ``versions`` has a row per path and version; the findings are its rows with
    ``blob`` and ``spans``.  ``ledger`` (blob, rule_version, spans) is what earlier
    runs returned, or None; blobs it has under ``rule_version`` aren't scanned again.
    """
    addressed = versions.select("*", content_address(F.col(text)).alias("_blob"))
    texts = addressed.select(F.col("_blob").alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if ledger is not None:
        known = ledger.filter(F.col("rule_version") == rule_version).select("blob")
        texts = texts.join(known, "blob", "left_anti")
    unseen = texts.groupBy("blob").agg(F.first("text").alias("text"))
    rows = scan_blobs(unseen, rules).select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    new = written(rows, "ledger")
    grown = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    current = grown.filter(F.col("rule_version") == rule_version).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    kept = [c for c in versions.columns if c not in ("blob", "spans")]
    findings = addressed.join(current, "_blob", "left").select(*kept, F.col("_blob").alias("blob"), F.col("_spans").alias("spans"))
    return findings, grown


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = span["start"] >= state["at"]
        parts = F.when(fresh, F.concat(state["parts"], F.array(gap, F.lit(mark)))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))
