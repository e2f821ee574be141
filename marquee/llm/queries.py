"""The registered query of each operator, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import attention_lm, bpe, conversation_repair, decontaminate, html_text, ngram_join, ranked_search, relative_parsing, repetition, resampling, secrets, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, i, i + 3) END AS shingle
        FROM d, range(1, greatest(len(w) - 3, least(len(w), 1)) + 1) t(i)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT u, v FROM common JOIN n a ON u = a.doc_id JOIN n b ON v = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
    reach(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(v) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON d.doc_id = reach.u GROUP BY d.doc_id, n
    """
)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query()
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target texts: those with quality label 1.  The sample is as large a share of all
    documents as they are of the labelled ones."""
    labels = table(spark, sf_dir, "labels").filter("quality is not null")
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    return resampling.resample(table(spark, sf_dir, "documents"), labels.filter("quality = 1"), share)


@query()
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"), "threshold", "flagged")


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, keep=["doc_id"])


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query()
def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return attention_lm.lm_scores(table(spark, sf_dir, "documents"), held_out)


@query(
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
    windows AS (
        SELECT r, g.size AS size, i, list_slice(w, i, i + g.size - 1) AS words
        FROM d, (VALUES (3), ({repetition.MIN_REPEAT}), ({repetition.MAX_LONGEST + 1})) g(size), range(1, len(w) - g.size + 2) t(i)),
    twice AS (
        SELECT r, size, i FROM
        (SELECT r, size, i, count(*) OVER (PARTITION BY r, size, words) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT DISTINCT r, size, i + k AS at FROM twice, range(0, size) t(k)),
    n AS (SELECT r, count(*) FILTER (size = 3) AS n3, count(*) FILTER (size = {repetition.MIN_REPEAT}) AS nc,
        count(*) FILTER (size = {repetition.MAX_LONGEST + 1}) AS nl FROM covered GROUP BY r),
    lines AS (
        SELECT r, count(*) - count(DISTINCT line) AS dups FROM
        (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    counted AS (
        SELECT doc_id, len(w)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
            coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n3, 0)::BIGINT AS n_repeat_words,
            coalesce(nc, 0)::BIGINT AS n_covered_words, coalesce(nl, 0) > 0 AS has_long_repeat
        FROM d LEFT JOIN n USING (r) LEFT JOIN lines USING (r)),
    judged AS (
        SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT_WORDS_PCT} * n_words AS base_failed
        FROM counted)
    SELECT *, NOT base_failed AND NOT has_long_repeat
        AND 100 * n_covered_words <= {repetition.MAX_COVERED_PCT} * n_words AS kept
    FROM judged
    """
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.withColumn("has_long_repeat", F.col("longest_repeat") > repetition.MAX_LONGEST).drop("text", "longest_repeat")


def _spans_sql(rules: list[secrets.Rule]) -> str:
    """One SELECT per rule of (r, kind, rank, start, end)."""
    parts = []
    for rank, rule in enumerate(rules):
        pattern = rule.regex.replace("'", "''")
        parts.append(
            f"""
            SELECT r, '{rule.kind}' AS kind, {rank} AS rank, e - m AS s, e FROM (
                SELECT r, m, g, sum(gap + m) OVER (PARTITION BY r ORDER BY i) AS e FROM (
                    SELECT r, i, length(gaps[i]) AS gap, length(whole[i]) AS m, length(tested[i]) AS g FROM (
                        SELECT r, string_split_regex(text, '{pattern}') AS gaps,
                            regexp_extract_all(text, '{pattern}', 0) AS whole,
                            regexp_extract_all(text, '{pattern}', {rule.group}) AS tested
                        FROM d), range(1, len(whole) + 1) t(i)))
            WHERE g >= {rule.least}"""
        )
    return " UNION ALL ".join(parts)


_BASE_KINDS = [r.kind for r in secrets.BASE_RULES]


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({_spans_sql(secrets.RULES)}),
    found AS (
        SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _BASE_KINDS)},
            string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) FILTER (rank < {len(_BASE_KINDS)}) AS base,
            string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) AS spans
        FROM spans GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in _BASE_KINDS)},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN found USING (r)
    """
)
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    findings, _ = secrets.scan_history(docs)
    base = secrets.of_kinds(F.col("spans"), _BASE_KINDS)
    return findings.select(
        "doc_id",
        *[secrets.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in _BASE_KINDS],
        F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def _like_any(verdict: str) -> str:
    parts = [f"regexp_matches(lower_url, '{url_filters.pattern_regex(p)}')" for p, v in url_filters.PATTERN_RULES if v == verdict]
    return "(" + " OR ".join(parts or ["false"]) + ")"


@query(
    rf"""
    WITH u AS (
        SELECT page_id, coalesce(url, '') AS url,
            translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_url,
            CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
    p AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u),
    r(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(str(r) for r in url_filters.HOST_RULES)}),
    hosts AS (SELECT DISTINCT host, path FROM p),
    best AS (
        SELECT host, path, arg_max(rule_host || rule_path, (length(rule_host || rule_path), rule_host || rule_path)) AS rule,
            arg_max(rule_verdict, (length(rule_host || rule_path), rule_host || rule_path)) AS rule_verdict
        FROM hosts JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path)
    SELECT page_id, p.host, p.path, rule,
        coalesce(rule_verdict, CASE WHEN {_like_any("allow")} THEN 'allow' WHEN {_like_any("block")} THEN 'block' ELSE 'allow' END) AS verdict
    FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
    """
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages, keep=["page_id", "url"])


_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    f"""
    WITH tf AS (
        SELECT r, doc_id, term, count(*) AS tf FROM
        (SELECT r, doc_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents)) GROUP BY ALL),
    n AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, docs),
    q AS (
        SELECT q, item_id, term, count(*) AS times FROM
        (SELECT q, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark)) GROUP BY ALL),
    scored AS (
        SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
        FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (r), c GROUP BY q, item_id, r, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("item_id", "rank", "doc_id", "score")


@query(
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    windows AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS words FROM d, range(1, len(w) - 11) t(i)),
    firsts AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
    gone AS (SELECT DISTINCT r, i + k AS pos FROM windows JOIN firsts USING (words), range(0, 13) t(k) WHERE least < doc_id),
    removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
    placed AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY pos) AS text FROM placed ANTI JOIN gone USING (r, pos) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
    """
)
def op11_relative_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relative_parsing.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    broken = conversation_repair.damaged(turns)
    repair = conversation_repair.repair_conversations(broken)
    found = turns.select("conv_id").distinct()
    for part in (conversation_repair.turn_gaps(broken), repair.summary, repair.digests()):
        other = part.withColumnRenamed("conv_id", "_conv_id")
        found = found.join(other, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
