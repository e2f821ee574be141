"""Where a query and its SQL twin are declared side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# The adapted input tables, in SQL.
VIEWS = {
    "ratings": """
        SELECT o_custkey AS "userId", l_partkey AS "movieId", ceil(l_quantity / 5) / 2 AS rating,
               epoch(o_orderdate)::BIGINT AS "timestamp", l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """
        SELECT p_partkey AS "movieId", p_name || ' (' || (1970 + p_size) || ')' AS title,
               p_type || '|' || split_part(p_name, ' ', 1) || '|' || p_brand AS genres
        FROM part""",
    "links": """
        SELECT p_partkey AS "movieId", lpad(p_partkey::VARCHAR, 7, '0') AS "imdbId",
               CASE WHEN p_partkey % 90 <> 0 THEN (p_partkey * 7)::VARCHAR END AS "tmdbId"
        FROM part""",
    "tags": """
        SELECT event_id, user_id AS userid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS tagid,
               event_type AS actiontype, "value" AS score, floor(epoch(ts))::BIGINT AS ts,
               CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS label
        FROM events""",
    "vectors": """
        SELECT vec_id AS id, embedding::DOUBLE[] AS emb, label FROM embeddings""",
    "scored": """
        SELECT doc_id, quality AS label, n_chars::DOUBLE AS score,
               n_chars::DOUBLE / (n_chars + 1000) AS probability
        FROM labels JOIN documents USING (doc_id)""",
    "genre_rows": """
        SELECT "movieId", unnest(string_split(genres, '|')) AS genre FROM movies""",
}
_NEEDS = {"genre_rows": ["movies"]}


def sql(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    """``WITH <adapted tables>, <extra ctes> <body>``."""
    names: list[str] = []
    for v in views.split():
        for need in [*_NEEDS.get(v, []), v]:
            if need not in names:
                names.append(need)
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + list(ctes)
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + f"\n{body}"


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query, with its SQL twin when SQL can say it."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
