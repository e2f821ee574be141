"""Queries over the item transition graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import graph as G
from marquee.plans.queries_samples import SQL_ORDER
from marquee.plans.registry import query, sql
from marquee.sources.adapters import USER_HISTORY, ratings_table

PAIRS_CTE = f"""linked AS (SELECT "movieId" AS src, lead("movieId") OVER (PARTITION BY "userId" ORDER BY {SQL_ORDER}) AS dst
    FROM ratings WHERE rating >= 3.5)"""
COUNTS_CTE = "pair_counts AS (SELECT src, dst, count(*)::BIGINT AS cnt FROM linked WHERE dst IS NOT NULL GROUP BY 1, 2)"


def pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return G.item_pair_counts(G.adjacent_pairs(ratings_table(spark, sf), USER_HISTORY))


@query("item_pair_counts", sql("ratings", "SELECT * FROM pair_counts", PAIRS_CTE, COUNTS_CTE))
def q_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pair_counts(spark, sf)


@query(
    "transition_matrix",
    sql(
        "ratings",
        "SELECT src, dst, cnt, round(cnt / sum(cnt) OVER (PARTITION BY src), 9) AS prob FROM pair_counts",
        PAIRS_CTE,
        COUNTS_CTE,
    ),
)
def q_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return G.transition_matrix(pair_counts(spark, sf)).withColumn("prob", F.round("prob", 9))


@query(
    "item_distribution",
    sql(
        "ratings",
        """SELECT src AS item, sum(cnt)::BIGINT AS cnt,
                  round(sum(cnt)::DOUBLE / (SELECT sum(cnt) FROM pair_counts), 9) AS prob
           FROM pair_counts GROUP BY 1""",
        PAIRS_CTE,
        COUNTS_CTE,
    ),
)
def q_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return G.item_distribution(pair_counts(spark, sf)).withColumn("prob", F.round("prob", 9))


# Stated workload sizes.
WALKS = 20_000
LENGTH = 10
SEED = 42


def _sql_draw(walk: str, step: str) -> str:
    pieces = []
    for p in (str(SEED), walk, step):
        pieces += [f"length(({p})::VARCHAR)::VARCHAR", "':'", f"({p})::VARCHAR"]
    return f"concat('0x', substr(md5(concat({', '.join(pieces)})), 1, 15))::BIGINT"


_PIECE = f"concat('0x', substr(md5(src::VARCHAR), 1, 15))::BIGINT % {G.PIECES}"

WALK_CTES = (
    PAIRS_CTE,
    COUNTS_CTE,
    """edges AS MATERIALIZED (SELECT src, dst, cnt, sum(cnt) OVER (PARTITION BY src ORDER BY dst) AS hi,
         sum(cnt) OVER (PARTITION BY src) AS total FROM pair_counts)""",
    f"""nodes AS MATERIALIZED (SELECT item, cnt, sum(cnt) OVER (ORDER BY piece, item) AS hi, sum(cnt) OVER () AS total
         FROM (SELECT src AS item, {_PIECE} AS piece, sum(cnt) AS cnt FROM pair_counts GROUP BY 1, 2))""",
    "sources AS MATERIALIZED (SELECT DISTINCT src, total FROM edges)",
    f"""walk AS (
         SELECT walk_id, 0 AS step, item FROM
           (SELECT range AS walk_id, {_sql_draw('range', '0')} % (SELECT max(total) FROM nodes) AS slot FROM range({WALKS}))
           JOIN nodes ON slot >= hi - cnt AND slot < hi
         UNION ALL
         SELECT w.walk_id, w.step + 1, e.dst FROM walk w JOIN sources s ON s.src = w.item
           JOIN edges e ON e.src = w.item
            AND {_sql_draw('w.walk_id', 'w.step + 1')} % s.total >= e.hi - e.cnt
            AND {_sql_draw('w.walk_id', 'w.step + 1')} % s.total < e.hi
         WHERE w.step + 1 < {LENGTH})""",
)


@query(
    "random_walks",
    sql(
        "ratings",
        "SELECT walk_id, count(*)::BIGINT AS n, string_agg(item::VARCHAR, ' ' ORDER BY step) AS walk FROM walk GROUP BY 1",
        *WALK_CTES,
        recursive=True,
    ),
)
def q_walks(spark: SparkSession, sf: str) -> DataFrame:
    walks = G.random_walks(pair_counts(spark, sf), WALKS, LENGTH, SEED, "md5")
    return walks.select(
        "walk_id", F.size("items").cast("bigint").alias("n"), F.array_join(F.col("items").cast("array<string>"), " ").alias("walk")
    )


@query(
    "walk_step",
    sql(
        "ratings",
        "SELECT walk_id, max(CASE WHEN step = 0 THEN item END) AS first, max(CASE WHEN step = 1 THEN item END) AS second FROM walk WHERE step < 2 GROUP BY 1",
        *WALK_CTES,
        recursive=True,
    ),
)
def q_step(spark: SparkSession, sf: str) -> DataFrame:
    walks = G.random_walks(pair_counts(spark, sf), WALKS, 2, SEED, "md5")
    return walks.select("walk_id", F.get("items", F.lit(0)).alias("first"), F.get("items", F.lit(1)).alias("second"))
