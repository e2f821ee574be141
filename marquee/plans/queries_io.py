"""Queries through text files: each writes given tables to the shared folder and
reads them back with the reader under test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.durable import scratch_path
from marquee.operators.aggregates import movie_profile
from marquee.plans.registry import query, sql
from marquee.sources import readers as RD
from marquee.sources import sinks as SK
from marquee.sources.adapters import VECTOR_DIM, item_vectors, links, movies, ratings, ratings_table, tag_samples


def _csv(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


@query("read_ratings", sql("ratings", 'SELECT "userId"::INTEGER AS "userId", "movieId"::INTEGER AS "movieId", rating, "timestamp" FROM ratings'))
def q_read_ratings(spark: SparkSession, sf: str) -> DataFrame:
    raw = ratings(spark, sf).select("userId", "movieId", "rating", "timestamp")
    return RD.read_ratings(spark, _csv(raw, "ratings-csv"), errors="raise")


@query("read_movies", sql("movies", """SELECT "movieId"::INTEGER AS "movieId", 'A, "' || title || '"' AS title, genres FROM movies"""))
def q_read_movies(spark: SparkSession, sf: str) -> DataFrame:
    # A comma and quotes in each title, written the way CSV files quote them.
    quoted = movies(spark, sf).withColumn("title", F.concat(F.lit('A, "'), "title", F.lit('"')))
    path = scratch_path(spark, "movies-csv")
    quoted.write.option("header", True).option("escape", '"').csv(path)
    return RD.read_movies(spark, path)


@query("read_links", sql("links", 'SELECT "movieId"::INTEGER AS "movieId", "imdbId", "tmdbId" FROM links'))
def q_read_links(spark: SparkSession, sf: str) -> DataFrame:
    return RD.read_links(spark, _csv(links(spark, sf), "links-csv"))


TAG_DEFAULTS = {"label": 0, "event_id": 0, "tagid": "", "score": 0.0, "actiontype": ""}


@query(
    "read_typed_tsv",
    sql(
        "tags",
        """SELECT label, event_id::INTEGER AS event_id, CASE WHEN tagid < 50 THEN tagid::VARCHAR ELSE '' END AS tagid,
                  CASE WHEN score > 20 THEN 0.0 ELSE round(score, 2) END AS score, actiontype FROM tags""",
    ),
)
def q_read_tsv(spark: SparkSession, sf: str) -> DataFrame:
    t = tag_samples(spark, sf)
    sparse = t.select(
        F.concat_ws(
            "\t",
            F.col("label").cast("string"),
            F.col("event_id").cast("string"),
            F.when(F.col("tagid") < 50, F.col("tagid").cast("string")).otherwise(""),
            F.when(F.col("score") > 20, "").otherwise(F.col("score").cast("string")),
            "actiontype",
        ).alias("value")
    )
    path = scratch_path(spark, "tags-tsv")
    sparse.write.text(path)
    back = RD.read_typed_tsv(spark, path, TAG_DEFAULTS)
    return back.withColumn("score", F.round(F.col("score").cast("double"), 2))


NAMED_TYPES = {"label": "int", "tagid": "int", "actiontype": "string", "score": "float", "event_id": "int"}


@query(
    "read_named_csv",
    sql(
        "tags",
        """SELECT label, tagid, actiontype, round(score, 2) AS score, event_id::INTEGER AS event_id FROM tags WHERE actiontype <> 'error'""",
    ),
)
def q_read_named(spark: SparkSession, sf: str) -> DataFrame:
    # Rows of one event type carry text in the numeric tag column: malformed.
    t = tag_samples(spark, sf)
    spoiled = t.withColumn("tagid", F.when(F.col("actiontype") == "error", "bad").otherwise(F.col("tagid").cast("string")))
    path = _csv(spoiled.select("event_id", "tagid", "actiontype", "score", "label"), "tags-csv")
    back = RD.read_named_csv(spark, path, NAMED_TYPES)
    return back.withColumn("score", F.round(F.col("score").cast("double"), 2))


@query(
    "read_matrix_tsv",
    sql(
        "vectors",
        """SELECT id, label, pos, round(v, 6) + 0.0 AS value FROM (
             SELECT id::DOUBLE AS id, label::VARCHAR AS label, unnest(emb) AS v, generate_subscripts(emb, 1)::INTEGER AS pos FROM vectors)""",
    ),
)
def q_read_matrix(spark: SparkSession, sf: str) -> DataFrame:
    cells = F.transform("emb", lambda v: v.cast("string"))
    lines = item_vectors(spark, sf).select(
        F.concat_ws("\t", F.col("label").cast("string"), F.col("id").cast("string"), F.array_join(cells, "\t"), F.lit("last")).alias("value")
    )
    path = scratch_path(spark, "matrix-tsv")
    lines.write.text(path)
    read = RD.read_matrix_tsv(spark, path, columns=VECTOR_DIM + 1)
    cells = read.select("label", F.get("features", F.lit(0)).alias("id"), F.posexplode("features").alias("pos", "value"))
    return cells.filter("pos > 0").select("id", "label", "pos", F.round("value", 6).alias("value"))


@query(
    "embedding_text",
    sql(
        "vectors",
        """SELECT id::VARCHAR AS id, pos, round(v, 6) + 0.0 AS v FROM (SELECT id, unnest(emb) AS v, generate_subscripts(emb, 1)::INTEGER - 1 AS pos FROM vectors)""",
    ),
)
def q_embedding_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "embedding")
    SK.write_embedding_text(item_vectors(spark, sf), path)
    back = SK.read_embedding_text(spark, path).select("id", F.posexplode("emb").alias("pos", "v"))
    return back.withColumn("v", F.round(F.col("v").cast("double"), 6))


@query(
    "export_kv",
    sql(
        "vectors",
        """SELECT 'i2vEmb:' || id AS key, generate_subscripts(emb, 1)::INTEGER - 1 AS pos, round(unnest(emb), 5) + 0.0 AS v,
                  (1700000000 + 86400)::BIGINT AS expires_at FROM vectors""",
    ),
)
def q_export(spark: SparkSession, sf: str) -> DataFrame:
    rows = SK.export_kv(item_vectors(spark, sf), "i2vEmb", F.lit(1_700_000_000))
    parts = rows.select("key", F.posexplode(F.split("value", " ")).alias("pos", "v"), "expires_at")
    return parts.withColumn("v", F.round(F.col("v").cast("float").cast("double"), 5) + F.lit(0.0))


@query(
    "movie_profile_json",
    sql(
        "ratings movies links",
        """SELECT "movieId", title, regexp_extract(title, '(\\d{4}).$', 1)::INTEGER AS "releaseYear", "imdbId", "tmdbId",
                  replace(genres, '|', ',') AS genres, coalesce(n, 0)::BIGINT AS "ratingNumber", round(coalesce(a, 0), 6) AS "averageRating", coalesce(tops, '') AS tops
           FROM movies JOIN links USING ("movieId")
           LEFT JOIN (SELECT "movieId", count(*) AS n, avg(rating) AS a FROM ratings GROUP BY 1) USING ("movieId")
           LEFT JOIN (SELECT "movieId", string_agg("movieId" || ':' || "userId" || ':' || (rating * 10)::INTEGER || ':' || "timestamp", ' ' ORDER BY r) AS tops FROM (
             SELECT *, row_number() OVER (PARTITION BY "movieId" ORDER BY rating DESC, "timestamp", l_orderkey, l_linenumber, "userId") AS r FROM ratings)
             WHERE r <= 10 GROUP BY 1) USING ("movieId")""",
    ),
)
def q_json(spark: SparkSession, sf: str) -> DataFrame:
    ties = ("timestamp", "l_orderkey", "l_linenumber", "userId")
    text = SK.movie_profile_json(movie_profile(ratings_table(spark, sf), movies(spark, sf), ties=ties, links=links(spark, sf)))
    rating = "struct<movieId:bigint,userId:bigint,score:double,timestamp:bigint>"
    shape = (
        "movieId bigint, title string, releaseYear int, imdbId string, tmdbId string, genres array<string>, ratingNumber bigint, "
        f"averageRating double, topRatings array<struct<rating:{rating}>>"
    )
    tops = F.transform(
        "j.topRatings.rating",
        lambda r: F.concat_ws(":", r["movieId"].cast("string"), r["userId"].cast("string"), (r["score"] * 10).cast("int").cast("string"), r["timestamp"].cast("string")),
    )
    plain = [f"j.{c}" for c in ("movieId", "title", "releaseYear", "imdbId", "tmdbId", "ratingNumber")]
    return text.select(F.from_json("json", shape).alias("j")).select(
        *plain,
        F.array_join("j.genres", ",").alias("genres"),
        F.round("j.averageRating", 6).alias("averageRating"),
        F.array_join(tops, " ").alias("tops"),
    )
