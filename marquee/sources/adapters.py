"""Views of the test tables as the library's input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.durable import written
from marquee.functions.encoders import epoch_seconds
from marquee.operators.histories import History

# Order of one user's ratings in the adapted table; total up to identical rows.
RATING_TIES = ("l_orderkey", "l_linenumber", "movieId", "rating")
USER_HISTORY = History(ties=RATING_TIES)
MOVIE_HISTORY = History(keys=("movieId",), ties=("l_orderkey", "l_linenumber", "userId", "rating"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line: the customer rates the part by its quantity."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
    )


def ratings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapted ratings, written once: for plans that read ratings several
    times and would repeat the join of orders and lines each time."""
    return written(ratings(spark, sf_dir), "ratings")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    year = (F.lit(1970) + F.col("p_size")).cast("string")
    return p.select(
        F.col("p_partkey").alias("movieId"),
        F.concat("p_name", F.lit(" ("), year, F.lit(")")).alias("title"),
        F.concat("p_type", F.lit("|"), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("|"), "p_brand").alias("genres"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("movieId"),
        F.lpad(key.cast("string"), 7, "0").alias("imdbId"),
        F.when(key % 90 != 0, (key * 7).cast("string")).alias("tmdbId"),
    )


def tag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("userid"),
        tag.alias("tagid"),
        F.col("event_type").alias("actiontype"),
        F.col("value").alias("score"),
        epoch_seconds(F.col("ts")).alias("ts"),
        F.when(F.col("event_type").isin("click", "purchase"), 1).otherwise(0).alias("label"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("emb"), "label"
    )


VECTOR_DIM = 64


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("probability"),
    )
