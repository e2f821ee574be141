"""Queries over ratings and movies: samples, statistics, histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import text as T
from marquee.operators import aggregates as A
from marquee.operators import histories as H
from marquee.operators import samples as S
from marquee.operators.encoding import string_index
from marquee.plans.registry import query, sql
from marquee.plans.training_samples import movie_half, training_samples
from marquee.sources.adapters import (
    MOVIE_HISTORY,
    RATING_TIES,
    USER_HISTORY,
    links,
    movies,
    ratings,
    ratings_table,
    table,
    tag_samples,
)

KEY = ["userId", "movieId", "timestamp", "l_orderkey", "l_linenumber", "rating"]
SQL_KEY = '"userId", "movieId", "timestamp", l_orderkey, l_linenumber, rating'
SQL_ORDER = '"timestamp", l_orderkey, l_linenumber, "movieId", rating'


def rounded(*names: str, digits: int = 6) -> list:
    return [F.round(n, digits).alias(n) for n in names]


# ---------------------------------------------------------------- sources

@query("ratings", sql("ratings", f"SELECT {SQL_KEY} FROM ratings"))
def q_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return ratings(spark, sf).select(*KEY)


@query("movies", sql("movies", "SELECT * FROM movies"))
def q_movies(spark: SparkSession, sf: str) -> DataFrame:
    return movies(spark, sf)


# ------------------------------------------------- filters and projections

@query("positive_ratings", sql("ratings", f"SELECT {SQL_KEY} FROM ratings WHERE rating >= 3.5"))
def q_positive(spark: SparkSession, sf: str) -> DataFrame:
    return S.positive_ratings(ratings(spark, sf)).select(*KEY)


@query(
    "add_label",
    sql("ratings", f"SELECT {SQL_KEY}, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label FROM ratings"),
)
def q_label(spark: SparkSession, sf: str) -> DataFrame:
    return S.add_label(ratings(spark, sf).select(*KEY))


@query(
    "with_int_id",
    sql(
        "links",
        'SELECT "movieId", TRY_CAST("imdbId" AS INTEGER) AS "imdbNumber", TRY_CAST("tmdbId" AS INTEGER) AS "tmdbNumber" FROM links',
    ),
)
def q_int_id(spark: SparkSession, sf: str) -> DataFrame:
    typed = S.with_int_id(links(spark, sf), "imdbId", out="imdbNumber")
    return S.with_int_id(typed, "tmdbId", out="tmdbNumber").select("movieId", "imdbNumber", "tmdbNumber")


@query(
    "select_rename_drop",
    sql("movies", 'SELECT "movieId" AS item, genres AS "genreText" FROM movies'),
)
def q_rename(spark: SparkSession, sf: str) -> DataFrame:
    return movies(spark, sf).withColumnRenamed("movieId", "item").drop("title").select("item", F.col("genres").alias("genreText"))


@query(
    "attach_scalar",
    sql(
        "ratings",
        """SELECT "movieId", count(*)::BIGINT AS "ratingCount", (SELECT count(*) FROM ratings)::BIGINT AS "sampleCount"
           FROM ratings GROUP BY 1""",
    ),
)
def q_scalar(spark: SparkSession, sf: str) -> DataFrame:
    r = ratings(spark, sf)
    counts = r.groupBy("movieId").agg(F.count(F.lit(1)).alias("ratingCount"))
    return S.attach_scalar(counts, "sampleCount", F.sum("ratingCount"))


@query(
    "fill_missing",
    sql(
        "ratings",
        """SELECT "userId", "movieId", count(*)::BIGINT AS n, round(coalesce(stddev_samp(rating), 0), 6) AS spread
           FROM ratings GROUP BY 1, 2""",
    ),
)
def q_fill(spark: SparkSession, sf: str) -> DataFrame:
    spread = ratings(spark, sf).groupBy("userId", "movieId").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("rating").alias("spread")
    )
    return S.fill_missing(spread).withColumn("spread", F.round("spread", 6))


@query(
    "preview",
    sql("ratings", f"SELECT {SQL_KEY} FROM ratings ORDER BY {SQL_ORDER}, \"userId\" LIMIT 10"),
)
def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    return S.preview(ratings(spark, sf).select(*KEY), 10, ["timestamp", *RATING_TIES, "userId"])


@query(
    "shuffle_samples",
    sql(
        "tags",
        """SELECT event_id, tagid, label,
               row_number() OVER (ORDER BY concat('0x', substr(md5(concat('1:7', length(event_id::VARCHAR)::VARCHAR, ':', event_id::VARCHAR)), 1, 15))::BIGINT, event_id)::BIGINT AS place
           FROM tags""",
    ),
)
def q_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return S.shuffle_samples(tag_samples(spark, sf), ["event_id"], 7, "md5", place="place").select(
        "event_id", "tagid", "label", "place"
    )


# ------------------------------------------------------------------- joins

@query(
    "join_movies",
    sql("ratings movies", f"SELECT {SQL_KEY}, title, genres FROM ratings LEFT JOIN movies USING (\"movieId\")"),
)
def q_join_movies(spark: SparkSession, sf: str) -> DataFrame:
    return S.join_movies(ratings(spark, sf), movies(spark, sf)).select(*KEY, "title", "genres")


@query(
    "join_movie_stats",
    sql(
        "ratings",
        f"""SELECT {SQL_KEY}, "ratingCount", round("avgRating", 6) AS "avgRating"
            FROM ratings LEFT JOIN stats USING ("movieId")""",
        'stats AS (SELECT "movieId", count(*)::BIGINT AS "ratingCount", avg(rating) AS "avgRating" FROM ratings GROUP BY 1)',
    ),
)
def q_join_stats(spark: SparkSession, sf: str) -> DataFrame:
    r = ratings(spark, sf)
    stats = A.movie_rating_stats(r).select("movieId", "ratingCount", "avgRating")
    return S.join_movie_stats(r, stats).select(*KEY, "ratingCount", *rounded("avgRating"))


@query(
    "join_links",
    sql("movies links", 'SELECT "movieId", title, "imdbId", "tmdbId" FROM movies LEFT JOIN links USING ("movieId")'),
)
def q_join_links(spark: SparkSession, sf: str) -> DataFrame:
    return S.join_links(movies(spark, sf), links(spark, sf)).select("movieId", "title", "imdbId", "tmdbId")


# -------------------------------------------------------------- aggregates

@query(
    "rating_histogram",
    sql(
        "ratings",
        """SELECT rating, count(*)::BIGINT AS count,
                  round(count(*)::DOUBLE / (SELECT count(*) FROM ratings), 9) AS percentage
           FROM ratings GROUP BY rating ORDER BY rating""",
    ),
)
def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return A.rating_histogram(ratings(spark, sf)).withColumn("percentage", F.round("percentage", 9))


@query(
    "movie_rating_stats",
    sql(
        "ratings",
        """SELECT "movieId", count(*)::BIGINT AS "ratingCount", round(avg(rating), 6) AS "avgRating",
                  round(var_samp(rating), 6) AS "ratingVar" FROM ratings GROUP BY 1""",
    ),
)
def q_stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.movie_rating_stats(ratings(spark, sf)).select("movieId", "ratingCount", *rounded("avgRating", "ratingVar"))


MOVIE_FEATURES_SQL = """
    SELECT "movieId", count(*)::BIGINT AS "movieRatingCount",
           format('{:.2f}', coalesce(avg(rating), 0))::DOUBLE AS "movieAvgRating",
           format('{:.2f}', coalesce(stddev_samp(rating), 0))::DOUBLE AS "movieRatingStddev"
    FROM ratings GROUP BY 1"""


@query("movie_features", sql("ratings", MOVIE_FEATURES_SQL))
def q_movie_features(spark: SparkSession, sf: str) -> DataFrame:
    return A.movie_features(ratings(spark, sf))


@query("sample_count", sql("ratings", 'SELECT count(*)::BIGINT AS "sampleCount" FROM ratings'))
def q_count(spark: SparkSession, sf: str) -> DataFrame:
    return A.sample_count(ratings(spark, sf))


GENRE_INDEX_CTE = """genre_index AS (
    SELECT genre, (row_number() OVER (ORDER BY count(*) DESC, genre) - 1)::INTEGER AS "genreIndex"
    FROM genre_rows GROUP BY genre)"""


@query(
    "vocabulary_size",
    sql("genre_rows", 'SELECT (max("genreIndex") + 1)::INTEGER AS "vocabularySize" FROM genre_index', GENRE_INDEX_CTE),
)
def q_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return A.vocabulary_size(string_index(_genres(spark, sf), "genre", "genreIndex"), "genreIndex")


def _genres(spark: SparkSession, sf: str) -> DataFrame:
    return movies(spark, sf).select("movieId", T.explode_genres(F.col("genres")).alias("genre"))


@query(
    "collect_genre_indexes",
    sql(
        "genre_rows",
        """SELECT "movieId", string_agg("genreIndex"::VARCHAR, ',' ORDER BY "genreIndex") AS indexes
           FROM (SELECT DISTINCT "movieId", "genreIndex" FROM genre_rows JOIN genre_index USING (genre)) GROUP BY 1""",
        GENRE_INDEX_CTE,
    ),
)
def q_genre_indexes(spark: SparkSession, sf: str) -> DataFrame:
    collected = A.collect_genre_indexes(string_index(_genres(spark, sf), "genre", "genreIndex"))
    return collected.select("movieId", F.array_join(F.col("genreIndexes").cast("array<string>"), ",").alias("indexes"))


GENRE_PREFERENCE_CTES = (
    """genre_cnt AS (SELECT "userId", genre, count(*)::BIGINT AS cnt FROM ratings JOIN genre_rows USING ("movieId")
                     WHERE rating >= 3.5 GROUP BY 1, 2)""",
    """preference AS (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY cnt DESC, genre)::INTEGER AS rank FROM genre_cnt)""",
)


@query(
    "genre_preference",
    sql("ratings genre_rows", 'SELECT "userId", genre, cnt, rank FROM preference WHERE rank <= 5', *GENRE_PREFERENCE_CTES),
)
def q_preference(spark: SparkSession, sf: str) -> DataFrame:
    return A.genre_preference(ratings(spark, sf), movies(spark, sf), 5).select("userId", "genre", "cnt", "rank")


@query(
    "movie_profile",
    sql(
        "ratings movies",
        """SELECT m."movieId", m.title, coalesce(n, 0)::BIGINT AS "ratingNumber", round(coalesce(a, 0), 6) AS "averageRating", "topUsers"
           FROM movies m LEFT JOIN (SELECT "movieId", count(*) AS n, avg(rating) AS a FROM ratings GROUP BY 1) USING ("movieId")
           LEFT JOIN best USING ("movieId")""",
        """best AS (SELECT "movieId", string_agg("userId" || ':' || (rating * 10)::INTEGER, ' ' ORDER BY r) AS "topUsers" FROM (
             SELECT *, row_number() OVER (PARTITION BY "movieId"
               ORDER BY rating DESC, "timestamp", l_orderkey, l_linenumber, "userId") AS r FROM ratings)
           WHERE r <= 10 GROUP BY 1)""",
    ),
)
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    ties = ("timestamp", "l_orderkey", "l_linenumber", "userId")
    profile = A.movie_profile(ratings(spark, sf), movies(spark, sf), ties=ties)
    best = F.transform(
        "topRatings", lambda r: F.concat(r["userId"].cast("string"), F.lit(":"), (r["score"] * 10).cast("int").cast("string"))
    )
    return profile.select(
        "movieId", "title", "ratingNumber", *rounded("averageRating"), F.array_join(best, " ").alias("topUsers")
    )


USER_STATS_SQL = """SELECT "userId", count(*)::BIGINT AS "userRatingCount", round(avg(rating), 6) AS "userAvgRating",
    round(stddev_samp(rating), 6) AS "userRatingStddev" FROM ratings {where} GROUP BY 1"""


@query("user_features", sql("ratings", USER_STATS_SQL.format(where="")))
def q_user_features(spark: SparkSession, sf: str) -> DataFrame:
    return A.user_features(ratings(spark, sf)).select(
        "userId", "userRatingCount", *rounded("userAvgRating", "userRatingStddev")
    )


@query(
    "user_profile",
    sql(
        "ratings",
        USER_STATS_SQL.format(where="WHERE \"userId\" IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    ),
)
def q_user_profile(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("userId"))
    return A.user_profile(ratings(spark, sf), wanted).select(
        "userId", "userRatingCount", *rounded("userAvgRating", "userRatingStddev")
    )


@query(
    "movie_lookup",
    sql(
        "ratings movies",
        """SELECT "movieId", title, count(rating)::BIGINT AS "ratingNumber", round(coalesce(avg(rating), 0), 6) AS "averageRating"
           FROM movies LEFT JOIN ratings USING ("movieId")
           WHERE "movieId" IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1, 2""",
    ),
)
def q_movie_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("movieId"))
    return A.movie_lookup(ratings(spark, sf), movies(spark, sf), ids).select("movieId", "title", "ratingNumber", *rounded("averageRating"))


@query(
    "popular_by_genre",
    sql(
        "ratings genre_rows",
        """SELECT genre, rank, "movieId", round("averageRating", 6) AS "averageRating", "ratingNumber" FROM (
             SELECT *, row_number() OVER (PARTITION BY genre ORDER BY "averageRating" DESC, "movieId")::INTEGER AS rank
             FROM (SELECT g.genre, g."movieId", coalesce(n, 0)::BIGINT AS "ratingNumber", coalesce(a, 0) AS "averageRating"
                   FROM (SELECT DISTINCT * FROM genre_rows) g
                   LEFT JOIN (SELECT "movieId", count(*) AS n, avg(rating) AS a FROM ratings GROUP BY 1) USING ("movieId")))
           WHERE rank <= 10""",
    ),
)
def q_popular(spark: SparkSession, sf: str) -> DataFrame:
    return A.popular_by_genre(ratings(spark, sf), movies(spark, sf), 10).select(
        "genre", "rank", "movieId", *rounded("averageRating"), "ratingNumber"
    )


def _popular_sql(measure: str, where: str = "true") -> str:
    return sql(
        "ratings genre_rows",
        rf"""SELECT genre, rank, "movieId", "ratingNumber", "releaseYear" FROM (
             SELECT *, row_number() OVER (PARTITION BY genre ORDER BY "{measure}" DESC, "movieId")::INTEGER AS rank
             FROM (SELECT g.genre, "movieId", coalesce(n, 0)::BIGINT AS "ratingNumber", regexp_extract(title, '(\d{{4}}).$', 1)::INTEGER AS "releaseYear"
                   FROM (SELECT DISTINCT * FROM genre_rows WHERE {where}) g JOIN movies USING ("movieId")
                   LEFT JOIN (SELECT "movieId", count(*) AS n FROM ratings GROUP BY 1) USING ("movieId")))
           WHERE rank <= 10""",
    )


_POPULAR = ["genre", "rank", "movieId", "ratingNumber", "releaseYear"]


@query("popular_by_number", _popular_sql("ratingNumber"))
def q_popular_number(spark: SparkSession, sf: str) -> DataFrame:
    return A.popular_by_genre(ratings(spark, sf), movies(spark, sf), 10, "number").select(*_POPULAR)


@query("newest_of_genre", _popular_sql("releaseYear", "genre = 'Brand#11'"))
def q_newest(spark: SparkSession, sf: str) -> DataFrame:
    return A.popular_by_genre(ratings(spark, sf), movies(spark, sf), 10, "releaseYear", "Brand#11").select(*_POPULAR)


# --------------------------------------------------------------- histories

SEQUENCES_CTE = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY {SQL_ORDER}) - 1 AS pos
    FROM ratings WHERE rating >= 3.5)"""


@query(
    "user_sequences",
    sql(
        "ratings",
        """SELECT "userId", (pos // 1000)::BIGINT AS chunk, count(*)::BIGINT AS n,
                  string_agg("movieId"::VARCHAR, ' ' ORDER BY pos) AS "movieIdStr" FROM placed GROUP BY 1, 2""",
        SEQUENCES_CTE,
    ),
)
def q_sequences(spark: SparkSession, sf: str) -> DataFrame:
    seqs = H.user_sequences(ratings_table(spark, sf), USER_HISTORY)
    return seqs.select("userId", "chunk", F.size("movieIds").cast("bigint").alias("n"), "movieIdStr")


@query(
    "next_item",
    sql(
        "ratings",
        f"""SELECT "userId", "movieId", "timestamp", l_orderkey, l_linenumber, rating,
                   lead("movieId") OVER (PARTITION BY "userId" ORDER BY {SQL_ORDER}) AS next_item
            FROM ratings WHERE rating >= 3.5""",
    ),
)
def q_next(spark: SparkSession, sf: str) -> DataFrame:
    return H.next_item(S.positive_ratings(ratings_table(spark, sf)), USER_HISTORY).select(*KEY, "next_item")


_BEFORE = f'(PARTITION BY "userId" ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'


@query(
    "user_history_stats",
    sql(
        "ratings",
        f"""SELECT {SQL_KEY}, count(rating) OVER {_BEFORE}::BIGINT AS "userRatingCount",
                   round(avg(rating) OVER {_BEFORE}, 6) AS "userAvgRating",
                   round(stddev_samp(rating) OVER {_BEFORE}, 6) AS "userRatingStddev" FROM ratings""",
    ),
)
def q_history_stats(spark: SparkSession, sf: str) -> DataFrame:
    return H.prior_stats(ratings_table(spark, sf), USER_HISTORY).select(
        *KEY, "userRatingCount", *rounded("userAvgRating", "userRatingStddev")
    )


RECENT_CTES = (
    f"""numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY {SQL_ORDER}) AS seq,
          coalesce(sum(CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END) OVER {_BEFORE}, 0) AS seen FROM ratings)""",
    """positives AS (SELECT "userId", list("movieId" ORDER BY seq) AS liked FROM numbered WHERE rating >= 3.5 GROUP BY 1)""",
    "recent AS (SELECT n.*, "
    + ", ".join(f'CASE WHEN seen >= {i} THEN liked[seen::BIGINT - {i - 1}] ELSE 0 END AS "userRatedMovie{i}"' for i in range(1, 6))
    + ' FROM numbered n LEFT JOIN positives USING ("userId"))',
)
RECENT_COLUMNS = [f"userRatedMovie{i}" for i in range(1, 6)]
SQL_RECENT = ", ".join(f'"{c}"' for c in RECENT_COLUMNS)


@query("recent_items", sql("ratings", f"SELECT {SQL_KEY}, {SQL_RECENT} FROM recent", *RECENT_CTES))
def q_recent(spark: SparkSession, sf: str) -> DataFrame:
    return H.recent_items(ratings_table(spark, sf), 5, USER_HISTORY).select(*KEY, *RECENT_COLUMNS)


@query(
    "top_k_per_group",
    sql(
        "ratings",
        f"""SELECT {SQL_KEY}, rank FROM (SELECT *, row_number() OVER (PARTITION BY "movieId"
              ORDER BY rating DESC, "timestamp", l_orderkey, l_linenumber, "userId")::INTEGER AS rank FROM ratings)
            WHERE rank <= 10""",
    ),
)
def q_top_k(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("rating"), *[F.col(c) for c in ("timestamp", "l_orderkey", "l_linenumber", "userId")]]
    return S.top_k_per_group(ratings(spark, sf), ["movieId"], order, 10).select(*KEY, "rank")


@query(
    "share_of_group",
    sql(
        "ratings",
        """SELECT "userId", rating, n, round(n / sum(n) OVER (PARTITION BY "userId"), 9) AS share
           FROM (SELECT "userId", rating, count(*)::BIGINT AS n FROM ratings GROUP BY 1, 2)""",
    ),
)
def q_share(spark: SparkSession, sf: str) -> DataFrame:
    counts = ratings(spark, sf).groupBy("userId", "rating").agg(F.count(F.lit(1)).alias("n"))
    return S.share_of_group(counts, ["userId"], "n").withColumn("share", F.round("share", 9))


@query(
    "order_by_count",
    sql(
        "genre_rows",
        "SELECT genre, count(*)::BIGINT AS cnt FROM genre_rows GROUP BY 1 ORDER BY cnt DESC, genre",
    ),
)
def q_order_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = _genres(spark, sf).groupBy("genre").agg(F.count(F.lit(1)).alias("cnt"))
    return S.order_by_count(counts, "cnt", "genre")


# ---------------------------------------------------------------- flagship

_YEAR = "coalesce(TRY_CAST(regexp_extract(title, '\\((\\d{4})\\)\\s*$', 1) AS INTEGER), 1990)"
CATALOGUE_CTE = f"""catalogue AS (SELECT "movieId", {_YEAR} AS "releaseYear",
    string_split(genres, '|')[1] AS "movieGenre1", string_split(genres, '|')[2] AS "movieGenre2",
    string_split(genres, '|')[3] AS "movieGenre3" FROM movies)"""
STATS_CTE = f"movie_stats AS ({MOVIE_FEATURES_SQL})"
SQL_MOVIE = '"releaseYear", "movieGenre1", "movieGenre2", "movieGenre3", "movieRatingCount", "movieAvgRating", "movieRatingStddev"'
MOVIE_OUT = ["releaseYear", "movieGenre1", "movieGenre2", "movieGenre3", "movieRatingCount", "movieAvgRating", "movieRatingStddev"]


@query(
    "movie_samples",
    sql(
        "ratings movies",
        f"""SELECT {SQL_KEY}, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label, {SQL_MOVIE}
            FROM ratings LEFT JOIN catalogue USING ("movieId") LEFT JOIN movie_stats USING ("movieId")""",
        CATALOGUE_CTE,
        STATS_CTE,
    ),
)
def q_movie_samples(spark: SparkSession, sf: str) -> DataFrame:
    return movie_half(ratings_table(spark, sf), movies(spark, sf)).select(*KEY, "label", *MOVIE_OUT)


USER_GENRES = [f"userGenre{i}" for i in range(1, 6)]
FAVOURITES_CTE = (
    'favourites AS (SELECT "userId", '
    + ", ".join(f'max(CASE WHEN rank = {i} THEN genre END) AS "userGenre{i}"' for i in range(1, 6))
    + " FROM preference GROUP BY 1)"
)
SAMPLE_OUT = [*KEY, "label", *MOVIE_OUT, "userRatingCount", "userAvgRating", "userRatingStddev", *RECENT_COLUMNS, *USER_GENRES]
HISTORY_CTE = f"""history AS (SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label,
    count(rating) OVER {_BEFORE}::BIGINT AS "userRatingCount",
    round(coalesce(avg(rating) OVER {_BEFORE}, 0), 6) AS "userAvgRating",
    round(coalesce(stddev_samp(rating) OVER {_BEFORE}, 0), 6) AS "userRatingStddev" FROM recent)"""


# Favourites from the positives before each rating only.
FAVOURITES_AS_OF_CTES = (
    """earlier AS (SELECT n."userId", n.seq, g.genre, count(*) AS cnt FROM numbered n
         JOIN numbered p ON p."userId" = n."userId" AND p.seq < n.seq AND p.rating >= 3.5
         JOIN genre_rows g ON g."movieId" = p."movieId" GROUP BY 1, 2, 3)""",
    'favourites AS (SELECT "userId", seq, '
    + ", ".join(f'max(CASE WHEN rank = {i} THEN genre END) AS "userGenre{i}"' for i in range(1, 6))
    + ' FROM (SELECT *, row_number() OVER (PARTITION BY "userId", seq ORDER BY cnt DESC, genre) AS rank FROM earlier) GROUP BY 1, 2)',
)


def _sample_sql(movie_stats_join: str, favourites: tuple[str, ...], on: str, *ctes: str) -> str:
    columns = ", ".join(f'"{c}"' for c in SAMPLE_OUT)
    return sql(
        "ratings genre_rows",
        f"""SELECT {columns} FROM {movie_stats_join} LEFT JOIN catalogue USING ("movieId") LEFT JOIN favourites USING ({on})""",
        CATALOGUE_CTE,
        *RECENT_CTES,
        *favourites,
        HISTORY_CTE,
        *ctes,
    )


@query(
    "training_samples",
    _sample_sql('history LEFT JOIN movie_stats USING ("movieId")', (*GENRE_PREFERENCE_CTES, FAVOURITES_CTE), '"userId"', STATS_CTE),
)
def q_samples(spark: SparkSession, sf: str) -> DataFrame:
    out = training_samples(ratings_table(spark, sf), movies(spark, sf), USER_HISTORY, MOVIE_HISTORY)
    return out.withColumns({c: F.round(c, 6) for c in ("userAvgRating", "userRatingStddev")}).select(*SAMPLE_OUT)


_MOVIE_BEFORE = """(PARTITION BY "movieId" ORDER BY "timestamp", l_orderkey, l_linenumber, "userId", rating
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query(
    "training_samples_as_of",
    _sample_sql(
        "timed",
        FAVOURITES_AS_OF_CTES,
        '"userId", seq',
        f"""timed AS (SELECT *, count(rating) OVER {_MOVIE_BEFORE}::BIGINT AS "movieRatingCount",
              round(coalesce(avg(rating) OVER {_MOVIE_BEFORE}, 0), 6) AS "movieAvgRating",
              round(coalesce(stddev_samp(rating) OVER {_MOVIE_BEFORE}, 0), 6) AS "movieRatingStddev" FROM history)""",
    ),
)
def q_samples_as_of(spark: SparkSession, sf: str) -> DataFrame:
    out = training_samples(ratings_table(spark, sf), movies(spark, sf), USER_HISTORY, MOVIE_HISTORY, scope="as_of")
    doubles = ("userAvgRating", "userRatingStddev", "movieAvgRating", "movieRatingStddev")
    return out.withColumns({c: F.round(c, 6) for c in doubles}).select(*SAMPLE_OUT)
