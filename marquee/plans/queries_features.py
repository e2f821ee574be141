"""Queries over column functions and feature transforms."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.durable import written
from marquee.functions import encoders as E
from marquee.functions import numeric as N
from marquee.functions import text as T
from marquee.operators import aggregates as A
from marquee.operators import encoding as M
from marquee.operators import feature_layout as FL
from marquee.operators import histories as H
from marquee.operators.metrics import check_labels
from marquee.operators.samples import with_int_id
from marquee.plans.queries_samples import GENRE_INDEX_CTE, KEY, SQL_KEY, _YEAR
from marquee.plans.registry import query, sql
from marquee.sources import layouts as LA
from marquee.sources.adapters import VECTOR_DIM, item_vectors, movies, ratings, tag_samples

# -------------------------------------------------------------- text


@query(
    "title_and_year",
    sql(
        "movies",
        f"""SELECT "movieId", {_YEAR} AS "releaseYear", trim(regexp_replace(title, '\\s*\\(\\d{{4}}\\)\\s*$', '')) AS name FROM movies""",
    ),
)
def q_title(spark: SparkSession, sf: str) -> DataFrame:
    title = F.col("title")
    return movies(spark, sf).select("movieId", T.release_year(title).alias("releaseYear"), T.strip_year(title).alias("name"))


@query(
    "genre_slots",
    sql(
        "movies",
        """SELECT "movieId", len(string_split(genres, '|'))::INTEGER AS n, string_split(genres, '|')[1] AS "movieGenre1",
                  string_split(genres, '|')[2] AS "movieGenre2", string_split(genres, '|')[3] AS "movieGenre3",
                  string_split(genres, '|')[4] AS "movieGenre4" FROM movies""",
    ),
)
def q_slots(spark: SparkSession, sf: str) -> DataFrame:
    genres = F.col("genres")
    return movies(spark, sf).select("movieId", F.size(T.split_genres(genres)).alias("n"), *T.genre_slots(genres, 4))


@query("explode_genres", sql("genre_rows", "SELECT * FROM genre_rows"))
def q_explode(spark: SparkSession, sf: str) -> DataFrame:
    return movies(spark, sf).select("movieId", T.explode_genres(F.col("genres")).alias("genre"))


@query(
    "round_2dp",
    sql(
        "ratings",
        """SELECT "movieId", format('{:.2f}', avg(rating))::DOUBLE AS avg2, format('{:.2f}', stddev_samp(rating))::DOUBLE AS dev2,
                  format('{:.2f}', avg(rating)) AS "avgText" FROM ratings GROUP BY 1""",
    ),
)
def q_round(spark: SparkSession, sf: str) -> DataFrame:
    stats = ratings(spark, sf).groupBy("movieId").agg(F.avg("rating").alias("a"), F.stddev_samp("rating").alias("d"))
    return stats.select(
        "movieId", T.round_2dp(F.col("a")).alias("avg2"), T.round_2dp(F.col("d")).alias("dev2"), T.format_2dp(F.col("a")).alias("avgText")
    )


@query(
    "sequence_text",
    sql(
        "movies",
        """SELECT "movieId", array_to_string(string_split(genres, '|'), ' ') AS text,
                  len(string_split(array_to_string(string_split(genres, '|'), ' '), ' '))::INTEGER AS n FROM movies""",
    ),
)
def q_sequence_text(spark: SparkSession, sf: str) -> DataFrame:
    joined = movies(spark, sf).select("movieId", T.sequence_text(T.split_genres(F.col("genres"))).alias("text"))
    return joined.withColumn("n", F.size(T.sequence_items(F.col("text"))))


@query(
    "time_ordered_items",
    sql(
        "ratings",
        """SELECT "userId", l_orderkey, string_agg("movieId"::VARCHAR, ' ' ORDER BY "timestamp", "movieId") AS items
           FROM ratings GROUP BY 1, 2""",
    ),
)
def q_time_ordered(spark: SparkSession, sf: str) -> DataFrame:
    # One array per order: its size is bounded by the lines of an order.
    events = F.collect_list(F.struct("timestamp", "movieId")).alias("events")
    grouped = ratings(spark, sf).groupBy("userId", "l_orderkey").agg(events)
    items = H.time_ordered_items(F.col("events")).cast("array<string>")
    return grouped.select("userId", "l_orderkey", T.sequence_text(items).alias("items"))


# ------------------------------------------------------- numbers

@query(
    "clip_scale",
    sql(
        "tags",
        """SELECT event_id, round(least(score, 100.0) / 100.0, 9) AS score100, round(least(score * 10, 400.0) / 400.0, 9) AS ctr400,
                  round(least(score, 26.0) / 260.0, 9) AS weight260 FROM tags""",
    ),
)
def q_clip(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("score")
    return tag_samples(spark, sf).select(
        "event_id",
        F.round(N.clip_scale(s, 100.0), 9).alias("score100"),
        F.round(N.clip_scale(s * 10, 400.0), 9).alias("ctr400"),
        F.round(N.clip_scale(s, 26.0, 260.0), 9).alias("weight260"),
    )


@query(
    "sigmoid_and_labels",
    sql(
        "ratings",
        f"""SELECT {SQL_KEY}, round(1 / (1 + exp(-(rating - 3))), 9) AS p,
                   format('{{:.2f}}%', 100 / (1 + exp(-(rating - 3)))) AS percent,
                   CASE WHEN rating >= 3.5 THEN 'Good Rating' ELSE 'Bad Rating' END AS verdict FROM ratings""",
    ),
)
def q_sigmoid(spark: SparkSession, sf: str) -> DataFrame:
    p = N.sigmoid(F.col("rating") - 3)
    verdict = T.label_text((F.col("rating") >= 3.5).cast("int"))
    return ratings(spark, sf).select(*KEY, F.round(p, 9).alias("p"), T.percent_text(p).alias("percent"), verdict.alias("verdict"))


@query(
    "softmax",
    sql(
        "vectors",
        """SELECT id, pos, round(exp(v - m) / z, 9) AS p FROM (
             SELECT id, unnest(emb) AS v, generate_subscripts(emb, 1)::INTEGER - 1 AS pos, list_max(emb) AS m,
                    list_sum(list_transform(emb, lambda x: exp(x - list_max(emb)))) AS z FROM vectors)""",
    ),
)
def q_softmax(spark: SparkSession, sf: str) -> DataFrame:
    soft = item_vectors(spark, sf).select("id", N.softmax(F.col("emb")).alias("p"))
    return soft.select("id", F.posexplode("p").alias("pos", "p")).withColumn("p", F.round("p", 9))


@query(
    "argmax_label",
    sql(
        "vectors",
        """SELECT id, 'dim' || (list_position(emb, list_max(emb)) - 1) AS best FROM vectors""",
    ),
)
def q_argmax(spark: SparkSession, sf: str) -> DataFrame:
    labels = [f"dim{i}" for i in range(VECTOR_DIM)]
    return item_vectors(spark, sf).select("id", N.argmax_label(F.col("emb"), labels).alias("best"))


# ------------------------------------------------------- vectors

NEIGHBOURS = "JOIN vectors b ON b.id = a.id + 1"


def _neighbours(spark: SparkSession, sf: str) -> DataFrame:
    v = item_vectors(spark, sf).select("id", "emb")
    following = v.select((F.col("id") - 1).alias("id"), F.col("emb").alias("nxt"))
    return v.join(following, "id")


@query(
    "vector_products",
    sql(
        "vectors",
        f"""SELECT a.id, round(list_dot_product(a.emb, b.emb), 6) + 0.0 AS dot,
                   round(list_dot_product(a.emb, b.emb) / (sqrt(list_dot_product(a.emb, a.emb)) * sqrt(list_dot_product(b.emb, b.emb))), 6) + 0.0 AS cosine,
                   round(sqrt(list_sum(list_transform(list_zip(a.emb, b.emb), lambda z: (z[1] - z[2]) ** 2))), 6) AS euclidean
            FROM vectors a {NEIGHBOURS}""",
    ),
)
def q_products(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.col("emb"), F.col("nxt")
    return _neighbours(spark, sf).select(
        "id",
        F.round(N.dot(a, b), 6).alias("dot"),
        F.round(N.cosine(a, b), 6).alias("cosine"),
        F.round(N.euclidean(a, b), 6).alias("euclidean"),
    )


@query(
    "interaction_features",
    sql(
        "vectors",
        f"""SELECT id, pos, round(v, 6) + 0.0 AS v FROM (SELECT id, unnest(f) AS v, generate_subscripts(f, 1)::INTEGER - 1 AS pos FROM (
              SELECT a.id, list_concat(list_concat(list_transform(list_zip(a.emb, b.emb), lambda z: z[1] - z[2]), a.emb),
                     list_concat(b.emb, list_transform(list_zip(a.emb, b.emb), lambda z: z[1] * z[2]))) AS f
              FROM vectors a {NEIGHBOURS}))""",
    ),
)
def q_interaction(spark: SparkSession, sf: str) -> DataFrame:
    both = _neighbours(spark, sf).select("id", F.posexplode(N.interaction_features(F.col("emb"), F.col("nxt"))).alias("pos", "v"))
    return both.withColumn("v", F.round("v", 6))


# ---------------------------------------------------------- encoders

def sql_md5(text: str) -> str:
    """Bucket number of a text; NULL, which ``concat`` would skip, stays NULL."""
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def sql_md5_tuple(*parts: str) -> str:
    pieces: list[str] = []
    for p in parts:
        text = f"coalesce(({p})::VARCHAR, '')"
        pieces += [f"length({text})::VARCHAR", "':'", text]
    return sql_md5(f"concat({', '.join(pieces)})")


@query(
    "hash_bucket",
    sql(
        "tags",
        f"""SELECT event_id, {sql_md5('tagid::VARCHAR')} % 5000 AS tag_bucket, {sql_md5('actiontype')} % 100 AS action_bucket,
                   {sql_md5('userid::VARCHAR')} % 200 AS user_bucket FROM tags""",
    ),
)
def q_hash(spark: SparkSession, sf: str) -> DataFrame:
    return tag_samples(spark, sf).select(
        "event_id",
        E.hash_bucket(F.col("tagid"), 5000, "md5").alias("tag_bucket"),
        E.hash_bucket(F.col("actiontype"), 100, "md5").alias("action_bucket"),
        E.hash_bucket(F.col("userid"), 200, "md5").alias("user_bucket"),
    )


@query(
    "cross_bucket",
    sql("tags", f"SELECT event_id, {sql_md5_tuple('tagid', 'userid')} % 10000 AS tag_user, {sql_md5_tuple('actiontype', 'tagid')} % 10000 AS action_tag FROM tags"),
)
def q_cross(spark: SparkSession, sf: str) -> DataFrame:
    return tag_samples(spark, sf).select(
        "event_id",
        E.cross_bucket([F.col("tagid"), F.col("userid")], 10_000, "md5").alias("tag_user"),
        E.cross_bucket([F.col("actiontype"), F.col("tagid")], 10_000, "md5").alias("action_tag"),
    )


ACTIONS = ["view", "click", "purchase"]


@query(
    "vocab_index",
    sql(
        "tags",
        "SELECT event_id, coalesce(list_position(['view', 'click', 'purchase'], actiontype), 0)::INTEGER - 1 AS action_index FROM tags",
    ),
)
def q_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return tag_samples(spark, sf).select("event_id", E.vocab_index(F.col("actiontype"), ACTIONS).alias("action_index"))


@query(
    "vocab_index_join",
    sql(
        "ratings movies",
        """SELECT "userId", "movieId", l_orderkey, l_linenumber, coalesce(i, -1)::BIGINT AS brand_index FROM ratings
           LEFT JOIN (SELECT "movieId", substr(string_split(genres, '|')[3], 7)::BIGINT AS i FROM movies
                      WHERE substr(string_split(genres, '|')[3], 7)::BIGINT < 20) USING ("movieId")""",
    ),
)
def q_vocab_join(spark: SparkSession, sf: str) -> DataFrame:
    number = F.substring(T.genre_slot(F.col("genres"), 3), 7, 10).cast("bigint")
    vocab = movies(spark, sf).select(F.col("movieId").alias("value"), number.alias("index")).filter(F.col("index") < 20)
    return M.vocab_index_join(ratings(spark, sf), "movieId", vocab, "brand_index").select(
        "userId", "movieId", "l_orderkey", "l_linenumber", "brand_index"
    )


@query(
    "identity_index",
    sql("ratings", f"""SELECT {SQL_KEY}, CASE WHEN "movieId" < 1001 THEN "movieId" END AS movie_index, "userId" AS user_index FROM ratings"""),
)
def q_identity(spark: SparkSession, sf: str) -> DataFrame:
    r = ratings(spark, sf)
    users = r.agg((F.max("userId") + 1).alias("n")).scalar()
    return r.select(
        *KEY,
        E.identity_index(F.col("movieId"), 1001, "null").alias("movie_index"),
        E.identity_index(F.col("userId"), users, "raise").alias("user_index"),
    )


_CASES = " + ".join(f"CASE WHEN score / 10 >= {b} THEN 1 ELSE 0 END" for b in E.W2V_SCORE_BOUNDS)


@query("bucketize", sql("tags", f"SELECT event_id, {_CASES} AS bucket FROM tags"))
def q_bucketize(spark: SparkSession, sf: str) -> DataFrame:
    return tag_samples(spark, sf).select("event_id", E.bucketize(F.col("score") / 10, E.W2V_SCORE_BOUNDS).alias("bucket"))


@query(
    "indicator",
    sql(
        "tags",
        "SELECT event_id, 3 AS size, CASE WHEN actiontype IN ('view', 'click', 'purchase') THEN list_position(['view', 'click', 'purchase'], actiontype)::INTEGER - 1 END AS hot FROM tags",
    ),
)
def q_indicator(spark: SparkSession, sf: str) -> DataFrame:
    indexed = tag_samples(spark, sf).select("event_id", E.vocab_index(F.col("actiontype"), ACTIONS).alias("i"))
    encoded = M.indicator(indexed, "i", len(ACTIONS), "v").select("event_id", *M.sparse_parts("v"))
    return encoded.select("event_id", "size", F.get("indices", F.lit(0)).alias("hot"))


# ------------------------------------------------------ transforms

@query(
    "one_hot",
    sql("movies", 'SELECT "movieId", (SELECT max("movieId") + 1 FROM movies)::INTEGER AS size, "movieId"::INTEGER AS hot FROM movies'),
)
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    typed = with_int_id(movies(spark, sf), "movieId").select("movieId", "movieIdNumber")
    encoded = M.one_hot(typed, "movieIdNumber", "movieIdVector").select("movieId", *M.sparse_parts("movieIdVector"))
    return encoded.select("movieId", "size", F.get("indices", F.lit(0)).alias("hot"))


@query("string_index", sql("genre_rows", 'SELECT "movieId", genre, "genreIndex" FROM genre_rows JOIN genre_index USING (genre)', GENRE_INDEX_CTE))
def q_string_index(spark: SparkSession, sf: str) -> DataFrame:
    exploded = movies(spark, sf).select("movieId", T.explode_genres(F.col("genres")).alias("genre"))
    return M.string_index(exploded, "genre", "genreIndex").withColumn("genreIndex", F.col("genreIndex").cast("int"))


@query(
    "multi_hot",
    sql(
        "genre_rows",
        """SELECT "movieId", (SELECT count(*) FROM genre_index)::INTEGER AS size,
                  string_agg("genreIndex"::VARCHAR, ',' ORDER BY "genreIndex") AS hot
           FROM (SELECT DISTINCT "movieId", "genreIndex" FROM genre_rows JOIN genre_index USING (genre)) GROUP BY 1""",
        GENRE_INDEX_CTE,
    ),
)
def q_multi_hot(spark: SparkSession, sf: str) -> DataFrame:
    encoded = M.multi_hot(movies(spark, sf)).select("movieId", *M.sparse_parts("vector"))
    return encoded.select("movieId", "size", F.array_join(F.col("indices").cast("array<string>"), ",").alias("hot"))


STATS_SQL = 'stats AS (SELECT "movieId", count(*)::BIGINT AS "ratingCount", avg(rating) AS "avgRating" FROM ratings GROUP BY 1)'


@query(
    "quantile_bucket_exact",
    sql(
        "ratings",
        f"""SELECT "movieId", "ratingCount", len(list_filter((SELECT list_distinct(quantile_cont("ratingCount"::DOUBLE, [{', '.join(str(i / 100) for i in range(1, 100))}])) FROM stats),
                   lambda b: b <= "ratingCount"))::INTEGER AS bucket FROM stats""",
        STATS_SQL,
    ),
)
def q_quantile_exact(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.movie_rating_stats(ratings(spark, sf)).select("movieId", "ratingCount")
    return M.quantile_bucket_exact(stats, "ratingCount", "bucket", 100)


@query("quantile_bucket", "SELECT true AS ordered, true AS even")
def q_quantile(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.movie_rating_stats(ratings(spark, sf)).select("movieId", "ratingCount")
    bucketed = written(M.quantile_bucket(stats, "ratingCount", "bucket", 100), "bucketed")
    # Buckets are disjoint ranges in order; no bucket of several values holds far more than its share.
    ranges = bucketed.groupBy("bucket").agg(
        F.min("ratingCount").alias("lo"), F.max("ratingCount").alias("hi"), F.count(F.lit(1)).alias("n"), F.countDistinct("ratingCount").alias("kinds")
    )
    before = F.lag("hi").over(W.orderBy("bucket"))
    placed = ranges.withColumn("after", F.coalesce(F.col("lo") > before, F.lit(True)))
    share = F.lit(3) * bucketed.count() / 100 + 3
    return placed.agg(F.bool_and("after").alias("ordered"), F.bool_and((F.col("kinds") == 1) | (F.col("n") <= share)).alias("even"))


@query(
    "min_max",
    sql(
        "ratings",
        """SELECT "movieId", round(CASE WHEN hi = lo THEN 0.5 ELSE ("avgRating" - lo) / (hi - lo) END, 6) AS scaled
           FROM stats, (SELECT min("avgRating") AS lo, max("avgRating") AS hi FROM stats)""",
        STATS_SQL,
    ),
)
def q_min_max(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.movie_rating_stats(ratings(spark, sf)).select("movieId", "avgRating")
    return M.min_max(stats, "avgRating", "scaled").select("movieId", F.round("scaled", 6).alias("scaled"))


@query(
    "rating_feature_stages",
    sql(
        "ratings",
        f"""SELECT "movieId", "ratingCount", round("avgRating", 6) AS vec, round(("avgRating" - lo) / (hi - lo), 6) AS scaled,
                   len(list_filter((SELECT list_distinct(quantile_cont("ratingCount"::DOUBLE, [{', '.join(str(i / 100) for i in range(1, 100))}])) FROM stats),
                   lambda b: b <= "ratingCount"))::INTEGER AS bucket
           FROM stats, (SELECT min("avgRating") AS lo, max("avgRating") AS hi FROM stats)""",
        STATS_SQL,
    ),
)
def q_stages(spark: SparkSession, sf: str) -> DataFrame:
    stats = A.movie_rating_stats(ratings(spark, sf)).select("movieId", "ratingCount", "avgRating")
    out = M.rating_feature_stages(stats, exact=True)
    return out.select(
        "movieId",
        "ratingCount",
        F.round(vector_to_array("avgRatingVec")[0], 6).alias("vec"),
        F.round(vector_to_array("scaleAvgRating")[0], 6).alias("scaled"),
        F.col("ratingCountBucket").cast("int").alias("bucket"),
    )


@query(
    "label_map",
    sql(
        "tags",
        """SELECT event_id, actiontype, i AS "labelIndex", CASE actiontype WHEN 'click' THEN 2.0 WHEN 'purchase' THEN 5.0 ELSE 1.0 END AS weight
           FROM tags JOIN (SELECT actiontype, (row_number() OVER (ORDER BY actiontype) - 1)::INTEGER AS i FROM (SELECT DISTINCT actiontype FROM tags)) USING (actiontype)""",
    ),
)
def q_label_map(spark: SparkSession, sf: str) -> DataFrame:
    mapped = M.label_map(tag_samples(spark, sf), "actiontype")
    weighted = M.class_weights(mapped, "actiontype", {"click": 2.0, "purchase": 5.0})
    return weighted.select("event_id", "actiontype", "labelIndex", "weight")


@query(
    "assemble",
    sql(
        "ratings",
        f"""SELECT {SQL_KEY}, unnest([0, 1, 2])::INTEGER AS position,
                   round(unnest([rating, l_linenumber::DOUBLE, "timestamp" / 86400]), 6) AS value FROM ratings""",
    ),
)
def q_assemble(spark: SparkSession, sf: str) -> DataFrame:
    days = ratings(spark, sf).withColumn("days", F.col("timestamp") / 86400)
    parts = M.assemble(days, ["rating", "l_linenumber", "days"]).select(*KEY, F.posexplode(vector_to_array("features")).alias("position", "value"))
    return parts.withColumn("value", F.round("value", 6))


# Sample files filled from the tag events: the same expression in both engines.
def _cell(name: str, kind: object, number: int) -> str:
    mixed = f"((tagid * {2 * number + 3} + userid * {number + 1} + {number}) % {7 + 3 * number})"
    if isinstance(kind, str):
        # An empty text now and then, and small numbers as texts.
        return f"CASE WHEN {mixed} = 5 THEN NULL ELSE CAST({mixed} % {4 + number} AS STRING) END AS {name}"
    if isinstance(kind, float):
        return f"CASE WHEN {mixed} = 3 THEN NULL ELSE round(score * {mixed} / 50, 4) END AS {name}"
    return f"CAST({mixed} % 2 AS INT) AS {name}"


_TAG_CELLS = [_cell(n, d, i) for i, (n, d) in enumerate(LA.TAG_SAMPLES.items()) if n != "label"]
_LISTING_CELLS = [_cell(n, d, i) for i, (n, d) in enumerate(LA.LISTING_SAMPLES.items()) if n != "label"]
_BEHAVIOUR_CELLS = [
    "CAST(tagid * 1601 AS BIGINT) AS entityid",
    "CAST((tagid * 4999 + userid * 77) % 410000 AS BIGINT) AS cate2",
    "CAST(userid % 40000 AS BIGINT) AS usertag1",
]


def _cells_cte(cells: list[str]) -> str:
    return f"cells AS (SELECT event_id, {', '.join(cells)} FROM tags)"


def _positions_sql(layout: list, table: str, key: str = "event_id") -> str:
    """(key, position, value) of every stored number, in SQL."""
    pairs, at = [], 0
    for f in layout:
        if isinstance(f, FL.Number):
            pairs.append(f"{{'p': {at}, 'v': round(coalesce({f.name}, 0)::DOUBLE, 6)}}")
        else:
            if isinstance(f, FL.Hashed):
                index = f"{sql_md5(f.name + '::VARCHAR')} % {f.width}"
            elif isinstance(f, FL.Words):
                index = f"list_position([{', '.join(repr(w) for w in f.words)}], {f.name}) - 1"
            elif isinstance(f, FL.Identity):
                index = f"CASE WHEN {f.name} >= 0 AND {f.name} < {f.width} THEN {f.name} END"
            elif isinstance(f, FL.Bounded):
                index = f"CASE WHEN {f.name} IS NOT NULL THEN {' + '.join(f'({f.name} >= {b})::INT' for b in f.bounds)} END"
            else:
                index = f"{sql_md5_tuple(*f.names)} % {f.width}"
            pairs.append(f"{{'p': {at} + ({index}), 'v': CASE WHEN ({index}) >= 0 THEN 1.0::DOUBLE ELSE 0.0 END}}")
        at += f.width
    return f"SELECT {key}, x.p::INTEGER AS position, x.v AS value FROM (SELECT {key}, unnest([{', '.join(pairs)}]) AS x FROM {table}) WHERE x.v <> 0"


def _encoded(df: DataFrame, layout: list, key: str = "event_id") -> DataFrame:
    found = FL.encode(df, layout, method="md5").select(key, F.inline(FL.positions("features")))
    return found.select(key, "position", F.round("value", 6).alias("value"))


_TAG_LAYOUT = [*LA.TAG_FEATURES, *LA.TAG_SCORE_BUCKETS]


@query("tag_features", sql("tags", _positions_sql(_TAG_LAYOUT, "cells"), _cells_cte(_TAG_CELLS)))
def q_tag_features(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(tag_samples(spark, sf).selectExpr("event_id", *_TAG_CELLS), _TAG_LAYOUT)


@query("listing_features", sql("tags", _positions_sql(LA.LISTING_FEATURES, "cells"), _cells_cte(_LISTING_CELLS)))
def q_listing_features(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(tag_samples(spark, sf).selectExpr("event_id", *_LISTING_CELLS), LA.LISTING_FEATURES)


@query("behaviour_features", sql("tags", _positions_sql(LA.BEHAVIOUR_FEATURES, "cells"), _cells_cte(_BEHAVIOUR_CELLS)))
def q_behaviour_features(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(tag_samples(spark, sf).selectExpr("event_id", *_BEHAVIOUR_CELLS), LA.BEHAVIOUR_FEATURES)


@query("hashed_features", sql("tags", "SELECT event_id, 262144 AS size, round(2 + score, 6) AS total FROM tags"))
def q_hashed(spark: SparkSession, sf: str) -> DataFrame:
    hashed = M.hashed_features(tag_samples(spark, sf), ["tagid", "actiontype", "score"], categorical=["tagid"])
    total = F.aggregate(F.unwrap_udt(F.col("features"))["values"], F.lit(0.0).cast("double"), lambda a, v: a + v)
    return hashed.select("event_id", M.sparse_parts("features")[0], F.round(total, 6).alias("total"))


@query(
    "check_labels",
    sql("ratings", 'SELECT DISTINCT "movieId" FROM ratings WHERE "movieId" NOT IN (SELECT "movieId" FROM ratings WHERE rating = 5.0)'),
)
def q_check_labels(spark: SparkSession, sf: str) -> DataFrame:
    r = ratings(spark, sf)
    return check_labels(r.filter("rating = 5.0"), r, "movieId")
