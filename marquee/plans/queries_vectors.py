"""Queries over item vectors: look-ups, neighbours, lists, trained embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.durable import scratch_path, written
from marquee.functions.encoders import hash_bucket
from marquee.functions.numeric import dot, euclidean, vec_sum
from marquee.functions.text import genre_slot
from marquee.operators import embedding as EM
from marquee.operators import graph as G
from marquee.operators import histories as H
from marquee.operators import interactions as IA
from marquee.operators import lsh as LS
from marquee.operators import retrieval as R
from marquee.operators.aggregates import genre_preference
from marquee.operators.samples import join_movies, lookup_embedding, positive_ratings
from marquee.plans.queries_features import sql_md5
from marquee.plans.queries_samples import GENRE_PREFERENCE_CTES, KEY, RECENT_CTES, SQL_KEY
from marquee.plans.registry import query, sql
from marquee.skew import hot_keys, skew_join
from marquee.sources.adapters import USER_HISTORY, VECTOR_DIM, item_vectors, movies, ratings, ratings_table
from marquee.sources.sinks import export_kv, read_embedding_text, write_embedding_text


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Scores are ranked as they are and rounded for the comparison only."""
    return df.withColumns({n: F.round(n, 6) + F.lit(0.0) for n in names})


def _positions(df: DataFrame, *ids: str, emb: str = "emb", digits: int = 6) -> DataFrame:
    return df.select(*ids, F.posexplode(emb).alias("pos", "v")).withColumn("v", F.round("v", digits))


_DOT = "list_dot_product({a}, {b})"
_RAW_COS = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


@query(
    "lookup_embedding",
    sql(
        "ratings vectors",
        f"SELECT {SQL_KEY}, round(coalesce(list_sum(emb), 0), 6) + 0.0 AS total, round(coalesce(emb[1], 0), 6) + 0.0 AS head FROM ratings LEFT JOIN vectors ON id = \"movieId\"",
    ),
)
def q_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = lookup_embedding(ratings(spark, sf), "movieId", item_vectors(spark, sf), VECTOR_DIM)
    total = F.aggregate("emb", F.lit(0.0).cast("double"), lambda a, v: a + v)
    return found.select(*KEY, F.round(total, 6).alias("total"), F.round(F.get("emb", F.lit(0)), 6).alias("head"))


@query(
    "similar_items",
    sql(
        "vectors",
        f"""SELECT id, item, round(score, 6) + 0.0 AS score, rank FROM (SELECT id, item, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, item)::INTEGER AS rank
              FROM (SELECT a.id, b.id AS item, {_RAW_COS.format(a='a.emb', b='b.emb')} AS score FROM vectors a JOIN vectors b ON a.id <> b.id))
            WHERE rank <= 20""",
    ),
)
def q_similar(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.similar_items(item_vectors(spark, sf), 20), "score")


@query(
    "find_synonyms",
    sql(
        "vectors",
        f"SELECT id, round(s, 6) + 0.0 AS similarity FROM (SELECT b.id, {_RAW_COS.format(a='a.emb', b='b.emb')} AS s FROM vectors a JOIN vectors b ON a.id = 158 AND b.id <> 158) ORDER BY s DESC, id LIMIT 20",
    ),
)
def q_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.find_synonyms(item_vectors(spark, sf), 158, 20), "similarity")


_RAW_DIST = "sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) ** 2)))"
_DIST = f"round({_RAW_DIST}, 6)"
# The ten-dimensional sample vector of the search, padded with zeros.
SAMPLE_PROBE = [0.795, 0.583, 1.120, 0.850, 0.174, -0.839, -0.0633, 0.249, 0.673, -0.237] + [0.0] * (VECTOR_DIM - 10)


@query(
    "nearest_k",
    sql("vectors", f"SELECT id, round(d, 6) AS distance FROM (SELECT id, {_RAW_DIST.format(a='emb', b=str(SAMPLE_PROBE))} AS d FROM vectors) ORDER BY d, id LIMIT 5"),
)
def q_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.approx_nearest(item_vectors(spark, sf), SAMPLE_PROBE, 5, exact=True), "distance")


# The stated query set of searches: every vector whose id is divisible by 50.
ASKED = "id % 50 = 0"


@query("approx_nearest", sql("vectors", f"SELECT id, 5::BIGINT AS n, true AS real, true AS recalled FROM vectors WHERE {ASKED}"))
def q_approx(spark: SparkSession, sf: str) -> DataFrame:
    vectors = item_vectors(spark, sf).select("id", "emb")
    asked = vectors.filter(ASKED)
    found = written(LS.lsh_top_k(asked, vectors, 5, VECTOR_DIM, same=True), "nearest")
    true = R.blocked_top_k(asked, vectors, 5, "euclidean", same=True)
    recall = LS.recall_of(found, true, ["id", "item"])
    # Distances are those of the vectors themselves.
    ends = found.join(vectors, "id").join(vectors.select(F.col("id").alias("item"), F.col("emb").alias("other")), "item")
    real = F.abs(F.col("distance") - euclidean(F.col("emb"), F.col("other"))) < 1e-9
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(real).alias("real")).withColumn("recalled", recall >= LS.RECALL)


_UNITS = LS.projections(VECTOR_DIM).tolist()


@query(
    "lsh_buckets",
    sql(
        "vectors",
        'SELECT id, t::INTEGER AS "hashTable", floor(list_dot_product(emb, unit) / 0.1)::BIGINT AS "bucketId" FROM vectors, units',
        f"units AS (SELECT unnest(range({len(_UNITS)})) AS t, unnest({_UNITS}::DOUBLE[][]) AS unit)",
    ),
)
def q_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return LS.lsh_buckets(item_vectors(spark, sf), VECTOR_DIM)


CLOSE = 1.1


@query(
    "similar_pairs",
    sql(
        "vectors",
        f"""SELECT * FROM (SELECT a.id AS id_a, b.id AS id_b, {_DIST.format(a='a.emb', b='b.emb')} AS distance
              FROM reps a JOIN reps b ON a.id < b.id) WHERE distance <= {CLOSE}""",
        "reps AS (SELECT min(id) AS id, emb FROM vectors GROUP BY emb)",
    ),
)
def q_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return R.similar_pairs(item_vectors(spark, sf), CLOSE)


# Every vector and two copies of every seventh.
COPIED = "copied AS (SELECT id, emb FROM vectors UNION ALL SELECT id + 1000000 * k, emb FROM vectors, (VALUES (1), (2)) t(k) WHERE id % 7 = 0)"


def copied_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = item_vectors(spark, sf).select("id", "emb")
    more = v.filter("id % 7 = 0").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    return v.unionByName(more.select((F.col("id") + 1000000 * F.col("k")).alias("id"), "emb"))


@query("copy_classes", sql("vectors", "SELECT min(id) OVER (PARTITION BY emb) AS rep, id FROM copied", COPIED))
def q_classes(spark: SparkSession, sf: str) -> DataFrame:
    return R.copy_classes(copied_vectors(spark, sf))


@query(
    "pairs_of_copies",
    sql(
        "vectors",
        f"""SELECT * FROM (SELECT a.id, b.id AS other, {_DIST.format(a='a.emb', b='b.emb')} AS distance
              FROM copied a JOIN copied b ON a.id <> b.id AND a.id % 10 = 0) WHERE distance <= {CLOSE}""",
        COPIED,
    ),
)
def q_pairs_of(spark: SparkSession, sf: str) -> DataFrame:
    v = copied_vectors(spark, sf)
    return R.pairs_of(R.similar_pairs(v, CLOSE), R.copy_classes(v), v.filter("id % 10 = 0"))


@query("similar_pairs_lsh", "SELECT 0::BIGINT AS wrong, true AS recalled")
def q_pairs_lsh(spark: SparkSession, sf: str) -> DataFrame:
    vectors = item_vectors(spark, sf)
    exact = written(R.similar_pairs(vectors, CLOSE), "pairs")
    found = written(R.similar_pairs(vectors, CLOSE, exact=False, dim=VECTOR_DIM), "pairs")
    # Every found pair is real, with its distance; nine tenths of the real ones are found.
    wrong = found.join(exact, ["id_a", "id_b", "distance"], "left_anti").agg(F.count(F.lit(1)).alias("wrong"))
    return wrong.withColumn("recalled", LS.recall_of(found, exact, ["id_a", "id_b"]) >= LS.RECALL)


USER_VECTOR_CTE = """user_vectors AS (
    SELECT "userId", list(m ORDER BY pos) AS emb FROM (
      SELECT "userId", pos, avg(v) AS m FROM (
        SELECT "userId", unnest(emb) AS v, generate_subscripts(emb, 1) AS pos
        FROM ratings JOIN vectors ON id = "movieId" WHERE rating >= 3.5) GROUP BY 1, 2) GROUP BY 1)"""


def user_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return R.user_embedding(positive_ratings(ratings(spark, sf)), item_vectors(spark, sf))


@query(
    "user_embedding",
    sql(
        "ratings vectors",
        """SELECT "userId", pos, round(v, 6) + 0.0 AS v FROM (
             SELECT "userId", unnest(emb) AS v, generate_subscripts(emb, 1)::INTEGER - 1 AS pos FROM user_vectors)""",
        USER_VECTOR_CTE,
    ),
)
def q_user_embedding(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(user_vectors(spark, sf), "userId")


@query(
    "recommend_for_users",
    sql(
        "ratings vectors",
        """SELECT id, item, round(score, 6) + 0.0 AS score, rank FROM (SELECT id, item, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, item)::INTEGER AS rank FROM (
             SELECT u."userId" AS id, v.id AS item, list_dot_product(u.emb, v.emb) AS score
             FROM user_vectors u CROSS JOIN vectors v
             WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = u."userId" AND r."movieId" = v.id))) WHERE rank <= 10""",
        USER_VECTOR_CTE,
    ),
)
def q_recommend(spark: SparkSession, sf: str) -> DataFrame:
    # Written once, narrow: vectors and seen items both come from the join of orders and lines.
    rated = written(ratings(spark, sf).select("userId", "movieId", "rating"), "rated")
    users = R.user_embedding(positive_ratings(rated), item_vectors(spark, sf)).withColumnRenamed("userId", "id")
    seen = rated.select(F.col("userId").alias("id"), F.col("movieId").alias("item"))
    return _rounded(R.recommend_for_users(users, item_vectors(spark, sf), 10, seen), "score")


_N = "(SELECT count(*) FROM vectors)"


@query(
    "fm_cross_terms",
    sql(
        "ratings vectors genre_rows",
        f"""SELECT {SQL_KEY}, round(coalesce(list_dot_product(i.emb, u.emb), 0), 6) + 0.0 AS item_user,
                   round(coalesce(list_dot_product(ig.emb, ug.emb), 0), 6) + 0.0 AS "itemGenre_userGenre",
                   round(coalesce(list_dot_product(ig.emb, u.emb), 0), 6) + 0.0 AS "itemGenre_user",
                   round(coalesce(list_dot_product(i.emb, ug.emb), 0), 6) + 0.0 AS "item_userGenre"
            FROM (SELECT r.*, string_split(genres, '|')[1] AS ig_name, p.genre AS ug_name FROM ratings r
                  LEFT JOIN movies USING ("movieId") LEFT JOIN (SELECT * FROM preference WHERE rank = 1) p ON p."userId" = r."userId") s
            LEFT JOIN vectors i ON i.id = {sql_md5('"movieId"::VARCHAR')} % {_N} LEFT JOIN vectors u ON u.id = {sql_md5('"userId"::VARCHAR')} % {_N}
            LEFT JOIN vectors ig ON ig.id = {sql_md5('ig_name')} % {_N} LEFT JOIN vectors ug ON ug.id = {sql_md5('ug_name')} % {_N}""",
        *GENRE_PREFERENCE_CTES,
    ),
)
def q_fm(spark: SparkSession, sf: str) -> DataFrame:
    r, m, v = ratings_table(spark, sf), movies(spark, sf), item_vectors(spark, sf)
    n = v.agg(F.count(F.lit(1)).alias("n")).scalar()
    favourite = genre_preference(r, m, 1).select("userId", F.col("genre").alias("ug_name"))
    first = m.select("movieId", genre_slot(F.col("genres"), 1).alias("ig_name"))

    def index(name: str, out: str):
        hashed = F.pmod(hash_bucket(F.col(name), 1 << 60, "md5"), F.col("_n"))
        return F.when(F.col(name).isNotNull(), hashed).alias(out)

    # A user without a favourite genre keeps all samples: that field has the zero vector.
    sampled = skew_join(join_movies(r, first), favourite, ["userId"], how="left", hot=lambda: hot_keys(r, ["userId"]))
    fields = [("movieId", "item"), ("userId", "user"), ("ig_name", "itemGenre"), ("ug_name", "userGenre")]
    indexed = written(sampled.withColumn("_n", n).select(*KEY, *[index(a, b) for a, b in fields]), "indexed")
    terms = ["item_user", "itemGenre_userGenre", "itemGenre_user", "item_userGenre"]
    crossed = IA.fm_cross_terms(indexed, {b: v for _, b in fields}, VECTOR_DIM)
    return crossed.select(*KEY, *[F.round(t, 6).alias(t) for t in terms])


HISTORY = [f"userRatedMovie{i}" for i in range(1, 6)]
_H = ", ".join(f'"{h}"' for h in HISTORY)


@query(
    "history_attention_pool",
    sql(
        "ratings vectors",
        f"""SELECT {SQL_KEY}, total, square, head, tail FROM recent JOIN pooled USING ("movieId", {_H})""",
        *RECENT_CTES,
        f"""filled AS (SELECT i AS id, coalesce(emb, list_transform(range({VECTOR_DIM}), lambda z: 0.0::DOUBLE)) AS emb FROM
              (SELECT DISTINCT "movieId" AS i FROM ratings UNION SELECT 0) LEFT JOIN vectors ON id = i)""",
        f"""pooled AS (SELECT "movieId", {_H}, round(sum(v), 6) + 0.0 AS total, round(sum(v * v), 6) + 0.0 AS square,
                   round(max(CASE WHEN pos = 0 THEN v END), 6) + 0.0 AS head, round(max(CASE WHEN pos = {VECTOR_DIM - 1} THEN v END), 6) + 0.0 AS tail
            FROM (SELECT "movieId", {_H}, pos, sum(CASE WHEN h = 0 THEN 0 ELSE x / (1 + exp(-d)) END) AS v FROM (
              SELECT k.*, unnest(hv.emb) AS x, generate_subscripts(hv.emb, 1)::INTEGER - 1 AS pos, list_dot_product(hv.emb, c.emb) AS d
              FROM (SELECT *, unnest([{_H}]) AS h FROM (SELECT DISTINCT "movieId", {_H} FROM recent)) k
              JOIN filled hv ON hv.id = k.h JOIN filled c ON c.id = k."movieId") GROUP BY ALL) GROUP BY ALL)""",
    ),
)
def q_attention(spark: SparkSession, sf: str) -> DataFrame:
    recent = H.recent_items(ratings_table(spark, sf), 5, USER_HISTORY)
    pooled = IA.history_attention_pool(recent, item_vectors(spark, sf), VECTOR_DIM, "movieId", HISTORY)
    p = F.col("pooled")
    parts = {"total": vec_sum(p), "square": dot(p, p), "head": F.get(p, F.lit(0)), "tail": F.get(p, F.lit(VECTOR_DIM - 1))}
    return pooled.select(*KEY, *[F.round(v, 6).alias(n) for n, v in parts.items()])


# ------------------------------------------------------- trained embeddings

_BRAND = "string_split(genres, '|')[3]"
_SESSION_ITEMS = f"""liked AS (SELECT "movieId", brand, count(*) AS n, count(*) OVER () AS items FROM (
    SELECT "movieId", {_BRAND} AS brand FROM ratings JOIN movies USING ("movieId") WHERE rating >= 3.5) GROUP BY 1, 2 HAVING count(*) >= 5)"""


def brand_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Positive ratings of one brand's items in time order, in sessions of 20: items of a brand
    stand together, so a trained space must show the brands."""
    brand = movies(spark, sf).select("movieId", F.get(F.split("genres", "\\|"), F.lit(2)).alias("brand"))
    rated = join_movies(ratings_table(spark, sf), brand)
    by_brand = H.History(keys=("brand",), time=USER_HISTORY.time, ties=("userId", *USER_HISTORY.ties))
    return H.user_sequences(rated, by_brand, max_len=20)


def _neighbours_share(trained: DataFrame, spark: SparkSession, sf: str):
    """Share of items whose nearest trained vector is of their own brand, as a scalar."""
    brand = movies(spark, sf).select(F.col("movieId").cast("string").alias("id"), F.get(F.split("genres", "\\|"), F.lit(2)).alias("brand"))
    near = R.similar_items(trained, 1).select("id", "item")
    both = near.join(brand, "id").join(brand.select(F.col("id").alias("item"), F.col("brand").alias("_other")), "item")
    return both.agg(F.avg((F.col("brand") == F.col("_other")).cast("double")).alias("share")).scalar()


def _judged(trained: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """(id, dims, finite, clustered): nine tenths of the nearest neighbours are of the own brand."""
    share = _neighbours_share(trained, spark, sf)
    numbers = F.forall("emb", lambda v: ~F.isnan(v) & (F.abs(v) < 1e6))
    return trained.select("id", F.size("emb").alias("dims"), numbers.alias("finite"), (share >= 0.9).alias("clustered"))


@query(
    "train_item2vec",
    sql("ratings movies", 'SELECT "movieId"::VARCHAR AS id, 10::INTEGER AS dims, true AS finite, true AS clustered FROM liked', _SESSION_ITEMS),
)
def q_item2vec(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(written(EM.train_item2vec(brand_sessions(spark, sf)), "embedding"), spark, sf)


@query("train_graph_embedding", "SELECT 0::BIGINT AS strangers, 0::BIGINT AS broken, true AS any, true AS clustered")
def q_graph_embedding(spark: SparkSession, sf: str) -> DataFrame:
    pairs = written(G.item_pair_counts(G.pairs_of_sequences(brand_sessions(spark, sf), "movieIds")), "pair-counts")
    trained = written(EM.train_graph_embedding(pairs), "embedding")
    judged = written(_judged(trained, spark, sf), "judged")
    nodes = pairs.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    strange = judged.join(nodes, "id", "left_anti").agg(F.count(F.lit(1))).scalar()
    broken = judged.filter("dims <> 10 or not finite").agg(F.count(F.lit(1))).scalar()
    return judged.agg((F.count(F.lit(1)) > 0).alias("any"), F.bool_and("clustered").alias("clustered")).select(
        strange.alias("strangers"), broken.alias("broken"), "any", "clustered"
    )


# The published flow: train on user sequences, write text and key-value rows, read back, hash, search.
_KNOWN_ITEMS = """known AS (SELECT "movieId" FROM ratings WHERE rating >= 3.5 GROUP BY 1 HAVING count(*) >= 5)"""


@query(
    "embedding_flow",
    sql(
        "ratings",
        """SELECT "movieId"::VARCHAR AS id, true AS same, 'i2vEmb:' || "movieId" AS key, 10::BIGINT AS numbers, 3::BIGINT AS tables, true AS near FROM known""",
        _KNOWN_ITEMS,
    ),
)
def q_embedding_flow(spark: SparkSession, sf: str) -> DataFrame:
    trained = written(EM.train_item2vec(H.user_sequences(ratings_table(spark, sf), USER_HISTORY), iterations=3), "embedding")
    path = scratch_path(spark, "embedding-text")
    write_embedding_text(trained, path)
    read = written(read_embedding_text(spark, path).withColumn("emb", F.col("emb").cast("array<double>")), "embedding")
    kept = export_kv(read, "i2vEmb", F.lit(1_700_000_000)).select("key", F.size(F.split("value", " ")).cast("bigint").alias("numbers"))
    tables = LS.lsh_buckets(read, EM.DIM).groupBy("id").agg(F.countDistinct("hashTable").alias("tables"))
    # The stated query set, against all rows.
    asked = read.filter(F.pmod(F.col("id").cast("bigint"), F.lit(50)) == 0)
    found = written(LS.lsh_top_k(asked, read, 5, EM.DIM, same=True), "nearest")
    recall = LS.recall_of(found, R.blocked_top_k(asked, read, 5, "euclidean", same=True), ["id", "item"])
    text = F.transform("t.emb", lambda v: v.cast("float")) == F.transform("r.emb", lambda v: v.cast("float"))
    both = trained.alias("t").join(read.alias("r"), F.col("t.id") == F.col("r.id")).select("t.id", text.alias("same"))
    keyed = both.withColumn("key", F.concat(F.lit("i2vEmb:"), "id")).join(kept, "key").join(tables, "id")
    return keyed.select("id", "same", "key", "numbers", "tables", (recall >= LS.RECALL).alias("near"))
