"""Queries over model training, scoring and evaluation.

Fits are not bit-stable across engines.  Each trainer therefore learns a planted signal, made
of the given columns with a tenth of noise, and is judged on samples it never saw: the twin
says which samples these are, their labels, and that the area is above a floor which a
constant or a model of noise does not reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.durable import scratch_path, written
from marquee.functions.encoders import stable_hash
from marquee.operators import evaluation as EV
from marquee.operators import metrics as V
from marquee.operators import models as L
from marquee.plans.queries_features import sql_md5, sql_md5_tuple
from marquee.plans.registry import query, sql
from marquee.plans.training_samples import training_samples
from marquee.skew import with_group_totals
from marquee.sources.adapters import MOVIE_HISTORY, USER_HISTORY, movies, ratings_table, scored_labels, tag_samples
from marquee.sources.sinks import load_model, save_model

CATEGORICAL = ["taggroup", "hour"]
NUMERIC = ["score"]

# A tenth of the planted labels is turned round, so the best area is about 0.9.
FLOOR = 0.75
_HELD = f"{sql_md5('event_id::VARCHAR')} % 1000 < 200"
_HOUR = "(floor(ts / 3600)::BIGINT % 24)"


def _planted_sql(base: str) -> str:
    turned = f"{sql_md5_tuple('event_id', repr('noise'))} % 10 = 0"
    return f"CASE WHEN ({base}) <> ({turned}) THEN 1.0::DOUBLE ELSE 0.0 END"


def planted(base: Column, key: str = "event_id") -> Column:
    """A label that follows ``base``, turned round for a tenth of the keys."""
    turned = F.pmod(stable_hash([F.col(key), F.lit("noise")], "md5"), F.lit(10)) == 0
    return F.when(base != turned, 1.0).otherwise(0.0)


def click_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Tag events with features, written once: fits and scoring read them repeatedly.

    One even file a core: a split of the events' file may hold several row groups or none, and
    each step of a fit would wait for the longest."""
    tags = tag_samples(spark, sf)
    hour = (F.floor(F.col("ts") / 3600) % 24).cast("int")
    typed = tags.select(
        "event_id", "userid", "tagid", "ts", (F.col("tagid") % 10).cast("string").alias("taggroup"), hour.cast("string").alias("hour"),
        "score", F.col("label").cast("double").alias("label"),
    )
    return written(typed.repartition(spark.sparkContext.defaultParallelism), "clicks")


# Plain signal of one field, and one that only two fields together show.
def one_field() -> Column:
    return F.col("taggroup").cast("int") < 4


def two_fields() -> Column:
    return (F.col("taggroup").cast("int") < 5) != (F.col("hour").cast("int") < 12)


def both_fields() -> Column:
    return (F.col("taggroup").cast("int") < 6) & (F.col("hour").cast("int") < 18)


_BOTH = f"tagid % 10 < 6 AND {_HOUR} < 18"
_ONE, _TWO = "tagid % 10 < 4", f"(tagid % 10 < 5) <> ({_HOUR} < 12)"


def _fitted_sql(base: str) -> str:
    """What SQL can say of a fit: each held-out sample has one probability, and their area is
    above the floor, which no constant reaches."""
    return sql("tags", f"SELECT event_id, {_planted_sql(base)} AS label, true AS valid, true AS learnt FROM tags WHERE {_HELD}")


def _judged(scored: DataFrame, *keys: str, floor: float = FLOOR) -> DataFrame:
    area = V.roc_auc(scored, "label", "probability").select("rocAuc").scalar()
    # NaN is above every number.
    return scored.select(*keys, "label", F.col("probability").between(0, 1).alias("valid"), ((area >= floor) & ~F.isnan(area)).alias("learnt"))


def _held_out(samples: DataFrame, base: Column, fit: Callable[[DataFrame], Transformer]) -> DataFrame:
    labelled = samples.withColumn("label", planted(base))
    return _judged(EV.held_out_scores(fit, *EV.split_by_key(labelled, ["event_id"], method="md5")), "event_id")


@query("train_logistic", _fitted_sql(_ONE))
def q_logistic(spark: SparkSession, sf: str) -> DataFrame:
    return _held_out(click_samples(spark, sf), one_field(), lambda df: L.train_logistic(df, CATEGORICAL, NUMERIC, n=1 << 12))


@query("train_mlp", _fitted_sql(_BOTH))
def q_mlp(spark: SparkSession, sf: str) -> DataFrame:
    return _held_out(
        click_samples(spark, sf), both_fields(), lambda df: L.train_mlp(df, CATEGORICAL, NUMERIC, hidden=L.HIDDEN["tag_new"], width=128)
    )


@query("train_wide", _fitted_sql(f"{sql_md5_tuple('(tagid % 10)::VARCHAR', f'({_HOUR} // 6)::VARCHAR')} % 2 = 0"))
def q_wide(spark: SparkSession, sf: str) -> DataFrame:
    samples = click_samples(spark, sf).withColumn("quarter", F.floor(F.col("hour").cast("int") / 6).cast("string"))
    of_cross = F.pmod(stable_hash([F.col("taggroup"), F.col("quarter")], "md5"), F.lit(2)) == 0
    return _held_out(L.with_cross(samples, ["taggroup", "quarter"]), of_cross, L.train_wide)


@query("train_fm", _fitted_sql(_TWO))
def q_fm_model(spark: SparkSession, sf: str) -> DataFrame:
    samples = click_samples(spark, sf).withColumn("half", F.when(F.col("hour").cast("int") < 12, "am").otherwise("pm"))
    return _held_out(samples, two_fields(), lambda df: L.train_fm(df, ["taggroup", "half"], n=256, max_iter=200))


_AFFINE = '("userId" % 4 = "movieId" % 4)'


@query(
    "train_cf",
    sql(
        "ratings",
        f"""SELECT "userId", "movieId", rating, CASE WHEN {_AFFINE} THEN 5.0::DOUBLE ELSE 1.0 END AS planted, true AS learnt FROM ratings
            WHERE {sql_md5_tuple('"userId"', '"movieId"')} % 1000 < 200
              AND "userId" IN (SELECT "userId" FROM ratings WHERE {sql_md5_tuple('"userId"', '"movieId"')} % 1000 >= 200)
              AND "movieId" IN (SELECT "movieId" FROM ratings WHERE {sql_md5_tuple('"userId"', '"movieId"')} % 1000 >= 200)""",
    ),
)
def q_cf(spark: SparkSession, sf: str) -> DataFrame:
    """Users like the items of their own quarter; the model must halve the squared error of a constant."""
    affine = F.when(F.pmod("userId", F.lit(4)) == F.pmod("movieId", F.lit(4)), 5.0).otherwise(1.0)
    r = written(ratings_table(spark, sf).select("userId", "movieId", F.col("rating").alias("_own"), affine.alias("rating")), "affinities")
    train, rest = EV.split_by_key(r, ["userId", "movieId"], method="md5")
    scored = written(L.train_cf(train).transform(rest), "scored")
    errors = scored.agg(F.avg((F.col("prediction") - F.col("rating")) ** 2).alias("model"), F.var_pop("rating").alias("constant"))
    learnt = errors.select((F.col("model") < 0.5 * F.col("constant")).alias("learnt")).scalar()
    return scored.select("userId", "movieId", F.col("_own").alias("rating"), F.col("rating").alias("planted"), learnt.alias("learnt"))


@query("sweep", "SELECT unnest(range(600, 981, 20))::INTEGER AS steps, true AS learnt")
def q_sweep(spark: SparkSession, sf: str) -> DataFrame:
    samples = click_samples(spark, sf).withColumn("label", planted(one_field()))
    found = L.sweep(samples, CATEGORICAL, L.SWEEP_STEPS, NUMERIC)
    return found.select("steps", (F.col("rocAuc") >= FLOOR).alias("learnt"))


@query(
    "split_by_time",
    sql(
        "tags",
        """SELECT event_id, ts >= (SELECT ts FROM (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS r, count(*) OVER () AS n FROM tags)
             WHERE r = floor(0.8 * n)::BIGINT) AS held FROM tags""",
    ),
)
def q_split_by_time(spark: SparkSession, sf: str) -> DataFrame:
    train, rest = EV.split_by_time(tag_samples(spark, sf), "ts")
    return train.select("event_id", F.lit(False).alias("held")).unionByName(rest.select("event_id", F.lit(True).alias("held")))


def _scored(model, samples: DataFrame) -> DataFrame:
    return L.score(model, samples).select("event_id", "label", F.round("probability", 6).alias("probability"))


@query("save_and_load_model", sql("tags", "SELECT event_id, label::DOUBLE AS label, true AS same FROM tags"))
def q_save(spark: SparkSession, sf: str) -> DataFrame:
    samples = click_samples(spark, sf)
    path = scratch_path(spark, "model")
    model = L.train_logistic(samples, CATEGORICAL, NUMERIC, n=1 << 12)
    save_model(model, path)
    again = _scored(load_model(spark, path), samples).select("event_id", F.col("probability").alias("again"))
    return _scored(model, samples).join(again, "event_id").select("event_id", "label", (F.col("probability") == F.col("again")).alias("same"))


@query("evaluate_model", 'SELECT true AS accuracy, true AS "logLoss", true AS "prAuc", true AS "rocAuc"')
def q_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """All metrics on the samples of the last fifth of the time, none of which a constant reaches."""
    samples = click_samples(spark, sf).withColumn("label", planted(one_field()))
    train, rest = EV.split_by_time(samples, "ts")
    found = EV.held_out_metrics(lambda df: L.train_logistic(df, CATEGORICAL, NUMERIC, l1=0.0, n=1 << 12), train, rest)
    # Of a constant: 0.58 right, a log loss of 0.68, areas of 0.42 and 0.5.
    return found.select(
        (F.col("accuracy") >= 0.8).alias("accuracy"), (F.col("logLoss") <= 0.55).alias("logLoss"),
        (F.col("prAuc") >= 0.7).alias("prAuc"), (F.col("rocAuc") >= FLOOR).alias("rocAuc"),
    )


@query(
    "prediction_report",
    sql(
        "scored",
        """SELECT doc_id, format('{:.2f}%', probability * 100) AS predicted,
                  CASE WHEN label <> 0 THEN 'Good Rating' ELSE 'Bad Rating' END AS actual FROM scored ORDER BY doc_id LIMIT 12""",
    ),
)
def q_report(spark: SparkSession, sf: str) -> DataFrame:
    return L.prediction_report(scored_labels(spark, sf), ["doc_id"], 12)


# ------------------------------------------------------------------ metrics

@query(
    "accuracy",
    sql("scored", "SELECT round(avg(CASE WHEN (probability > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored"),
)
def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return V.accuracy(scored_labels(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"))


@query(
    "log_loss",
    sql(
        "scored",
        """SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 9) AS "logLoss"
           FROM (SELECT label, least(greatest(probability, 1e-7), 1 - 1e-7) AS p FROM scored)""",
    ),
)
def q_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return V.log_loss(scored_labels(spark, sf)).select(F.round("logLoss", 9).alias("logLoss"))


_CURVE = """curve AS (SELECT s, pos, neg, coalesce(sum(neg) OVER up, 0) AS neg_below,
    coalesce(sum(pos) OVER down, 0) AS tp0, coalesce(sum(neg) OVER down, 0) AS fp0
    FROM (SELECT score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
          FROM {source} GROUP BY 1)
    WINDOW up AS (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           down AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_ROC = 'SELECT round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS "rocAuc" FROM curve'
_PR = """SELECT round(sum(pos * ((tp0 + pos) / (tp0 + pos + fp0 + neg) +
    CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE (tp0 + pos) / (tp0 + pos + fp0 + neg) END) / 2.0) / sum(pos), 9) AS "prAuc" FROM curve"""


@query("roc_auc", sql("scored", _ROC, _CURVE.format(source="scored")))
def q_roc(spark: SparkSession, sf: str) -> DataFrame:
    return V.roc_auc(scored_labels(spark, sf)).select(F.round("rocAuc", 9).alias("rocAuc"))


@query("pr_auc", sql("scored", _PR, _CURVE.format(source="scored")))
def q_pr(spark: SparkSession, sf: str) -> DataFrame:
    return V.pr_auc(scored_labels(spark, sf)).select(F.round("prAuc", 9).alias("prAuc"))


@query("roc_auc_clicks", sql("tags", _ROC, _CURVE.format(source="tags")))
def q_roc_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return V.roc_auc(tag_samples(spark, sf)).select(F.round("rocAuc", 9).alias("rocAuc"))


@query("pr_auc_clicks", sql("tags", _PR, _CURVE.format(source="tags")))
def q_pr_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return V.pr_auc(tag_samples(spark, sf)).select(F.round("prAuc", 9).alias("prAuc"))


@query(
    "mse",
    sql(
        "ratings",
        """SELECT round(avg((rating - m) * (rating - m)), 6) AS mse
           FROM ratings JOIN (SELECT "movieId", avg(rating) AS m FROM ratings GROUP BY 1) USING ("movieId")""",
    ),
)
def q_mse(spark: SparkSession, sf: str) -> DataFrame:
    predicted = with_group_totals(ratings_table(spark, sf), ["movieId"], {"prediction": F.avg("rating")})
    return V.mse(predicted, "rating").select(F.round("mse", 6).alias("mse"))


# ------------------------------------------------- models on movie samples

MOVIE_NUMBERS = [
    "releaseYear", "movieRatingCount", "movieAvgRating", "movieRatingStddev",
    "userRatingCount", "userAvgRating", "userRatingStddev",
]
MOVIE_TEXTS = [*[f"userGenre{i}" for i in range(1, 6)], *[f"movieGenre{i}" for i in range(1, 4)]]


def movie_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship samples, complete and written once for training."""
    out = training_samples(ratings_table(spark, sf), movies(spark, sf), USER_HISTORY, MOVIE_HISTORY)
    filled = out.na.fill(0.0).na.fill("", subset=MOVIE_TEXTS).withColumn("label", F.col("label").cast("double"))
    return written(filled, "samples")


# The planted label of movie samples: new films, a tenth turned round.
_MOVIE_KEY = ["userId", "movieId", "timestamp", "l_orderkey", "l_linenumber"]
_MOVIE_HELD = f"""{sql_md5_tuple('"userId"', '"movieId"')} % 1000 < 200"""


def _movie_sql(base: str) -> str:
    turned = sql_md5_tuple("l_orderkey", "l_linenumber", '"movieId"') + " % 10 = 0"
    return sql(
        "ratings movies",
        f"""SELECT "userId", "movieId", "timestamp", l_orderkey, l_linenumber,
                   CASE WHEN ({base}) <> ({turned}) THEN 1.0::DOUBLE ELSE 0.0 END AS label, true AS valid, true AS learnt
            FROM ratings JOIN movies USING ("movieId") WHERE {_MOVIE_HELD}""",
    )


def _movie_held_out(samples: DataFrame, base: Column, fit: Callable[[DataFrame], Transformer]) -> DataFrame:
    turned = F.pmod(stable_hash([F.col("l_orderkey"), F.col("l_linenumber"), F.col("movieId")], "md5"), F.lit(10)) == 0
    labelled = samples.withColumn("label", F.when(base != turned, 1.0).otherwise(0.0))
    train, rest = EV.split_by_key(labelled, ["userId", "movieId"], method="md5")
    return _judged(EV.held_out_scores(fit, train, rest), *_MOVIE_KEY)


@query("train_movie_mlp", _movie_sql(r"""regexp_extract(title, '(\d{4})\)$', 1)::INTEGER >= 1995"""))
def q_movie_mlp(spark: SparkSession, sf: str) -> DataFrame:
    def fit(df: DataFrame):
        return L.train_mlp(df, MOVIE_TEXTS, MOVIE_NUMBERS, hidden=L.HIDDEN["movie"], width=256, max_iter=15)

    return _movie_held_out(movie_samples(spark, sf), F.col("releaseYear") >= 1995, fit)


@query("train_movie_wide", _movie_sql(f"""{sql_md5_tuple("string_split(genres, '|')[3]", '("userId" % 4)')} % 2 = 0"""))
def q_movie_wide(spark: SparkSession, sf: str) -> DataFrame:
    samples = movie_samples(spark, sf).withColumn("quarter", F.pmod("userId", F.lit(4)))
    of_cross = F.pmod(stable_hash([F.col("movieGenre3"), F.col("quarter")], "md5"), F.lit(2)) == 0
    return _movie_held_out(L.with_cross(samples, ["movieGenre3", "quarter"]), of_cross, lambda df: L.train_wide(df, max_iter=20))
