"""Column functions: traps and corrections."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import encoders as E
from marquee.functions import numeric as N
from marquee.functions import text as T
from marquee.operators import encoding as M
from marquee.operators import samples as S
from marquee.operators import aggregates as A


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "title,year,name",
    [
        ("Heat (1995)", 1995, "Heat"),
        ("Heat (1995)   ", 1995, "Heat"),
        ("  Alien 3 (a) (1992)", 1992, "Alien 3 (a)"),
        ("M", 1990, "M"),
        ("No year at all", 1990, "No year at all"),
        (None, 1990, None),
    ],
)
def test_titles(spark, title, year, name):
    assert one(spark, title, "string", T.release_year) == year
    assert one(spark, title, "string", T.strip_year) == name


def test_missing_genre_is_null_not_an_error(spark):
    row = spark.createDataFrame([("Drama|War",)], "g string").select(*T.genre_slots(F.col("g"), 3)).first()
    assert list(row) == ["Drama", "War", None]


@pytest.mark.parametrize("x,text", [(0.125, "0.12"), (2.325, "2.33"), (2.175, "2.17"), (1234.5, "1,234.50")])
def test_two_places(spark, x, text):
    assert one(spark, x, "double", T.format_2dp) == text
    assert one(spark, x, "double", T.round_2dp) == float(text.replace(",", ""))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=6))
def test_softmax(spark, values):
    got = one(spark, values, "array<double>", N.softmax)
    top = max(values)
    powers = [math.exp(v - top) for v in values]
    assert got == pytest.approx([p / sum(powers) for p in powers], abs=1e-12)


def test_argmax_takes_the_first_maximum(spark):
    assert one(spark, [1.0, 3.0, 3.0], "array<double>", lambda a: N.argmax_label(a, ["p", "q", "r"])) == "q"


def test_cosine_of_a_zero_vector_is_null(spark):
    assert one(spark, [0.0, 0.0], "array<double>", lambda a: N.cosine(a, a)) is None


def test_clip(spark):
    assert [one(spark, x, "double", lambda c: N.clip_scale(c, 100.0)) for x in (50.0, 100.0, 900.0)] == [0.5, 1.0, 1.0]


@settings(max_examples=15, deadline=None)
@given(st.text(max_size=8), st.integers(1, 5000))
def test_hash_in_range(spark, text, n):
    for method in ("xxhash64", "md5"):
        got = one(spark, text, "string", lambda c: E.hash_bucket(c, n, method))
        assert 0 <= got < n


def test_cross_is_not_a_plain_concatenation(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    for method in ("xxhash64", "md5"):
        got = [r[0] for r in df.select(E.stable_hash([F.col("x"), F.col("y")], method)).collect()]
        assert got[0] != got[1]


def test_vocab_and_identity(spark):
    assert one(spark, "War", "string", lambda c: E.vocab_index(c, E.GENRE_VOCABULARY)) == 5
    assert one(spark, "Nope", "string", lambda c: E.vocab_index(c, E.GENRE_VOCABULARY)) == -1
    assert one(spark, None, "string", lambda c: E.vocab_index(c, E.GENRE_VOCABULARY)) == -1
    assert one(spark, 1001, "bigint", lambda c: E.identity_index(c, 1001, "null")) is None
    with pytest.raises(Exception, match="id outside"):
        one(spark, -1, "bigint", lambda c: E.identity_index(c, 1001))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-2, 2), min_size=2, max_size=10))
def test_bucketize_is_monotone(spark, values):
    df = spark.createDataFrame([(v,) for v in sorted(values)], "x double")
    got = [r[0] for r in df.select(E.bucketize(F.col("x"), E.W2V_SCORE_BOUNDS)).collect()]
    assert got == [sum(b <= v for b in E.W2V_SCORE_BOUNDS) for v in sorted(values)]


def test_epoch_ignores_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:01.9' as t")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(E.epoch_seconds(F.col("t"))).first()[0] == 1711852201
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# ------------------------------------------------------------ table transforms

def test_indicator_of_an_unknown_index_is_the_zero_vector(spark):
    df = spark.createDataFrame([(-1,), (2,), (None,)], "i int")
    got = [(r.v.size, r.v.toArray().sum()) for r in M.indicator(df, "i", 3, "v").collect()]
    assert got == [(3, 0.0), (3, 1.0), (3, 0.0)]


def test_multi_hot_with_a_repeated_genre(spark):
    df = spark.createDataFrame([(1, "A|A|B"), (2, "A")], "movieId int, genres string")
    got = {r.movieId: list(r.vector.toArray()) for r in M.multi_hot(df).collect()}
    assert got == {1: [1.0, 1.0], 2: [1.0, 0.0]}


def test_genre_indexes_do_not_repeat(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 0.0), (1, 2.0)], "movieId int, genreIndex double")
    assert A.collect_genre_indexes(df).first()["genreIndexes"] == [0, 2]


def test_string_index_ties_by_name(spark):
    df = spark.createDataFrame([(g,) for g in "bbca"], "g string")
    assert {r.g: r.i for r in M.string_index(df, "g", "i").collect()} == {"b": 0.0, "a": 1.0, "c": 2.0}


def test_equal_values_share_a_bucket(spark):
    df = spark.createDataFrame([(v,) for v in [1] * 50 + [2] * 3 + [9]], "x int")
    got = {(r.x, r.b) for r in M.quantile_bucket_exact(df, "x", "b", 10).collect()}
    assert len(got) == 3


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert {r.y for r in M.min_max(df, "x", "y").collect()} == {0.5}


def test_labels_of_unrated_rows(spark):
    df = spark.createDataFrame([(3.5,), (3.4,), (None,)], "rating double")
    assert [r.label for r in S.add_label(df).collect()] == [1, 0, 0]
    assert [r.label for r in S.add_label(df, null_label="null").collect()] == [1, 0, None]
    assert S.positive_ratings(df).count() == 1


def test_int_ids(spark):
    df = spark.createDataFrame([("7",), ("x",)], "id string")
    assert [r.idNumber for r in S.with_int_id(df, "id").collect()] == [7, None]
    with pytest.raises(Exception):
        S.with_int_id(df, "id", "raise").collect()


def test_single_rating_has_no_variance(spark):
    df = spark.createDataFrame([(1, 4.0)], "movieId int, rating double")
    assert A.movie_rating_stats(df).first()["ratingVar"] is None
    assert A.movie_features(df).first()["movieRatingStddev"] == 0.0


def test_shuffle_is_repeatable_and_complete(spark):
    df = spark.range(200).repartition(7)
    a = [r.id for r in S.shuffle_samples(df, ["id"], 3).collect()]
    b = [r.id for r in S.shuffle_samples(spark.range(200).repartition(3), ["id"], 3).collect()]
    assert a == b and sorted(a) == list(range(200)) and a != sorted(a)
    placed = S.shuffle_samples(df, ["id"], 3, place="n").orderBy("n").collect()
    assert [r.id for r in placed] == a and [r.n for r in placed] == list(range(1, 201))


def test_class_weights(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert {r.c: r.weight for r in M.class_weights(df, "c", {"a": 3.0}).collect()} == {"a": 3.0, "b": 1.0}
