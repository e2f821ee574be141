"""Readers, sinks and the malformed input they must survive."""

import json

import pytest
from pyspark.sql import functions as F

from marquee.operators import aggregates as A
from marquee.sources import layouts as LA
from marquee.sources import readers as RD
from marquee.sources import sinks as SK


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_ratings_by_name_and_numeric_time(spark, tmp_path):
    path = put(tmp_path, "r.csv", "timestamp,userId,rating,movieId\n1000,1,3.5,10\n900,1,,11\n800,x,2.0,12\n")
    got = RD.read_ratings(spark, path)
    assert got.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "double"), ("timestamp", "bigint")]
    assert [r.timestamp for r in got.orderBy("timestamp").collect()] == [800, 900, 1000]
    assert got.filter("userId is null").count() == 1
    with pytest.raises(Exception):
        RD.read_ratings(spark, path, errors="raise").collect()


def test_quoted_titles_and_links(spark, tmp_path):
    m = put(tmp_path, "m.csv", 'movieId,title,genres\n1,"Good, Bad ""Ugly"" (1966)",Western\n')
    assert RD.read_movies(spark, m).first()["title"] == 'Good, Bad "Ugly" (1966)'
    l = put(tmp_path, "l.csv", "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n")
    rows = RD.read_links(spark, l).orderBy("movieId").collect()
    assert [(r.imdbId, r.tmdbId) for r in rows] == [("0114709", "862"), ("0113497", None)]


DEFAULTS = {"label": 0, "tag": "", "score": 0.0}


def test_typed_tsv(spark, tmp_path):
    path = put(tmp_path, "t.tsv", "1\ta\t0.5\n\t\t\n0\tb\t\n")
    got = RD.read_typed_tsv(spark, path, DEFAULTS)
    assert got.dtypes == [("label", "int"), ("tag", "string"), ("score", "float")]
    assert [tuple(r) for r in got.collect()] == [(1, "a", 0.5), (0, "", 0.0), (0, "b", 0.0)]


@pytest.mark.parametrize("line", ["1\ta", "1\ta\t0.5\tmore", "1\ta\tword"])
def test_bad_tsv_lines(spark, tmp_path, line):
    path = put(tmp_path, "t.tsv", f"1\ta\t0.5\n{line}\n")
    # Also when only one column is read, or none.
    for action in (lambda d: d.collect(), lambda d: d.select("tag").collect(), lambda d: d.count()):
        with pytest.raises(Exception, match="bad line"):
            action(RD.read_typed_tsv(spark, path, DEFAULTS))
    assert RD.read_typed_tsv(spark, path, DEFAULTS, "drop").count() == 1
    kept = RD.read_typed_tsv(spark, path, DEFAULTS, "quarantine")
    assert [r._line for r in kept.filter("_error is not null").collect()] == [line]


@pytest.mark.parametrize("layout,size", [(LA.TAG_SAMPLES, 42), (LA.TAG_SAMPLES_NEW, 28), (LA.LISTING_SAMPLES, 28)])
def test_layouts(spark, tmp_path, layout, size):
    assert len(layout) == size
    path = put(tmp_path, "t.tsv", "\t" * (size - 1) + "\n")
    row = RD.read_typed_tsv(spark, path, layout).first().asDict()
    assert row == dict(layout)
    for n in (size - 1, size + 1):
        bad = put(tmp_path, f"b{n}.tsv", "\t" * (n - 1) + "\n")
        with pytest.raises(Exception, match="bad line"):
            RD.read_typed_tsv(spark, bad, layout).count()


CSV = "label,movieId,genre,score\n1,7,War,0.5\n0,0,0,\n1,8,Drama\n1,9,War,1.0,extra\n1,x,War,1.0\n0,5,,2.5\n"
TYPES = {"label": "int", "movieId": "int", "genre": "string", "score": "float"}


def test_named_csv(spark, tmp_path):
    got = RD.read_named_csv(spark, put(tmp_path, "s.csv", CSV), TYPES)
    assert got.columns == ["movieId", "genre", "score", "label"]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [(0, "", 0.0, 0), (5, "", 2.5, 0), (7, "War", 0.5, 1)]
    # Pruned reads and counts see the same rows.
    assert got.count() == 3 and got.select("genre").count() == 3 and len(got.select("label").collect()) == 3


def test_matrix(spark, tmp_path):
    path = put(tmp_path, "m.tsv", "yes\t1\t2.5\t\tlast\n")
    row = RD.read_matrix_tsv(spark, path).first()
    assert (row.label, row.features) == ("yes", [1.0, 2.5, None])
    with pytest.raises(Exception, match="not a number"):
        RD.read_matrix_tsv(spark, path, drop_last=False).collect()


def test_matrix_lines_that_are_wrong(spark, tmp_path):
    path = tmp_path / "m.tsv"
    path.write_text("a\t1\t2\tz\nb\t1\tx\tz\nc\t1\tz\nd\n\ne\t\t3\tz\n")
    path = str(path)
    good = [("a", [1.0, 2.0]), ("e", [None, 3.0])]
    assert [tuple(r) for r in RD.read_matrix_tsv(spark, path, columns=2, on_error="drop").collect()] == good
    held = RD.read_matrix_tsv(spark, path, columns=2, on_error="quarantine").collect()
    assert [(r.label, r.features) for r in held if r["_error"] is None] == good
    assert {r["_line"]: r["_error"] for r in held if r["_error"]} == {"b\t1\tx\tz": "not a number", "c\t1\tz": "cells: 1", "d": "cells: -1", "": "cells: -1"}
    for n in (None, 2):
        with pytest.raises(Exception, match="bad line"):
            RD.read_matrix_tsv(spark, path, columns=n).collect()
    with pytest.raises(ValueError):
        RD.read_matrix_tsv(spark, path, on_error="ignore")


def test_embedding_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("158", [1.0, -0.25, 3e-5]), ("a:b", [0.0, 2.0, 7.0])], "id string, emb array<float>")
    lines = sorted(r.value for r in SK.embedding_lines(df).collect())
    assert lines[0].startswith("158:1.0 -0.25 ")
    SK.write_embedding_text(df.filter("id = '158'"), str(tmp_path / "e"))
    back = SK.read_embedding_text(spark, str(tmp_path / "e")).first()
    want = df.filter("id = '158'").first()
    assert (back.id, back.emb) == (want.id, want.emb)


def test_key_values(spark):
    df = spark.createDataFrame([(361, [0.5, -1.0])], "id int, emb array<float>")
    row = SK.export_kv(df, "i2vEmb", F.lit(1000)).first()
    assert tuple(row) == ("i2vEmb:361", "0.5 -1.0", 87400)


def test_profile_json(spark):
    ratings = spark.createDataFrame([(1, 5, 4.0, 10), (2, 5, 4.5, 20)], "userId bigint, movieId bigint, rating double, timestamp bigint")
    movies = spark.createDataFrame([(5, "Up (2009)", "A|B"), (6, "None", None)], "movieId bigint, title string, genres string")
    links = spark.createDataFrame([(5, "0077", "12"), (6, "0078", None)], "movieId bigint, imdbId string, tmdbId string")
    got = {r.movieId: json.loads(r.json) for r in SK.movie_profile_json(A.movie_profile(ratings, movies, links=links)).collect()}
    assert {k: got[5][k] for k in ("releaseYear", "imdbId", "tmdbId", "genres")} == {"releaseYear": 2009, "imdbId": "0077", "tmdbId": "12", "genres": ["A", "B"]}
    assert got[6]["releaseYear"] == 1990 and "tmdbId" not in got[6]
    assert got[5]["ratingNumber"] == 2 and got[5]["averageRating"] == 4.25
    assert got[5]["topRatings"][0] == {"rating": {"movieId": 5, "userId": 2, "score": 4.5, "timestamp": 20}}
    assert got[6]["topRatings"] == [] and got[6]["ratingNumber"] == 0


def test_column_functions_run_on_a_stream(spark, tmp_path):
    """Stateless parts need nothing special on a streaming DataFrame."""
    from marquee.functions.encoders import hash_bucket

    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.tsv", "1\ta\t0.5\n0\tb\t\n")
    lines = spark.readStream.text(str(tmp_path / "in")).withColumn("_f", F.split("value", "\t", -1))
    parsed = RD.parse_typed_lines(lines, DEFAULTS).withColumn("bucket", hash_bucket(F.col("tag"), 10, "md5"))
    query = parsed.writeStream.format("memory").queryName("parsed").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("parsed").count() == 2
