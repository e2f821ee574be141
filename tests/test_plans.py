"""What the plans must look like at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from marquee.operators import aggregates as A
from marquee.operators import histories as H
from marquee.operators import samples as S
from marquee.sources.adapters import RATING_TIES, USER_HISTORY, ratings_table


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["training_samples", "movie_features", "user_sequences", "recent_items", "transition_matrix", "genre_preference", "multi_hot", "roc_auc"],
)
def test_no_python_and_no_nested_loops(spark, sf, name):
    text = physical(entry_points.queries()[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = physical(S.positive_ratings(ratings_table(spark, sf)).select("userId"))
    assert "GreaterThanOrEqual(rating,3.5)" in text
    assert "ReadSchema: struct<userId:bigint,rating:double>" in text


def test_group_limit_runs_before_the_shuffle(spark, sf):
    text = physical(A.top_ratings(ratings_table(spark, sf)))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", text)


def test_history_features_shuffle_ratings_once(spark, sf):
    df = H.user_history_features(ratings_table(spark, sf), 5, USER_HISTORY)
    assert physical(df).count("Exchange") == 1


def test_stats_combine_before_the_shuffle(spark, sf):
    text = physical(A.movie_rating_stats(ratings_table(spark, sf)))
    assert "partial_var_samp" in text and text.count("Exchange") == 1


def test_sliced_plan_moves_rows_by_key_and_slice(spark, big_user):
    history = H.History(ties=("line", "movieId", "rating"), hot_rows=100, span=7200)
    text = physical(H.prior_stats(big_user, history))
    assert re.search(r"hashpartitioning\(userId#\d+L, _slice#\d+L", text)


def test_single_partition_windows_see_bucket_totals_only(spark, sf):
    text = physical(entry_points.queries()["roc_auc"](spark, sf))
    for block in re.findall(r"Window \[.*?\][\s\S]*?Exchange SinglePartition[^\n]*\n[^\n]*\n[^\n]*", text):
        assert "_bucket" in block


def test_scalar_is_a_subquery(spark, sf):
    df = S.attach_scalar(ratings_table(spark, sf), "n", F.count(F.lit(1)))
    assert "Subquery" in physical(df) and "Join" not in physical(df)


def test_ties_are_total(spark, sf):
    r = ratings_table(spark, sf)
    dup = r.groupBy("userId", "timestamp", *RATING_TIES).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("rating").alias("d"))
    assert dup.filter("d > 1").count() == 0


def test_a_walk_step_moves_its_frontier_only(spark):
    """The guide table lies in buckets of the join key: with broadcasts off only the walks are shuffled."""
    from marquee.operators import graph as G

    counts = spark.createDataFrame([(i % 20, (i * 7) % 23, 1 + i % 5) for i in range(200)], "src int, dst int, cnt bigint").distinct()
    table = G.guide_table(G.with_successor_widths(G.sampling_table(counts), G.source_widths(counts)))
    start = spark.range(50).select(F.col("id").alias("walk_id"), (F.col("id") % 20).cast("int").alias("at"), F.lit(10).alias("total"), F.lit(2).alias("width"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical(G.walk_step(G.with_draw(start, 1, 7, "xxhash64"), table, 1, 7))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Exchange") == 1 and "Bucketed: true" in text and "SortMergeJoin" in text
    # The one exchange is on the side of the walks.
    assert "walk_id" in text[text.index("Exchange") :].split("FileScan")[0]


def test_recent_items_sort_rows_once(spark, sf):
    """A task holds one sorted copy of its rows, also with statistics over the same rows."""
    r = ratings_table(spark, sf)
    for df in (H.recent_items(r, 5, USER_HISTORY), H.user_history_features(r, 5, USER_HISTORY)):
        assert len(re.findall(r"\bSort \[", physical(df).replace("isFinalPlan=true", ""))) == 1


def test_samples_meet_movies_before_they_are_wide(spark, big_user):
    """With movies too big to broadcast, no shuffle by movie carries what users bring."""
    from marquee.plans.training_samples import training_samples

    movies = spark.createDataFrame([(i, f"Film {i} (1990)", "A|B") for i in range(1, 41)], "movieId bigint, title string, genres string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = training_samples(big_user, movies, H.History(ties=("line", "movieId", "rating")))
        text = physical(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin [movieId" in line]
    windows = [i for i, line in enumerate(lines) if re.search(r"Window .*userId", line) and "GroupLimit" not in line]
    # A tree is printed from its result down: windows over users stand above the join by movie.
    first = [i for i in joins if "LeftOuter" in lines[i]]
    assert windows and first and all(min(windows) < i for i in first)


def test_a_movie_listed_twice_repeats_samples_only(spark, big_user):
    """A sample for each of its rows in the catalogue; the histories of users count a rating once."""
    from collections import Counter

    from marquee.plans.training_samples import training_samples

    listed = [(i, f"Film {i} (1990)", "A|B") for i in range(1, 41)]
    history = H.History(ties=("line", "movieId", "rating"))
    of_user = ["userId", "movieId", "timestamp", "line", "rating", "userRatingCount", "userAvgRating", "userRatingStddev", *[f"userRatedMovie{i}" for i in range(1, 6)]]

    def samples(rows):
        movies = spark.createDataFrame(rows, "movieId bigint, title string, genres string")
        return training_samples(big_user, movies, history)

    once, twice = samples(listed), samples([*listed, (7, "Film 7 (1991)", "C")])
    assert once.columns == twice.columns
    want = Counter()
    for row in once.select(*of_user).collect():
        want[row] += 2 if row.movieId == 7 else 1
    assert Counter(twice.select(*of_user).collect()) == want
    assert {r.releaseYear for r in twice.filter("movieId = 7").select("releaseYear").collect()} == {1990, 1991}


def test_samples_as_of_move_by_movie_while_narrow(spark, sf):
    """What users bring is added last: the exchange by movie lies below the one by user."""
    text = physical(entry_points.queries()["training_samples_as_of"](spark, sf))
    assert 0 < text.index("hashpartitioning(userId") < text.index("hashpartitioning(movieId")
    by_movie = text[text.index("hashpartitioning(movieId") :]
    assert "userRatedMovie" not in by_movie and "userGenre" not in by_movie
