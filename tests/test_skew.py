"""Hot-key detours give exactly what the plain operators give."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.operators import graph as G
from marquee.operators import histories as H
from marquee.operators import retrieval as R
from marquee.operators.samples import share_of_group
from marquee.skew import hot_keys, salted_join, skew_join, with_group_totals

TIES = ("line", "movieId", "rating")
PLAIN = H.History(ties=TIES, hot_rows=10**9)
CUT = H.History(ties=TIES, hot_rows=100, span=7200)
# Slices so fine that most hold one timestamp, and nearly all users hot.
FINE = H.History(ties=TIES, hot_rows=3, span=1)


def bag(df):
    """Rows with their counts; numbers to nine places, as merged deviations differ in the last bits."""
    rows = df.select(*sorted(df.columns)).collect()
    return Counter(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("cut", [CUT, FINE])
@pytest.mark.parametrize(
    "run",
    [
        lambda df, h: H.with_position(df, h),
        lambda df, h: H.next_item(df, h),
        lambda df, h: H.prior_stats(df, h),
        lambda df, h: H.recent_items(df, 5, h),
        lambda df, h: H.recent_items(df, 1, h),
        lambda df, h: H.user_history_features(df, 3, h),
        lambda df, h: H.user_sequences(df, h, max_len=7),
    ],
)
def test_sliced_windows_equal_plain_ones(big_user, run, cut):
    assert cut.lay_out(big_user).cut
    assert bag(run(big_user, cut)) == bag(run(big_user, PLAIN))


def test_per_user_table_reaches_every_slice(big_user):
    per_user = big_user.groupBy("userId").agg(F.max("rating").alias("best"))
    got = H.user_history_features(big_user, 2, CUT, per_user=per_user)
    assert got.filter("best is null").count() == 0
    assert bag(got) == bag(H.user_history_features(big_user, 2, PLAIN, per_user=per_user))


def test_recent_items_against_brute_force(big_user):
    got = H.recent_items(big_user, 3, CUT).collect()
    rows = sorted(big_user.collect(), key=lambda r: (r.userId, r.timestamp, r.line, r.movieId, r.rating))
    want, seen, user = Counter(), [], None
    for r in rows:
        if r.userId != user:
            user, seen = r.userId, []
        last = (seen[::-1] + [0, 0, 0])[:3]
        want[(r.userId, r.movieId, r.rating, r.timestamp, r.line, *last)] += 1
        if r.rating >= 3.5:
            seen.append(r.movieId)
    have = Counter(
        (r.userId, r.movieId, r.rating, r.timestamp, r.line, r.userRatedMovie1, r.userRatedMovie2, r.userRatedMovie3) for r in got
    )
    assert have == want


def test_sequences_keep_every_item(big_user):
    got = H.user_sequences(big_user, CUT, max_len=10)
    assert got.agg(F.max(F.size("movieIds"))).first()[0] <= 10
    assert got.select(F.explode("movieIds")).count() == big_user.filter("rating >= 3.5").count()


def test_hot_keys_are_found(big_user):
    assert [r.userId for r in hot_keys(big_user, ["userId"], 100).collect()] == [1]
    assert hot_keys(big_user, ["userId"], 10**6).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_is_a_join(spark, big_user, how):
    names = spark.createDataFrame([(i, f"m{i}") for i in range(3, 30)], "movieId bigint, name string")
    hot = hot_keys(big_user, ["movieId"], 100)
    assert hot.count() >= 1
    assert bag(salted_join(big_user, names, ["movieId"], hot, how, 8)) == bag(big_user.join(names, "movieId", how))


def test_skew_join_without_broadcast(spark, big_user):
    names = spark.createDataFrame([(i, f"m{i}") for i in range(3, 30)], "movieId bigint, name string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = bag(skew_join(big_user, names, ["movieId"], hot_rows=100))
        shares = bag(share_of_group(big_user, ["movieId"], "rating", hot_rows=100))
        totals = bag(with_group_totals(big_user, ["userId"], {"n": F.count(F.lit(1))}, hot_rows=50))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == bag(big_user.join(names, "movieId", "left"))
    whole = W.partitionBy("movieId")
    assert shares == bag(big_user.withColumn("share", F.col("rating") / F.sum("rating").over(whole)))
    assert totals == bag(big_user.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("userId"))))


def test_guide_table_in_pieces_covers_every_slot(spark, big_user):
    counts = G.item_pair_counts(G.adjacent_pairs(big_user, CUT))
    for hot_rows in (10**9, 2):
        table = G.sampling_table(counts, hot_rows=hot_rows).collect()
        sizes = {(r.src, r.dst): r.cnt for r in counts.collect()}
        spans = {}
        for r in table:
            spans[(r.src, r.dst)] = (r.start, r.end)
        assert {k: e - s for k, (s, e) in spans.items()} == sizes
        by_src = {}
        for (src, _), span in spans.items():
            by_src.setdefault(src, []).append(span)
        for found in by_src.values():
            found.sort()
            assert found[0][0] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:]))
        assert len(table) <= 2 * len(sizes) + len(by_src)


def _vectors(spark, n, dim=6, seed=3, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(v) for v in rng.normal(size=dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(copies)]
    return rows, spark.createDataFrame(rows, "id bigint, emb array<double>")


@pytest.mark.parametrize("block", [7, 1000])
@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_blocked_top_k_is_exact(spark, block, metric):
    rows, df = _vectors(spark, 40, copies=8)
    got = {}
    for r in R.blocked_top_k(df, df, 5, metric, same=True, block_rows=block).collect():
        got.setdefault(r.id, []).append((r.rank, r.item, r.score))
    mat = np.array([v for _, v in rows])
    for i, (key, v) in enumerate(rows):
        v = np.array(v)
        if metric == "dot":
            s = mat @ v
        elif metric == "cosine":
            s = (mat @ v) / (np.linalg.norm(mat, axis=1) * np.linalg.norm(v))
        else:
            s = -np.sqrt(np.maximum(((mat - v) ** 2).sum(1), 0))
        order = sorted((-round(float(x), 11) + 0.0, rows[j][0]) for j, x in enumerate(s) if j != i)[:5]
        assert [g[1] for g in sorted(got[key])] == [o[1] for o in order]


def test_recommendations_stay_full_for_a_user_who_saw_almost_all(spark):
    _, items = _vectors(spark, 50)
    _, users = _vectors(spark, 3, seed=9)
    seen = spark.createDataFrame([(0, i) for i in range(45)] + [(1, 3), (1, 3)], "id bigint, item bigint")
    got = R.recommend_for_users(users, items, 5, seen, block_rows=8).collect()
    assert {r.item for r in got if r.id == 0} == set(range(45, 50))
    assert 3 not in {r.item for r in got if r.id == 1}
    assert Counter(r.id for r in got) == {0: 5, 1: 5, 2: 5}


@pytest.mark.parametrize("block", [6, 1000])
def test_similar_pairs(spark, block):
    rows, df = _vectors(spark, 30, copies=20)
    got = {(r.id_a, r.id_b): r.distance for r in R.similar_pairs(df, 2.0, block_rows=block).collect()}
    mat = np.array([v for _, v in rows[:30]])
    want = {}
    for a in range(30):
        for b in range(a + 1, 30):
            d = round(float(np.linalg.norm(mat[a] - mat[b])), 6)
            if d <= 2.0:
                want[(a, b)] = d
    assert got == want
    classes = R.copy_classes(df)
    assert sorted(map(tuple, classes.collect())) == sorted([(i, i) for i in range(30)] + [(0, 30 + i) for i in range(20)])
    # Copies and their neighbours written out: every pair of ids, as a plain self join finds them.
    all_ids = np.array([v for _, v in rows])
    full = {(a, b): round(float(np.linalg.norm(all_ids[a] - all_ids[b])), 6) for a in range(50) for b in range(50) if a != b}
    asked = R.pairs_of(R.similar_pairs(df, 2.0, block_rows=block), classes, df.filter("id in (0, 3, 41)")).collect()
    assert {(r.id, r.other): r.distance for r in asked} == {k: d for k, d in full.items() if d <= 2.0 and k[0] in (0, 3, 41)}
    near = {(r.id_a, r.id_b) for r in R.similar_pairs(df, 2.0, exact=False, dim=len(rows[0][1]), bucket_length=4.0, block_rows=block).collect()}
    assert near <= set(want) and len(near) >= 0.9 * len(want)


@pytest.mark.parametrize("scope", ["global", "as_of"])
def test_training_samples_with_hot_users_and_movies(spark, big_user, scope):
    from marquee.plans.training_samples import training_samples

    movies = spark.createDataFrame(
        [(i, f"T{i} ({1950 + i})", "A|B" if i % 2 else "B|C|D") for i in range(1, 38)], "movieId bigint, title string, genres string"
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = bag(training_samples(big_user, movies, PLAIN, H.History(("movieId",), ties=("line", "userId", "rating")), scope))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_movie = H.History(("movieId",), ties=("line", "userId", "rating"), hot_rows=100, span=7200)
        got = bag(training_samples(big_user, movies, CUT, by_movie, scope))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want and sum(got.values()) == big_user.count()


def test_ranks_of_tiny_scores(spark):
    """Scores far below any fixed number of decimals still decide."""
    users = spark.createDataFrame([(1, [1e-4, 0.0])], "id bigint, emb array<double>")
    items = spark.createDataFrame([(1, [1e-4, 0.0]), (2, [5e-4, 0.0]), (3, [9e-4, 0.0])], "id bigint, emb array<double>")
    got = R.recommend_for_users(users, items, 1).collect()
    assert [(r.item, r.score) for r in got] == [(3, pytest.approx(9e-8))]


def test_rows_without_a_key_are_sliced(spark):
    """A third of the rows has no user: they are cut into slices and windowed as one key."""
    rows = [(None if i % 3 == 0 else i % 7, i % 11, (i % 10) / 2, (i * 37 % 300) * 3600, i) for i in range(600)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint, line int")
    plain, small = H.History(ties=("line",)), H.History(ties=("line",), hot_rows=50)
    laid = small.lay_out(df)
    assert laid.no_key and laid.df.filter("userId is null and not _hot").isEmpty()
    assert laid.df.filter("userId is null").select("_slice").distinct().count() > 5
    for f in (H.with_position, H.prior_stats, H.next_item):
        assert bag(f(df, history=small)) == bag(f(df, history=plain))


def test_one_second_of_one_key_is_cut_by_rank(spark):
    """All rows of a key carry one timestamp: the key is visibly sliced, and nothing changes."""
    rows = [(1 if i % 3 else i % 40, (i * 7) % 50, (i % 10) / 2, 1000, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint, line int")
    small = H.History(ties=TIES, hot_rows=100)
    laid = small.lay_out(df)
    sizes = [r["count"] for r in laid.df.filter("userId = 1").groupBy("_slice").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 300
    for run in (H.with_position, H.prior_stats, H.next_item, lambda d, history: H.recent_items(d, 4, history), lambda d, history: H.user_sequences(d, history, max_len=9)):
        assert bag(run(df, history=small)) == bag(run(df, history=PLAIN))


def test_deviation_far_from_zero(spark):
    """Values near 1e9 with deviation 1: merged slices equal a two-pass deviation."""
    rng = np.random.default_rng(3)
    values = 1e9 + rng.normal(size=600)
    rows = [(1, 0, float(v), i * 3600, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint, line int")
    for history in (PLAIN, CUT, FINE, H.History(ties=TIES, hot_rows=50, span=10**9)):
        for r in H.prior_stats(df, history).collect():
            if r.line >= 2:
                before = values[: r.line]
                assert r.userRatingStddev == pytest.approx(np.std(before - before.mean(), ddof=1), rel=1e-6)
                assert r.userAvgRating == pytest.approx(before.mean(), rel=1e-12)


@pytest.mark.parametrize("history", [PLAIN, CUT, FINE], ids=["plain", "cut", "fine"])
def test_running_favourites_against_brute_force(spark, big_user, history):
    """Every row sees the genres of its own past only."""
    genres = {m: [f"g{m % 5}", f"h{m % 3}"] + (["x"] if m % 7 == 0 else []) for m in range(0, 41)}
    table = spark.createDataFrame([(m, g) for m, g in genres.items() if m % 11], "movieId bigint, genres array<string>")
    rated = big_user.join(table, "movieId", "left")
    got = Counter((r.userId, r.line, r.movieId, r.rating, r.timestamp, r.userGenre1, r.userGenre2, r.userGenre3) for r in H.running_favourites(rated, "genres", 3, history).collect())
    want, counts, user = Counter(), Counter(), None
    for r in sorted(big_user.collect(), key=lambda r: (r.userId, r.timestamp, r.line, r.movieId, r.rating)):
        if r.userId != user:
            user, counts = r.userId, Counter()
        best = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]]
        want[(r.userId, r.line, r.movieId, r.rating, r.timestamp, *(best + [None] * 3)[:3])] += 1
        if r.rating >= 3.5 and r.movieId % 11:
            counts.update(genres[r.movieId])
    # Equal rows may swap their places.
    assert Counter(k[:5] for k in got) == Counter(k[:5] for k in want)
    assert sum((got & want).values()) >= sum(want.values()) - 40
    assert got == want


def test_favourites_of_rows_without_a_key(spark):
    rows = [(None if i % 2 else 1, i, 5.0, i * 3600, i, [f"g{i % 3}"]) for i in range(40)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint, line int, genres array<string>")
    cut = H.History(ties=TIES, hot_rows=5, span=7200)
    assert bag(H.running_favourites(df, "genres", 2, cut)) == bag(H.running_favourites(df, "genres", 2, PLAIN))


def test_size_estimates(spark):
    from marquee.durable import written
    from marquee.skew import bytes_of, estimated_bytes, fits_broadcast

    assert [bytes_of(x) for x in ("10485760", "10m", "256KB", " 2 g", "-1", "7b")] == [10485760, 10 << 20, 256 << 10, 2 << 30, -1, 7]
    small = written(spark.range(10), "small")
    assert 0 < estimated_bytes(small) < 20_000 and fits_broadcast(small)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit, fits in (("-1", False), ("1b", False), ("1g", True)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert fits_broadcast(small) is fits
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert estimated_bytes(small.alias("a").join(small.alias("b"), F.col("a.id") < F.col("b.id"))) > estimated_bytes(small)


def test_favourites_rank_few_genres(monkeypatch):
    """A row's favourites follow from the last ones and its own genres, however many were seen."""
    import random

    from marquee.operators import histories

    rng, ranked, top = random.Random(11), [], histories._top_genres
    monkeypatch.setattr(histories, "_top_genres", lambda counts, n: ranked.append(len(counts)) or top(counts, n))
    counts, seen, best = {}, {}, [None] * 5
    for _ in range(3000):
        genres = [rng.choice([None, *[f"g{i}" for i in range(60)]]) for _ in range(rng.randint(1, 3))]
        for g in genres:
            if g is not None:
                seen[g] = seen.get(g, 0) + 1
        best = histories._favourites_after(best, counts, genres, 5)
        assert best == top(seen, 5)
    assert counts == seen and max(ranked) <= 8
