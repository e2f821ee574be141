"""Transition graph and walks."""

from collections import Counter

from pyspark.sql import functions as F

from marquee import skew
from marquee.operators import embedding as EM
from marquee.operators import graph as G
from marquee.operators.histories import History

TIES = History(ties=("line", "movieId", "rating"))


def test_probabilities_sum_to_one(big_user):
    counts = G.item_pair_counts(G.adjacent_pairs(big_user, TIES))
    sums = G.transition_matrix(counts).groupBy("src").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    assert abs(G.item_distribution(counts).agg(F.sum("prob")).first()[0] - 1) < 1e-9


def test_pairs_of_arrays(spark):
    seqs = spark.createDataFrame([(["a", "b", "b"],), (["x"],), ([],)], "items array<string>")
    got = Counter((r.src, r.dst) for r in G.pairs_of_sequences(seqs).collect())
    assert got == {("a", "b"): 1, ("b", "b"): 1}


def test_walks_follow_edges_and_repeat(big_user):
    counts = G.item_pair_counts(G.adjacent_pairs(big_user, TIES))
    edges = {(r.src, r.dst) for r in counts.collect()}
    first = {r.walk_id: r["items"] for r in G.random_walks(counts, 300, 6, seed=1).collect()}
    again = {r.walk_id: r["items"] for r in G.random_walks(counts, 300, 6, seed=1, hot_rows=2).collect()}
    assert len(first) == 300 and set(first) == set(range(300))
    assert all((a, b) in edges for w in first.values() for a, b in zip(w, w[1:]))
    assert {k: len(v) for k, v in first.items()} and all(1 <= len(v) <= 6 for v in first.values())
    other = {r.walk_id: r["items"] for r in G.random_walks(counts, 300, 6, seed=2).collect()}
    assert other != first and again.keys() == first.keys()


def test_hot_successors_are_counted_from_the_edges(big_user, monkeypatch):
    """Not from the guide table, which would be computed once more."""
    counted = []

    def watched(df, keys, hot_rows):
        counted.append(df.columns)
        return plain(df, keys, hot_rows)

    plain = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", watched)
    monkeypatch.setattr(G, "hot_keys", watched)
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    counts = G.item_pair_counts(G.adjacent_pairs(big_user, TIES))
    walks = {r.walk_id: r["items"] for r in G.random_walks(counts, 40, 4, seed=1, hot_rows=8).collect()}
    # The start table, of one root, is counted itself.
    assert ["src", "dst", "cnt"] in counted and sum("bucket" in columns for columns in counted) == 1
    monkeypatch.undo()
    assert walks == {r.walk_id: r["items"] for r in G.random_walks(counts, 40, 4, seed=1, hot_rows=8).collect()}


def test_walk_stops_at_a_dead_end(spark):
    counts = spark.createDataFrame([("a", "b", 3), ("b", "c", 1)], "src string, dst string, cnt bigint")
    for r in G.random_walks(counts, 50, 9).collect():
        assert "".join(r["items"]) in ("abc", "bc")


def test_draws_follow_the_counts(spark):
    counts = spark.createDataFrame(
        [("a", "a", 700), ("a", "b", 200), ("a", "c", 100), ("b", "a", 1), ("c", "a", 1)], "src string, dst string, cnt bigint"
    )
    steps = Counter()
    for r in G.random_walks(counts, 4000, 4, seed=3).collect():
        steps.update(zip(r["items"], r["items"][1:]))
    total = sum(n for (s, _), n in steps.items() if s == "a")
    for dst, p in (("a", 0.7), ("b", 0.2), ("c", 0.1)):
        assert abs(steps[("a", dst)] / total - p) < 0.03


def test_item2vec_is_repeatable_and_shaped(spark):
    seqs = spark.createDataFrame([([str(i % 5), str((i + 1) % 5), str((i + 2) % 5)],) for i in range(60)], "movieIds array<string>")
    a = {r.id: r.emb for r in EM.train_item2vec(seqs, dim=4).collect()}
    b = {r.id: r.emb for r in EM.train_item2vec(seqs, dim=4).collect()}
    assert a == b and set(a) == {"0", "1", "2", "3", "4"} and {len(v) for v in a.values()} == {4}
