"""Metrics against brute force and the built-in evaluator."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from marquee.operators import metrics as V
from marquee.operators.ranking import global_rank, with_range_bucket

ROWS = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.2, 0.5, 0.7, 0.9]) | st.floats(0, 1)), min_size=2, max_size=25)


def frame(spark, rows):
    return spark.createDataFrame([(int(y), float(s)) for y, s in rows], "label int, score double")


@settings(max_examples=10, deadline=None)
@given(ROWS)
def test_roc_auc(spark, rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    got = V.roc_auc(frame(spark, rows)).first()[0]
    if not pos or not neg:
        assert got is None
        return
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want, abs=1e-12)
    mapped = [(y, 4 * s) for y, s in rows]  # exact for every float, also below the normal ones
    flipped = [(y, -s) for y, s in rows]
    assert V.roc_auc(frame(spark, mapped)).first()[0] == pytest.approx(want, abs=1e-12)
    assert V.roc_auc(frame(spark, flipped)).first()[0] == pytest.approx(1 - want, abs=1e-12)


def test_areas_equal_the_evaluator_on_many_scores(spark):
    df = spark.range(5000).select(
        (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("label"),
        F.round(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9973)) / 9973.0 * (1 + F.pmod("id", F.lit(2))), 3).alias("score"),
    )
    doubled = df.withColumn("label", F.col("label").cast("double"))
    for metric, ours in (("areaUnderROC", V.roc_auc), ("areaUnderPR", V.pr_auc)):
        built_in = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0, metricName=metric).evaluate(doubled)
        assert ours(df).first()[0] == pytest.approx(built_in, abs=1e-9)


def test_global_rank_with_outliers_and_ties(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([1e12, -5, 0, 0, 0, 1, 2, 3, -1e9, 0.5] * 30)], "id int, x double")
    ranked = global_rank(with_range_bucket(df, "x"), ["x", "id"]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 301))
    assert [(r.x, r.id) for r in ranked] == sorted((r.x, r.id) for r in ranked)


def test_plain_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.6), (0, 0.0)], "label int, probability double")
    assert V.accuracy(df).first()[0] == pytest.approx(2 / 3)
    import math

    want = -(math.log(0.9) + math.log(0.4) + math.log(1 - 1e-7)) / 3
    assert V.log_loss(df).first()[0] == pytest.approx(want)
    assert V.mse(df, "label", "probability").first()[0] == pytest.approx((0.01 + 0.36) / 3)
    assert V.evaluate(df).columns == ["logLoss", "accuracy", "rocAuc", "prAuc"]


def test_unseen_labels(spark):
    a = spark.createDataFrame([(0,), (1,)], "label int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "label int")
    assert [r.label for r in V.check_labels(a, b).collect()] == [2]
    assert V.check_labels(b, a.filter("label = 1")).count() == 0
