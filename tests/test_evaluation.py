"""Splits, held-out evaluation, quantiles and feature layouts."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from marquee.operators import encoding as M
from marquee.operators import evaluation as EV
from marquee.operators import feature_layout as FL
from marquee.operators import models as L
from marquee.operators.quantiles import exact_quantiles, order_statistics
from marquee.sources import layouts as LA


def test_split_by_key_is_a_property_of_the_key(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 500)
    train, rest = EV.split_by_key(df, ["k"])
    keys = {r.k for r in rest.collect()}
    assert 60 < len(keys) < 140 and not keys & {r.k for r in train.collect()}
    again = EV.split_by_key(df.repartition(7), ["k"])[1]
    assert {r.k for r in again.collect()} == keys
    assert train.count() + rest.count() == 2000


def test_split_by_time_keeps_ties_together(spark):
    df = spark.createDataFrame([(i, i // 10 if i < 95 else None) for i in range(100)], "id int, t int")
    train, rest = EV.split_by_time(df, "t")
    assert train.agg(F.max("t")).first()[0] < rest.agg(F.min("t")).first()[0]
    assert rest.count() == 25 and train.filter("t is null").count() == 5
    none = df.filter("t is null")
    assert [x.count() for x in EV.split_by_time(none, "t")] == [5, 0]


def test_a_constant_model_stays_below_the_floor(spark):
    base = spark.range(800).select("id", (F.pmod(F.xxhash64("id"), F.lit(10))).cast("string").alias("c"))
    df = base.withColumn("label", (F.col("c").cast("int") < 4).cast("double"))
    train, rest = EV.split_by_key(df, ["id"])
    good = EV.held_out_metrics(lambda d: L.train_logistic(d, ["c"], n=64), train, rest).first()
    assert good.rocAuc > 0.95 and good.accuracy > 0.9
    constant = EV.held_out_metrics(lambda d: L.train_logistic(d, ["c"], n=64, l1=100.0), train, rest).first()
    assert constant.rocAuc == 0.5


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0] * 40 + [2.0] * 3,
        [2.0**-k for k in range(300)] + [0.0, -1e300, 1e300],
        [random.Random(2).gauss(1e9, 1) for _ in range(700)],
        [None, 3.0, float("nan"), 1.0, 2.0],
    ],
)
def test_order_statistics(spark, values):
    solid = sorted(v for v in values if v is not None and not math.isnan(v))
    ranks = list(range(0, len(solid), max(1, len(solid) // 13))) + [len(solid) - 1, len(solid), -1]
    got = order_statistics(frame(spark, values), "x", ranks)
    assert got == {r: solid[r] for r in ranks if 0 <= r < len(solid)}


def test_quantiles_equal_the_sorted_ones(spark):
    rng = random.Random(4)
    values = [round(rng.expovariate(0.1), 2) for _ in range(1500)]
    fractions = [i / 100 for i in range(1, 100)]
    assert exact_quantiles(frame(spark, values), "x", fractions) == pytest.approx(np.quantile(values, fractions).tolist(), abs=1e-9)
    assert exact_quantiles(frame(spark, []).repartition(1), "x", fractions) == []


def test_wide_indicator_ships_its_width_only(spark):
    df = spark.createDataFrame([(0,), (403_647,), (403_648,), (-1,), (None,)], "i int")
    encoder = FL.fixed_encoder(spark, ["_slot"], ["v"], [403_648])
    assert list(encoder.categorySizes) == [403_648]
    got = [r.v for r in M.indicator(df, "i", 403_648, "v").collect()]
    assert got == [SparseVector(403_648, {0: 1.0}), SparseVector(403_648, {403_647: 1.0})] + [SparseVector(403_648, {})] * 3


def test_layout_positions(spark):
    layout = [FL.Words("w", ["a", "b"]), FL.Number("x"), FL.Bounded("x", [0.5, 1.5]), FL.Identity("i", 4), FL.Hashed("w", 8), FL.Crossed(["w", "i"], 16)]
    assert FL.width(layout) == 34
    assert [tuple(r) for r in FL.offsets(spark, layout).collect()] == [("w", 0, 2), ("x", 2, 1), ("x", 3, 3), ("i", 6, 4), ("w", 10, 8), ("w_x_i", 18, 16)]
    rows = [("b", 1.5, 3), ("z", None, 9), (None, 0.0, -1)]
    df = spark.createDataFrame(rows, "w string, x double, i int")
    got = [{p.position: p.value for p in r.p} for r in FL.encode(df, layout).select(FL.positions("features").alias("p")).collect()]
    assert got[0].keys() >= {1, 2, 5, 9} and got[0][2] == 1.5 and len(got[0]) == 6
    # Neither word nor number nor integer is known: hash and cross are left.
    assert len(got[1]) == 2 and all(k >= 10 for k in got[1])
    assert set(got[2]) - {3} == {k for k in got[2] if k >= 18} and len(got[2]) == 2


def test_layouts_fit_their_files():
    for features, columns in ((LA.TAG_FEATURES, LA.TAG_SAMPLES), (LA.LISTING_FEATURES, LA.LISTING_SAMPLES), (LA.MOVIE_FEATURES, LA.MOVIE_SAMPLES), (LA.BEHAVIOUR_FEATURES, LA.TAG_BEHAVIOUR)):
        for f in features:
            assert set(f.names if isinstance(f, FL.Crossed) else [f.name]) <= set(columns)
    assert (len(LA.TAG_SAMPLES), len(LA.TAG_SAMPLES_NEW), len(LA.LISTING_SAMPLES)) == (42, 28, 28)


def test_movie_layout(spark):
    values = {n: {"int": 7, "float": 2.5, "string": "Drama"}[t] for n, t in LA.MOVIE_SAMPLES.items()}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {t}" for n, t in LA.MOVIE_SAMPLES.items()))
    found = FL.encode(df, LA.MOVIE_FEATURES).select("features", FL.positions("features").alias("p")).first()
    assert found.features.size == FL.width(LA.MOVIE_FEATURES)
    # Eight genres, two ids, seven numbers and the cross.
    assert len(found.p) == 18 and {19 * i + 10 for i in range(8)} <= {p.position for p in found.p}


def murmur3(data, seed):
    """32-bit murmur hash of whole bytes, as signed."""
    mask, h = 0xFFFFFFFF, seed

    def rotated(x, r):
        return ((x << r) | (x >> (32 - r))) & mask

    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        k = rotated(int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (rotated(h ^ k, 13) * 5 + 0xE6546B64) & mask
    if tail := data[whole:]:
        h ^= rotated(int.from_bytes(tail, "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ (h >> shift)) * factor & mask
    return h - (1 << 32) if h >> 31 else h


def test_hashed_features_by_position(spark):
    df = spark.createDataFrame([("x1", 7, 2.5), ("long value", 8, -1.0)], "c string, k int, x double")
    n = 1 << 10
    for r in M.hashed_features(df, ["c", "k", "x"], n, categorical=["k"]).collect():
        want = {}
        for name, value in ((f"c={r.c}", 1.0), (f"k={r.k}", 1.0), ("x", r.x)):
            want[murmur3(name.encode(), 42) % n] = value
        assert dict(zip(r.features.indices.tolist(), r.features.values.tolist(), strict=True)) == want
