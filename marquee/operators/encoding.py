"""Feature transforms on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Bucketizer,
    CountVectorizerModel,
    FeatureHasher,
    MinMaxScaler,
    OneHotEncoder,
    QuantileDiscretizer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.encoders import bucketize_by_array
from marquee.functions.text import split_genres
from marquee.operators.feature_layout import indicator  # noqa: F401  (M13)
from marquee.operators.quantiles import exact_quantiles
from marquee.skew import skew_join


def one_hot(df: DataFrame, id_col: str, out: str, drop_last: bool = False) -> DataFrame:
    """Sparse one-hot of an integer id; the width is the largest id plus one (M1)."""
    encoder = OneHotEncoder(inputCols=[id_col], outputCols=[out], dropLast=drop_last)
    return encoder.fit(df).transform(df)


def fit_string_index(df: DataFrame, col: str, out: str, invalid: str = "error") -> StringIndexerModel:
    return StringIndexer(inputCol=col, outputCol=out, handleInvalid=invalid, stringOrderType="frequencyDesc").fit(df)


def string_index(df: DataFrame, col: str, out: str, invalid: str = "error") -> DataFrame:
    """Index by falling frequency, ties by name (M2).

    The label list lives in the model: use it for bounded vocabularies such as
    genres, and :func:`frequency_index` for a column of any cardinality.
    """
    return fit_string_index(df, col, out, invalid).transform(df)


def label_map(df: DataFrame, col: str, out: str = "labelIndex") -> DataFrame:
    """Class to index in alphabetical order."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("int"))


def class_weights(df: DataFrame, label: str, weights: dict[str, float], out: str = "weight") -> DataFrame:
    """Weight per row from a weight per class, 1.0 for classes not named."""
    pairs = [F.lit(v) for item in weights.items() for v in item]
    return df.withColumn(out, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(label)), F.lit(1.0)))


def vocab_index_join(df: DataFrame, col: str, vocab: DataFrame, out: str) -> DataFrame:
    """Vocabulary as a table ``(value, index)``; -1 for unknown values (M9)."""
    words = vocab.select(F.col("value").alias(col), F.col("index").alias(out))
    joined = skew_join(df, words, [col])
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(-1)))


def multi_hot(movies: DataFrame, key: str = "movieId", genres: str = "genres", out: str = "vector") -> DataFrame:
    """Multi-hot genre vector per movie (M3).

    The vocabulary order is that of :func:`string_index`.  Each row already
    holds its whole list, so building the vectors needs no shuffle.
    """
    exploded = movies.select(F.explode(split_genres(F.col(genres))).alias("genre"))
    labels = fit_string_index(exploded, "genre", "genreIndex").labels
    encoder = CountVectorizerModel.from_vocabulary(list(labels), inputCol="_genres", outputCol=out)
    encoder.setBinary(True)
    listed = movies.withColumn("_genres", split_genres(F.col(genres)))
    return encoder.transform(listed).drop("_genres")


def to_dense(df: DataFrame, col: str, out: str) -> DataFrame:
    """Scalar to a vector of length one (M4)."""
    return VectorAssembler(inputCols=[col], outputCol=out, handleInvalid="keep").transform(df)


def quantile_discretizer(col: str, out: str, n: int = 100, error: float = 0.001) -> QuantileDiscretizer:
    return QuantileDiscretizer(inputCol=col, outputCol=out, numBuckets=n, relativeError=error)


def quantile_bucket(df: DataFrame, col: str, out: str, n: int = 100, error: float = 0.001) -> DataFrame:
    """At most n buckets of about equal size; equal splits merge (M5)."""
    return quantile_discretizer(col, out, n, error).fit(df).transform(df)


def quantile_splits(df: DataFrame, col: str, n: int = 100) -> list[float]:
    """Distinct exact split points of n buckets of equal frequency."""
    return sorted(set(exact_quantiles(df, col, [i / n for i in range(1, n)])))


def quantile_bucket_exact(df: DataFrame, col: str, out: str, n: int = 100) -> DataFrame:
    """Exact split points; equal values share a bucket."""
    splits = F.array(*[F.lit(s) for s in quantile_splits(df, col, n)]).cast("array<double>")
    return df.withColumn(out, F.when(F.col(col).isNotNull(), bucketize_by_array(F.col(col), splits)))


def min_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """(x - min) / (max - min), 0.5 for a constant column, as the ML scaler does
    it but on a plain column (M6)."""
    ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("ends"))
    x, lo, hi = F.col(col), F.col("_ends.lo"), F.col("_ends.hi")
    scaled = F.when(hi == lo, F.lit(0.5)).otherwise((x - lo) / F.nullif(hi - lo, F.lit(0.0)))
    return df.withColumn("_ends", ends.scalar()).withColumn(out, F.when(x.isNotNull(), scaled)).drop("_ends")


def min_max_scaler(vector: str, out: str) -> MinMaxScaler:
    return MinMaxScaler(inputCol=vector, outputCol=out)


def feature_stages(stages: Sequence, df: DataFrame) -> PipelineModel:
    """Fit ordered stages (M7); transform with the returned model."""
    return Pipeline(stages=list(stages)).fit(df)


def rating_feature_stages(stats: DataFrame, buckets: int = 100, exact: bool = False) -> DataFrame:
    """Rating count to quantile buckets and average rating to [0, 1] (M4-M7).

    Split points are the discretizer's approximate ones, or exact ones."""
    cutter = quantile_discretizer("ratingCount", "ratingCountBucket", buckets)
    if exact:
        splits = [float("-inf"), *quantile_splits(stats, "ratingCount", buckets), float("inf")]
        cutter = Bucketizer(splits=splits, inputCol="ratingCount", outputCol="ratingCountBucket")
    stages = [VectorAssembler(inputCols=["avgRating"], outputCol="avgRatingVec"), cutter, min_max_scaler("avgRatingVec", "scaleAvgRating")]
    return feature_stages(stages, stats).transform(stats)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Numbers and encoded categories to one vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def hashed_features(
    df: DataFrame, cols: Sequence[str], n: int = 1 << 18, out: str = "features", categorical: Sequence[str] = ()
) -> DataFrame:
    """Mixed columns hashed to one sparse vector."""
    hasher = FeatureHasher(inputCols=list(cols), outputCol=out, numFeatures=n)
    if categorical:
        hasher.setCategoricalCols(list(categorical))
    return hasher.transform(df)


def sparse_parts(vector: str) -> list:
    """Size and index list of a sparse vector column, without densifying it."""
    raw = F.unwrap_udt(F.col(vector))
    return [raw["size"].alias("size"), raw["indices"].alias("indices")]
