"""Evaluation of scored rows as aggregates (V1-V6).  One row out, except V6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.ranking import running_before, with_range_bucket

CLIP = 1e-7


def accuracy(df: DataFrame, label: str = "label", probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Share of rows whose thresholded probability equals the label (V1)."""
    hit = (F.col(probability) > threshold).cast("int") == F.col(label)
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def log_loss(df: DataFrame, label: str = "label", probability: str = "probability", clip: float = CLIP) -> DataFrame:
    """Mean binary cross-entropy with clipped probabilities (V2)."""
    p = F.least(F.greatest(F.col(probability), F.lit(clip)), F.lit(1.0 - clip))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("logLoss"))


def mse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean squared error (V5)."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.avg(error * error).alias("mse"))


def _by_score(df: DataFrame, label: str, score: str, sign: int) -> DataFrame:
    """Positives and negatives per distinct score, in range buckets.  A score
    shared by a third of all rows is one row here."""
    grouped = df.groupBy((F.col(score).cast("double") * sign).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
    )
    return with_range_bucket(grouped, "s")


def _pair_area(pos: Column, neg: Column, neg_below: Column) -> Column:
    return pos.cast("double") * (neg_below + neg / 2.0)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; tied scores count one half (V3).

    NULL when one class is missing."""
    ordered = running_before(_by_score(df, label, score, 1), ["s"], {"below": F.col("neg")})
    sums = ordered.agg(
        F.sum(_pair_area(F.col("pos"), F.col("neg"), F.col("below"))).alias("area"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    return sums.select((F.col("area") / F.nullif(F.col("p").cast("double") * F.col("n"), F.lit(0.0))).alias("rocAuc"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under precision over recall by trapezoids between distinct scores,
    starting from recall 0 at the first point's precision (V4)."""
    falling = _by_score(df, label, score, -1)
    ordered = running_before(falling, ["s"], {"tp0": F.col("pos"), "fp0": F.col("neg")})
    tp, fp = F.col("tp0") + F.col("pos"), F.col("fp0") + F.col("neg")
    here = tp / (tp + fp)
    before = F.coalesce(F.col("tp0") / F.nullif(F.col("tp0") + F.col("fp0"), F.lit(0)), here)
    sums = ordered.agg(F.sum(F.col("pos") * (here + before) / 2.0).alias("area"), F.sum("pos").alias("p"))
    return sums.select((F.col("area") / F.nullif(F.col("p"), F.lit(0))).alias("prAuc"))


def check_labels(train: DataFrame, valid: DataFrame, label: str = "label") -> DataFrame:
    """Labels of ``valid`` that training never saw (V6): must be empty."""
    return valid.select(label).distinct().join(train.select(label).distinct(), on=label, how="left_anti")


def evaluate(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Log loss, accuracy, ROC and PR area of scored rows, as one row."""
    parts = [log_loss(df, label, probability), accuracy(df, label, probability)]
    parts += [roc_auc(df, label, probability), pr_auc(df, label, probability)]
    first = parts[0]
    for p in parts[1:]:
        first = first.withColumn(p.columns[0], p.scalar())
    return first
