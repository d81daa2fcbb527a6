"""AUC, accuracy, precision, recall and F1 over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmweave.operators.features import LABEL

#: Ranges of the score, about equally full of distinct scores; each is ordered by itself.
RANGES = 256
#: Bins of the histogram for the binned area.
BINS = 1000


def _is(column: str, value: float) -> Column:
    return F.col(column) == value


def _per_score(df: DataFrame, score: str, label: str, prediction: str | None) -> DataFrame:
    """Counts per distinct score. Equal scores meet before the shuffle, so no score is a hot key."""
    hit = _is(prediction, 1.0) if prediction else F.lit(False)
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(_is(label, 1.0)).alias("pos"),
        F.count_if(_is(label, 0.0)).alias("neg"),
        F.count_if(hit & _is(label, 1.0)).alias("tp"),
        F.count_if(hit & _is(label, 0.0)).alias("fp"),
    )


def _score_folds(df: DataFrame, score: str, label: str, prediction: str | None = None) -> DataFrame:
    """Counts per score, folded by range.

    A global ordered window would put all scores in one task. Here each range of the score is ordered by itself,
    and only one row per range, RANGES at most, goes on to the window that adds up the ranges. ``wins`` counts the
    (positive, negative) pairs in which the positive scores higher, a tie counting half.
    """
    scores = _per_score(df, score, label, prediction)
    cuts = scores.agg(F.percentile_approx("score", [i / RANGES for i in range(1, RANGES)]).alias("cuts"))
    ranged = scores.join(F.broadcast(cuts)).withColumn(  # one row of cuts
        "range", F.coalesce(F.size(F.filter("cuts", lambda cut: cut <= F.col("score"))), F.lit(0))
    )
    higher = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumn("over", F.coalesce(F.sum("pos").over(higher), F.lit(0)))
    ranges = inner.groupBy("range").agg(
        F.sum("pos").cast("double").alias("positives"),
        F.sum("neg").cast("double").alias("negatives"),
        F.sum(F.col("neg") * (F.col("over") + F.col("pos") / 2)).alias("wins"),
        F.sum("tp").cast("double").alias("tp"),
        F.sum("fp").cast("double").alias("fp"),
    )
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("above", F.coalesce(F.sum("positives").over(above), F.lit(0.0))).agg(
        F.sum("positives").alias("positives"),
        F.sum("negatives").alias("negatives"),
        F.sum(F.col("wins") + F.col("negatives") * F.col("above")).alias("wins"),
        F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"),
    )


def _auc() -> Column:
    return F.try_divide(F.col("wins"), F.col("positives") * F.col("negatives"))


def exact_auc(df: DataFrame, score: str = "score", label: str = LABEL) -> DataFrame:
    """Area under the ROC curve, not binned; NULL unless both classes are there."""
    return _score_folds(df, score, label).select(_auc().alias("auc"))


def binned_auc(df: DataFrame, score: str = "score", label: str = LABEL, bins: int = BINS, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """One row: auc from a histogram of the scores per class, and error, by which it is off at most; NULL unless both classes are there.

    ``bins`` equal ranges lie between ``low`` and ``high``; scores beyond them are counted with the first or the last, NULL and NaN scores with none.
    Each task sends on a row per bin, however many rows and distinct scores there are. Only pairs of one bin are in doubt: they count half,
    so the error is half their share of all pairs.
    """
    place = F.floor((F.col(score).cast("double") - low) / (high - low) * bins)
    known = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    counts = known.groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(
        F.count_if(_is(label, 1.0)).cast("double").alias("pos"), F.count_if(_is(label, 0.0)).cast("double").alias("neg")
    )
    above = F.coalesce(F.sum("pos").over(Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    pairs = F.sum("pos") * F.sum("neg")
    return counts.withColumn("above", above).agg(  # bins rows in one task
        F.try_divide(F.sum(F.col("neg") * (F.col("above") + F.col("pos") / 2)), pairs).alias("auc"),
        F.try_divide(F.sum(F.col("neg") * F.col("pos")) / 2, pairs).alias("error"),
    )


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row of tp, fp, tn, fn; only partial sums are shuffled."""
    cells = {"tp": (1.0, 1.0), "fp": (0.0, 1.0), "tn": (0.0, 0.0), "fn": (1.0, 0.0)}
    return df.agg(
        *[F.count_if(_is(label, y) & _is(prediction, p)).alias(name) for name, (y, p) in cells.items()]
    )


def _ratios() -> dict[str, Column]:
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return {
        "accuracy": F.try_divide(tp + tn, tp + fp + tn + fn),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
    }


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    return confusion(df, label, prediction).select(_ratios()["accuracy"].alias("accuracy"))


def precision_recall_f1(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of the positive class; NULL where a ratio has no denominator."""
    ratios = _ratios()
    return confusion(df, label, prediction).select(
        *[ratios[name].alias(name) for name in ("precision", "recall", "f1")]
    )


def evaluate(
    df: DataFrame, score: str = "score", label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """All five measures in one pass over the scored rows."""
    folded = _score_folds(df, score, label, prediction).withColumns(
        {"fn": F.col("positives") - F.col("tp"), "tn": F.col("negatives") - F.col("fp")}
    )
    return folded.select(_auc().alias("auc"), *[c.alias(name) for name, c in _ratios().items()])
