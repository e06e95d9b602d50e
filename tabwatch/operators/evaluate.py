"""Area under ROC with tied scores averaged, computed as a distributed
rank sum:

AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)

Rows are first reduced to one row per distinct score (map-side combined),
so a score that a third of all rows share is one row.  The running count of
negatives below each score is a prefix sum over the ordered distinct scores, by
ranges that are split until each is one task's work (``ordered``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.operators.ordered import MAX_ROWS, prefix_sums


def auc_rank_sum(df: DataFrame, label: str, score: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row ``(auc, n_pos, n_neg)``; label 1 = positive, 0 = negative, any
    other label fails the job.  Rows without a score or label are left out; a NaN
    score ranks above all numbers.  The rows are read once: their distinct scores
    are written, and the ranges and the sums read that.  No task sorts more than
    ``max_rows`` distinct scores, however many there are."""
    y = F.col(label).cast("double")
    known = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(F.concat(F.lit("label is neither 0 nor 1: "), y.cast("string"))).cast("double"))
    sc = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(score).cast("double").alias("s"))
            .agg(F.sum(known).cast("bigint").alias("p"),
                 F.sum(1.0 - known).cast("bigint").alias("n")))
    t = prefix_sums(sc, ["s"], {"neg_below": F.col("n")}, max_rows)
    agg = t.agg(F.sum(F.col("p").cast("double") * (F.col("neg_below").cast("double") + F.col("n") / 2.0))
                .alias("_u"), F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"))
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(F.when(den > 0, F.col("_u") / den).alias("auc"),
                      F.col("n_pos").cast("bigint").alias("n_pos"),
                      F.col("n_neg").cast("bigint").alias("n_neg"))


def auc_evaluator(pred: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """MLlib's evaluator with the exact curve (numBins=0)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(pred))
