"""Evaluation metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.operators.cumulative import ROWS_PER_RANGE, running_totals


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Root mean square error as a one-row frame (same as RegressionEvaluator('rmse'))."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"))


def probability_of_positive(col: str = "probability"):
    """Element 1 of an ML probability vector (the positive class)."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(col)[1]


def auc(df: DataFrame, label: str = "label", score: str = "p", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """C11: exact area under ROC and under PR, as BinaryClassificationMetrics
    computes them with no down-sampling (numBins = 0).

    One aggregate per distinct score (positives, negatives); running sums
    over the scores in descending order (``running_totals``: range-bucketed,
    never one task); then each point's trapezoid only needs the previous
    point, which is the running sum minus the row's own counts -- so no
    ordered ``lag`` is needed.  ROC starts at (0, 0); PR starts at
    (0, precision of the first threshold).
    """
    per = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("tp_n"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("fp_n"),
    )
    cum = running_totals(per, "s", ["tp_n", "fp_n"], descending=True, rows_per_range=rows_per_range)
    tp, fp = F.col("cum_tp_n").cast("double"), F.col("cum_fp_n").cast("double")
    P, N = F.col("total_tp_n").cast("double"), F.col("total_fp_n").cast("double")
    tp0, fp0 = tp - F.col("tp_n"), fp - F.col("fp_n")
    # with no positives (or no negatives) the curve is undefined: try_divide gives null, never an error
    prec = F.try_divide(tp, tp + fp)
    prec0 = F.when(tp0 + fp0 == 0, prec).otherwise(F.try_divide(tp0, tp0 + fp0))
    steps = cum.select(
        (F.try_divide(fp - fp0, N) * F.try_divide(tp + tp0, P) / 2).alias("roc"),
        (F.try_divide(tp - tp0, P) * (prec + prec0) / 2).alias("pr"),
    )
    undefined = F.sum(F.when(F.col("roc").isNull(), 1).otherwise(0)) > 0
    return steps.agg(
        F.when(undefined, F.lit(None)).otherwise(F.sum("roc")).cast("double").alias("auc_roc"),
        F.when(F.sum(F.when(F.col("pr").isNull(), 1).otherwise(0)) > 0, F.lit(None)).otherwise(F.sum("pr")).cast("double").alias("auc_pr"),
    )
