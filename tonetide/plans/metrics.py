"""Model evaluation as aggregates.

* Regression metrics are one grouped aggregate: per-category or per-stock
  evaluation is a ``groupBy``, not a driver loop of evaluator jobs.
* AUC is exact (Mann-Whitney with tie-averaged ranks) and distributed:
  rows are first collapsed to distinct scores (partial aggregation, so a
  score shared by a third of the rows is one row), and the negatives below
  each distinct score are totals over range partitions of the scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import with_totals_before


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by=()) -> DataFrame:
    """n, mse, rmse, mae, r2 (= 1 - SSE / (n * var_pop(label)), the evaluator's r2) over the
    rows that have both a label and a prediction; a group without any has n = 0 and nulls."""
    by = [by] if isinstance(by, str) else list(by)
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label))
    err = y - F.col(prediction)
    sse = F.sum(err * err)
    n = F.count(err)
    return df.groupBy(*by).agg(
        n.alias("n"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(y) * n)).alias("r2"),
    )


def auc(df: DataFrame, label: str, score: str, by=(), rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Exact area under the ROC curve per group: columns ``by + [auc, n_pos, n_neg]``.

    A range partition has about ``rows_per_bucket`` distinct scores.
    """
    by = [by] if isinstance(by, str) else list(by)
    pos = (F.col(label) == 1).cast("long")
    neg = (F.col(label) == 0).cast("long")
    hist = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
            .groupBy(*by, F.col(score).alias("__s"))
            .agg(F.sum(pos).alias("__p"), F.sum(neg).alias("__n")))
    ranked = with_totals_before(hist, ["__s"], {"__below": F.col("__n")}, by, rows_per_bucket)
    u = F.sum(F.col("__p") * (F.col("__below") + F.col("__n") * F.lit(0.5)))
    out = ranked.groupBy(*by).agg(u.alias("__u"), F.sum("__p").alias("n_pos"), F.sum("__n").alias("n_neg"))
    return out.select(*by, F.try_divide(F.col("__u"), F.col("n_pos") * F.col("n_neg")).alias("auc"),
                      "n_pos", "n_neg")
