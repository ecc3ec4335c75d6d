"""Prediction quality: RMSE and the absolute-error histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Histogram bucket labels, lower bounds 0, 1, 2, 3, 4 (the last is open).
BUCKETS = [">=0 and <1", ">=1 and <2", ">=2 and <3", ">=3 and <4", ">=4"]


def _joined(pred: DataFrame, labels: DataFrame) -> DataFrame:
    return pred.join(labels.select("user_id", "business_id", "label"), ["user_id", "business_id"])


def rmse(pred: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: (n, rmse)."""
    d = _joined(pred, labels)
    return d.agg(F.count(F.lit(1)).alias("n"),
                 F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).alias("rmse"))


def error_histogram(pred: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, n): absolute errors in [0,1), [1,2), [2,3), [3,4), [4, inf)."""
    err = F.abs(F.col("prediction") - F.col("label"))
    bucket = (F.when(err < 1, F.lit(BUCKETS[0])).when(err < 2, F.lit(BUCKETS[1]))
              .when(err < 3, F.lit(BUCKETS[2])).when(err < 4, F.lit(BUCKETS[3])).otherwise(F.lit(BUCKETS[4])))
    return _joined(pred, labels).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
