"""Prediction sinks.

Both write ``user_id, business_id, prediction`` rows as CSV from the executors (no collect). The
"loose" variant reproduces the header with a space after each comma; Spark trims header names
unless told otherwise, so the writer disables leading-whitespace trimming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _prepare(df: DataFrame, order_by: str | None, files: int | None) -> DataFrame:
    """The output columns. With ``order_by`` rows are range-partitioned by that column and sorted: part
    files in the order of their names follow it. ``files``: how many, default the shuffle partitions."""
    if order_by:
        n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    return df.select(F.col("user_id").cast("string"), F.col("business_id").cast("string"),
                     F.col("prediction").cast("double"))


def write_predictions_csv(df: DataFrame, path: str, order_by: str | None = None, files: int | None = None) -> None:
    """Header ``user_id,business_id,prediction``; one part file per partition."""
    out = _prepare(df, order_by, files)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_predictions_csv_loose(df: DataFrame, path: str, order_by: str | None = None, files: int | None = None) -> None:
    """Header ``user_id, business_id, prediction`` (spaces after commas in the header only)."""
    out = _prepare(df, order_by, files).toDF("user_id", " business_id", " prediction")
    (out.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def in_line_order(pred: DataFrame, pairs: DataFrame, line: str = "line") -> DataFrame:
    """Every row of ``pairs`` with its prediction and its ``line``; ``pred`` may repeat a pair, which then
    has one prediction."""
    once = pred.groupBy("user_id", "business_id").agg(F.max("prediction").alias("prediction"))
    return pairs.select("user_id", "business_id", line).join(once, ["user_id", "business_id"])
