"""Per-key rating statistics and grouping operators.

All are hash aggregates with map-side partial aggregation, so a key holding a third of all rows is
combined inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_ratings(train: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """(user_id, business_id, stars), one row per pair: the rating of the last row by ``order_by``,
    then by stars; ``line`` of :mod:`ratewise.sources.readers` makes that the last line of the file.
    Without ``order_by`` the largest rating stands."""
    last = F.struct(*(order_by or []), "stars")
    return train.groupBy("user_id", "business_id").agg(F.max_by("stars", last).alias("stars"))


def item_stats(train: DataFrame) -> DataFrame:
    """(business_id, item_mean, item_degree): mean over all of the item's ratings."""
    return train.groupBy("business_id").agg(
        F.avg("stars").alias("item_mean"), F.count(F.lit(1)).alias("item_degree"))


def user_stats(train: DataFrame) -> DataFrame:
    """(user_id, user_mean, user_degree): the fallback prediction and the heavy-user test."""
    return train.groupBy("user_id").agg(
        F.avg("stars").alias("user_mean"), F.count(F.lit(1)).alias("user_degree"))


def item_mean(train: DataFrame) -> DataFrame:
    return train.groupBy("business_id").agg(F.avg("stars").alias("item_mean"))


def user_mean(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(F.avg("stars").alias("user_mean"))


def ratings_by_key(train: DataFrame, key: str = "business_id") -> DataFrame:
    """Grouped view of the ratings: per key, the count, sum and mean of stars.

    A summary, not the rating lists that the survey describes: the plans here stay in long form, so
    no group is ever collected into one row.
    """
    return train.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.sum("stars").alias("sum_stars"),
        F.avg("stars").alias("avg_stars"))


def explode_group_having(train: DataFrame, key: str = "user_id", value: str = "business_id",
                         min_size: int = 2) -> DataFrame:
    """Keys with at least ``min_size`` values, and how many they have.

    A summary, not the concatenated list that the survey describes: no group is gathered into a
    single row. (The long-form input is already flat.)
    """
    return (train.groupBy(key).agg(F.count(value).alias("n_values"))
            .filter(F.col("n_values") >= min_size))


def tip_stats(tip: DataFrame, key: str, suffix: str) -> DataFrame:
    """Count, mean likes and mean text length of tips per ``key``."""
    return tip.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"n_tip_{suffix}"),
        F.avg("likes").alias(f"avg_like_{suffix}"),
        F.avg(F.length("text")).alias(f"avg_tip_len_{suffix}"))
