"""Id sets and scoping: which users / items appear in training or in the pairs to score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def id_union(train: DataFrame, pairs: DataFrame, col: str) -> DataFrame:
    """Distinct ids of ``col`` over training rows and pairs."""
    return train.select(col).union(pairs.select(col)).distinct()


def scope_users(user: DataFrame, train: DataFrame, pairs: DataFrame) -> DataFrame:
    """User profiles whose id occurs in training or in the pairs (semi-join)."""
    return user.join(id_union(train, pairs, "user_id"), "user_id", "left_semi")


def scope_items(business: DataFrame, train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Business profiles whose id occurs in training or in the pairs; unknown ids are dropped."""
    return business.join(id_union(train, pairs, "business_id"), "business_id", "left_semi")


def id_dictionary(ids: DataFrame, col: str, index_col: str = "idx",
                  num_partitions: int | None = None) -> DataFrame:
    """Dense 0-based index of the distinct ids in sort order: (col, idx).

    Distributed: the ids are range-partitioned by value, numbered inside each partition, and
    shifted by the row count of all earlier partitions (a table with one row per partition). The
    partition-tagged ids are checkpointed first, so both uses see the same partitioning even if
    an executor is lost in between.
    """
    from ratewise.session import cut_lineage

    n = num_partitions or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = cut_lineage(ids.select(col).distinct().repartitionByRange(n, col)
                         .withColumn("_pid", F.spark_partition_id()))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = tagged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(col)) - 1)
    return (local.join(F.broadcast(offsets), "_pid")
            .select(col, (F.col("_off") + F.col("_local")).cast("long").alias(index_col)))


def cold_start(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per pair: is the user / the item absent from training (cold)?"""
    users = train.select("user_id").distinct().withColumn("_u", F.lit(True))
    items = train.select("business_id").distinct().withColumn("_i", F.lit(True))
    return (pairs.select("user_id", "business_id")
            .join(users, "user_id", "left").join(items, "business_id", "left")
            .select("user_id", "business_id",
                    F.col("_u").isNull().alias("cold_user"), F.col("_i").isNull().alias("cold_item")))
