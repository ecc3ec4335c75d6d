"""Profile feature tables: one row per business / user, plus check-in and tip statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions import scalars as S
from ratewise.operators.stats import tip_stats
from ratewise.sources.schemas import COMPLIMENTS

# Profile columns, in the order of the reference's feature rows.
BUSINESS_FEATURES = ["latitude", "longitude", "stars", "review_count", "is_open",
                     "len_attributes", "len_categories", "len_hours"]
USER_FEATURES = (["review_count", "date_since", "n_friends", "useful", "funny", "fans", "n_elite",
                  "max_elite", "avg_stars"] + [f"compliment_{c}" for c in COMPLIMENTS])


def business_profile(business: DataFrame) -> DataFrame:
    """business_id, latitude, longitude, stars, review_count, is_open, len_attributes,
    len_categories, len_hours, state."""
    return business.select(
        "business_id", "latitude", "longitude", "stars", "review_count", "is_open",
        S.map_size("attributes").alias("len_attributes"),
        S.token_count("categories").alias("len_categories"),
        S.map_size("hours").alias("len_hours"),
        "state")


def user_profile(user: DataFrame, reference_date: str = S.REFERENCE_DATE) -> DataFrame:
    """user_id plus the 19 profile features."""
    return user.select(
        "user_id", "review_count",
        S.days_since("yelping_since", reference_date).alias("date_since"),
        S.token_count("friends").alias("n_friends"),
        "useful", "funny", "fans",
        S.token_count("elite").alias("n_elite"),
        S.max_token("elite").alias("max_elite"),
        F.col("average_stars").alias("avg_stars"),
        *[f"compliment_{c}" for c in COMPLIMENTS])


def checkin_stats(checkin: DataFrame) -> DataFrame:
    """business_id, checkin_sum, checkin_avg over the values of the ``time`` map.

    One input row per business; if a business repeats, its rows are summed by a partial
    aggregate rather than collected.
    """
    per_row = checkin.select("business_id", S.map_value_sum("time").alias("s"), F.size("time").alias("n"))
    return per_row.groupBy("business_id").agg(
        F.sum("s").alias("checkin_sum"),
        F.try_divide(F.sum("s").cast("double"), F.sum("n")).alias("checkin_avg"))


def tip_stats_item(tip: DataFrame) -> DataFrame:
    return tip_stats(tip, "business_id", "business")


def tip_stats_user(tip: DataFrame) -> DataFrame:
    return tip_stats(tip, "user_id", "user")
