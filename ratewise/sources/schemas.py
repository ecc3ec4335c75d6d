"""Explicit schemas for every input and output. JSON and CSV are never schema-inferred."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])

# As read: ratings are parsed after header lines are gone, so that a bad number can fail the job.
RATINGS_TEXT = T.StructType([*RATINGS.fields[:2], T.StructField("stars", T.StringType())])

PAIRS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
])

BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.IntegerType()),
    T.StructField("is_open", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("hours", T.MapType(T.StringType(), T.StringType())),
])

# The ten compliment counters of a user profile, in profile order.
COMPLIMENTS = ["hot", "more", "cute", "list", "note", "plain", "cool", "funny", "writer", "photos"]

USER = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("review_count", T.IntegerType()),
        T.StructField("yelping_since", T.StringType()),
        T.StructField("friends", T.StringType()),
        T.StructField("useful", T.IntegerType()),
        T.StructField("funny", T.IntegerType()),
        T.StructField("fans", T.IntegerType()),
        T.StructField("elite", T.StringType()),
        T.StructField("average_stars", T.DoubleType()),
    ]
    + [T.StructField(f"compliment_{c}", T.IntegerType()) for c in COMPLIMENTS]
)

CHECKIN = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("time", T.MapType(T.StringType(), T.IntegerType())),
])

TIP = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("likes", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
])
