"""Q2 weighted hybrid: 0.1 x item-kNN + 0.9 x boosted-tree prediction on six profile features.

Model features per (user, item): user review_count and average_stars, business stars,
review_count, longitude and latitude. Profiles attach by equi-join on the ids (strict inner joins
reproduce the reference, which fails on a missing profile; the default keeps every pair and
leaves the features missing). The model prediction is guarded (NaN / inf / 0 -> 3) before blending; the two
predictions meet by a join on (user_id, business_id), not by row position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions import scalars as S
from ratewise.operators import features as FE
from ratewise.operators import models, neighbours
from ratewise.operators.stats import latest_ratings
from ratewise.session import cut_lineage

FEATURES = ["user_review_count", "user_average_stars", "business_stars", "business_review_count",
            "business_longitude", "business_latitude"]


def profile_rows(rows: DataFrame, user: DataFrame, business: DataFrame, strict: bool = False) -> DataFrame:
    how = "inner" if strict else "left"
    u = user.select("user_id", F.col("review_count").alias("user_review_count"),
                    F.col("average_stars").alias("user_average_stars"))
    b = business.select("business_id", F.col("stars").alias("business_stars"),
                        F.col("review_count").alias("business_review_count"),
                        F.col("longitude").alias("business_longitude"),
                        F.col("latitude").alias("business_latitude"))
    return rows.join(u, "user_id", how).join(b, "business_id", how)


def feature_rows(train: DataFrame, pairs: DataFrame, user: DataFrame, business: DataFrame,
                 strict: bool = False) -> DataFrame:
    """Training rows (is_train = 1, label) and distinct pairs with the six features; a feature without
    its profile is NULL. ``strict`` drops rows without both profiles."""
    rows = (train.select("user_id", "business_id", F.col("stars").cast("double").alias("label"),
                         F.lit(1).alias("is_train"))
            .unionByName(pairs.select("user_id", "business_id", F.lit(None).cast("double").alias("label"),
                                      F.lit(0).alias("is_train")).distinct()))
    return cut_lineage(profile_rows(rows, user, business, strict))


def design_matrix(train: DataFrame, pairs: DataFrame, user: DataFrame, business: DataFrame,
                  strict: bool = False) -> tuple[DataFrame, list[str]]:
    """The rows of :func:`feature_rows` with missing features imputed and flagged, for models that take
    no missing values, and the names of the feature columns."""
    wide = FE.impute_with_flags(feature_rows(train, pairs, user, business, strict), FEATURES,
                                stats_where="is_train = 1", drop_constant_flags=True)
    return wide, [c for c in wide.columns if c in FEATURES or c.endswith("_missing")]


def model_predictions(train: DataFrame, pairs: DataFrame, user: DataFrame, business: DataFrame,
                      params: dict | None = None, strict: bool = False) -> DataFrame:
    """(user_id, business_id, model_prediction) guarded, one row per distinct pair."""
    wide = feature_rows(train, pairs, user, business, strict)
    model = models.fit_trees(wide.filter("is_train = 1"), FEATURES, "label", models.HYBRID, [FEATURES[:2], FEATURES[2:]], **(params or {}))
    pred = models.predict(model, wide.filter("is_train = 0"), ["user_id", "business_id"])
    return pred.select("user_id", "business_id", S.guard_prediction("prediction").alias("model_prediction"))


def hybrid_predict(train: DataFrame, pairs: DataFrame, user: DataFrame, business: DataFrame,
                   min_overlap: int = 75, knn_weight: float = 0.1, params: dict | None = None,
                   strict: bool = False, order_by: list[str] | None = None, unique: bool = False) -> DataFrame:
    """(user_id, business_id, knn_prediction, model_prediction, prediction) for every row of ``pairs``;
    prediction = knn_weight * kNN + (1 - knn_weight) * model. Repeats as in :func:`neighbours.knn_predict`."""
    if not unique:
        train = latest_ratings(train, order_by)
    knn = neighbours.knn_predict(train, pairs, min_overlap=min_overlap, decimals=None, unique=unique)
    mod = model_predictions(train, pairs, user, business, params, strict)
    return (knn.join(mod, ["user_id", "business_id"])
            .select("user_id", "business_id", F.col("prediction").alias("knn_prediction"), "model_prediction",
                    S.blend("prediction", "model_prediction", knn_weight).alias("prediction")))
