"""Q3 feature model: wide user/business features -> boosted trees -> clip to [1, 5].

Every table stays distributed: profiles are scoped by semi-join, optional features attach by
left joins, PCA components are computed by Spark ML, and the train and test rows are one frame
(``is_train`` tag) so the state one-hot sees the joint vocabulary.

Naming: user features are prefixed ``user_`` and business features ``business_``; the reference
lets the business ``review_count`` overwrite the user's -- ours keeps both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions import scalars as S
from ratewise.operators import features as FE
from ratewise.operators import models, profiles, scope
from ratewise.session import cut_lineage

USER_EXTRA = ["n_tip_user", "avg_like_user", "avg_tip_len_user"]
BUSINESS_EXTRA = ["checkin_sum", "checkin_avg", "n_tip_business", "avg_like_business",
                  "avg_tip_len_business"]


def user_features(user: DataFrame, tip: DataFrame, train: DataFrame, pairs: DataFrame) -> DataFrame:
    """user_id + user_* columns for users in scope."""
    u = profiles.user_profile(scope.scope_users(user, train, pairs))
    u = u.join(profiles.tip_stats_user(tip), "user_id", "left")
    cols = profiles.USER_FEATURES + USER_EXTRA
    return u.select("user_id", *[F.col(c).alias(f"user_{c}") for c in cols])


def business_features(business: DataFrame, checkin: DataFrame, tip: DataFrame, train: DataFrame,
                      pairs: DataFrame, pca_attr: int = 5, pca_cat: int = 10,
                      with_pca: bool = True) -> DataFrame:
    """business_id + business_* columns (incl. state and, optionally, PCA components)."""
    b_all = scope.scope_items(business, train, pairs)
    b = profiles.business_profile(b_all)
    b = (b.join(profiles.checkin_stats(checkin), "business_id", "left")
         .join(profiles.tip_stats_item(tip), "business_id", "left"))
    cols = profiles.BUSINESS_FEATURES + BUSINESS_EXTRA + ["state"]
    b = b.select("business_id", *[F.col(c).alias(f"business_{c}") for c in cols])
    if with_pca:
        # PCA is fitted on every business profile, as the reference does
        b = (b.join(FE.pca_attributes(business, pca_attr), "business_id", "left")
             .join(FE.pca_categories(business, pca_cat), "business_id", "left"))
    return b


def wide_rows(train: DataFrame, pairs: DataFrame, ufeat: DataFrame, bfeat: DataFrame,
              strict: bool = False, reference_names: bool = False) -> DataFrame:
    """Train rows (is_train=1, label) and pairs (is_train=0) with every feature attached.

    ``strict`` keeps only rows whose user and business have features. With ``reference_names`` the
    features lose their prefixes and a business feature replaces the user's of the same name."""
    rows = (train.select("user_id", "business_id", F.col("stars").cast("double").alias("label"),
                         F.lit(1).alias("is_train"))
            .unionByName(pairs.select("user_id", "business_id", F.lit(None).cast("double").alias("label"),
                                      F.lit(0).alias("is_train"))))
    if reference_names:
        bfeat = bfeat.toDF(*[c if c == "business_id" else c.removeprefix("business_") for c in bfeat.columns])
        ufeat = ufeat.toDF(*[c if c == "user_id" else c.removeprefix("user_") for c in ufeat.columns])
        ufeat = ufeat.select("user_id", *[c for c in ufeat.columns if c not in bfeat.columns and c != "user_id"])
    how = "inner" if strict else "left"
    return rows.join(ufeat, "user_id", how).join(bfeat, "business_id", how)


def feature_columns(wide: DataFrame) -> list[str]:
    skip = {"user_id", "business_id", "label", "is_train", "business_state", "state", "state_feature"}
    return [c for c in wide.columns if c not in skip]


def feature_model_predict(train: DataFrame, pairs: DataFrame, business: DataFrame, user: DataFrame,
                          checkin: DataFrame, tip: DataFrame, params: dict | None = None,
                          pca_attr: int = 5, pca_cat: int = 10, strict: bool = False,
                          reference_names: bool = False) -> DataFrame:
    """(user_id, business_id, raw_prediction, prediction) for every row of ``pairs``: the boosted trees'
    output, and that clipped to [1, 5]. One fit; the wide rows are written once to the shared scratch
    folder and read by the training copy and the predictions. Missing features stay missing: the trees
    route them. ``params`` changes settings of the booster by name."""
    train = train.select("user_id", "business_id", "stars")
    asked = pairs.select("user_id", "business_id")
    ufeat = user_features(user, tip, train, asked)
    bfeat = cut_lineage(business_features(business, checkin, tip, train, asked, pca_attr, pca_cat))
    wide = cut_lineage(wide_rows(train, asked.distinct(), ufeat, bfeat, strict, reference_names))
    state = "state" if reference_names else "business_state"
    wide = FE.state_one_hot(wide, state, bfeat.select(F.col("business_state").alias(state)))
    columns, of_user = feature_columns(wide), {c.removeprefix("user_") if reference_names else c for c in ufeat.columns}
    if reference_names:
        of_user -= {c.removeprefix("business_") for c in bfeat.columns}
    model = models.fit_trees(wide.filter("is_train = 1"), columns, "label", groups=[[c for c in columns if c in of_user]], **(params or {}))
    pred = models.predict(model, wide.filter("is_train = 0"), ["user_id", "business_id"])
    # one prediction a distinct pair, a row for every time it was listed
    return asked.join(pred, ["user_id", "business_id"]).select(
        "user_id", "business_id", F.col("prediction").alias("raw_prediction"),
        S.clip_prediction("prediction").alias("prediction"))
