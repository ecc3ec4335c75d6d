"""Named queries over the stand-in tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the full test tables of ``sf_dir`` through :class:`StandIn`, so its work grows
with the data. Thresholds that an oracle SQL string must repeat are fixed per key:
``min_overlap`` 20 for the ordinary keys and 125 for the ``*_strict`` keys (SURVEY 7.2 item 9).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions import scalars as S
from ratewise.operators import evaluate, neighbours, profiles, scope, similarity, stats
from ratewise.operators import features as FE
from ratewise.plans import feature_model, hybrid
from ratewise.plans.knn import run_knn
from ratewise.session import apply_conf, checkpoint_dir, cut_lineage, scratch_path
from ratewise.sources import readers, sinks
from ratewise.sources.standin import StandIn
from ratewise.streaming import score_pair_stream

MIN_OVERLAP = 20
MIN_OVERLAP_STRICT = 125

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, compact: bool = False):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            checkpoint_dir(spark)
            return fn(StandIn(spark, sf_dir, compact))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _knn(s: StandIn, min_overlap: int) -> DataFrame:
    return neighbours.knn_predict(s.train, s.pairs, min_overlap=min_overlap, unique=True)


@query("knn_predict_duplicates")
def _q_knn_predict_duplicates(s: StandIn) -> DataFrame:
    """Q1 from every raw rating row, the last of a (user, item) standing, for every raw held-out row."""
    rows = s.named(s.raw_test)
    return neighbours.knn_predict(s.named(s.raw_train), rows, min_overlap=MIN_OVERLAP,
                                  order_by=["l_orderkey", "l_linenumber"])


@query("knn_predict", compact=True)
def _q_knn_predict(s: StandIn) -> DataFrame:
    """Q1 item-kNN prediction for every held-out pair."""
    return _knn(s, MIN_OVERLAP)


@query("knn_predict_strict", compact=True)
def _q_knn_predict_strict(s: StandIn) -> DataFrame:
    """Q1 with the overlap threshold inside the co-rater range at sf0.01."""
    return _knn(s, MIN_OVERLAP_STRICT)


def _sims(s: StandIn, min_overlap: int) -> DataFrame:
    cand = neighbours.knn_candidates(s.pairs, s.train)
    return similarity.item_similarity(s.train, similarity.needed_pairs(cand), min_overlap)


@query("item_similarity", compact=True)
def _q_item_similarity(s: StandIn) -> DataFrame:
    """K2: similarity of every needed (item, neighbour) pair."""
    return _sims(s, MIN_OVERLAP)


@query("item_similarity_strict", compact=True)
def _q_item_similarity_strict(s: StandIn) -> DataFrame:
    return _sims(s, MIN_OVERLAP_STRICT)


@query("item_similarity_heavy", compact=True)
def _q_item_similarity_heavy(s: StandIn) -> DataFrame:
    """K2 with users of over 20 ratings on the heavy path, which never pairs a user's ratings."""
    cand = neighbours.knn_candidates(s.pairs, s.train)
    return similarity.item_similarity(s.train, similarity.needed_pairs(cand), MIN_OVERLAP, heavy_user_degree=20)


@query("knn_top_k", compact=True)
def _q_knn_top_k(s: StandIn) -> DataFrame:
    """K3: the 3 most similar positive neighbours per pair."""
    cand = neighbours.knn_candidates(s.pairs, s.train)
    # the candidates themselves: pair_similarity takes their distinct unordered pairs
    sims = neighbours.positive(lambda: similarity.pair_similarity(s.train, cand, MIN_OVERLAP))
    return neighbours.knn_top_k(cand, sims, 3)


# ---- sources -------------------------------------------------------------------------------
def _round(df: DataFrame, cols: list[str], decimals: int = 6) -> DataFrame:
    return df.select(*[F.round(c, decimals).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("scan_ratings")
def _q_scan_ratings(s: StandIn) -> DataFrame:
    """The training ratings written as header CSV and read back, in eight splits at least."""
    path = scratch_path(s.spark, "ratings-csv")
    s.train.write.option("header", True).csv(path)
    return readers.read_ratings_csv(s.spark, path, min_partitions=8)


@query("scan_pairs")
def _q_scan_pairs(s: StandIn) -> DataFrame:
    """Labelled pairs written as 3-column CSV; the pairs reader ignores the label."""
    path = scratch_path(s.spark, "pairs-csv")
    s.test.write.option("header", True).csv(path)
    return readers.read_pairs_csv(s.spark, path)


def _json_roundtrip(s: StandIn, df: DataFrame, name: str) -> str:
    path = scratch_path(s.spark, name)
    df.write.json(path)
    return path


@query("scan_business_json")
def _q_scan_business_json(s: StandIn) -> DataFrame:
    """Business profiles as JSON lines, read back with the explicit schema."""
    b = readers.read_business_json(s.spark, _json_roundtrip(s, s.business, "business-json"))
    return b.select("business_id", "latitude", "longitude", F.round("stars", 6).alias("stars"),
                    "review_count", "is_open", "state", "categories",
                    F.col("attributes")["brand"].alias("attr_brand"),
                    F.col("attributes")["size"].alias("attr_size"),
                    F.col("attributes")["kind"].alias("attr_kind"),
                    S.map_size("hours").alias("len_hours"))


@query("scan_user_json")
def _q_scan_user_json(s: StandIn) -> DataFrame:
    """User profiles as JSON lines, read back."""
    u = readers.read_user_json(s.spark, _json_roundtrip(s, s.user, "user-json"))
    return _round(u, ["average_stars"])


@query("scan_checkin_json")
def _q_scan_checkin_json(s: StandIn) -> DataFrame:
    """Check-in maps as JSON lines, read back and exploded to (business_id, event_type, n)."""
    c = readers.read_checkin_json(s.spark, _json_roundtrip(s, s.checkin, "checkin-json"))
    return c.select("business_id", F.explode("time").alias("event_type", "n"))


@query("scan_tip_json")
def _q_scan_tip_json(s: StandIn) -> DataFrame:
    """Tips as JSON lines, read back."""
    return readers.read_tip_json(s.spark, _json_roundtrip(s, s.tip, "tip-json"))


def _sink_roundtrip(s: StandIn, loose: bool) -> DataFrame:
    pred = _knn(s, MIN_OVERLAP)
    path = scratch_path(s.spark, "pred-csv")
    (sinks.write_predictions_csv_loose if loose else sinks.write_predictions_csv)(pred, path)
    lines = s.spark.read.text(path)
    header = lines.filter(F.col("value").startswith("user_id")).select(F.max("value").alias("header"))
    rows = s.spark.read.option("header", True).csv(path).toDF("user_id", "business_id", "prediction")
    return rows.select("user_id", "business_id", F.col("prediction").cast("double").alias("prediction")).join(F.broadcast(header))


@query("sink_csv", compact=True)
def _q_sink_csv(s: StandIn) -> DataFrame:
    """kNN predictions through the standard-header CSV sink, read back with its header line."""
    return _sink_roundtrip(s, loose=False)


@query("sink_csv_loose", compact=True)
def _q_sink_csv_loose(s: StandIn) -> DataFrame:
    """kNN predictions through the loose-header CSV sink, read back with its header line."""
    return _sink_roundtrip(s, loose=True)


@query("knn_end_to_end", compact=True)
def _q_knn_end_to_end(s: StandIn) -> DataFrame:
    """Q1 from files: ratings and pairs CSV -> kNN predictions."""
    tp, pp = scratch_path(s.spark, "e2e-train"), scratch_path(s.spark, "e2e-pairs")
    s.train.write.option("header", True).csv(tp)
    s.test.write.option("header", True).csv(pp)
    train, pairs = readers.read_ratings_csv(s.spark, tp), readers.read_pairs_csv(s.spark, pp)
    return neighbours.knn_predict(train, pairs, min_overlap=MIN_OVERLAP)


# ---- profiles and scalars ------------------------------------------------------------------
@query("business_profile")
def _q_business_profile(s: StandIn) -> DataFrame:
    """P3."""
    return _round(profiles.business_profile(s.business), ["stars"])


@query("user_profile")
def _q_user_profile(s: StandIn) -> DataFrame:
    """P4."""
    return _round(profiles.user_profile(s.user), ["avg_stars"])


@query("token_count")
def _q_token_count(s: StandIn) -> DataFrame:
    """P6 on friends, elite and (part) categories."""
    return s.user.select("user_id", S.token_count("friends").alias("n_friends"),
                         S.token_count("elite").alias("n_elite"))


@query("map_size")
def _q_map_size(s: StandIn) -> DataFrame:
    """P7 on attributes and hours of every part-business."""
    return s.part_business.select("business_id", S.map_size("attributes").alias("len_attributes"),
                                  S.map_size("hours").alias("len_hours"),
                                  S.token_count("categories").alias("len_categories"))


@query("max_token")
def _q_max_token(s: StandIn) -> DataFrame:
    """P8 on elite years."""
    return s.user.select("user_id", S.max_token("elite").alias("max_elite"))


@query("account_age_days")
def _q_account_age_days(s: StandIn) -> DataFrame:
    """P9."""
    return s.user.select("user_id", S.days_since("yelping_since").alias("date_since"))


@query("flatten_attributes")
def _q_flatten_attributes(s: StandIn) -> DataFrame:
    """(business_id, attr, value, is_digit)."""
    return FE.flatten_attributes(s.part_business)


@query("checkin_stats")
def _q_checkin_stats(s: StandIn) -> DataFrame:
    """P12."""
    return _round(profiles.checkin_stats(s.checkin), ["checkin_avg"])


def _lineitem_values(s: StandIn, shift: float) -> DataFrame:
    li = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return li.select("l_orderkey", "l_linenumber", ((F.col("l_quantity") - shift) / 5).alias("raw"))


@query("guard_prediction")
def _q_guard_prediction(s: StandIn) -> DataFrame:
    """P15 over (l_quantity - 25) / 5, which is 0 for quantity 25."""
    v = _lineitem_values(s, 25.0)
    return _round(v.select("l_orderkey", "l_linenumber", "raw", S.guard_prediction("raw").alias("guarded")),
                  ["raw", "guarded"])


@query("clip_prediction")
def _q_clip_prediction(s: StandIn) -> DataFrame:
    """P16 over (l_quantity - 20) / 5, spanning -3.8 .. 6."""
    v = _lineitem_values(s, 20.0)
    return _round(v.select("l_orderkey", "l_linenumber", "raw", S.clip_prediction("raw").alias("clipped")),
                  ["raw", "clipped"])


@query("blend", compact=True)
def _q_blend(s: StandIn) -> DataFrame:
    """0.1 x kNN + 0.9 x item mean (guarded) per held-out pair."""
    knn = neighbours.knn_predict(s.train, s.pairs, min_overlap=MIN_OVERLAP, decimals=None, unique=True)
    im = stats.item_mean(s.train)
    out = knn.join(im, "business_id", "left").select(
        "user_id", "business_id",
        S.blend("prediction", S.guard_prediction("item_mean")).alias("prediction"))
    return _round(out, ["prediction"])


# ---- ids, scope, joins ---------------------------------------------------------------------
@query("distinct_ids")
def _q_distinct_ids(s: StandIn) -> DataFrame:
    """A1: distinct users of the training ratings."""
    return scope.distinct_ids(s.train, "user_id")


@query("id_union")
def _q_id_union(s: StandIn) -> DataFrame:
    """Distinct items of training and pairs."""
    return scope.id_union(s.train, s.pairs, "business_id")


@query("id_dictionary")
def _q_id_dictionary(s: StandIn) -> DataFrame:
    """Dense index of the user ids of training and pairs."""
    return scope.id_dictionary(scope.id_union(s.train, s.pairs, "user_id"), "user_id")


@query("scope_users")
def _q_scope_users(s: StandIn) -> DataFrame:
    """J1."""
    return scope.scope_users(s.user, s.train, s.pairs).select("user_id", "review_count")


@query("scope_items")
def _q_scope_items(s: StandIn) -> DataFrame:
    """J2."""
    return scope.scope_items(s.business, s.train, s.pairs).select("business_id", "is_open")


@query("cold_start")
def _q_cold_start(s: StandIn) -> DataFrame:
    """J10/J11."""
    return scope.cold_start(s.train, s.pairs)


@query("knn_candidates")
def _q_knn_candidates(s: StandIn) -> DataFrame:
    """J7."""
    return neighbours.knn_candidates(s.pairs, s.train)


@query("co_rating_counts", compact=True)
def _q_co_rating_counts(s: StandIn) -> DataFrame:
    """Common raters of every needed pair that shares one."""
    cand = neighbours.knn_candidates(s.pairs, s.train)
    return similarity.co_rating_counts(s.train, similarity.needed_pairs(cand))


@query("explode_group_having")
def _q_explode_group_having(s: StandIn) -> DataFrame:
    """F3."""
    return stats.explode_group_having(s.train)


# ---- aggregates ----------------------------------------------------------------------------
@query("ratings_by_key")
def _q_ratings_by_key(s: StandIn) -> DataFrame:
    """A3."""
    return _round(stats.ratings_by_key(s.train), ["avg_stars", "sum_stars"])


@query("tip_stats_item")
def _q_tip_stats_item(s: StandIn) -> DataFrame:
    """A4."""
    return _round(profiles.tip_stats_item(s.tip), ["avg_like_business", "avg_tip_len_business"])


@query("tip_stats_user")
def _q_tip_stats_user(s: StandIn) -> DataFrame:
    """A5."""
    return _round(profiles.tip_stats_user(s.tip), ["avg_like_user", "avg_tip_len_user"])


@query("item_mean")
def _q_item_mean(s: StandIn) -> DataFrame:
    """A6."""
    return _round(stats.item_mean(s.train), ["item_mean"])


@query("user_mean")
def _q_user_mean(s: StandIn) -> DataFrame:
    """A7."""
    return _round(stats.user_mean(s.train), ["user_mean"])


@query("centred_ratings")
def _q_centred_ratings(s: StandIn) -> DataFrame:
    """K1."""
    return _round(similarity.centred_ratings(s.train), ["centred"])


@query("category_vocab")
def _q_category_vocab(s: StandIn) -> DataFrame:
    """A8."""
    return FE.category_vocab(s.part_business)


@query("rmse", compact=True)
def _q_rmse(s: StandIn) -> DataFrame:
    """RMSE of the kNN predictions on the held-out labels."""
    pred = neighbours.knn_predict(s.train, s.pairs, min_overlap=MIN_OVERLAP, decimals=None, unique=True)
    return _round(evaluate.rmse(pred, s.test), ["rmse"])


@query("error_histogram", compact=True)
def _q_error_histogram(s: StandIn) -> DataFrame:
    """A10."""
    pred = neighbours.knn_predict(s.train, s.pairs, min_overlap=MIN_OVERLAP, decimals=None, unique=True)
    return evaluate.error_histogram(pred, s.test)


# ---- features ------------------------------------------------------------------------------
@query("one_hot_attributes")
def _q_one_hot_attributes(s: StandIn) -> DataFrame:
    """E2."""
    return FE.one_hot_attributes(s.part_business)


@query("multi_hot_categories")
def _q_multi_hot_categories(s: StandIn) -> DataFrame:
    """E3."""
    return FE.multi_hot_categories(s.part_business)


@query("pca_attributes")
def _q_pca_attributes(s: StandIn) -> DataFrame:
    """E4 (rows-only check)."""
    return FE.pca_attributes(s.part_business, 5)


@query("pca_categories")
def _q_pca_categories(s: StandIn) -> DataFrame:
    """E5 (rows-only check)."""
    return FE.pca_categories(s.part_business, 10)


@query("pca_category_norms")
def _q_pca_category_norms(s: StandIn) -> DataFrame:
    """E5 with as many components as categories: a business's squares add up to those of its centred row."""
    rows, index = FE.category_rows(s.part_business)
    n = index.count()
    pc = FE.pca_indicators(rows, index, n, "p")
    total = sum((F.col(f"p{j}") * F.col(f"p{j}") for j in range(n)), F.lit(0.0))
    return pc.select("business_id", F.round(total, 6).alias("square_norm"))


def _wide(s: StandIn) -> DataFrame:
    ufeat = feature_model.user_features(s.user, s.tip, s.train, s.pairs)
    bfeat = feature_model.business_features(s.business, s.checkin, s.tip, s.train, s.pairs, with_pca=False)
    return feature_model.wide_rows(s.train, s.pairs, ufeat, bfeat)


@query("feature_join")
def _q_feature_join(s: StandIn) -> DataFrame:
    """Business profile with optional check-in and tip features attached by left joins."""
    b = feature_model.business_features(s.business, s.checkin, s.tip, s.train, s.pairs, with_pca=False)
    return _round(b, [c for c, t in b.dtypes if t == "double"])


@query("wide_features")
def _q_wide_features(s: StandIn) -> DataFrame:
    """Train and test rows with every user and business feature (PCA excluded)."""
    w = _wide(s)
    return _round(w, [c for c, t in w.dtypes if t == "double"])


@query("union_one_hot")
def _q_union_one_hot(s: StandIn) -> DataFrame:
    """State one-hot over the joint train+test vocabulary, as the name of the hot column."""
    rows = _wide(s).select("user_id", "business_id", "is_train", "business_state")
    scoped = scope.scope_items(s.business, s.train, s.pairs).select(F.col("state").alias("business_state"))
    return FE.state_one_hot(rows, values=scoped).select("user_id", "business_id", "is_train", "state_feature")


@query("impute_flags")
def _q_impute_flags(s: StandIn) -> DataFrame:
    """Mean imputation (means over training rows) with missing flags."""
    w = cut_lineage(_wide(s).select("user_id", "business_id", "is_train", "user_avg_stars", "business_stars"))
    out = FE.impute_with_flags(w, ["user_avg_stars", "business_stars"], stats_where="is_train = 1")
    return _round(out, ["user_avg_stars", "business_stars"])


# ---- models and pipelines (rows-only checks) -----------------------------------------------
@query("wide_features_strict")
def _q_wide_features_strict(s: StandIn) -> DataFrame:
    """Rows that have both profiles only, with the reference's unprefixed names."""
    known = s.user.filter("review_count > 0")
    ufeat = feature_model.user_features(known, s.tip, s.train, s.pairs)
    bfeat = feature_model.business_features(s.business, s.checkin, s.tip, s.train, s.pairs, with_pca=False)
    w = feature_model.wide_rows(s.train, s.pairs, ufeat, bfeat, strict=True, reference_names=True)
    w = w.select("user_id", "business_id", "is_train", "review_count", "stars", "avg_stars", "n_friends", "checkin_sum")
    return _round(w, ["stars", "avg_stars"])


def _hybrid_features(s: StandIn, strict: bool) -> DataFrame:
    wide, _ = hybrid.design_matrix(s.train, s.pairs, s.known_user, s.business, strict)
    cols = ["user_id", "business_id", "is_train", *hybrid.FEATURES]
    return _round(wide.select(*cols), hybrid.FEATURES)


@query("hybrid_features")
def _q_hybrid_features(s: StandIn) -> DataFrame:
    """Design matrix of the hybrid, users without a profile imputed."""
    return _hybrid_features(s, strict=False)


@query("hybrid_features_strict")
def _q_hybrid_features_strict(s: StandIn) -> DataFrame:
    """The same, rows without a profile dropped."""
    return _hybrid_features(s, strict=True)


@query("hybrid_predict", compact=True)
def _q_hybrid_predict(s: StandIn) -> DataFrame:
    """Q2 with M3/M4 inside: kNN, guarded boosted-tree and blended predictions from one fit."""
    return hybrid.hybrid_predict(s.train, s.pairs, s.user, s.business, min_overlap=MIN_OVERLAP, unique=True)


@query("hybrid_parts", compact=True)
def _q_hybrid_parts(s: StandIn) -> DataFrame:
    """The kNN column of Q2, whether the model's column is there and guarded, and what the blend
    leaves over."""
    h = hybrid.hybrid_predict(s.train, s.pairs, s.known_user, s.business, min_overlap=MIN_OVERLAP, unique=True,
                              params=dict(trees=10, depth=4))
    guarded = (S.guard_prediction("model_prediction") == F.col("model_prediction")).alias("guarded")
    left = F.abs(F.col("prediction") - 0.1 * F.col("knn_prediction") - 0.9 * F.col("model_prediction")) > 1e-9
    return h.select("user_id", "business_id", F.round("knn_prediction", 6).alias("knn_prediction"), guarded,
                    left.alias("left_over"))


@query("ordered_files", compact=True)
def _q_ordered_files(s: StandIn) -> DataFrame:
    """Raw ratings in a file, the last line of a (user, item) standing, and predictions written
    in the order of the pairs file; the number of each output line, read back."""
    tp, pp, out = (scratch_path(s.spark, f"ordered-{n}") for n in ("train", "pairs", "out"))
    lines = s.named(s.raw_train).repartitionByRange("l_orderkey", "l_linenumber", "stars").sortWithinPartitions("l_orderkey", "l_linenumber", "stars")
    lines.select("user_id", "business_id", "stars").write.option("header", True).csv(tp)
    pairs = s.test.repartitionByRange("user_id", "business_id").sortWithinPartitions("user_id", "business_id")
    pairs.write.option("header", True).csv(pp)
    run_knn(s.spark, tp, pp, out, min_overlap=MIN_OVERLAP)
    got = scope.id_dictionary(readers.read_ratings_csv(s.spark, out, ordered=True).withColumn(
        "row", F.struct("line", "user_id", "business_id", "stars")), "row", "line_no")
    return got.select("line_no", "row.user_id", "row.business_id", F.round("row.stars", 6).alias("prediction"))


@query("feature_model_predict")
def _q_feature_model_predict(s: StandIn) -> DataFrame:
    """Q3 with M1/M2 inside: boosted-tree predictions before and after clipping, from one fit."""
    return feature_model.feature_model_predict(s.train, s.pairs, s.business, s.user, s.checkin, s.tip)


# ---- streaming -----------------------------------------------------------------------------
@query("stream_knn_predict", compact=True)
def _q_stream_knn_predict(s: StandIn) -> DataFrame:
    """Q1 through Structured Streaming: pair CSV files -> foreachBatch kNN -> parquet sink."""
    src, sink = scratch_path(s.spark, "stream-src"), scratch_path(s.spark, "stream-sink")
    s.test.write.option("header", True).csv(src)
    q = score_pair_stream(s.spark, s.train, src, sink, min_overlap=MIN_OVERLAP)
    q.awaitTermination()
    return s.spark.read.parquet(sink).select("user_id", "business_id", "prediction")
