"""key -> DuckDB SQL for every SQL-expressible registered query."""

from oracle import sql
from oracle.sql import side

_KNN20 = sql.knn_ctes(20)

ORACLE: dict[str, str] = {
    # item-kNN
    "knn_predict": sql.knn_predict(20),
    "knn_predict_strict": sql.knn_predict(125),
    "knn_end_to_end": sql.knn_predict(20),
    "stream_knn_predict": sql.knn_predict(20),
    "item_similarity": sql.item_similarity(20),
    "item_similarity_strict": sql.item_similarity(125),
    "knn_top_k": sql.knn_top_k(20, 3),
    "knn_candidates": sql.with_ctes(_KNN20, "SELECT user_id, business_id, neighbour_id, neighbour_stars FROM cand"),
    "co_rating_counts": sql.with_ctes(_KNN20, "SELECT business_id, neighbour_id, n_common FROM co"),
    "centred_ratings": sql.with_ctes(_KNN20, """
        SELECT t.user_id, t.business_id, t.stars, round(t.stars - m.item_mean, 6) AS centred
        FROM train t JOIN imean m ON m.business_id = t.business_id"""),
    "rmse": sql.with_ctes(_KNN20, """
        SELECT count(*) AS n, round(sqrt(avg(power(k.prediction - t.label, 2))), 6) AS rmse
        FROM knn k JOIN test t ON k.user_id = t.user_id AND k.business_id = t.business_id"""),
    "error_histogram": sql.with_ctes(_KNN20, """
        SELECT CASE WHEN e < 1 THEN '>=0 and <1' WHEN e < 2 THEN '>=1 and <2'
                    WHEN e < 3 THEN '>=2 and <3' WHEN e < 4 THEN '>=3 and <4' ELSE '>=4' END AS bucket,
               count(*) AS n
        FROM (SELECT abs(k.prediction - t.label) AS e FROM knn k
              JOIN test t ON k.user_id = t.user_id AND k.business_id = t.business_id) x
        GROUP BY 1"""),
    "blend": sql.with_ctes(_KNN20, """
        SELECT k.user_id, k.business_id,
               round(0.1 * k.prediction + 0.9 * CASE WHEN m.item_mean IS NULL OR isnan(m.item_mean)
                       OR isinf(m.item_mean) OR m.item_mean = 0 THEN 3.0 ELSE m.item_mean END, 6) AS prediction
        FROM knn k LEFT JOIN imean m ON m.business_id = k.business_id"""),
    # sources and sinks
    "scan_ratings": sql.with_ctes(sql.BASE, "SELECT user_id, business_id, stars FROM train"),
    "scan_pairs": sql.with_ctes(sql.BASE, "SELECT user_id, business_id FROM test"),
    "scan_business_json": side("""
        SELECT business_id, latitude, longitude, round(stars, 6) AS stars, review_count, is_open, state,
               categories, attr_brand, attr_size, attr_kind, len_hours FROM business"""),
    "scan_user_json": side("""
        SELECT user_id, review_count, yelping_since, friends, useful, funny, fans, elite,
               round(average_stars, 6) AS average_stars, compliment_hot, compliment_more, compliment_cute,
               compliment_list, compliment_note, compliment_plain, compliment_cool, compliment_funny,
               compliment_writer, compliment_photos FROM usr"""),
    "scan_checkin_json": side("SELECT business_id, event_type, n FROM checkin_rows"),
    "scan_tip_json": side("SELECT business_id, user_id, likes, text FROM tip"),
    # profiles and scalars
    "business_profile": side("""
        SELECT business_id, latitude, longitude, round(stars, 6) AS stars, review_count, is_open,
               len_attributes, len_categories, len_hours, state FROM bprof"""),
    "user_profile": side("""
        SELECT user_id, review_count, date_since, n_friends, useful, funny, fans, n_elite, max_elite,
               round(avg_stars, 6) AS avg_stars, compliment_hot, compliment_more, compliment_cute,
               compliment_list, compliment_note, compliment_plain, compliment_cool, compliment_funny,
               compliment_writer, compliment_photos FROM uprof"""),
    "token_count": side("SELECT user_id, n_friends, n_elite FROM uprof"),
    "map_size": side("""
        SELECT business_id, len_attributes, len_hours,
               CAST(len(string_split(categories, ',')) AS INTEGER) AS len_categories FROM part_business"""),
    "max_token": side("SELECT user_id, max_elite FROM uprof"),
    "account_age_days": side("SELECT user_id, date_since FROM uprof"),
    "flatten_attributes": side("""
        SELECT business_id, attr, value, regexp_full_match(value, '[0-9]+') AS is_digit FROM (
          SELECT business_id, 'brand' AS attr, attr_brand AS value FROM part_business WHERE attr_brand IS NOT NULL
          UNION ALL SELECT business_id, 'size', whole_size FROM part_business WHERE whole_size IS NOT NULL
          UNION ALL SELECT business_id, 'type', p_type FROM part_business WHERE attr_kind IS NOT NULL
          UNION ALL SELECT business_id, ' big', big FROM part_business WHERE attr_kind IS NOT NULL
          UNION ALL SELECT business_id, ' code', whole_size FROM part_business WHERE attr_kind IS NOT NULL) a"""),
    "checkin_stats": side("SELECT business_id, checkin_sum, round(checkin_avg, 6) AS checkin_avg FROM checkin_stats"),
    "guard_prediction": """
        SELECT l_orderkey, l_linenumber, round(raw, 6) AS raw,
               round(CASE WHEN raw IS NULL OR isnan(raw) OR isinf(raw) OR raw = 0 THEN 3.0 ELSE raw END, 6) AS guarded
        FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 25.0) / 5 AS raw FROM lineitem) x""",
    "clip_prediction": """
        SELECT l_orderkey, l_linenumber, round(raw, 6) AS raw,
               round(CASE WHEN isnan(raw) THEN raw WHEN raw < 1 THEN 1.0 WHEN raw > 5 THEN 5.0 ELSE raw END, 6) AS clipped
        FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 20.0) / 5 AS raw FROM lineitem) x""",
    # ids, scope, joins
    "distinct_ids": sql.with_ctes(sql.BASE, "SELECT DISTINCT user_id FROM train"),
    "id_union": sql.with_ctes(sql.BASE, """
        SELECT business_id FROM train UNION SELECT business_id FROM test"""),
    "id_dictionary": sql.with_ctes(sql.BASE, """
        SELECT user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS idx
        FROM (SELECT user_id FROM train UNION SELECT user_id FROM test) u"""),
    "scope_users": side("""
        SELECT user_id, review_count FROM usr
        WHERE user_id IN (SELECT user_id FROM train UNION SELECT user_id FROM test)"""),
    "scope_items": side("""
        SELECT business_id, is_open FROM business
        WHERE business_id IN (SELECT business_id FROM train UNION SELECT business_id FROM test)"""),
    "cold_start": sql.with_ctes(sql.BASE, """
        SELECT p.user_id, p.business_id,
               p.user_id NOT IN (SELECT user_id FROM train) AS cold_user,
               p.business_id NOT IN (SELECT business_id FROM train) AS cold_item
        FROM test p"""),
    "explode_group_having": sql.with_ctes(sql.BASE, """
        SELECT user_id, count(business_id) AS n_values FROM train GROUP BY user_id HAVING count(business_id) >= 2"""),
    # aggregates
    "ratings_by_key": sql.with_ctes(sql.BASE, """
        SELECT business_id, count(*) AS n_ratings, round(sum(stars), 6) AS sum_stars,
               round(avg(stars), 6) AS avg_stars FROM train GROUP BY business_id"""),
    "tip_stats_item": side("""
        SELECT business_id, n_tip_business, round(avg_like_business, 6) AS avg_like_business,
               round(avg_tip_len_business, 6) AS avg_tip_len_business FROM tip_item"""),
    "tip_stats_user": side("""
        SELECT user_id, n_tip_user, round(avg_like_user, 6) AS avg_like_user,
               round(avg_tip_len_user, 6) AS avg_tip_len_user FROM tip_user"""),
    "item_mean": sql.with_ctes(sql.BASE, """
        SELECT business_id, round(avg(stars), 6) AS item_mean FROM train GROUP BY business_id"""),
    "user_mean": sql.with_ctes(sql.BASE, """
        SELECT user_id, round(avg(stars), 6) AS user_mean FROM train GROUP BY user_id"""),
    "category_vocab": side("""
        SELECT DISTINCT unnest(string_split(coalesce(categories, ''), ', ')) AS category FROM part_business"""),
    # features
    "multi_hot_categories": side("""
        SELECT DISTINCT business_id, unnest(string_split(coalesce(categories, ''), ', ')) AS category
        FROM part_business"""),
}

_BFEAT = """bfeat AS (
  SELECT b.business_id,
         b.latitude AS business_latitude, b.longitude AS business_longitude, b.stars AS business_stars,
         b.review_count AS business_review_count, b.is_open AS business_is_open,
         b.len_attributes AS business_len_attributes, b.len_categories AS business_len_categories,
         b.len_hours AS business_len_hours,
         c.checkin_sum AS business_checkin_sum, c.checkin_avg AS business_checkin_avg,
         t.n_tip_business AS business_n_tip_business, t.avg_like_business AS business_avg_like_business,
         t.avg_tip_len_business AS business_avg_tip_len_business, b.state AS business_state
  FROM bprof b
  LEFT JOIN checkin_stats c ON c.business_id = b.business_id
  LEFT JOIN tip_item t ON t.business_id = b.business_id
  WHERE b.business_id IN (SELECT business_id FROM train UNION SELECT business_id FROM test))"""

_UFEAT = """ufeat AS (
  SELECT u.user_id,
         u.review_count AS user_review_count, u.date_since AS user_date_since, u.n_friends AS user_n_friends,
         u.useful AS user_useful, u.funny AS user_funny, u.fans AS user_fans, u.n_elite AS user_n_elite,
         u.max_elite AS user_max_elite, u.avg_stars AS user_avg_stars,
         u.compliment_hot AS user_compliment_hot, u.compliment_more AS user_compliment_more,
         u.compliment_cute AS user_compliment_cute, u.compliment_list AS user_compliment_list,
         u.compliment_note AS user_compliment_note, u.compliment_plain AS user_compliment_plain,
         u.compliment_cool AS user_compliment_cool, u.compliment_funny AS user_compliment_funny,
         u.compliment_writer AS user_compliment_writer, u.compliment_photos AS user_compliment_photos,
         t.n_tip_user AS user_n_tip_user, t.avg_like_user AS user_avg_like_user,
         t.avg_tip_len_user AS user_avg_tip_len_user
  FROM uprof u LEFT JOIN tip_user t ON t.user_id = u.user_id
  WHERE u.user_id IN (SELECT user_id FROM train UNION SELECT user_id FROM test))"""

_WIDE = """wide AS (
  SELECT r.user_id, r.business_id, r.label, r.is_train, uf.* EXCLUDE (user_id), bf.* EXCLUDE (business_id)
  FROM (SELECT user_id, business_id, stars AS label, 1 AS is_train FROM train
        UNION ALL SELECT user_id, business_id, CAST(NULL AS DOUBLE), 0 FROM test) r
  LEFT JOIN ufeat uf ON uf.user_id = r.user_id
  LEFT JOIN bfeat bf ON bf.business_id = r.business_id)"""

_R = "round({0}, 6) AS {0}"
_BF_DOUBLES = ["business_latitude", "business_longitude", "business_stars", "business_checkin_avg",
               "business_avg_like_business", "business_avg_tip_len_business"]
_UF_DOUBLES = ["user_avg_stars", "user_avg_like_user", "user_avg_tip_len_user"]

ORACLE["feature_join"] = side(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in _BF_DOUBLES) + ") FROM bfeat",
    [_BFEAT])
ORACLE["wide_features"] = side(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in ["label"] + _BF_DOUBLES + _UF_DOUBLES)
    + ") FROM wide", [_BFEAT, _UFEAT, _WIDE])
ORACLE["union_one_hot"] = side("""
    SELECT user_id, business_id, is_train,
           CASE WHEN business_state IS NULL OR business_state = (SELECT min(business_state) FROM wide) THEN NULL
                ELSE 'state_' || business_state END AS state_feature
    FROM wide""", [_BFEAT, _UFEAT, _WIDE])
ORACLE["impute_flags"] = side("""
    SELECT user_id, business_id, is_train,
           round(coalesce(user_avg_stars, avg(user_avg_stars) FILTER (WHERE is_train = 1) OVER ()), 6) AS user_avg_stars,
           CAST(user_avg_stars IS NULL AS INTEGER) AS user_avg_stars_missing,
           round(coalesce(business_stars, avg(business_stars) FILTER (WHERE is_train = 1) OVER ()), 6) AS business_stars,
           CAST(business_stars IS NULL AS INTEGER) AS business_stars_missing
    FROM (SELECT r.user_id, r.business_id, r.is_train, ut.average_stars AS user_avg_stars, it.stars AS business_stars
          FROM (SELECT user_id, business_id, 1 AS is_train FROM train UNION ALL SELECT user_id, business_id, 0 FROM test) r
          LEFT JOIN user_train ut ON ut.user_id = r.user_id
          LEFT JOIN item_train it ON it.business_id = r.business_id) w""")

_FLAT = """flat AS (
  SELECT business_id, 'brand' AS attr, attr_brand AS value FROM part_business WHERE attr_brand IS NOT NULL
  UNION ALL SELECT business_id, 'size', whole_size FROM part_business WHERE whole_size IS NOT NULL
  UNION ALL SELECT business_id, 'type', p_type FROM part_business WHERE attr_kind IS NOT NULL
  UNION ALL SELECT business_id, ' big', big FROM part_business WHERE attr_kind IS NOT NULL
  UNION ALL SELECT business_id, ' code', whole_size FROM part_business WHERE attr_kind IS NOT NULL),
voc AS (SELECT DISTINCT attr, value FROM flat),
num AS (SELECT attr, bool_and(regexp_full_match(value, '[0-9]+')) AS numeric_attr FROM voc GROUP BY attr),
ranked_voc AS (
  SELECT v.attr, v.value,
         row_number() OVER (PARTITION BY v.attr
            ORDER BY CASE WHEN n.numeric_attr THEN CAST(v.value AS DECIMAL(38,0)) END ASC NULLS LAST,
                     v.value) AS pos
  FROM voc v JOIN num n ON n.attr = v.attr)"""

ORACLE["one_hot_attributes"] = side("""
    SELECT f.business_id, f.attr || '_' || f.value AS feature
    FROM flat f JOIN ranked_voc r ON r.attr = f.attr AND r.value = f.value WHERE r.pos > 1""", [_FLAT])

_RAW = """rawp AS (SELECT user_id, business_id FROM rated WHERE l_orderkey % 10 = 0)"""
ORACLE["knn_predict_duplicates"] = sql.with_ctes(_KNN20 + [_RAW], """
    SELECT r.user_id, r.business_id, round(k.prediction, 6) AS prediction
    FROM rawp r JOIN knn k ON k.user_id = r.user_id AND k.business_id = r.business_id""")
ORACLE["item_similarity_heavy"] = sql.item_similarity(20)
for _key, _header in (("sink_csv", "user_id,business_id,prediction"), ("sink_csv_loose", "user_id, business_id, prediction")):
    ORACLE[_key] = sql.with_ctes(_KNN20, f"""
        SELECT user_id, business_id, round(prediction, 6) AS prediction, '{_header}' AS header FROM knn""")

_ROWS = """rows AS (SELECT user_id, business_id, 1 AS is_train FROM train
  UNION ALL SELECT user_id, business_id, 0 FROM test)"""
ORACLE["wide_features_strict"] = side("""
    SELECT r.user_id, r.business_id, r.is_train, b.business_review_count AS review_count,
           round(b.business_stars, 6) AS stars, round(u.user_avg_stars, 6) AS avg_stars,
           u.user_n_friends AS n_friends, b.business_checkin_sum AS checkin_sum
    FROM rows r JOIN ufeat u ON u.user_id = r.user_id AND u.user_review_count > 0
    JOIN bfeat b ON b.business_id = r.business_id""", [_BFEAT, _UFEAT, _ROWS])

_HYBRID = """matrix AS (
  SELECT r.user_id, r.business_id, r.is_train, u.user_id IS NOT NULL AND b.business_id IS NOT NULL AS whole,
         u.review_count AS user_review_count, u.average_stars AS user_average_stars,
         b.stars AS business_stars, b.review_count AS business_review_count,
         b.longitude AS business_longitude, b.latitude AS business_latitude
  FROM rows r LEFT JOIN (SELECT usr.* FROM usr JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = usr.user_id WHERE c.c_acctbal >= 0) u ON u.user_id = r.user_id
  LEFT JOIN business b ON b.business_id = r.business_id)"""
_HYBRID_COLS = ["user_review_count", "user_average_stars", "business_stars", "business_review_count",
                "business_longitude", "business_latitude"]


def _hybrid(where: str) -> str:
    cols = ", ".join(f"""round(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM m WHERE is_train = 1)), 6) AS {c}"""
                     for c in _HYBRID_COLS)
    return side(f"SELECT user_id, business_id, is_train, {cols} FROM m",
                [_ROWS, _HYBRID, f"m AS (SELECT * FROM matrix WHERE {where})"])


ORACLE["hybrid_features"] = _hybrid("true")
ORACLE["hybrid_features_strict"] = _hybrid("whole")

ORACLE["pca_category_norms"] = side("""
    SELECT b.business_id, round((SELECT sum(m * m) FROM mu) + coalesce(sum(1 - 2 * mu.m), 0), 6) AS square_norm
    FROM part_business b LEFT JOIN tok t ON t.business_id = b.business_id LEFT JOIN mu ON mu.token = t.token
    GROUP BY b.business_id""", [
    """tok AS (SELECT DISTINCT business_id, unnest(string_split(coalesce(categories, ''), ', ')) AS token FROM part_business)""",
    """mu AS (SELECT token, count(*) / CAST((SELECT count(*) FROM part_business) AS DOUBLE) AS m FROM tok GROUP BY token)"""])
ORACLE["hybrid_parts"] = sql.with_ctes(_KNN20, """
    SELECT user_id, business_id, round(prediction, 6) AS knn_prediction, true AS guarded, false AS left_over FROM knn""")
ORACLE["ordered_files"] = sql.with_ctes(_KNN20, """
    SELECT CAST(row_number() OVER (ORDER BY user_id, business_id) - 1 AS BIGINT) AS line_no, user_id, business_id,
           round(prediction, 6) AS prediction FROM knn""")
