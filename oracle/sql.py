"""Independent DuckDB SQL for every SQL-expressible query.

Written directly against the raw test tables (region nation customer supplier part orders
lineitem events conversations ...), with the stand-in inputs rebuilt as CTEs. Nothing here is
generated from the Spark plans.
"""

from __future__ import annotations

RATED = """rated AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(l.l_suppkey AS VARCHAR) AS business_id,
         CAST(1 + floor((l.l_quantity - 1) / 10) AS DOUBLE) AS stars,
         l.l_orderkey, l.l_linenumber, o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

TRAIN = """train AS (
  SELECT user_id, business_id, stars FROM (
    SELECT user_id, business_id, stars,
           row_number() OVER (PARTITION BY user_id, business_id
                              ORDER BY l_orderkey DESC, l_linenumber DESC, stars DESC) AS rn
    FROM rated WHERE l_orderkey % 10 <> 0 AND o_custkey % 50 <> 0) t WHERE rn = 1)"""

TEST = """test AS (
  SELECT user_id, business_id, label FROM (
    SELECT user_id, business_id, stars AS label,
           row_number() OVER (PARTITION BY user_id, business_id
                              ORDER BY l_orderkey DESC, l_linenumber DESC, stars DESC) AS rn
    FROM rated WHERE l_orderkey % 10 = 0) t WHERE rn = 1)"""

BASE = [RATED, TRAIN, TEST]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def knn_ctes(min_overlap: int, k: int = 3, denominator: str = "sum") -> list[str]:
    den = "(sqrt(co.den_a) + sqrt(co.den_b))" if denominator == "sum" else "(sqrt(co.den_a) * sqrt(co.den_b))"
    return BASE + [
        """imean AS (SELECT business_id, avg(stars) AS item_mean, count(*) AS item_degree
                     FROM train GROUP BY business_id)""",
        """umean AS (SELECT user_id, avg(stars) AS user_mean FROM train GROUP BY user_id)""",
        """cand AS (SELECT p.user_id, p.business_id, t.business_id AS neighbour_id,
                           t.stars AS neighbour_stars
                    FROM test p JOIN train t ON p.user_id = t.user_id)""",
        """needed AS (SELECT DISTINCT business_id, neighbour_id FROM cand)""",
        """cent AS (SELECT t.user_id, t.business_id, t.stars - m.item_mean AS c
                    FROM train t JOIN imean m ON t.business_id = m.business_id)""",
        """co AS (SELECT n.business_id, n.neighbour_id, count(*) AS n_common,
                         sum(a.c * b.c) AS num, sum(a.c * a.c) AS den_a, sum(b.c * b.c) AS den_b
                  FROM needed n
                  JOIN cent a ON a.business_id = n.business_id
                  JOIN cent b ON b.business_id = n.neighbour_id AND b.user_id = a.user_id
                  GROUP BY n.business_id, n.neighbour_id)""",
        f"""sims AS (SELECT n.business_id, n.neighbour_id,
                            CAST(coalesce(co.n_common, 0) AS BIGINT) AS n_common,
                            CASE WHEN coalesce(co.n_common, 0) < {min_overlap} THEN CAST(0 AS DOUBLE)
                                 WHEN co.den_a = 0 OR co.den_b = 0 THEN CAST(0 AS DOUBLE)
                                 ELSE round(co.num / {den}, 9) END AS similarity
                     FROM needed n LEFT JOIN co
                       ON co.business_id = n.business_id AND co.neighbour_id = n.neighbour_id)""",
        """ranked AS (SELECT c.user_id, c.business_id, c.neighbour_id, c.neighbour_stars, s.similarity,
                             row_number() OVER (PARTITION BY c.user_id, c.business_id
                                                ORDER BY s.similarity DESC, c.neighbour_id ASC) AS rank
                      FROM cand c JOIN sims s
                        ON s.business_id = c.business_id AND s.neighbour_id = c.neighbour_id
                      WHERE s.similarity > 0)""",
        f"""top AS (SELECT * FROM ranked WHERE rank <= {k})""",
        """wavg AS (SELECT user_id, business_id,
                           sum(similarity * neighbour_stars) / sum(abs(similarity)) AS weighted
                    FROM top GROUP BY user_id, business_id)""",
        """knn AS (SELECT p.user_id, p.business_id,
                          coalesce(w.weighted, u.user_mean, CAST(3 AS DOUBLE)) AS prediction
                   FROM test p
                   LEFT JOIN wavg w ON w.user_id = p.user_id AND w.business_id = p.business_id
                   LEFT JOIN umean u ON u.user_id = p.user_id)""",
    ]


def knn_predict(min_overlap: int) -> str:
    return with_ctes(knn_ctes(min_overlap),
                     "SELECT user_id, business_id, round(prediction, 6) AS prediction FROM knn")


def item_similarity(min_overlap: int) -> str:
    return with_ctes(knn_ctes(min_overlap),
                     "SELECT business_id, neighbour_id, n_common, similarity FROM sims")


def knn_top_k(min_overlap: int, k: int = 3) -> str:
    return with_ctes(knn_ctes(min_overlap, k),
                     """SELECT user_id, business_id, CAST(rank AS INTEGER) AS rank, neighbour_id,
                               similarity, neighbour_stars FROM top""")


# ---- stand-in side tables -----------------------------------------------------------------
ITEM_TRAIN = """item_train AS (SELECT business_id, avg(stars) AS stars,
                                CAST(count(*) AS INTEGER) AS review_count
                         FROM train GROUP BY business_id)"""

PART_FIELDS = """part_fields AS (
  SELECT p_partkey, replace(p_name, ' ', ', ') AS categories,
         CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS attr_brand,
         CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_size AS VARCHAR), 3, '0')
              ELSE CAST(p_size AS VARCHAR) END AS attr_size,
         CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS whole_size,
         CASE WHEN p_size % 10 = 0 THEN NULL
              ELSE '{''type'': ' || p_type || ', ''big'': ' || CASE WHEN p_size > 25 THEN '1' ELSE '0' END
                   || ', ''code'': 0' || CAST(p_size AS VARCHAR) || ': x}'
         END AS attr_kind,
         p_type, CASE WHEN p_size > 25 THEN '1' ELSE '0' END AS big,
         CASE WHEN p_size % 10 = 0 THEN 0 ELSE 3 END AS len_attributes,
         CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_size % 3 + 1 END AS len_hours
  FROM part)"""

BUSINESS = """business AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS business_id,
         CAST(s.s_nationkey AS DOUBLE) AS latitude,
         CAST(s.s_suppkey % 180 AS DOUBLE) AS longitude,
         it.stars AS stars, coalesce(it.review_count, 0) AS review_count,
         CASE WHEN s.s_acctbal > 0 THEN 1 ELSE 0 END AS is_open,
         n.n_name AS state, pf.categories, pf.attr_brand, pf.attr_size, pf.attr_kind,
         pf.p_type, pf.big, pf.whole_size, pf.len_attributes, pf.len_hours
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN part_fields pf ON pf.p_partkey = s.s_suppkey
  LEFT JOIN item_train it ON it.business_id = CAST(s.s_suppkey AS VARCHAR))"""

PART_BUSINESS = """part_business AS (
  SELECT CAST(p_partkey AS VARCHAR) AS business_id, * FROM part_fields)"""

USER = """ord AS (
  SELECT o_custkey, CAST(count(*) AS INTEGER) AS review_count,
         strftime(min(o_orderdate), '%Y-%m-%d') AS yelping_since,
         array_to_string(list_sort(list_distinct(list(CAST(year(o_orderdate) AS VARCHAR)))), ',') AS elite,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS useful,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS INTEGER) AS funny,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS INTEGER) AS fans
  FROM orders GROUP BY o_custkey),
ev AS (
  SELECT user_id AS e_user,
    CAST(count(*) FILTER (WHERE event_type = 'view' AND hour(ts) < 12) AS INTEGER) AS c_hot,
    CAST(count(*) FILTER (WHERE event_type = 'view' AND hour(ts) >= 12) AS INTEGER) AS c_more,
    CAST(count(*) FILTER (WHERE event_type = 'click' AND hour(ts) < 12) AS INTEGER) AS c_cute,
    CAST(count(*) FILTER (WHERE event_type = 'click' AND hour(ts) >= 12) AS INTEGER) AS c_list,
    CAST(count(*) FILTER (WHERE event_type = 'error' AND hour(ts) < 12) AS INTEGER) AS c_note,
    CAST(count(*) FILTER (WHERE event_type = 'error' AND hour(ts) >= 12) AS INTEGER) AS c_plain,
    CAST(count(*) FILTER (WHERE event_type = 'purchase' AND hour(ts) < 12) AS INTEGER) AS c_cool,
    CAST(count(*) FILTER (WHERE event_type = 'purchase' AND hour(ts) >= 12) AS INTEGER) AS c_funny,
    CAST(count(*) FILTER (WHERE event_type = 'signup' AND hour(ts) < 12) AS INTEGER) AS c_writer,
    CAST(count(*) FILTER (WHERE event_type = 'signup' AND hour(ts) >= 12) AS INTEGER) AS c_photos
  FROM events GROUP BY user_id),
user_train AS (SELECT user_id, avg(stars) AS average_stars FROM train GROUP BY user_id),
usr AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id,
         coalesce(o.review_count, 0) AS review_count, o.yelping_since,
         CASE WHEN c.c_custkey % 7 = 0 THEN 'None'
              ELSE array_to_string(list_transform(range(1, c.c_custkey % 5 + 2),
                                                  lambda x: CAST(c.c_custkey + x AS VARCHAR)), ',') END AS friends,
         CAST(CASE WHEN c.c_custkey % 7 = 0 THEN 0 ELSE c.c_custkey % 5 + 1 END AS INTEGER) AS n_friends_expected,
         coalesce(o.useful, 0) AS useful, coalesce(o.funny, 0) AS funny, coalesce(o.fans, 0) AS fans,
         coalesce(o.elite, 'None') AS elite, ut.average_stars,
         coalesce(e.c_hot, 0) AS compliment_hot, coalesce(e.c_more, 0) AS compliment_more,
         coalesce(e.c_cute, 0) AS compliment_cute, coalesce(e.c_list, 0) AS compliment_list,
         coalesce(e.c_note, 0) AS compliment_note, coalesce(e.c_plain, 0) AS compliment_plain,
         coalesce(e.c_cool, 0) AS compliment_cool, coalesce(e.c_funny, 0) AS compliment_funny,
         coalesce(e.c_writer, 0) AS compliment_writer, coalesce(e.c_photos, 0) AS compliment_photos
  FROM customer c
  LEFT JOIN ord o ON o.o_custkey = c.c_custkey
  LEFT JOIN ev e ON e.e_user = c.c_custkey
  LEFT JOIN user_train ut ON ut.user_id = CAST(c.c_custkey AS VARCHAR))"""

USER_PROFILE = """uprof AS (
  SELECT user_id, review_count,
         CAST(date_diff('day', CAST(yelping_since AS DATE), DATE '2021-03-10') AS INTEGER) AS date_since,
         CAST(CASE WHEN friends IS NULL OR friends = 'None' THEN 0 ELSE len(string_split(friends, ',')) END AS INTEGER) AS n_friends,
         useful, funny, fans,
         CAST(CASE WHEN elite IS NULL OR elite = 'None' THEN 0 ELSE len(string_split(elite, ',')) END AS INTEGER) AS n_elite,
         CASE WHEN elite IS NULL OR elite = 'None' THEN 0
              ELSE TRY_CAST(trim(list_max(string_split(elite, ','))) AS INTEGER) END AS max_elite,
         average_stars AS avg_stars,
         compliment_hot, compliment_more, compliment_cute, compliment_list, compliment_note,
         compliment_plain, compliment_cool, compliment_funny, compliment_writer, compliment_photos
  FROM usr)"""

CHECKIN = """checkin_rows AS (
  SELECT CAST(user_id AS VARCHAR) AS business_id, event_type, CAST(count(*) AS INTEGER) AS n
  FROM events GROUP BY user_id, event_type),
checkin_stats AS (
  SELECT business_id, CAST(sum(n) AS BIGINT) AS checkin_sum,
         CAST(sum(n) AS DOUBLE) / count(*) AS checkin_avg
  FROM checkin_rows GROUP BY business_id)"""

TIP = """tip AS (
  SELECT CAST((conv_id * 7 + turn) % 150 AS VARCHAR) AS business_id, CAST(conv_id AS VARCHAR) AS user_id, CAST(turn AS INTEGER) AS likes, text
  FROM conversations)"""

TIP_STATS = """tip_item AS (
  SELECT business_id, count(*) AS n_tip_business, avg(likes) AS avg_like_business,
         avg(length(text)) AS avg_tip_len_business FROM tip GROUP BY business_id),
tip_user AS (
  SELECT user_id, count(*) AS n_tip_user, avg(likes) AS avg_like_user,
         avg(length(text)) AS avg_tip_len_user FROM tip GROUP BY user_id)"""

BUSINESS_PROFILE = """bprof AS (
  SELECT business_id, latitude, longitude, stars, review_count, is_open, len_attributes,
         CAST(CASE WHEN categories IS NULL OR categories = 'None' THEN 0
                   ELSE len(string_split(categories, ',')) END AS INTEGER) AS len_categories,
         len_hours, state
  FROM business)"""

SIDE = BASE + [ITEM_TRAIN, PART_FIELDS, BUSINESS, PART_BUSINESS, USER, USER_PROFILE, CHECKIN, TIP,
               TIP_STATS, BUSINESS_PROFILE]


def side(body: str, extra: list[str] | None = None) -> str:
    return with_ctes(SIDE + (extra or []), body)
