"""Item-kNN against an independent brute-force implementation of the same semantics."""
import random
from collections import defaultdict
from math import sqrt

import pytest
from pyspark.sql import functions as F

from ratewise.operators import neighbours, similarity


def brute_knn(train_rows, pairs, min_overlap, k=3, default=3.0):
    by_item, by_user = defaultdict(dict), defaultdict(dict)
    for u, i, r in train_rows:
        by_item[i][u] = r
        by_user[u][i] = r
    mean = {i: sum(d.values()) / len(d) for i, d in by_item.items()}

    def sim(i, j):
        a, b = by_item.get(i, {}), by_item.get(j, {})
        common = set(a) & set(b)
        if not a or not b or len(common) < min_overlap:
            return 0.0
        num = d1 = d2 = 0.0
        for v in common:
            x, y = a[v] - mean[i], b[v] - mean[j]
            num, d1, d2 = num + x * y, d1 + x * x, d2 + y * y
        if d1 == 0 or d2 == 0:
            return 0.0
        return round(num / (sqrt(d1) + sqrt(d2)), 9)

    out = {}
    for u, i in pairs:
        rated = by_user.get(u, {})
        if not rated:
            out[(u, i)] = default
            continue
        cands = [(sim(i, j), j, r) for j, r in rated.items()]
        pos = sorted([c for c in cands if c[0] > 0], key=lambda t: (-t[0], t[1]))[:k]
        if not pos:
            out[(u, i)] = sum(rated.values()) / len(rated)
        else:
            out[(u, i)] = sum(s * r for s, _, r in pos) / sum(s for s, _, _ in pos)
    return out


def _frames(spark, train_rows, pairs):
    train = spark.createDataFrame(train_rows, "user_id string, business_id string, stars double")
    p = spark.createDataFrame(pairs, "user_id string, business_id string")
    return train, p


def _random_fixture(seed, n_users=40, n_items=12, density=0.45):
    rnd = random.Random(seed)
    rows = []
    for u in range(n_users):
        for i in range(n_items):
            if rnd.random() < density:
                rows.append((f"u{u:02d}", f"i{i:02d}", float(rnd.randint(1, 5))))
    # a constant-rating item (zero denominator) and a heavy user rating everything
    rows += [(f"u{u:02d}", "iconst", 4.0) for u in range(0, n_users, 2)]
    rows += [("uheavy", f"i{i:02d}", float(rnd.randint(1, 5))) for i in range(n_items)]
    pairs = [(f"u{rnd.randrange(n_users):02d}", f"i{rnd.randrange(n_items):02d}") for _ in range(60)]
    pairs += [("ucold", "i01"), ("u01", "icold"), ("uheavy", "i03"), ("u03", "iconst")]
    return rows, sorted(set(pairs))


@pytest.mark.parametrize("seed,min_overlap,heavy", [(1, 3, 500), (2, 5, 500), (3, 3, 4), (4, 8, 6)])
def test_knn_matches_brute_force(spark, seed, min_overlap, heavy):
    rows, pairs = _random_fixture(seed)
    train, p = _frames(spark, rows, pairs)
    got = {(r.user_id, r.business_id): r.prediction for r in neighbours.knn_predict(
        train, p, min_overlap=min_overlap, heavy_user_degree=heavy, decimals=None).collect()}
    want = brute_knn(rows, pairs, min_overlap)
    assert set(got) == set(want)
    for key, v in want.items():
        assert got[key] == pytest.approx(v, abs=1e-9), key


def test_hand_edges(spark):
    # items a, b share 3 raters; c shares 2 with a; d is rated only by the cold-item side
    rows = [("u1", "a", 5.0), ("u2", "a", 3.0), ("u3", "a", 1.0),
            ("u1", "b", 4.0), ("u2", "b", 3.0), ("u3", "b", 2.0),
            ("u1", "c", 1.0), ("u2", "c", 5.0),
            ("u4", "b", 1.0)]
    pairs = [("u1", "a"),      # self pair: a is among u1's ratings
             ("u9", "a"),      # cold user -> 3
             ("u1", "zz"),     # cold item -> user mean
             ("u4", "a")]      # single neighbour b
    train, p = _frames(spark, rows, pairs)
    for mo in (2, 3, 4):
        got = {(r.user_id, r.business_id): r.prediction for r in neighbours.knn_predict(
            train, p, min_overlap=mo, decimals=None).collect()}
        want = brute_knn(rows, pairs, mo)
        for key, v in want.items():
            assert got[key] == pytest.approx(v, abs=1e-9), (mo, key)
    got = {(r.user_id, r.business_id): r.prediction for r in neighbours.knn_predict(
        train, p, min_overlap=3, decimals=None).collect()}
    assert got[("u9", "a")] == 3.0
    assert got[("u1", "zz")] == pytest.approx((5 + 4 + 1) / 3)


def test_similarity_symmetric_and_product(spark):
    rows, pairs = _random_fixture(7)
    train, p = _frames(spark, rows, pairs)
    needed = similarity.needed_pairs(neighbours.knn_candidates(p, train))
    s = {(r.business_id, r.neighbour_id): r.similarity
         for r in similarity.item_similarity(train, needed, 2).collect()}
    for (i, j), v in s.items():
        if (j, i) in s:
            assert s[(j, i)] == v
    prod = similarity.item_similarity(train, needed, 2, denominator="product").collect()
    assert all(-1.0 - 1e-9 <= r.similarity <= 1.0 + 1e-9 for r in prod)


def test_top_k_uses_window_group_limit(spark):
    rows, pairs = _random_fixture(3)
    train, p = _frames(spark, rows, pairs)
    cand = neighbours.knn_candidates(p, train)
    sims = similarity.pair_similarity(train, similarity.needed_pairs(cand), 2)
    plan = neighbours.knn_top_k(cand, sims, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_pairs_and_ratings_count_once(spark):
    rows, pairs = _random_fixture(5)
    old = [(u, i, 6.0 - r, 0) for u, i, r in rows]      # earlier, other ratings of the same pairs
    train = spark.createDataFrame([(u, i, r, 1) for u, i, r in rows] + old + old,
                                  "user_id string, business_id string, stars double, line int")
    asked = spark.createDataFrame(pairs + pairs + pairs[:7], "user_id string, business_id string")
    got = neighbours.knn_predict(train, asked, min_overlap=4, decimals=None, order_by=["line"], heavy_user_degree=6).collect()
    want = brute_knn(rows, pairs, 4)
    assert len(got) == 2 * len(pairs) + 7
    for r in got:
        assert r.prediction == pytest.approx(want[(r.user_id, r.business_id)], abs=1e-9)


def test_empty_ids_are_ids(spark):
    rows, pairs = _random_fixture(6)
    rows += [("", i, 4.0) for _, i, _ in rows[:5]] + [("u01", "", 2.0)]
    rows = list({(u, i): (u, i, r) for u, i, r in rows}.values())
    pairs = pairs + [("", "i03"), ("u02", "")]
    train, p = _frames(spark, rows, pairs)
    got = {(r.user_id, r.business_id): r.prediction for r in neighbours.knn_predict(train, p, min_overlap=3, decimals=None).collect()}
    want = brute_knn(rows, pairs, 3)
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_similarity_drops_ratings_of_items_in_no_needed_pair(spark):
    rows, pairs = _random_fixture(2)
    train, _ = _frames(spark, rows, pairs)
    needed = spark.createDataFrame([("i01", "i02")], "business_id string, neighbour_id string")
    plan = similarity.pair_similarity(train, needed, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") >= 1 and plan.count("LeftSemi") >= 3


def test_terms_of_unneeded_pairs_are_dropped_before_the_sums(spark):
    """Of 30 items that all users rated, 20 pairs are needed: no other pair's terms reach the aggregate."""
    from ratewise.operators import similarity

    ratings = spark.createDataFrame([(f"u{u}", f"b{i:02d}", float((u * i) % 5)) for u in range(12) for i in range(30)],
                                    "user_id string, business_id string, centred double")
    needed = spark.createDataFrame([(f"b{i:02d}", f"b{i + 5:02d}") for i in range(20)], "lo string, hi string")
    a = ratings.toDF("user_id", "lo", "c_lo")
    terms = a.join(ratings.toDF("user_id", "hi", "c_hi"), "user_id").filter("lo <= hi").select("lo", "hi", "c_lo", "c_hi")
    kept = similarity.masked(terms, needed)
    assert terms.count() == 12 * 465 and kept.count() == 12 * 20
    assert kept.join(needed, ["lo", "hi"], "left_anti").count() == 0
    plan = kept.groupBy("lo", "hi").count()._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.index("partial_count") < plan.index("LeftSemi"), "the mask stands below the partial aggregate"
    assert similarity.pair_mask(spark.range(3 * similarity.MASK).selectExpr("id as lo", "id as hi")).count() <= similarity.MASK


@pytest.mark.parametrize("heavy", [1, 6, 500])
def test_co_rating_sums_of_repeats_and_null_ids(spark, monkeypatch, heavy):
    """Every term once, with lists cut into chunks of four item numbers and dealt to three buckets."""
    monkeypatch.setattr(similarity, "CHUNK", 4)
    rnd = random.Random(heavy)
    rows = [(f"u{rnd.randrange(15)}", f"i{rnd.randrange(14):02d}", float(rnd.randint(-2, 2))) for _ in range(160)]
    rows += [(None, "i01", 1.0), (None, "i02", 1.0), ("u1", None, 1.0)]
    needed = [(f"i{a:02d}", f"i{b:02d}") for a in range(14) for b in range(a, 14) if rnd.random() < 0.6] + [("i01", None), ("i01", "zz")]
    want = defaultdict(lambda: [0, 0.0, 0.0, 0.0])
    for u, i, x in rows:
        for v, j, y in rows:
            if None not in (u, i, j) and u == v and (i, j) in needed:
                w = want[i, j]
                w[0], w[1], w[2], w[3] = w[0] + 1, w[1] + x * y, w[2] + x * x, w[3] + y * y
    centred = spark.createDataFrame(rows, "user_id string, business_id string, centred double")
    degree = centred.groupBy("user_id").count().withColumnRenamed("count", "user_degree")
    got = similarity.co_rating_stats(centred, spark.createDataFrame(needed, "lo string, hi string"), degree, heavy, 3)
    assert {(r.lo, r.hi): [r.n_common, r.num, r.den_lo, r.den_hi] for r in got.collect()} == dict(want)


def test_terms_are_summed_before_any_shuffle(spark):
    """No join makes a row per user and pair of ratings, and no aggregate shuffles their sums."""
    rows, pairs = _random_fixture(4)
    train, p = _frames(spark, rows, pairs)
    needed = similarity.needed_pairs(neighbours.knn_candidates(p, train))
    plan = similarity.pair_similarity(train, needed, 2)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert "MapInArrow" in plan and "sum(" not in plan


@pytest.mark.parametrize("heavy", [0, 500])
def test_co_rating_sums_leave_out_null_ratings(spark, heavy):
    """As the sums over a self-join: a NULL rating counts as common, NaN stays NaN, a sum of NULLs is NULL."""
    rnd = random.Random(8)
    value = {0: None, 1: float("nan")}
    rows = [(f"u{u}", f"i{i}", 4.0 if i == 7 and u % 2 else None if i == 7 else value.get(rnd.randrange(9), float(rnd.randint(-2, 2))))
            for u in range(12) for i in range(9) if rnd.random() < 0.7] + [("v", "i0", None), ("v", "i8", None), ("w", "only", None), ("w", "i0", 1.0)]
    centred = spark.createDataFrame(rows, "user_id string, business_id string, centred double")
    degree = centred.groupBy("user_id").count().withColumnRenamed("count", "user_degree")
    a, b = centred.toDF("user_id", "lo", "x"), centred.toDF("user_id", "hi", "y")
    want = a.join(b, "user_id").where("lo <= hi").groupBy("lo", "hi").agg(*[F.expr(e) for e in (
        "count(1)", "sum(x * y)", "sum(x * x)", "sum(y * y)")])
    got = similarity.co_rating_stats(centred, want.select("lo", "hi"), degree, heavy)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


@pytest.mark.parametrize("length", [2, 4096])
def test_top_k_gathers_candidates_before_the_shuffle(spark, monkeypatch, length):
    """As the join of single candidates on the unordered pair, with NULL ids and NaN similarities; no join on pairs."""
    monkeypatch.setattr(neighbours, "LIST", length)
    rnd = random.Random(3)
    ids = ["i0", "i1", "i2", "i3", "i4", "i5", "i6", None]
    cand = spark.createDataFrame([(f"u{u}", i, j, float(rnd.randint(1, 5))) for u in range(6) for i in ids for j in ids if rnd.random() < 0.7],
                                 "user_id string, business_id string, neighbour_id string, neighbour_stars double")
    sims = spark.createDataFrame([(f"i{a}", f"i{b}", rnd.choice([0.5, 0.25, 0.75, -1.0, 0.0, float("nan")])) for a in range(7) for b in range(a, 7)],
                                 "lo string, hi string, similarity double")
    top = neighbours.knn_top_k(cand, sims, 3)
    joined = cand.join(sims.filter("similarity > 0"), similarity.on_pair())
    joined.createOrReplaceTempView("scored_candidates")
    want = spark.sql("select user_id, business_id, rank, neighbour_id, similarity, neighbour_stars from (select *, row_number() over "
                     "(partition by user_id, business_id order by similarity desc, neighbour_id) as rank from scored_candidates) where rank <= 3")
    assert want.count() > 50 and sorted(map(str, top.collect())) == sorted(map(str, want.collect()))
    assert "least(" not in top._jdf.queryExecution().executedPlan().toString()


def test_lists_are_shuffled_packed(spark):
    """A light user's list goes to its buckets in less than 4 bytes a rating, not 12 and more."""
    rnd = random.Random(1)
    rows = [(f"u{u}", i, float(rnd.randint(1, 5))) for u in range(2000) for i in rnd.sample(range(600), 20)]
    packed = similarity._light_rows(spark.createDataFrame(rows, "user_id string, item int, centred double").coalesce(1), 8)
    got = packed.selectExpr("kind", "bucket", "length(data) as n").collect()
    sent = sum(len(sorted(items)[at:]) for items in _by_user(rows) for at in {
        next(k for k, i in enumerate(sorted(items)) if i % 8 == p) for p in {i % 8 for i in items}})
    assert {(r.kind, r.bucket) for r in got} == {(1, p) for p in range(8)}
    assert sum(r.n for r in got) < 4 * sent


def _by_user(rows):
    lists = defaultdict(list)
    for u, i, _ in rows:
        lists[u].append(i)
    return lists.values()


def test_candidates_are_shuffled_packed_and_unsorted(spark):
    """The candidates of a pair go to its item in less than 3 bytes each, and no window sorts their rows."""
    rnd = random.Random(2)
    rows = [(f"u{u}", 2 * a, 2 * b, float(rnd.randint(1, 5))) for u in range(1500) for a in rnd.sample(range(600), 2) for b in rnd.sample(range(600), 20)]
    frame = spark.createDataFrame(rows, "user_id string, a long, b long, neighbour_stars double").coalesce(1)
    got = frame.mapInArrow(neighbours._pack_lists(8, neighbours.LIST), similarity.PACKED).selectExpr("kind", "bucket", "length(data) as n").collect()
    assert {(r.kind, r.bucket) for r in got} == {(1, p) for p in range(8)}
    assert sum(r.n for r in got) < 3 * len(rows)
    train, p = _frames(spark, *_random_fixture(3))
    cand = neighbours.knn_candidates(p, train)
    plan = neighbours.knn_top_k(cand, similarity.pair_similarity(train, cand, 2), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "collect_list" not in plan


def test_needed_keys_are_distinct(spark):
    rnd = random.Random(4)
    keys = [rnd.randrange(50) << 32 | rnd.randrange(9) for _ in range(2000)] + [7 << 32 | 2 ** 31 - 1] * 2
    got = similarity._distinct_keys(spark.createDataFrame([(k,) for k in keys], "key long")).collect()
    assert sorted(r.a << 32 | r.b for r in got) == sorted(set(keys))
    assert similarity._distinct_keys(spark.createDataFrame([], "key long")).count() == 0


def test_a_heavy_users_rating_costs_the_fewer_of_ratings_and_partners():
    """500 needed partners of an item and a list of four ratings: four look-ups, not 500, and the other way round."""
    import numpy as np
    import pyarrow as pa

    from ratewise.operators import similarity as sim

    def lists(item, n):
        return pa.record_batch({"items": pa.array([np.diff(item, prepend=0)]), "centred": pa.array([[float(i % 5) for i in item]])})

    few = sim._Sums(np.array([0 << 32 | h for h in range(500)]))
    few.heavy_lists(lists([0, 3, 499, 700], 1000), 0, 1000)
    assert few.lookups == 4 and np.flatnonzero(few.n).tolist() == [0, 3, 499]
    many = sim._Sums(np.array([0 << 32 | 3, 0 << 32 | 900]))
    many.heavy_lists(lists(list(range(500)), 1000), 0, 1000)
    assert many.lookups == 1 and many.n.tolist() == [1, 0]  # the partner behind the list's end is not sought
    assert [x[0] for x in many.sums] == [0.0, 0.0, 9.0]
    chunk = sim._Sums(np.array([0 << 32 | h for h in range(500)]))
    chunk.heavy(pa.record_batch({"items": pa.array([[3, 499]], pa.list_(pa.int32())), "centred": pa.array([[3.0, 4.0]]),
                                 "of": pa.array([[0]], pa.list_(pa.int32())), "of_centred": pa.array([[1.0]])}))
    assert chunk.lookups == 2 and np.flatnonzero(chunk.n).tolist() == [3, 499] and chunk.sums[0][3] == 3.0
