"""PCA against a closed form, one-hot order rules, imputation, the two model pipelines end to end."""
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ratewise.operators import features as FE


def test_pca_two_columns_closed_form(spark):
    rnd = random.Random(0)
    pts = [(str(i), x, 0.5 * x + rnd.gauss(0, 0.3)) for i, x in enumerate(rnd.gauss(0, 1) for _ in range(400))]
    df = spark.createDataFrame(pts, "business_id string, x double, y double")
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(df)
    out = FE.pca_columns(vec, "v", 2, "pc_").toPandas()
    arr = np.array([[p[1], p[2]] for p in pts])
    eig = np.sort(np.linalg.eigvalsh(np.cov(arr.T)))[::-1]
    assert out["pc_0"].var(ddof=1) == pytest.approx(eig[0], rel=1e-6)
    assert out["pc_1"].var(ddof=1) == pytest.approx(eig[1], rel=1e-6)
    assert abs(out["pc_0"].mean()) < 1e-9
    assert abs(np.corrcoef(out["pc_0"], out["pc_1"])[0, 1]) < 1e-6
    # sign rule: largest absolute loading positive -> pc_0 grows with x here
    assert np.corrcoef(out["pc_0"], arr[:, 0])[0, 1] > 0


def test_attribute_one_hot_drop_first(spark):
    rows = [("b1", {"size": "10", "brand": "B#2"}),
            ("b2", {"size": "9", "brand": "B#10"}),
            ("b3", {"size": "x9", "kind": "{'type': A, 'big': 1}"}),
            ("b4", None)]
    df = spark.createDataFrame(rows, "business_id string, attributes map<string,string>")
    voc = {(r.attr, r.value): (r.position, r.kept) for r in
           FE.attribute_vocabulary(FE.flatten_attributes(df)).collect()}
    # "size" mixes digits and text -> string order: "10" < "9" < "x9"
    assert voc[("size", "10")] == (1, False)
    assert voc[("brand", "B#10")] == (1, False)
    assert voc[(" big", "1")] == (1, False)
    rows, index = FE.attribute_rows(df)
    names = {r.position: r.token.split("\u0001") for r in index.collect()}
    assert sorted(names) == list(range(len(names))) and [names[i] for i in sorted(names)] == sorted(names.values())
    got = {r.business_id: [names[i] for i in r.ones] for r in rows.collect()}
    assert got["b4"] == [] and got["b1"] == [["brand", "B#2"]]


def test_impute_with_flags(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "a double")
    out = FE.impute_with_flags(df, ["a"]).collect()
    assert [r.a for r in out] == [1.0, 2.0, 3.0, 2.0]
    assert [r.a_missing for r in out] == [0, 1, 0, 1]


def test_impute_stats_from_training_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 3.0, 5.0), (1, None, 5.0), (0, 100.0, 5.0), (0, None, 5.0)],
                               "is_train int, a double, b double")
    out = FE.impute_with_flags(df, ["a", "b"], stats_where="is_train = 1", drop_constant_flags=True)
    assert "b_missing" not in out.columns          # b is never missing: no constant flag column
    rows = out.collect()
    assert [r.a for r in rows] == [1.0, 3.0, 2.0, 100.0, 2.0]   # mean over training rows only
    assert [r.a_missing for r in rows] == [0, 0, 1, 0, 1]


@pytest.mark.parametrize("key", ["pca_attributes", "pca_categories"])
def test_rows_only_pca_keys_are_deterministic(spark, key):
    from ratewise.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    def rows():
        df = QUERIES[key](spark, SF_SMALL)
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    first, second = rows(), rows()
    assert first and first == second


def _dense(ones, width):
    x = np.zeros((len(ones), width))
    for row, at in zip(x, ones):
        row[at] = 1
    return x


def test_wide_vocabularies_in_tiles_agree_with_numpy(spark):
    """The block Krylov path, with tiles of 16 of 90 tokens, on rows with a few strong directions."""
    from ratewise.operators import sparse_pca

    rng = random.Random(6)
    rows = [(f"b{i}", sorted({t for t in range(90) if rng.random() < (0.7 if t % 6 == i % 6 and t < 60 else 0.05)})) for i in range(300)]
    rows.append(("none", []))
    df = spark.createDataFrame(rows, "business_id string, ones array<int>").repartition(3)
    x = _dense([r[1] for r in rows], 90)
    x = x - x.mean(axis=0)
    eig = np.linalg.svd(x, full_matrices=False)
    want = x @ eig[2][:4].T
    for exact in (1024, 0):
        table, shift, variance = sparse_pca.loadings(df, 90, 4, exact=exact, tile=16)
        assert variance == pytest.approx(eig[1][:4] ** 2 / (len(x) - 1), rel=1e-8)
        got = sparse_pca.project(df, "business_id", table, shift, 6, "p").toPandas().set_index("business_id").loc[[r[0] for r in rows]].to_numpy()
        assert (got[:, 4:] == 0).all()
        for j in range(4):
            assert min(np.abs(got[:, j] - want[:, j]).max(), np.abs(got[:, j] + want[:, j]).max()) < 1e-5
        v = np.array([r.loading for r in table.orderBy("position").collect()])
        assert v.T @ v == pytest.approx(np.eye(4), abs=1e-8) and (v.max(0) >= -v.min(0) - 1e-9).all()


def test_pca_of_empty_tables_and_few_tokens(spark):
    df = spark.createDataFrame([("a", "x, y"), ("b", None)], "business_id string, categories string")
    got = {r.business_id: list(r)[1:] for r in FE.pca_categories(df, 5).collect()}
    assert set(got) == {"a", "b"} and all(len(v) == 5 for v in got.values())
    assert sum(v * v for v in got["a"]) == pytest.approx(0.75)
    assert FE.pca_categories(df.limit(0), 2).count() == 0


@pytest.mark.parametrize("key,k", [("pca_attributes", 5), ("pca_categories", 10)])
def test_pca_against_numpy(spark, key, k):
    from ratewise.sources.standin import StandIn
    from tests.conftest import SF_SMALL

    business = StandIn(spark, SF_SMALL).part_business
    ones, index = (FE.attribute_rows if k == 5 else FE.category_rows)(business)
    rows = ones.collect()
    x = _dense([r[1] for r in rows], index.count())
    x = x - x.mean(axis=0)
    eig = np.linalg.svd(x, full_matrices=False)
    want = eig[1] ** 2 / (len(x) - 1)
    got = getattr(FE, key)(business, k).toPandas().set_index("business_id").loc[[r[0] for r in rows]].to_numpy()
    assert got.var(axis=0, ddof=1) == pytest.approx(want[:k], rel=1e-6, abs=1e-9)
    assert np.abs(got.mean(axis=0)).max() < 1e-9
    for j in range(k):  # a component is fixed up to sign where its eigenvalue stands alone
        if min(abs(want[j] - w) for i, w in enumerate(want) if i != j) > 1e-6:
            ref = x @ eig[2][j]
            assert min(np.abs(got[:, j] - ref).max(), np.abs(got[:, j] + ref).max()) < 1e-6


def test_equal_integers_are_one_column(spark):
    df = spark.createDataFrame([("a", {"n": "5"}), ("b", {"n": "05"}), ("c", {"n": "10"})], "business_id string, attributes map<string,string>")
    got = {(r.business_id, r.feature) for r in FE.one_hot_attributes(df).collect()}
    assert got == {("c", "n_10")}


def test_pipelines_beat_the_user_mean(spark):
    """Q2 and Q3 end to end with few trees, with every pair listed twice."""
    from ratewise.operators import evaluate, stats
    from ratewise.plans import feature_model, hybrid
    from ratewise.sources.standin import StandIn
    from tests.conftest import SF_SMALL

    s = StandIn(spark, SF_SMALL)
    twice = s.pairs.union(s.pairs)
    mean = s.pairs.join(stats.user_mean(s.train), "user_id", "left").select(
        "user_id", "business_id", F.coalesce("user_mean", F.lit(3.0)).alias("prediction"))
    limit = evaluate.rmse(mean, s.test).first()["rmse"]
    q2 = hybrid.hybrid_predict(s.train, twice, s.user, s.business, min_overlap=5, params=dict(trees=25, depth=3))
    q3 = feature_model.feature_model_predict(s.train, twice, s.business, s.user, s.checkin, s.tip, dict(trees=25, depth=3))
    for out in (q2, q3):
        assert out.count() == twice.count()
        assert evaluate.rmse(out.dropDuplicates(["user_id", "business_id"]), s.test).first()["rmse"] < 1.05 * limit
    row = q2.first()
    assert row.prediction == pytest.approx(0.1 * row.knn_prediction + 0.9 * row.model_prediction)
    assert q3.filter("prediction < 1 or prediction > 5 or abs(prediction - least(greatest(raw_prediction, 1), 5)) > 1e-9").count() == 0


def test_state_one_hot_drops_the_first_value(spark):
    rows = spark.createDataFrame([("r1", "AZ"), ("r2", "NV"), ("r3", None), ("r4", "PA"), ("r5", "XX")], "user_id string, business_state string")
    values = spark.createDataFrame([("PA",), ("NV",), ("AZ",), ("AZ",), (None,)], "business_state string")
    got = {r.user_id: (r.state_feature, r.state_vec.toArray().tolist()) for r in FE.state_one_hot(rows, values=values).collect()}
    assert got == {"r1": (None, [0, 0]), "r2": ("state_NV", [1, 0]), "r3": (None, [0, 0]), "r4": ("state_PA", [0, 1]),
                   "r5": (None, [0, 0])}


def test_strict_rows_and_reference_names(spark):
    from ratewise.plans import feature_model

    train = spark.createDataFrame([("u1", "b1", 4.0), ("u2", "b9", 2.0)], "user_id string, business_id string, stars double")
    u = spark.createDataFrame([("u1", 3, 1.5), ("u2", 4, 2.5)], "user_id string, user_review_count int, user_fans double")
    b = spark.createDataFrame([("b1", 70)], "business_id string, business_review_count int")
    wide = feature_model.wide_rows(train, train, u, b, strict=True, reference_names=True)
    assert {(r.user_id, r.review_count, r.fans) for r in wide.collect()} == {("u1", 70, 1.5)}
    assert feature_model.wide_rows(train, train, u, b).count() == 4


def test_wide_plan_reads_each_table_few_times(spark):
    from ratewise.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    plan = QUERIES["wide_features"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan parquet") <= 10
