"""Scalar expressions on hand-written edge tables (FIXTURES.md: scalar_edge, attr_edge, pred_edge)."""
import math

from pyspark.sql import functions as F

from ratewise.functions import scalars as S


def test_token_count_max_token(spark):
    rows = [("a", None), ("b", "None"), ("c", ""), ("d", "2012, 2015"), ("e", "2012,2015")]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r.k: (r.n, r.m) for r in df.select("k", S.token_count("v").alias("n"),
                                               S.max_token("v").alias("m")).collect()}
    assert got["a"] == (0, 0)
    assert got["b"] == (0, 0)
    assert got["c"][0] == 1 and got["c"][1] is None      # one empty piece, not an int
    assert got["d"] == (2, 2012)                         # " 2015" sorts below "2012"
    assert got["e"] == (2, 2015)


def test_days_since(spark):
    df = spark.createDataFrame([("2021-03-09",), ("2020-03-10",), ("bad",), (None,)], "d string")
    got = [r[0] for r in df.select(S.days_since("d")).collect()]
    assert got == [1, 365, None, None]


def test_flatten_nested_map(spark):
    # map literals keep entry order (as the JSON reader does); later keys must win
    df = spark.sql("""
        SELECT * FROM VALUES
          ('null', CAST(NULL AS MAP<STRING,STRING>)),
          ('empty', map()),
          ('nested', map('parking', "{'garage': False, 'street': True}", 'stars', '4')),
          ('collide', map('garage', 'x', 'parking', "{'garage': True}")),
          ('collide_rev', map('parking', "{'garage': True}", 'garage', 'x')),
          ('digits', map('a', '05', 'b', '5', 'c', '0', 'd', '000', 'e', '0x1', 'f', "{'g': 007}")),
          ('three', map('n', "{'x': a: b, 'y'}"))
        AS t(k, m)""")
    got = {r.k: r.f for r in df.select("k", S.flatten_nested_map("m").alias("f")).collect()}
    assert got["null"] == {}
    assert got["empty"] == {}
    assert got["nested"] == {"garage": "False", " street": "True", "stars": "4"}
    assert got["collide"] == {"garage": "True"}
    assert got["collide_rev"] == {"garage": "x"}
    assert got["digits"] == {"a": "5", "b": "5", "c": "0", "d": "0", "e": "0x1", "g": "7"}
    assert got["three"] == {"x": "a", " y": None}


def test_map_size_and_checkin(spark):
    df = spark.createDataFrame([("a", None), ("b", {}), ("c", {"x": 2, "y": 4})],
                               "k string, m map<string,int>")
    got = {r.k: (r.n, r.s, r.a) for r in df.select(
        "k", S.map_size("m").alias("n"), S.map_value_sum("m").alias("s"),
        S.map_value_mean("m").alias("a")).collect()}
    assert got["a"] == (0, None, None)
    assert got["b"] == (0, 0, None)
    assert got["c"] == (2, 6, 3.0)


def test_guard_and_clip(spark):
    vals = [float("nan"), float("inf"), float("-inf"), 0.0, 0.2, 3.3, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    out = df.select(S.guard_prediction("p").alias("g"), S.clip_prediction("p").alias("c")).collect()
    assert [r.g for r in out] == [3.0, 3.0, 3.0, 3.0, 0.2, 3.3, 7.0]
    clipped = [r.c for r in out]
    assert math.isnan(clipped[0])
    assert clipped[1:] == [5.0, 1.0, 1.0, 1.0, 3.3, 5.0]


def test_blend(spark):
    df = spark.createDataFrame([(4.0, 2.0)], "k double, m double")
    assert df.select(S.blend("k", "m")).first()[0] == 0.1 * 4.0 + 0.9 * 2.0


def test_error_histogram_edges(spark):
    from ratewise.operators import evaluate

    errs = [0.0, 0.999, 1.0, 2.0, 3.0, 4.0, 5.0]
    pred = spark.createDataFrame([("u", str(i), 1.0 + e) for i, e in enumerate(errs)],
                                 "user_id string, business_id string, prediction double")
    labels = spark.createDataFrame([("u", str(i), 1.0) for i in range(len(errs))],
                                   "user_id string, business_id string, label double")
    got = {r.bucket: r.n for r in evaluate.error_histogram(pred, labels).collect()}
    assert got == {">=0 and <1": 2, ">=1 and <2": 1, ">=2 and <3": 1, ">=3 and <4": 1, ">=4": 2}
    r = evaluate.rmse(pred, labels).first()
    assert r.n == 7
    assert abs(r.rmse - math.sqrt(sum(e * e for e in errs) / 7)) < 1e-12
