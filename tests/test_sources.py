"""Readers and sinks: CSV and JSON-lines round trips with explicit schemas."""
import os
import tempfile

import pytest

from ratewise.sources import readers, sinks


def test_ratings_csv_with_repeated_header(spark):
    d = tempfile.mkdtemp(prefix="rw-src-")
    p = os.path.join(d, "r.csv")
    with open(p, "w") as f:
        f.write("user_id,business_id,stars\nu1,b1,4.0\nuser_id,business_id,stars\nu2,b2,3.5\n")
    rows = sorted(tuple(r) for r in readers.read_ratings_csv(spark, p).collect())
    assert rows == [("u1", "b1", 4.0), ("u2", "b2", 3.5)]
    pairs = sorted(tuple(r) for r in readers.read_pairs_csv(spark, p).collect())
    assert pairs == [("u1", "b1"), ("u2", "b2")]


def test_empty_ids_stay_and_bad_numbers_fail(spark):
    d = tempfile.mkdtemp(prefix="rw-src-")
    good, bad, empty = (os.path.join(d, x) for x in ("good.csv", "bad.csv", "empty.csv"))
    with open(good, "w") as f:
        f.write("user_id,business_id,stars\n,b1,4.0\nu1,,2\nu2,b2, 3.5\n")
    rows = sorted(tuple(r) for r in readers.read_ratings_csv(spark, good, min_partitions=4).collect())
    assert rows == [("", "b1", 4.0), ("u1", "", 2.0), ("u2", "b2", 3.5)]
    assert sorted(tuple(r) for r in readers.read_pairs_csv(spark, good).collect()) == [("", "b1"), ("u1", ""), ("u2", "b2")]
    for path, value in ((bad, "four"), (empty, "")):
        with open(path, "w") as f:
            f.write(f"user_id,business_id,stars\nu1,b1,4.0\nu2,b1,{value}\n")
        with pytest.raises(Exception, match="not a number"):
            readers.read_ratings_csv(spark, path).collect()


def test_split_hint_needs_no_shuffle(spark):
    d = tempfile.mkdtemp(prefix="rw-src-")
    spark.range(200000).selectExpr("id user_id", "id business_id", "1.0 stars").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{d}/r")
    plain = readers.read_ratings_csv(spark, f"{d}/r")
    assert plain.rdd.getNumPartitions() < 7
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")  # the least size of a split
    try:
        split = readers.read_ratings_csv(spark, f"{d}/r", min_partitions=7)
        assert split.rdd.getNumPartitions() >= 7 and split.count() == 200000
        assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_jobs(spark):
    """Q1, Q2 and Q3 from written files to prediction files."""
    from ratewise.plans.knn import run_feature_model, run_hybrid, run_knn
    from ratewise.sources.standin import StandIn
    from tests.conftest import SF_SMALL

    s, d = StandIn(spark, SF_SMALL), tempfile.mkdtemp(prefix="rw-jobs-")
    s.train.write.option("header", True).csv(f"{d}/train")
    s.test.write.option("header", True).csv(f"{d}/pairs")
    for name in ("business", "user", "checkin", "tip"):
        getattr(s, name).write.json(f"{d}/{name}")
    few = dict(trees=2, depth=2)
    run_knn(spark, f"{d}/train", f"{d}/pairs", f"{d}/q1", min_overlap=5)
    run_hybrid(spark, f"{d}/train", f"{d}/user", f"{d}/business", f"{d}/pairs", f"{d}/q2", min_overlap=5, params=few)
    run_feature_model(spark, f"{d}/train", f"{d}/business", f"{d}/user", f"{d}/checkin", f"{d}/tip", f"{d}/pairs", f"{d}/q3", few)
    for q in ("q1", "q2", "q3"):
        assert spark.read.option("header", True).csv(f"{d}/{q}").count() == s.pairs.count()


def test_business_json_nested_fields(spark):
    d = tempfile.mkdtemp(prefix="rw-src-")
    p = os.path.join(d, "b.json")
    with open(p, "w") as f:
        f.write('{"business_id": "b1", "stars": 4.5, "review_count": 3, "is_open": 1, "state": "AZ",'
                ' "categories": "Food, Bars", "attributes": {"parking": "{\'garage\': False}"},'
                ' "hours": null, "latitude": 1.0, "longitude": 2.0, "ignored": [1, 2]}\n')
    r = readers.read_business_json(spark, p).first()
    assert r.business_id == "b1" and r.attributes == {"parking": "{'garage': False}"} and r.hours is None


def test_loose_and_standard_headers(spark):
    # a one-row fixture in one partition, so each sink writes exactly one part file
    df = spark.createDataFrame([("u1", "b1", 3.25)], "user_id string, business_id string, "
                               "prediction double").coalesce(1)
    d = tempfile.mkdtemp(prefix="rw-sink-")
    sinks.write_predictions_csv_loose(df, os.path.join(d, "loose"))
    sinks.write_predictions_csv(df, os.path.join(d, "std"))

    def header(sub):
        part = [f for f in os.listdir(os.path.join(d, sub)) if f.startswith("part-")][0]
        with open(os.path.join(d, sub, part)) as f:
            return f.read().splitlines()

    assert header("loose") == ["user_id, business_id, prediction", "u1,b1,3.25"]
    assert header("std") == ["user_id,business_id,prediction", "u1,b1,3.25"]


def test_compact_rating_tables_are_the_same_rows(spark):
    from tests.conftest import SF_SMALL
    from ratewise.sources.standin import StandIn

    plain, compact = StandIn(spark, SF_SMALL), StandIn(spark, SF_SMALL, compact=True)
    for name in ("train", "test"):
        a, b = getattr(plain, name), getattr(compact, name)
        assert a.schema == b.schema and a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and b.count() > 0
        assert "ratewise-" in b.inputFiles()[0] and not a.inputFiles()
