"""Order of lines: the last rating stands, output follows the pairs file, header lines by whole line."""
import glob

import pytest

from ratewise.operators.stats import latest_ratings
from ratewise.plans.knn import run_knn
from ratewise.sources import readers, sinks


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _lines(out):
    return [x for f in sorted(glob.glob(f"{out}/part-*")) for x in open(f).read().splitlines()]


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400")
    yield
    spark.conf.set(key, before)


def test_the_last_line_of_a_rating_stands(spark, tmp_path, small_splits):
    lines = ["user_id,business_id,stars"] + [f"u{i % 7},b{i % 3},{(i * 7) % 5 + 1}" for i in range(200)]
    df = readers.read_ratings_csv(spark, _write(tmp_path / "r.csv", lines), ordered=True)
    assert df.rdd.getNumPartitions() > 3
    want = {}
    for x in lines[1:]:
        u, b, r = x.split(",")
        want[u, b] = float(r)
    assert {(r.user_id, r.business_id): r.stars for r in latest_ratings(df, ["line"]).collect()} == want


def test_files_of_an_input_follow_each_other_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in (2, 0, 1):
        _write(folder / f"part-{k}.csv", ["user_id,business_id,stars", f"u,b,{k + 1}"])
    df = readers.read_ratings_csv(spark, str(folder), ordered=True)
    assert latest_ratings(df, ["line"]).first()["stars"] == 3.0


def test_output_follows_the_pairs_file(spark, tmp_path, small_splits):
    train = ["user_id,business_id,stars"] + [f"u{i % 9},b{(i * 5) % 11},{i % 5 + 1}" for i in range(99)]
    pairs = [f"u{(i * 7) % 10},b{(i * 3) % 12}" for i in range(90)] + ["u1,b1", "u1,b1"]
    out = str(tmp_path / "out")
    run_knn(spark, _write(tmp_path / "t.csv", train), _write(tmp_path / "p.csv", ["user_id,business_id", *pairs]), out, min_overlap=1)
    got = [x.rsplit(",", 1)[0] for x in _lines(out) if not x.startswith("user_id")]
    assert got == pairs
    assert {x for x in _lines(out) if x.startswith("user_id")} == {"user_id, business_id, prediction"}


def test_header_by_whole_line(spark, tmp_path):
    path = _write(tmp_path / "h.csv", ["user_id,business_id,stars", "user_id,b,4", "u,b,3", "user_id,business_id,stars", "u,,2"])
    got = sorted(tuple(r) for r in readers.read_ratings_csv(spark, path, header="line").collect())
    assert got == [("u", "", 2.0), ("u", "b", 3.0), ("user_id", "b", 4.0)]
    assert sorted(tuple(r) for r in readers.read_ratings_csv(spark, path).collect()) == [("u", "", 2.0), ("u", "b", 3.0)]
    assert [tuple(r) for r in readers.read_pairs_csv(spark, path, header="line").select("user_id", "business_id").collect()][0] == ("user_id", "b")
    with pytest.raises(ValueError):
        readers.read_pairs_csv(spark, path, header="none")


def test_ordered_sink_writes_ranges(spark, tmp_path):
    df = spark.createDataFrame([(f"u{i}", "b", float(i), (i * 37) % 100) for i in range(100)], "user_id string, business_id string, prediction double, line int")
    sinks.write_predictions_csv(df, str(tmp_path / "o"), "line", files=4)
    got = [x for x in _lines(tmp_path / "o") if not x.startswith("user_id")]
    assert got == [f"u{i},b,{float(i)}" for i in sorted(range(100), key=lambda i: (i * 37) % 100)]
    assert len(glob.glob(f"{tmp_path}/o/part-*")) == 4
