"""Boosted trees against a brute-force booster, and their rules: missing values, columns, stop, lost state."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.operators import boosting, models
from ratewise.operators.boosting import Settings


def _soft(g, l1):
    return max(abs(g) - l1, 0.0) * (1 if g > 0 else -1)


def _brute_tree(x, g, s, columns, rows=None, depth=0):
    """Nested tuples (feature, threshold, missing left, left, right) or a leaf value, by trying every
    threshold between distinct values of every column, missing values on either side."""
    rows = list(range(len(x))) if rows is None else rows
    score = lambda r: _soft(sum(g[i] for i in r), s.l1) ** 2 / (len(r) + s.l2)
    leaf = -s.rate * _soft(sum(g[i] for i in rows), s.l1) / (len(rows) + s.l2)
    best = (1e-6, None)
    for c in columns if depth < s.depth else ():
        known = sorted({x[i][c] for i in rows if x[i][c] is not None})
        # a cut of the whole table that no row of this node lies across is the same split
        for side in (False, True):
            for v in known:
                left = [i for i in rows if (x[i][c] is None and side) or (x[i][c] is not None and x[i][c] <= v)]
                right = [i for i in rows if i not in set(left)]
                if min(len(left), len(right)) < max(1, s.min_rows):
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, (c, v, side, left, right))
    if best[1] is None:
        return leaf
    c, v, side, left, right = best[1]
    return (c, v, side, _brute_tree(x, g, s, columns, left, depth + 1), _brute_tree(x, g, s, columns, right, depth + 1))


def _walk(tree, row):
    while isinstance(tree, tuple):
        c, v, side, left, right = tree
        tree = left if (side if row[c] is None else row[c] <= v) else right
    return tree


def _frame(spark, x, y, parts=3):
    names = [f"f{j}" for j in range(len(x[0]))]
    rows = [(i, *r, t) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names) + ", label double").repartition(parts), names


def _predictions(model, df):
    return [r["prediction"] for r in model.transform(df).orderBy("id").collect()]


@pytest.mark.parametrize("settings", [
    Settings(trees=1, depth=3, rate=1.0, min_rows=4, l1=0.5, l2=0.5, base=0.0),
    Settings(trees=1, depth=4, rate=0.3, min_rows=1, l1=2.0, l2=1.0),
    Settings(trees=3, depth=2, rate=0.5, min_rows=10, l1=0.0, l2=0.0)])
def test_same_splits_and_leaves_as_brute_force(spark, settings):
    rng = random.Random(8)
    x = [[rng.choice([None, *range(8)]) if j else rng.randrange(30) for j in range(3)] for _ in range(200)]
    x = [[None if v is None else float(v) for v in r] for r in x]
    y = [rng.gauss(0, 1) + (r[0] > 12) * 2 - (r[1] is None) + (r[2] or 0) / 4 for r in x]
    df, names = _frame(spark, x, y)
    model = boosting.fit(df, names, "label", settings)
    at = [settings.base] * len(x)
    for _ in range(settings.trees):
        tree = _brute_tree(x, [a - t for a, t in zip(at, y)], settings, range(3))
        at = [a + _walk(tree, r) for a, r in zip(at, x)]
    assert _predictions(model, df) == pytest.approx(at, abs=1e-5)
    assert model.rmse[-1] == pytest.approx(np.sqrt(np.mean((np.array(at) - y) ** 2)), abs=1e-5)


def test_missing_values_that_carry_the_label(spark):
    x = [[None if i % 3 == 0 else float(i % 7), float(i % 5)] for i in range(300)]
    y = [4.0 if r[0] is None else 1.0 for r in x]
    df, names = _frame(spark, x, y)
    model = boosting.fit(df, names, "label", Settings(trees=1, depth=1, rate=1.0, l2=0.0, base=0.0))
    assert _predictions(model, df) == pytest.approx(y)
    nan = df.withColumn("f0", F.coalesce("f0", F.lit(float("nan"))))
    assert _predictions(model, nan) == pytest.approx(y)


def test_blocks_partitions_and_exchange_do_not_change_the_model(spark, monkeypatch):
    rng = random.Random(3)
    x = [[rng.random(), rng.choice([None, 1.0, 2.0]), rng.gauss(0, 5)] for _ in range(3000)]
    df, names = _frame(spark, x, [float(rng.randint(1, 5)) for _ in x])
    s = Settings(trees=4, depth=4, columns=0.7, l1=0.5, l2=0.5, min_rows=4, max_bins=16)
    want = _predictions(boosting.fit(df.coalesce(1), names, "label", s), df)
    assert want == _predictions(boosting.fit(df.orderBy("f0"), names, "label", s, block_rows=500), df)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)  # histograms are added up by the executors
    monkeypatch.setattr(boosting, "PIECE", 64)
    assert want == _predictions(boosting.fit(df.repartition(5), names, "label", s, block_rows=700), df)


def test_a_worker_without_state_catches_up(spark, monkeypatch):
    """Nothing is kept between passes: each one computes the predictions from the trees."""
    rng = random.Random(5)
    x = [[rng.random(), rng.random()] for _ in range(900)]
    df, names = _frame(spark, x, [r[0] * 3 + rng.random() for r in x])
    s = Settings(trees=23, depth=3, rate=0.3)
    want = _predictions(boosting.fit(df, names, "label", s, block_rows=300), df)
    b = boosting.Block("k", boosting.to_bins(np.array(x), [np.array([0.5])] * 2), np.zeros(900))
    tree = boosting.Tree.leaf(1)
    tree.feature[0], tree.cut[0], tree.value[1:] = 0, 0, (1.0, 2.0)
    missing = boosting.missing_bins([np.array([0.5])] * 2)
    kept = boosting._advance(b, [tree], s, missing, None, 0)[0]
    b.state = {}
    assert (boosting._advance(b, [tree], s, missing, None, 0)[0] == kept).all()
    twice = boosting._advance(b, [tree, tree], s, missing, None, 0)[0]
    b.state = {}
    assert (boosting._advance(b, [tree, tree], s, missing, None, 0)[0] == twice).all()
    assert want == _predictions(boosting.fit(df, names, "label", s, block_rows=450), df)


def test_stop_rule_keeps_the_best_round(spark):
    """With a leaf penalty above all residuals no tree gains anything, so it stops after the sixth round
    without gain and the first round stays."""
    df, names = _frame(spark, [[float(i)] for i in range(50)], [0.5] * 50)
    model = boosting.fit(df, names, "label", Settings(trees=40, stop_rounds=6))
    assert model.n_trees == 1 and len(model.rmse) == 7
    rng = random.Random(1)
    df, names = _frame(spark, [[rng.random()] for _ in range(200)], [rng.random() for _ in range(200)])
    model = boosting.fit(df, names, "label", Settings(trees=12, depth=2, stop_rounds=6))
    assert model.n_trees == 12 and model.rmse == sorted(model.rmse, reverse=True)


def test_a_tree_uses_its_draw_of_columns_only(spark):
    rng = random.Random(2)
    x = [[rng.random() for _ in range(10)] for _ in range(400)]
    df, names = _frame(spark, x, [sum(r) for r in x])
    model = boosting.fit(df, names, "label", Settings(trees=6, depth=4, columns=0.2))
    used = [set(t.feature[t.feature >= 0].tolist()) for t in model.trees]
    assert all(1 <= len(u) <= 2 for u in used) and len(set().union(*used)) > 2


def test_cut_points_follow_distinct_values_or_quantiles():
    x = np.array([[1.0, np.nan, k] for k in range(1000)])
    one, none, many = boosting.cut_points(x, 8)
    assert len(one) == 0 and len(none) == 0 and len(many) == 7
    bins = boosting.to_bins(x, [one, none, many])
    assert (bins[1] == 1).all() and np.bincount(bins[2]).min() >= 120
    assert boosting.missing_bins([one, none, many]).tolist() == [1, 1, 8]


def test_empty_tables_null_labels_and_vector_columns(spark):
    from pyspark.ml.feature import VectorAssembler

    df, names = _frame(spark, [[1.0, 2.0], [2.0, 1.0], [3.0, None]] * 5, [1.0, 2.0, None] * 5)
    model = boosting.fit(df, names, "label", Settings(trees=2, depth=1, rate=1.0, l2=0.0))
    assert _predictions(model, df)[:2] == pytest.approx([1.0, 2.0])
    empty = boosting.fit(df.limit(0), names, "label", Settings(base=2.5))
    assert empty.n_trees == 0 and set(_predictions(empty, df)) == {2.5}
    v = VectorAssembler(inputCols=["f0"], outputCol="v").transform(df)
    same = boosting.fit(v, ["v", "f1"], "label", Settings(trees=2, depth=1, rate=1.0, l2=0.0))
    assert _predictions(same, v) == _predictions(model, df)


def test_beats_the_mean_on_a_planted_signal(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.random()) for i in range(500)]
    df = spark.createDataFrame([(*r, 2 * r[1] - r[2] + rng.gauss(0, 0.1)) for r in rows], "id long, x1 double, x2 double, label double")
    model = models.fit_trees(df, ["x1", "x2"], trees=40, depth=3, rate=0.3)
    rmse = model.transform(df).select(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))).first()[0]
    assert rmse < 0.5 * df.select(F.stddev_pop("label")).first()[0]
    assert rmse == pytest.approx(model.rmse[model.n_trees - 1], abs=1e-5)


def test_a_table_of_one_block_takes_a_job_for_several_trees(spark):
    """More rows than a block once had; a job a level would be 24 jobs."""
    df = spark.range(140_000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)) / 7.0).alias(f"f{k}") for k in range(2)])
    df = df.withColumn("label", F.col("f0") - F.col("f1") * F.col("f0"))
    sc = spark.sparkContext
    sc.setJobGroup("alone", "fit")
    try:
        model = boosting.fit(df, ["f0", "f1"], "label", Settings(trees=6, depth=4))
        jobs = len(sc.statusTracker().getJobIdsForGroup("alone"))
    finally:
        sc._jsc.clearJobGroup()
    assert model.n_trees == 6 and model.rmse[-1] < model.rmse[0] and jobs < 12


def test_groups_of_features_do_not_change_the_model(spark):
    rng = random.Random(11)
    users, items = ([[rng.choice([None, 1.0, 2.0, 3.0]), rng.random(), float(rng.randint(0, 1))] for _ in range(n)] for n in (60, 25))
    x = [[*rng.choice(users), *rng.choice(items)] for _ in range(2500)]
    df, names = _frame(spark, x, [float(rng.randint(1, 5)) for _ in x])
    s = Settings(trees=13, depth=5, columns=0.7, l1=0.5, l2=0.5, min_rows=4)
    want = _predictions(boosting.fit(df, names, "label", s), df)
    assert want == _predictions(boosting.fit(df, names, "label", s, groups=[names[:3]]), df)
    assert want == _predictions(boosting.fit(df, names, "label", s, block_rows=400, groups=[names[:3], names[3:]]), df)


def test_level_passes_move_no_rows_and_survive_lost_files(spark, monkeypatch):
    """Tasks find the rows in the executor's folder; when it is gone they get them, and all trees, again."""
    import glob
    import os
    import shutil

    rng = random.Random(7)
    x = [[rng.random(), rng.choice([None, 1.0, 2.0])] for _ in range(1200)]
    df, names = _frame(spark, x, [r[0] * 3 + (r[1] or 0) for r in x])
    s = Settings(trees=14, depth=3)
    want = _predictions(boosting.fit(df, names, "label", s), df)
    calls, shelve, level = [], boosting._Passes.shelve, boosting._level
    monkeypatch.setattr(boosting._Passes, "shelve", lambda self: calls.append(1) or shelve(self))
    assert want == _predictions(boosting.fit(df, names, "label", s, block_rows=300), df) and len(calls) == 1
    local = spark.sparkContext.parallelize([0], 1).map(lambda _: os.environ["SPARK_LOCAL_DIRS"].split(",")[0]).first()
    assert not glob.glob(f"{local}/python/boosting-*")  # a fit leaves none
    passes = []

    def lost(*a):
        passes.append(1)
        if len(passes) in (5, 38):
            found = glob.glob(f"{local}/python/boosting-*")
            assert found
            for f in found:
                shutil.rmtree(f)
        return level(*a)

    monkeypatch.setattr(boosting, "_level", lost)
    assert want == _predictions(boosting.fit(df, names, "label", s, block_rows=300), df) and len(calls) == 4


def test_sums_beyond_the_integers_that_doubles_hold():
    bins = boosting.Grouped.dense(np.zeros((1, 3), np.uint8))
    residual = np.array([2.0 ** 53, 1.0, 1.0])
    out = boosting.histogram(bins, residual, np.zeros(3, np.int16), 1, boosting.Cells(np.array([0]), np.array([1], np.uint8)))
    assert out[0, 0].tolist() == [2 ** 53 + 2, 3]
