import numpy as np
import pytest

from ratewise.llm.vector_codes import CoverTree, code_digest, codebooks_digest, square_distances, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(ids, x, entries=256, rounds=4, parts=4):
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, x[i].tolist()))[:entries]
    m = x.shape[1] // parts
    cut = [x[:, p * m:(p + 1) * m] for p in range(parts)]
    books = [c[order].copy() for c in cut]
    far = lambda p: ((cut[p][:, None] - books[p][None]) ** 2).sum(2)
    for _ in range(rounds):
        for p in range(parts):
            near = far(p).argmin(1)
            for k in range(len(order)):
                if (near == k).any():
                    books[p][k] = cut[p][near == k].sum(0) // (near == k).sum()
    d = [far(p) for p in range(parts)]
    codes = ["".join(f"{k:02x}" for k in row) for row in zip(*(a.argmin(1).tolist() for a in d))]
    return codes, sum(a.min(1) for a in d), books


def _compare(spark, rows, x, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found, books = vector_codes(df, **sizes)
    codes, errors, want = _brute([r[0] for r in rows], x, sizes.get("entries", 256), sizes.get("rounds", 4))
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in found.collect())
    assert got == sorted((r[0] is None, r[0] or 0, c, int(e)) for r, c, e in zip(rows, codes, errors))
    assert codebooks_digest(books) == codebooks_digest(want)


def test_clusters_ties_and_repeats_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-40, 40, (9, 8))
    x = np.concatenate([centres[rng.integers(0, 9, 300)] + rng.integers(-2, 3, (300, 8)), centres[:3].repeat(40, 0), np.zeros((9, 8), int)])
    rows = [(int(rng.integers(0, 500)) if i % 50 else None, (v / 1024).tolist(), i % 3) for i, v in enumerate(x)]
    _compare(spark, rows, x, entries=16, block=64)
    _compare(spark, rows, x, entries=7, rounds=1, block=1000)
    _compare(spark, rows, x, entries=256)


def test_subtrees_are_assigned_whole():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.integers(-3, 4, (400, 4)) for c in ([0] * 4, [900] * 4, [-900, 900, 0, 0])])
    tree = CoverTree.build(x)
    ranges, _, single = tree.assign(np.array([[0] * 4, [900] * 4, [-900, 900, 0, 0], [5000] * 4]))
    assert len(ranges) <= 6 and len(single) == 0
    assert sorted(tree.place.tolist()) == list(range(len(x)))
    count, total = tree.sums(np.array([[0] * 4, [900] * 4]))
    near = square_distances(x, np.array([[0] * 4, [900] * 4])).argmin(1)
    assert count.tolist() == [(near == k).sum() for k in (0, 1)] and (total == [x[near == k].sum(0) for k in (0, 1)]).all()


def test_tree_holds_its_points_within_the_radius():
    x = np.random.default_rng(2).integers(-100, 100, (500, 3))
    t = CoverTree.unpacked(CoverTree.build(x).packed())
    assert (t.points == x[t.place]).all()
    for (start, end, child, n), r in zip(t.nodes, t.radius):
        d = np.sqrt(square_distances(t.points[start:end], t.points[start:start + 1]).astype(float)).max()
        assert abs(d - r) < 1e-6
        if n:
            kids = t.nodes[child:child + n]
            assert kids[0, 0] == start and kids[-1, 1] == end and (kids[1:, 0] == kids[:-1, 1]).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], None), (5, [], None), (6, [-0.0001], None),
            (7, [0.5, -0.5, 1.0, 2.0, 3e38], 2), (8, [0.0, 0.0, 0.0, -0.001, -1e30], 2)]
    x = np.zeros((4, 8), np.int64)
    x[1, 0] = -1
    x[2, :5] = [512, -512, 1024, 2048, 1 << 24]
    x[3, 3:5] = [-2, -(1 << 24)]
    df = spark.createDataFrame(rows, SCHEMA)
    found, books = vector_codes(df, entries=2)
    codes, errors, want = _brute([5, 6, 7, 8], x, 2)
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in found.collect()) == list(zip([5, 6, 7, 8], codes, errors.tolist()))
    assert codebooks_digest(books) == codebooks_digest(want)
    d = {r["vec_id"]: r for r in code_digest(df).collect()}
    assert d[5]["label_error"] == d[5]["error"] + d[6]["error"] and d[7]["label_error"] == d[7]["error"] + d[8]["error"]


def test_empty_tables_and_other_columns(spark):
    assert code_digest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert code_digest(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, [1.0], "c", 2.5, "r", 4, b"b")],
                               "vec_id long, embedding array<double>, code string, error double, row string, v int, trees binary")
    r = vector_codes(df)[0].first()
    assert (r["row"], r["v"], r["trees"], r["code"], r["error"]) == ("r", 4, b"b", "00000000", 0)
    with pytest.raises(ValueError):
        vector_codes(df, entries=257)


def test_the_given_table(spark):
    from tests.conftest import SF_SMALL

    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = df.collect()
    x = np.floor(np.array([r["embedding"] for r in rows], float) * 1024).astype(np.int64)
    codes, errors, books = _brute([r["vec_id"] for r in rows], x)
    by_label = {}
    for r, e in zip(rows, errors.tolist()):
        by_label[r["label"]] = by_label.get(r["label"], 0) + e
    want = {r["vec_id"]: (c, e, by_label[r["label"]], codebooks_digest(books)) for r, c, e in zip(rows, codes, errors.tolist())}
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in code_digest(df).collect()} == want
