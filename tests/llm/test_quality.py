import random
import zlib

from ratewise.llm.quality import fit_quality, held_out, keep_good, quality_digest, score_quality

LABELS = "doc_id long, quality int, toxic int"


def _corpus(n=300):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "river", "walked", "home", "quiet", "morning", "letter"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 120)))
    bad = lambda: " ".join("".join(rng.choice("#$%&!") for _ in range(3)) + rng.choice(["BUY", "NOW", "|"]) for _ in range(rng.randint(5, 120)))
    y = [int(rng.random() < 0.7) for _ in range(n)]
    return [(i, good() if v else bad()) for i, v in enumerate(y)], y


def test_held_out_accuracy(spark, make_docs):
    rows, y = _corpus()
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    got = {r["doc_id"]: r for r in quality_digest(make_docs(rows), labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i in got if got[i]["held_out"])
    assert sum(got[i]["predicted"] == y[i] for i in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    kept = {r["doc_id"] for r in keep_good(make_docs(rows), labels).collect()}
    assert kept == {i for i in got if got[i]["predicted"]}


def test_held_out_labels_and_other_columns_do_not_matter(spark, make_docs):
    rows, y = _corpus(120)
    flip = lambda i, v: 1 - v if zlib.crc32(str(i).encode()) % 5 == 0 else v
    a = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    b = spark.createDataFrame([(i, flip(i, v), 1) for i, v in enumerate(y)], LABELS)
    docs = make_docs(rows)
    assert sorted(quality_digest(docs, a).collect()) == sorted(quality_digest(docs.repartition(7), b).collect())


def test_odd_tables(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, 0)], LABELS)
    rows = [(1, None), (1, None), (2, ""), (None, "x"), (4, "long " * 50000)]
    assert {r["score"] for r in quality_digest(make_docs(rows), none).collect()} == {0.5}
    assert {r["score"] for r in quality_digest(make_docs(rows), one).collect()} == {1.0}
    assert quality_digest(make_docs([]), none).count() == 0
    full, y = _corpus(60)
    model = fit_quality(make_docs(full), spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS))
    got = score_quality(make_docs(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["quality_score"] <= 1 for r in got)
    assert not make_docs(rows).where(held_out("doc_id")).where("doc_id is null").count()


def test_long_texts_keep_their_signal(spark, make_docs):
    rows, y = _corpus()
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    model = fit_quality(make_docs(rows), labels)
    rng = random.Random(5)
    long = []
    for kb in (2, 20, 50, 100, 300):
        for v in (0, 1):
            pool, text = [t for i, t in rows if y[i] == v], ""
            while len(text) < kb << 10:
                text += rng.choice(pool) + "\n"
            long.append((kb * 10 + v, text))
    got = {r["doc_id"]: r["quality_score"] for r in score_quality(make_docs(long), model).collect()}
    assert all((s >= 0.3) == (i % 10 == 1) for i, s in got.items()), got


def test_curve_is_fitted_on_whole_texts(spark, make_docs):
    rows, y = _corpus()
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    a, b = (fit_quality(make_docs([(i, ("same start " * 2000)[:16384] + t + end) for i, t in rows]), labels) for end in ("", " tail" * 900))
    assert not (a.mean == b.mean).all()


def test_dictionaries_learn_from_whole_texts(spark, make_docs):
    """Texts that differ only behind their first 16 KB are told apart."""
    rows, y = _corpus(120)
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    start = ("the same start of every text " * 600)[:16384]
    docs = make_docs([(i, start + " " + (t + " ") * (60_000 // len(t))) for i, t in rows])
    got = {r["doc_id"]: r for r in quality_digest(docs, labels).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == y[i] for i in held) / len(held) > 0.95


def test_a_score_column_of_the_input_stays(spark, make_docs):
    rows, y = _corpus(80)
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], LABELS)
    docs = make_docs(rows).selectExpr("*", "'own' as quality_score", "doc_id as quality_score_")
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["quality_score"] for r in kept.collect()} == {"own"}
    scored = score_quality(docs, fit_quality(docs, labels))
    assert scored.columns.count("quality_score") == 1 and dict(scored.dtypes)["quality_score"] == "double"


def test_held_out_labels_of_the_given_table(spark):
    from tests.conftest import SF_ORACLE

    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = [r for r in quality_digest(docs, labels).collect() if r["held_out"] and r["doc_id"] in y]
    good, bad = ([r["predicted"] for r in got if y[r["doc_id"]] == v] for v in (1, 0))
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad), (sum(good), len(good), sum(bad), len(bad))
