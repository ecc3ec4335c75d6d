import hashlib
import random
import re

import pytest

from ratewise.llm.window_dedup import Part, repeated_words, window_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(rows, window=13):
    """[(words, removed intervals, kept)] of (doc_id, text) rows; a null id is the smallest."""
    at = [(-(1 << 63) if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in at:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in at:
        gone = {p for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < i for p in range(k, k + window)}
        spans = [(p, next(q for q in range(p, len(w) + 1) if q not in gone)) for p in sorted(gone) if p - 1 not in gone]
        out.append((len(w), spans, " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def _check(docs, rows, **sizes):
    got = sorted((r["n"], r["n_words"], [tuple(s) for s in r["removed"]], r["text"], r["n_removed"])
                 for r in repeated_words(docs, **sizes).collect())
    want = [(n, w, s, kept, sum(e - b for b, e in s)) for n, (w, s, kept) in enumerate(_brute(rows, sizes.get("window", 13)))]
    assert got == want


def _frame(spark, rows, parts=4):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n long, doc_id long, text string").repartition(parts)


def test_planted_passages_copies_and_overlaps(spark):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passages = [words(rng.choice([13, 14, 30, 60])) for _ in range(6)]
    rows = []
    for i in range(60):
        t = words(rng.choice([0, 5, 12, 40, 90]))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) - 12)
            at = rng.randrange(len(t) + 1)
            t[at:at] = p[a:]
        rows.append((i * 3 - 20, rng.choice([" ", "\n", "\t \x0b"]).join(t)))
    rows += [(500 + i, rows[7 * i][1]) for i in range(8)]
    rows.append((900, " ".join(["again"] * 40)))
    rows.append((901, " ".join(["again"] * 20 + words(3))))
    _check(_frame(spark, rows), rows)
    _check(_frame(spark, rows, 1), rows, part_bytes=300, bucket_bytes=200)


def test_nulls_short_and_repeated_rows(spark):
    text = " ".join(f"x{i}" for i in range(20))
    rows = [(None, text), (None, text), (1, text), (1, text), (2, None), (3, ""), (4, " \t\n "), (5, "one  two"),
            (6, text.upper()), (7, " ".join(f"x{i}" for i in range(12))), (8, text + " é ü " + text), (None, None)]
    _check(_frame(spark, rows), rows)


def test_a_very_long_text_and_one_word_repeated(spark):
    long = " ".join(f"v{i % 5000}" for i in range(60_000))
    rows = [(1, long), (2, "a " + long), (3, "v1 " * 13)]
    _check(_frame(spark, rows), rows)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_other_windows(spark, window):
    rows = [(3, "a b c d e f"), (1, "c d e"), (2, "x b c d y f f")]
    _check(_frame(spark, rows), rows, window=window)


def test_columns_that_clash_stay_and_empty_tables(spark):
    kind = "text string, part int, row string, kept string, n_words string, removed int, doc_id int, hashes binary"
    docs = spark.createDataFrame([("a b", 1, "r", "k", "n", 7, 3, b"h")], kind)
    r = repeated_words(docs).first()
    assert (r["part"], r["row"], r["kept"], r["doc_id"], r["n_words"], r["removed"], r["hashes"]) == (1, "r", "k", 3, 2, [], b"h")
    assert repeated_words(docs.limit(0)).count() == 0
    assert window_digest(docs.limit(0)).collect() == []


def test_parts_give_the_same_windows_in_any_order():
    import pyarrow as pa

    rows = [{"doc_id": i % 4, "text": f"a b c {i % 3} d e"} for i in range(9)]
    of = lambda r: Part(pa.table({"row": pa.array(r)}), 3, 5)
    a, b = of(rows), of(rows[::-1])
    assert [(x, k.tolist()) for x, k in a.blocks()] == [(x, k.tolist()) for x, k in b.blocks()]
    assert (a.hash == b.hash).all() and (a.first == b.first).all()


def test_digest_of_the_given_table(spark, sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()]
    want = {i: (w, sum(e - b for b, e in s), hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (w, s, kept) in zip(rows, _brute(rows))}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in window_digest(sf_docs).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def test_the_texts_are_shuffled_once(spark, sf_docs):
    df = repeated_words(sf_docs.select("doc_id", "text"))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
