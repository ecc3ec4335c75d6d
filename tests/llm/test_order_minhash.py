import hashlib
import random

from pyspark.sql import functions as F

from ratewise.llm.order_minhash import edited_fingerprints, fingerprint_digest, likeness, with_fingerprint


def _digest(df):
    return {r["doc_id"]: r for r in fingerprint_digest(df).collect()}


def test_edited_texts_against_brute_force(spark, sf_docs):
    rows = sorted((r["doc_id"], r["text"] or "") for r in sf_docs.select("doc_id", "text").collect())
    got = _digest(sf_docs)
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        nxt, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["n_chars"] == len(t)
    ordered = [got[d] for d, _ in rows]
    long = [r for r in ordered if r["n_chars"] > 300]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.08 > sum(r["near_next"] for r in long) / len(long)
    assert all(0 <= r[c] <= 1 for r in ordered for c in ("near_edited", "near_next"))


def test_small_and_odd_tables(make_docs):
    assert _digest(make_docs([])) == {}
    one = _digest(make_docs([(5, "a b c d e f g h")]))[5]
    assert one["near_next"] == 1.0  # the next document of a single one is itself
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "word"), (5, "word"), (None, "no id"), (6, "ÀÉ 😀 " * 400), (7, "same line again\n" * 300)]
    got = _digest(make_docs(rows))
    assert len(got) == len(rows)
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == got[3]["fingerprint"]
    assert got[4]["fingerprint"] == got[5]["fingerprint"] and got[4]["near_next"] == 1.0
    assert got[6]["n_chars"] == 2000


def test_repeats_of_a_kmer_are_numbered_and_order_counts(spark, make_docs):
    base = " ".join(f"w{i}" for i in range(200))
    back = " ".join(f"w{i}" for i in [*range(100, 200), *range(100)])
    rows = [(1, base), (2, back), (3, "a b c d e " * 4), (4, "a b c d e " * 40), (5, base + " end")]
    f = {r["doc_id"]: r["f"] for r in with_fingerprint(make_docs(rows), "text", "f").collect()}
    like = lambda a, b: spark.range(1).select(likeness(F.lit(f[a]), F.lit(f[b])).alias("x")).first()["x"]
    assert like(1, 5) > 0.9
    assert like(1, 2) < like(1, 5)  # the same words in another order
    assert f[3] != f[4] and like(3, 4) < 0.9


def test_native_plan(make_docs):
    plan = edited_fingerprints(make_docs([(1, "a"), (2, "b")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def _permuted(rng, a, b, k=5, bins=64, pick=2):
    """Likeness of Order MinHash with a permutation of its own for each register."""
    grams = [[tuple(t[i:i + k]) for i in range(len(t) - k + 1)] for t in (a, b)]
    same = 0
    for _ in range(bins):
        rank = {g: rng.random() for g in {*grams[0], *grams[1]}}
        x, y = ([g for g in t if g in set(sorted(t, key=rank.get)[:pick])] for t in grams)
        same += x == y
    return same / bins


def test_short_texts_follow_the_order(spark, make_docs):
    rng = random.Random(4)
    for n in (8, 40, 60, 100):
        pairs = []
        for i in range(60):
            a = [f"n{n}x{i}y{j}" for j in range(n)]
            pairs.append((a, [w for q in (3, 2, 1, 0) for w in a[q * n // 4:(q + 1) * n // 4]]))
        rows = [(2 * i + s, " ".join(p[s])) for i, p in enumerate(pairs) for s in (0, 1)]
        f = with_fingerprint(make_docs(rows), "text", "f").select("doc_id", "f")
        b = f.select((F.col("doc_id") - 1).alias("doc_id"), F.col("f").alias("g"))
        got = f.join(b, "doc_id").where("doc_id % 2 = 0").agg(F.avg(likeness(F.col("f"), F.col("g")))).first()[0]
        want = sum(_permuted(rng, *p) for p in pairs) / len(pairs)
        print(n, got, want)
        assert abs(got - want) < 0.05, (n, got, want)


def test_every_register_of_a_text_with_words_is_filled(make_docs):
    rows = [(1, "one"), (2, "a b c d e f"), (3, " ".join(f"w{i}" for i in range(30))), (4, "")]
    f = {r["doc_id"]: r["f"].split(":") for r in with_fingerprint(make_docs(rows), "text", "f").collect()}
    assert all(len(x) == 64 for x in f.values())
    assert all(len(v) == 8 for i in (1, 2, 3) for v in f[i]) and set(f[4]) == {""}
    assert len(set(f[1])) == len(set(f[2])) == 1 < len(set(f[3]))
