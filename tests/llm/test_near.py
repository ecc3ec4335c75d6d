import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewise.llm.bag_minhash import across_components, keep_one, near_classes, shingles, signatures, similarity
from ratewise.llm.common import components
from ratewise.llm.wordhash import hash_words


def bag(t, k=5):
    w = (t or "").lower().split()
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def jaccard(a, b):
    a, b = bag(a), bag(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute_classes(rows, threshold=0.8):
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (d, t), (e, u) in combinations(rows, 2):
        if (t or "") == (u or "") or jaccard(t, u) >= threshold:
            a, b = sorted((root(d), root(e)))
            parent[b] = a
    return {d: root(d) for d in parent}


def family(rng, n, size=60, edits=2):
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = f"z{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_classes_against_brute_force(make_docs, sf_docs):
    rng = random.Random(5)
    texts = [x for _ in range(8) for x in family(rng, 6, rng.randint(20, 90), 3)]
    texts += [None, "", " ", "", "one", "one", "two words", "a b c d", "a b c d e", "the same line " * 50, "the same line " * 49, "x " * 30000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_classes(make_docs(rows)).collect()}
    assert got == brute_classes(sorted(rows))
    sf = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    assert {r["doc_id"]: r["class_id"] for r in near_classes(sf_docs).collect()} == brute_classes(sf)


def test_large_family_of_near_copies(make_docs):
    rng = random.Random(11)
    rows = list(enumerate(family(rng, 400, 60, 8)))  # many of which only reach the class through others
    got = {r["doc_id"]: r["class_id"] for r in near_classes(make_docs(rows)).collect()}
    want = brute_classes(rows)
    assert sum(got[d] == want[d] for d in got) >= 0.995 * len(rows)


def test_small_blocks_join_the_same_classes(make_docs, monkeypatch):
    from ratewise.llm import bag_minhash

    rng = random.Random(12)
    rows = list(enumerate(family(rng, 120, 60, 8)))
    want = brute_classes(rows)
    monkeypatch.setattr(bag_minhash, "BLOCK", 16)
    got = {r["doc_id"]: r["class_id"] for r in near_classes(make_docs(rows)).collect()}
    assert sum(got[d] == want[d] for d in got) >= 119


def test_blocks_join_components_that_the_star_left_apart(spark):
    """A chain in one bucket: each text is near the next only, and all start as their own component."""
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(30):
        t = " ".join([*words[:5], *(f"c{i // 2}x{j}" if j == 50 + (i + 1) // 2 else w for j, w in enumerate(words[5:]))])
        sig = signatures(*shingles(*hash_words([t])), 1)[0]
        sig[:5] = 7
        rows.append((1, 0, 30, i, i, sig.tobytes(), t))
    m = spark.createDataFrame(rows, "bucket long, band int, n long, id long, component long, signature binary, text string")
    links = [tuple(r) for r in across_components(m).collect()]
    brute = {(i, j) for i in range(30) for j in range(i + 1, 30) if jaccard(rows[i][6], rows[j][6]) >= 0.8}
    assert links and set(links) <= brute
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in range(30)} == brute_classes([(r[3], r[6]) for r in rows])


def test_one_of_each_class_stays(make_docs, spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other text here"), (3, "other text here"), (None, "x"), (None, None)]
    kept = keep_one(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"]) == [(False, 1), (False, 3)]
    assert kept.where("doc_id is null").count() == 2
    assert keep_one(make_docs([])).count() == 0 and near_classes(make_docs([])).count() == 0


def test_signatures_are_unbiased():
    rng = random.Random(2)
    a, b = [], []
    for _ in range(200):
        w = [rng.choice("abcd") for _ in range(rng.randint(5, 150))]  # counts far over one
        v = list(w)
        for _ in range(rng.randint(0, 6)):
            v[rng.randrange(len(v))] = "z"
        a.append(" ".join(w))
        b.append(" ".join(v))
    sig = signatures(*shingles(*hash_words(a + b)), len(a + b))
    near = (sig[:200] == sig[200:]).mean(axis=1)
    true = np.array([jaccard(x, y) for x, y in zip(a, b)])
    assert abs((near - true).mean()) < 0.01 and np.abs(near - true).max() < 0.2
    assert similarity(a, b) == pytest.approx(true)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab \n\té😀Ü."), max_size=40)), max_size=5))
def test_word_hashes(texts):
    h, at = hash_words(texts)
    words = [[w for w in (t or "").lower().replace("\t", " ").replace("\n", " ").split(" ") if w] for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(h.tolist())) == len(set(flat)) and len({(w, x) for w, x in zip(flat, h.tolist())}) == len(set(flat))


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    from ratewise.llm import wordhash

    t = ["some words " * 300, "x" * 5000 + " y"]
    whole = hash_words(t)[0]
    monkeypatch.setattr(wordhash, "CHUNK", 64)
    assert (hash_words(t)[0] == whole).all()


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 300) if i % 60] + [(1000, x) for x in range(1001, 1200)] + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(300)]
    parent = {x: x for l in links for x in l}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark, make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (None, b), (None, "c d e f g h"), (None, "c d e f g h"), (3, "x y z"), (3, "x y z")]
    docs = make_docs(rows).selectExpr("*", "1 as _row", "2 as _named")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "c d e f g h"), (1, a), (1, b), (3, "x y z")]
