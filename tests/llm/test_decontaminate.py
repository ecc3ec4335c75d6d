import random

import numpy as np
import pytest

from ratewise.llm.decontaminate import drop_leaks, find_leaks, last_sentence, latent_space, lcs
from tests.conftest import SF_SMALL

ITEMS = "item_id long, text string"


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert lcs(a, b) == brute_lcs(a, b)


def _text(rng, n):
    return " ".join(f"w{int(rng.expovariate(0.004))}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


def test_planted_leaks(spark, make_docs):
    rng = random.Random(6)
    items = [(i, _text(rng, rng.randint(12, 60))) for i in range(25)]
    docs, leaked = [], set()
    for d in range(160):
        words = _text(rng, rng.randint(30, 400)).split()
        if d % 4 == 0:
            i = rng.randrange(25)
            quote = items[i][1].split()
            if d % 8 == 0:  # a paraphrase: a tenth of the words changed
                for _ in range(max(1, len(quote) // 10)):
                    quote[rng.randrange(len(quote))] = f"p{rng.randint(0, 99)}"
            at = rng.randrange(len(words))
            words[at:at] = quote
            leaked.add((d, i))
        docs.append((d, " ".join(words).upper() if d % 3 == 0 else "\n".join(words)))
    bench = spark.createDataFrame(items, ITEMS)
    got = {(r["doc_id"], r["item_id"]): r for r in find_leaks(make_docs(docs), bench).collect()}
    assert set(got) == leaked
    assert all(r["lcs"] >= 0.55 and r["cosine"] >= 0.25 for r in got.values())
    kept = drop_leaks(make_docs(docs), bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(160)) - {d for d, _ in leaked}
    assert kept.columns == make_docs(docs).columns


def test_exact_passages_of_the_tables(spark, sf_docs):
    norm = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = [(r["item_id"], norm(r["text"])) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in sf_docs.collect() for i, t in items if t in norm(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(sf_docs, bench).collect()}
    assert want <= got and len(got) <= len(want) * 1.3 + 1


def test_long_texts_are_searched_whole(spark, make_docs):
    rng = random.Random(9)
    item = _text(rng, 30)
    long = _text(rng, 70000).split()
    docs = [(1, " ".join(long[:66000] + item.split() + long[66000:])), (2, " ".join(long[:32750] + item.split() + long[32750:])), (3, " ".join(long))]
    got = {r["doc_id"]: r for r in find_leaks(make_docs(docs), spark.createDataFrame([(0, item)], ITEMS)).collect()}
    assert set(got) == {1, 2}
    assert got[1]["first_word"] <= 66000 <= got[1]["first_word"] + got[1]["n_words"]


def test_odd_tables(spark, make_docs):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item)], ITEMS)
    rows = [(1, None), (2, ""), (3, "..."), (4, "x"), (5, f"it says {item} here"), (5, f"it says {item} here"), (None, item)]
    got = find_leaks(make_docs(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(5, 1), (None, 1), (5, None), (None, None)}
    assert {r["doc_id"] for r in drop_leaks(make_docs(rows), bench).collect()} == {1, 2, 3, 4}
    assert find_leaks(make_docs([]), bench).count() == 0
    assert find_leaks(make_docs(rows), spark.createDataFrame([], ITEMS)).count() == 0


def test_documents_are_told_apart_by_their_texts(spark, make_docs):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item)], ITEMS)
    rows = [(7, "a clean text of some length that nobody asked for"), (7, f"it says {item} here"), (None, f"so it says {item}"), (None, "clean")]
    docs = make_docs(rows).selectExpr("*", "1 as _mark", "'m' as mark")
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {(r["doc_id"], r["text"]) for r in kept.collect()} == {rows[0], rows[3]}


def test_recall_of_planted_items_with_a_small_fit(spark, sf_docs, monkeypatch):
    """Items of the given benchmark in given documents, exact and with a fifth of their words replaced: those
    whose common subsequence still reaches the share are found, by a space fitted on a few documents."""
    from ratewise.llm import decontaminate

    monkeypatch.setattr(decontaminate.latent_space, "__defaults__", (40, 7))
    rng = random.Random(12)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    items = [(r["item_id"], r["text"].split()) for r in bench.collect() if len(r["text"].split()) >= 10]
    hosts = [r["text"].split() for r in sf_docs.orderBy("doc_id").collect() if 30 <= len(r["text"].split()) <= 400]
    rows, want = [], set()
    for d in range(120):
        i, words = rng.choice(items)
        quote, host = list(words), list(rng.choice(hosts))
        if d % 2:
            for k in rng.sample(range(len(quote)), len(quote) // 5):
                quote[k] = f"zz{rng.randint(0, 99)}"
        at = rng.randrange(len(host))
        rows.append((d, " ".join(host[:at] + quote + host[at:])))
        if brute_lcs(words, quote) >= 0.8 * len(words):
            want.add((d, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, bench).collect()}
    assert len(want) > 90 and len(want - got) <= 1, want - got


def test_items_in_blocks(spark, make_docs, monkeypatch):
    from ratewise.llm import decontaminate

    rng = random.Random(3)
    items = [(i, _text(rng, 20)) for i in range(9)]
    docs = make_docs([(i, f"lead in {t} and out") for i, t in items])
    bench = spark.createDataFrame(items, ITEMS)
    whole = sorted(tuple(r) for r in find_leaks(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 2)
    assert sorted(tuple(r) for r in find_leaks(docs, bench).collect()) == whole and len(whole) >= 9


def test_latent_space_spans_the_leading_directions(make_docs):
    """Close to the singular vectors of the whole TF-IDF matrix, found densely."""
    from ratewise.llm import decontaminate as D
    from ratewise.llm.wordhash import hash_words

    rng = random.Random(2)
    topics = [[f"t{k}x{i}" for i in range(30)] for k in range(6)]
    texts = [" ".join(rng.choice(topics[d % 6]) for _ in range(64)) for d in range(120)]
    space = latent_space(make_docs(list(enumerate(texts))), make_docs([]))
    words, at = hash_words(texts, True)
    a = np.zeros((120, D.TERMS))
    for i in range(120):
        np.add.at(a[i], D.terms_of(words[at[i]:at[i + 1]]), 1)
    idf = np.log(121 / ((a > 0).sum(axis=0) + 1)) + 1
    weighted = a * idf
    weighted /= np.sqrt((a * idf ** 2).sum(axis=1))[:, None]
    top = np.linalg.svd(weighted, full_matrices=False)[2][:6]
    basis = np.linalg.qr(space / idf[:, None])[0]
    assert np.linalg.norm(top @ basis, axis=1).min() > 0.95


def test_last_sentence():
    assert last_sentence("A b. C d!\nE f? g h.") .strip() == "g h"
    assert last_sentence("") == "" and last_sentence("...") == ""


def test_latent_space_is_fitted_on_all_documents(spark):
    docs = spark.range(41_000).selectExpr("id as doc_id", "concat('t', id % 6, 'x', id % 37, ' t', id % 6, 'y', id % 41, ' z', id % 11) as text")
    items = spark.createDataFrame([(0, "t1x1 t1y1 z5")], ITEMS)
    got, whole, some = latent_space(docs, items), latent_space(docs, items, 10 ** 9), latent_space(docs, items, 20_000)
    assert np.allclose(np.abs(got), np.abs(whole), atol=1e-4) and not (got.shape == some.shape and np.allclose(np.abs(got), np.abs(some), atol=1e-4))
