import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewise.llm.common import numbered
from ratewise.llm.repair import Encoder, Shard, pack, read_documents, write_shards
from ratewise.llm.sharding import cut_links, line_links, place_documents, propagate, shard_digest, water_fill

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def test_numbering_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.5 else f"g{i % 5}", rng.randint(0, 50), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, o long, v long").repartition(7)
    got = {r["id"]: (r["rank"], r["before"]) for r in numbered(df, ["g"], ["o", "id"], "v").collect()}
    want, n, s = {}, Counter(), Counter()
    for i, g, o, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        want[i] = (n[g], s[g])
        n[g] += 1
        s[g] += v
    assert got == want


def test_sizes_near_equal_and_groups_together(sf_docs):
    rows = shard_digest(sf_docs).collect()
    text = {r["doc_id"]: r["text"] for r in sf_docs.collect()}
    load, slots, group = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        group[text[r["doc_id"]]].add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(load.values()) / 16
    assert max(abs(load[i] - mean) for i in range(16)) < 0.15 * mean  # a few documents a shard
    assert all(len(v) == 1 for v in group.values())


def test_a_group_larger_than_a_shard_is_split(make_docs):
    rows = [(i, "the same text of a hot group") for i in range(600)] + [(1000 + i, f"text {i} " * (i % 9 + 1)) for i in range(600)]
    got = place_documents(make_docs(rows)).collect()
    load, hot = Counter(), set()
    for r in got:
        load[r["shard"]] += r["size"]
        if r["doc_id"] < 1000:
            hot.add(r["shard"])
    mean = sum(load.values()) / 16
    assert max(load.values()) < 1.05 * mean and min(load.values()) > 0.95 * mean
    assert len(hot) <= -(-600 * 29 // mean) + 2


def test_propagation_cuts_fewer_edges_than_its_start(spark):
    rng = random.Random(8)
    ids = list(range(640))
    rng.shuffle(ids)
    cliques = [ids[i:i + 10] for i in range(0, 640, 10)]
    links = [(c[i], c[j]) for c in cliques for i in range(10) for j in range(i)]
    links += [(cliques[k][0], cliques[(k + 1) % 64][0]) for k in range(64)] + [(1, 1), (5, 99999)]
    nodes = spark.createDataFrame([(i, 10) for i in range(640)], "id long, size long")
    e = spark.createDataFrame(links, "a long, b long")
    cut = {}
    for rounds in (0, 6):
        at = {r["id"]: r["shard"] for r in propagate(nodes, e, rounds=rounds).collect()}
        assert len(at) == 640 and max(Counter(at.values()).values()) <= 44
        cut[rounds] = sum(at[a] != at[b] for a, b in links if b < 640)
    assert cut[6] < cut[0]


def test_rounds_move_documents_of_the_given_table(spark, sf_docs):
    """Links of shared lines: the rounds cut fewer than the hashed start, and a start without rounds differs."""
    from pyspark.sql import functions as F

    texts = sf_docs.select(F.xxhash64("text").alias("id"), "text").distinct()
    links = line_links(texts)
    brute = defaultdict(set)
    for r in texts.collect():
        for line in set(r["text"].split("\n")):
            if len(line.strip(" ")) >= 24:
                brute[line].add(r["id"])
    want = {(a, min(v)) for v in brute.values() if 1 < len(v) <= 64 for a in v if a != min(v)}
    got = {(r["a"], r["b"]) for r in links.collect()}
    assert want and want <= got
    nodes = texts.select("id", F.octet_length("text").alias("size"))
    before, after = (cut_links(propagate(nodes, links, rounds=n), links) for n in (0, 5))
    assert after < 0.7 * before
    assert {(r["doc_id"], r["shard"]) for r in place_documents(sf_docs).collect()} != {
        (r["doc_id"], r["shard"]) for r in place_documents(sf_docs, rounds=0).collect()}


def test_hot_lines_are_split_into_stars(spark):
    texts = spark.range(1000).selectExpr("id", "concat('a line that very many texts do share\n', id) as text")
    links = line_links(texts).collect()
    hubs = Counter(r["b"] for r in links)
    assert max(hubs.values()) < 130 and len(links) + len(hubs) == 1000


def test_columns_that_clash_stay(spark):
    kind = "doc_id long, text string, id string, node int, d string, order int, own int, _mark string, slot string"
    df = spark.createDataFrame([(i, f"t{i % 3}", f"i{i}", i, "d", i, 7, "m", "old") for i in range(9)], kind)
    got = place_documents(df, 4).collect()
    assert sorted((r["doc_id"], r["id"], r["node"], r["d"], r["order"], r["own"], r["_mark"]) for r in got) == [
        (i, f"i{i}", i, "d", i, 7, "m") for i in range(9)]


def test_shards_of_odd_tables(make_docs):
    assert shard_digest(make_docs([])).count() == 0
    rows = [(1, None), (1, None), (None, ""), (2, "long " * 40000), (3, "x")]
    got = shard_digest(make_docs(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert {r["text_crc32"] for r in got if r["size"] == 1} == {0}


def test_water_fill():
    assert water_fill([3, 1, 5], 3) == pytest.approx([0.5, 2.5, 0])
    assert water_fill([0, 0], 4) == pytest.approx([2, 2])
    assert water_fill([2, 9], 0) == pytest.approx([0, 0])


# ---- token files ---------------------------------------------------------------------------
def _whole(texts):
    e = Encoder(PATH, False)
    return [e([t or ""])[0].astype("<u4") for t in texts]


def test_ids_are_those_of_whole_texts(spark, sf_docs):
    rows = sorted((r["doc_id"], r["text"]) for r in sf_docs.collect())
    got = {r["doc_id"]: r for r in read_documents(write_shards(sf_docs, PATH, True, 5000)).collect()}
    start = 0
    assert max(Counter((r["part"], r["seq"]) for r in got.values()).values()) < 25
    for (d, _), ids in zip(rows, _whole([t for _, t in rows])):
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len({(r["part"], r["seq"]) for r in got.values()}) > 8


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_encoding_by_word_is_encoding_whole(text):
    assert Encoder(PATH, True)([text])[0].tolist() == _whole([text])[0].tolist()


def test_encoding_odd_texts():
    texts = ["a <|endoftext|> b<|startoftext|>c \t\x0b", "É È \x1c\x1d İstanbul ΣΑΣ ﬁ éx ö ́y", "don't I'LL 12 3.4 ,;. x,;.'s", " a b\x85c", "WORD, Word. word!?", "", "x" * 300 + " " + "y" * 300 + ". " + "x" * 300]
    e = Encoder(PATH, True)
    for _ in range(2):  # new, then from the cache
        ids, n = e(texts)
        want = _whole(texts)
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == np.concatenate(want).tolist()


def test_a_full_cache_changes_nothing(monkeypatch):
    from ratewise.llm import repair

    monkeypatch.setattr(repair, "CACHED_WORDS", 20)
    e = Encoder(PATH, True)
    for lo in range(0, 200, 10):
        texts = [" ".join(f"w{chr(97 + (lo + i) % 26)}{chr(97 + i % 7)}x" for i in range(15)), "and the same again"]
        assert e(texts)[0].tolist() == np.concatenate(_whole(texts)).tolist()
        assert len(e.cache) <= 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(3, 9), max_size=60), min_size=1, max_size=6), st.integers(2, 4))
def test_grammar_round_trip_and_ranges(docs, least):
    ids = np.array([x for d in docs for x in [*d, 2]], np.uint16)
    per = np.array([len(d) + 1 for d in docs])
    shard = Shard(pack([None, *range(len(docs) - 1)], ids, per, 10))
    assert shard.all_ids().tolist() == ids.tolist() and shard.doc_ids[0] is None
    for i, d in enumerate(docs):
        whole = [*d, 2]
        assert shard.ids(i).tolist() == whole
        for a, b in ((0, 1), (2, 7), (-3, None), (5, 2)):
            assert shard.ids(i, a, b).tolist() == whole[a:b]


def test_grammar_compresses_repeats():
    ids = np.tile(np.array([5, 6, 7, 8, 2], np.uint16), 2000)
    shard = Shard(pack(list(range(2000)), ids, np.full(2000, 5), 10))
    assert len(shard.symbols) <= 2 * 2000 + 10 and shard.all_ids().tolist() == ids.tolist()


def test_token_files_of_odd_tables(make_docs):
    assert read_documents(write_shards(make_docs([]), PATH, True)).count() == 0
    rows = [(3, "b"), (1, None), (1, None), (None, "a"), (2, "x " * 3000)]
    got = sorted(read_documents(write_shards(make_docs(rows), PATH, True, 100)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 3]
    assert [r["start"] for r in got] == [0, 2, 3, 4, 3005]
