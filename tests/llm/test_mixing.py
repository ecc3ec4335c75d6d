from collections import defaultdict

import pytest

from ratewise.llm.mixing import mix_blocks, mix_digest, mix_documents, shuffled, source_targets


def brute_targets(sizes):
    """Share by weight; what stands above twice its size stops there and its excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > 2 * sizes[s]]
        if not over:
            return {**capped, **{s: w[s] * level for s in free}}
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_targets_against_brute_force(spark):
    for sizes in ({"a": 10, "b": 100, "c": 5, None: 40}, {"x": 7}, {"a": 0, "b": 9}, {"é": 3, "z": 3000, "A": 50, "": 1, "b": 2}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_contract_and_reruns(spark, sf_docs):
    got = mix_digest(sf_docs).collect()
    assert sorted(got) == sorted(mix_digest(sf_docs.repartition(5)).collect())
    source = {r["doc_id"]: r["source"] for r in sf_docs.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert target == pytest.approx(brute_targets(sizes))
    assert all(abs(taken[s] - target[s]) <= 256 for s in sizes)


def test_draws_are_disjoint_and_shards_exact(sf_docs):
    _, draws = mix_blocks(sf_docs)
    rows = draws.collect()
    assert len({(r["row"], r["block"], r["pass"]) for r in rows}) == len(rows)
    per = defaultdict(int)
    for r in rows:
        per[r["shard"]] += 1
    assert set(per) <= set(range(16)) and max(per.values()) - min(per.values()) <= 4  # halves of halves
    out = shuffled(draws).collect()
    assert [(r["shard"], r["place"]) for r in out] == sorted((r["shard"], r["place"]) for r in out)


def test_odd_tables_and_whole_documents(make_docs):
    assert mix_digest(make_docs([])).count() == 0
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (4, "x " * 9000, "b"), (None, "y z", "b"), (5, " ", "c")]
    got = mix_digest(make_docs(rows)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["size"] for r in got} == {1: 0, 2: 0, 3: 2, 4: 9000, None: 2, 5: 1}
    docs = [(i, f"w{i} " * (i % 7 + 1), f"s{i % 3}") for i in range(60)]
    mixed = mix_documents(make_docs(docs))
    assert mixed.columns == make_docs(docs).columns
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r["doc_id"]] += 1
    assert set(copies.values()) <= {1, 2} and len(copies) > 20


def _spread(spark, n=240):
    rows = [(i, f"w{i} " * (i % 7 + 1), "en", None if i % 5 == 0 else f"s{i % 3}", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def test_written_documents_are_the_draws_in_shard_order(spark):
    docs = _spread(spark)
    _, draws = mix_blocks(docs, None)
    want = [(r["doc_id"], r["shard"]) for r in shuffled(draws).collect()]
    got = mix_documents(docs).collect()
    assert [r["doc_id"] for r in got] == [d for d, _ in want] and len(got) > 240


def test_results_need_the_tree(spark, sf_docs, monkeypatch):
    from pyspark.sql import functions as F

    from ratewise.llm import mixing

    before, order = sorted(mix_digest(sf_docs).collect()), [r["doc_id"] for r in mix_documents(_spread(spark)).collect()]
    assert all(len(r["shards"]) > 0 or r["taken"] == 0 for r in before)
    tree = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda q, shards, seed: tree(q, shards, seed).withColumn(
        "cuts", F.transform("cuts", lambda c: F.lit(0).cast("long"))))
    assert sorted(mix_digest(sf_docs).collect()) != before
    assert [r["doc_id"] for r in mix_documents(_spread(spark)).collect()] != order


def test_rows_that_share_an_id_and_clashing_columns(spark):
    kind = "doc_id long, text string, source string, lang string, _id int, _mark string, d int, shard int, place string, key int"
    rows = [(1, "a b", "s", "en", 1, "m", 2, 3, "p", 4), (1, "a b", "s", None, 1, "m", 2, 3, "p", 4), (None, "c", "s", "en", 1, None, 2, 3, "p", 4),
            (None, "s", "s", "en", 1, "m", 2, 3, "p", 4), (None, None, "s", "en", 1, "m", 2, 3, "p", 4)]
    docs = spark.createDataFrame(rows + rows[:1] * 2, kind)
    got = mix_documents(docs, weights=(1,), share=1.0).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in docs.where("text is not null").collect())
    twice = mix_documents(docs, weights=(1,), share=2.0).collect()
    assert sorted(map(str, twice)) == sorted(2 * [str(r) for r in docs.where("text is not null").collect()])


def test_narrow_checkpoints_have_few_files(spark, sf_docs, monkeypatch):
    """However many partitions a shuffle has, steps of a mix leave few files (some 3 x 64 without ``few_files``)."""
    from ratewise.llm import common, mixing

    files, cut = [], common.cut_lineage
    counted = lambda df: files.append((d := cut(df)).rdd.getNumPartitions()) or d
    monkeypatch.setattr(common, "cut_lineage", counted)
    monkeypatch.setattr(mixing, "cut_lineage", counted)
    want = sorted(map(str, mix_digest(sf_docs).collect()))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(mixing, "stored", lambda df, name: df)
    files.clear()
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert common.few_files(spark) == 8
        assert sorted(map(str, mix_digest(sf_docs).collect())) == want
        assert sum(files) <= 40
        files.clear()
        mix_documents(sf_docs)
        assert sum(files) <= 48
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_native_plan(sf_docs):
    for df in (mix_digest(sf_docs), mix_documents(sf_docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
