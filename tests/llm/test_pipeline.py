import corpus_pipeline
from ratewise.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near import brute_classes


def test_stages_hold_what_each_operator_promises(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "shard":
            assert docs.columns == seen["documents"].columns
    rows = {k: [r.asDict() for r in v.collect()] for k, v in seen.items()}
    ids = {k: [r["doc_id"] for r in v] for k, v in rows.items()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 0").collect()}
    assert len(bad & set(ids["quality"])) < len(bad & set(ids["documents"])) / 2
    classes = brute_classes([(r["doc_id"], r["text"]) for r in rows["quality"]])
    assert sorted(ids["near_dedup"]) == sorted(set(classes.values()))
    norm = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    items = [norm(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not any(i in norm(r["text"]) for r in rows["decontaminate"] for i in items)
    dropped = [r for r in rows["near_dedup"] if r["doc_id"] not in set(ids["decontaminate"])]
    assert all(any(i in norm(r["text"]) for i in items) for r in dropped)
    sizes, taken = {}, {}
    words = lambda r: len([w for w in r["text"].split() if w])
    for r in rows["decontaminate"]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r)
    for r in rows["mix"]:
        taken[r["source"]] = taken.get(r["source"], 0) + words(r)
    longest = max(words(r) for r in rows["decontaminate"])
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in brute_targets(sizes).items())
    assert sorted(ids["shard"]) == sorted(ids["mix"])
    assert {r["shard"] for r in rows["shard"]} == set(range(16))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "shard", "slot"} <= set(out.columns) and out.count() > 0
