import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewise.llm.chat import END, NEXT, SEP, START, chat_digest, format_chat, parse_chat

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def _read(spark, rows):
    f = format_chat(spark.createDataFrame(rows, SCHEMA))
    return {r["conv_id"]: r for r in f.withColumn("t", parse_chat(F.col("formatted"))).collect()}


def _row(conv, turn, role, text):
    return (conv, turn, role, text, "x")


def test_merges_adjacent_turns_of_one_role(spark):
    r = _read(spark, [_row(1, 0, "user", "a"), _row(1, 1, "user", "b"), _row(1, 2, "assistant", "c")])[1]
    assert r["formatted"] == f"{START}user{SEP}a{NEXT}b{END}{START}assistant{SEP}c{END}"
    assert [r["formatted"][s["start"]:s["start"] + s["chars"]] for s in r["loss_spans"]] == ["c"]
    assert [t["block"] for t in r["t"]] == [0, 0, 1]


def test_nulls_ties_empty_texts_and_null_conversations(spark):
    rows = [_row(1, None, None, None), _row(1, 0, "assistant", ""), _row(1, 0, "assistant", ""), _row(None, 0, "user", "n")]
    got = _read(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["t"]] == [("", ""), ("assistant", ""), ("assistant", "")]
    assert [(t["role"], t["text"]) for t in got[None]["t"]] == [("user", "n")]
    assert format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<|im_sep|>\\", "x\n"]),
                          st.text(st.sampled_from("a<|>\\\nim_end sep/é😀"), max_size=12)), max_size=6))
def test_round_trip_with_control_strings(spark, turns):
    turns = [*turns, ("assistant", "<|im_end|>\n<|im_start|>assistant ok\\"), ("user", "<|im_next|><")]
    rows = [_row(7, i, *t) for i, t in enumerate(turns)]
    d = chat_digest(format_chat(spark.createDataFrame(rows, SCHEMA))).first()
    assert _read(spark, rows)[7]["t"] and [(t["role"], t["text"]) for t in _read(spark, rows)[7]["t"]] == turns
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    assert d["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
    assert (d["loss_sha256"], d["loss_chars"], d["n_turns"]) == (sha(loss), len(loss), len(turns))
