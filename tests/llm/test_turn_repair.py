import hashlib
import random
import re
import zlib

import numpy as np

from ratewise.llm.turn_repair import cheapest_audits, damage_turns, least_paths, repair_digest, repair_turns

SCHEMA = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}


def _faults(rows):
    seen, out = set(), []
    for row in rows:
        text = row[1].strip("\t\n\x0b\x0c\r ")
        out.append("blank" if not text else "duplicate" if row in seen else "" if text[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


def _cheapest(initials, faults):
    """(cost, audit): the least pair, by (cost, audit) of every state from the end."""
    none = (10 ** 9, "")
    best = {"": (0, ""), "s": none, "u": none, "a": (0, "")}
    for i in range(len(initials), -1, -1):
        now = dict(best) if i == len(initials) else {}
        for s in FOLLOWS if i < len(initials) else ():
            options = [(4 + best[s][0], "D" + best[s][1])]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if initials[i] == FOLLOWS[s] or (s == "" and initials[i] == "s"):
                    options.append((more + best[initials[i]][0], "K" + best[initials[i]][1]))
                options.append((3 + more + best[FOLLOWS[s]][0], "R" + best[FOLLOWS[s]][1]))
            now[s] = min(options)
        for _ in range(3):
            now = {s: min(c, (3 + now[FOLLOWS[s]][0], "I" + now[FOLLOWS[s]][1])) for s, c in now.items()}
        best = now
    return best[""]


def _brute_rows(rows):
    """What repair_turns gives for (role, text) rows in order, but for the gaps."""
    faults = _faults(rows)
    cost, audit = _cheapest([r[:1] for r, _ in rows], faults)
    out, s, i = [], "", 0
    for x in audit:
        if x in "KR":
            s = rows[i][0][:1] if x == "K" else FOLLOWS[s]
            out.append((rows[i][0] if x == "K" else {"u": "user", "a": "assistant"}[s], rows[i][1]))
        elif x == "I":
            s = FOLLOWS[s]
            out.append(({"u": "user", "a": "assistant"}[s], ""))
        i += x != "I"
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return [faults.count(f) for f in ("blank", "duplicate", "truncated")] + [illegal, cost, audit, out]


def _brute(rows):
    conv = {}
    for c, t, role, text in rows:
        kept = conv.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            kept += [(t is not None, t or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, kept in conv.items():
        kept.sort()
        t = [t for known, t, _, _ in kept if known]
        *found, turns = _brute_rows([r[2:] for r in kept])
        text = "\n".join(f"{a}:{b}" for a, b in turns)
        out[c] = [max(t) - min(t) + 1 - len(set(t)) if t else 0, *found, hashlib.sha256(text.encode()).hexdigest()]
    return out


def _digest(df):
    return {r["conv_id"]: list(r)[1:] for r in repair_digest(df).collect()}


def test_random_conversations_against_brute_force(spark):
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "a", "über"]
    texts = ["hi.", "ok", "what?", "", " \t", None, "x.\n", "same.", "a! ", "é", ".\n\n", " "]
    rows = [(c, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles), rng.choice(texts))
            for c in [*range(700), None] for t in range(rng.randint(1, 9))]
    got = _digest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == _brute(rows)
    assert any(g[5] == 0 and g[6] == "" for g in got.values())  # a conversation that lost all its rows


def test_a_long_conversation_among_short_ones(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"t{t % 900}" + rng.choice([".", ""])) for t in range(4000)]
    rows += [(c, t, "user", "x.") for c in range(20) if c != 7 for t in range(3)]
    assert _digest(spark.createDataFrame(rows, SCHEMA).repartition(3)) == _brute(rows)


def test_the_given_table(spark):
    from tests.conftest import SF_SMALL

    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert _digest(df) == _brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_operator_returns_the_repaired_turns(spark):
    rows = [(1, 0, "system", "be good."), (1, 1, "user", "hi?"), (1, 2, "user", "there?"), (1, 3, "assistant", "cut of"),
            (2, 0, "assistant", "alone."), (3, None, "user", " ")]
    got = {r["conv_id"]: r for r in repair_turns(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["audit"] == "KKIKK" and got[1]["cost"] == 6 and got[1]["truncated"] == 1 and got[1]["illegal"] == 1
    assert [tuple(t) for t in got[1]["repaired"]] == [("system", "be good."), ("user", "hi?"), ("assistant", ""), ("user", "there?"), ("assistant", "cut of")]
    assert got[2]["audit"] == "IK" and [tuple(t) for t in got[2]["repaired"]] == [("user", ""), ("assistant", "alone.")]
    assert (got[3]["blank"], got[3]["audit"], got[3]["repaired"], got[3]["gaps"]) == (1, "D", [], 0)


def test_damage(spark):
    rows = [(c, t, "assistant", "a. b! c?") for c in range(30) for t in range(10)]
    got = damage_turns(spark.createDataFrame(rows, SCHEMA)).collect()
    for c, t, *_ in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        mine = [tuple(r)[2:] for r in got if (r["conv_id"], r["turn"]) == (c, t)]
        want = ("user" if kind == 4 else "assistant", {1: "", 2: "a b c"}.get(kind, "a. b! c?"), kind == 0)
        assert mine == [want] * (2 if kind == 3 else 1)


def test_empty_tables_other_columns_and_key_types(spark):
    assert repair_digest(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([("k", 0, "user", "hi.", 1, "b", "c")], "conv_id string, turn int, role string, text string, same int, gone string, cut string")
    r = repair_turns(df).first()
    assert (r["conv_id"], r["audit"], r["cost"]) == ("k", "KI", 3)


def test_all_cheapest_repairs_of_short_conversations():
    """Every sequence of up to three rows, by brute force over (cost, audit)."""
    faults = ("", "blank", "truncated")
    kinds = [(i, f) for i in "sua?" for f in faults]
    cases = [()] + [(a,) for a in kinds] + [(a, b) for a in kinds for b in kinds] + [(a, b, c) for a in kinds for b in kinds for c in kinds[::5]]
    flat = [r for c in cases for r in c]
    cost, audit = cheapest_audits(np.array(["sua?".index(i) for i, _ in flat]), np.array([f == "blank" for _, f in flat]),
                                  np.array([f == "truncated" for _, f in flat]), np.array([len(c) for c in cases]))
    assert list(zip(cost.tolist(), audit)) == [_cheapest([i for i, _ in c], [f for _, f in c]) for c in cases]


def test_least_paths_reads_long_paths_by_doubling():
    n = 1000
    letter, target = np.zeros((2, n + 1), np.int64), np.tile(np.arange(n + 1), (2, 1))
    letter[0, :n], target[0, :n] = 1 + np.arange(n) % 3, np.arange(1, n + 1)
    letter[1, 10], target[1, 10] = 1, 500  # a shorter way with a smaller letter
    (path, whole) = least_paths(letter, target, np.array([0, 11]))
    assert path.tolist() == [1 + k % 3 for k in range(10)] + [1] + [1 + k % 3 for k in range(500, n)]
    assert whole.tolist() == [1 + k % 3 for k in range(11, n)]
