"""Repair of a conversation's turns at least cost, with the least audit string.

Rows of a conversation, by turn, are to read ``(s?(ua)+)?`` in role initials. Edits: Keep costs 0, Rerole
to user or assistant 3, Delete 4 (the only choice for blank and duplicate rows), Insert of a user or
assistant row with empty text, anywhere, 3; a truncated row that stays costs 3 more. The audit is the
string of the edits' initials (D, I, K, R); of all cheapest repairs the one with the least audit is taken.

Method. A node is (rows read, last role written); a cost recurrence from the end gives each node its
least cost, and the arcs that keep to it are the optimal ones. Prefix doubling ranks the nodes by their
audits of 1, 2, 4 ... letters: the rank for 2n letters orders the pairs (rank for n, rank of the node n
letters on), and the pointers double with it. A node's arc is the least by (letter, rank of its target);
doubled pointers then read the path of every conversation in as many steps as its length has bits. All
conversations that a task holds go through these steps together, as arrays.

The work in Spark: one shuffle by conversation, sorted within; a task streams its rows and holds one
conversation (or one Arrow batch of short ones) at a time. A conversation is the unit of the result (its
audit and its digest are single values), so it is not cut.

Defined results: a null role or text is one space; rows sort by (turn, role, text), nulls first, and
repeated rows all stay, so the second is a duplicate; a role other than system, user or assistant can't
be kept, unless its initial is s, u or a, which is all that counts; an empty role has no initial and can't be
kept; null conv_ids are one conversation; rows marked as gone name their conversation but are not read; a
conversation without rows has zeros, an empty audit and no turns; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ratewise.llm.common import NOT_SPACE

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Letters of an audit, in order; 0 stands for its end.
LETTERS = "-DIKR"
#: States: nothing written, after s, after u, after a; the state that writes u or a next leads to.
START, NEXT = 0, np.array([2, 2, 3, 2])
INITIALS = "sua"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FAULTS = ("blank", "duplicate", "truncated")
#: Conversations of more rows than this are worked on alone.
ALONE = 1024


def _kept_state(initial: np.ndarray) -> np.ndarray:
    """(rows, 4): the state after keeping a row of this initial (0 s, 1 u, 2 a, 3 other), or -1."""
    to = np.full((len(initial), 4), -1)
    to[initial == 0, 0] = 1
    for s in (0, 1, 3):
        to[initial == 1, s] = 2
    to[initial == 2, 2] = 3
    return to


def cheapest_audits(initials: np.ndarray, must_go: np.ndarray, cut: np.ndarray, sizes: np.ndarray):
    """(cost, audit) of conversations that lie one after the other with ``sizes`` rows each."""
    n_conv, first = len(sizes), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    base = first[:-1] + np.arange(n_conv)  # a conversation has one node row more than rows
    big = np.int64(1) << 60
    extra = np.where(cut, CUT, 0)
    to = _kept_state(initials)
    keep = np.where((to >= 0) & ~must_go[:, None], KEEP + extra[:, None], big)
    change = np.where(must_go, big, REROLE + extra)

    cost = np.zeros((first[-1] + n_conv, 4), np.int64)
    cost[base + sizes] = [0, 2 * INSERT, INSERT, 0]
    order = np.argsort(-sizes, kind="stable")
    for j in range(int(sizes.max(initial=0))):
        c = order[:np.searchsorted(-sizes[order], -j, side="left")]  # those with more than j rows
        row, node = first[c] + sizes[c] - 1 - j, base[c] + sizes[c] - 1 - j
        after = cost[node + 1]
        kept = keep[row] + np.take_along_axis(after, np.maximum(to[row], 0), 1)
        e = np.minimum(np.minimum(DELETE + after, kept), change[row][:, None] + after[:, NEXT])
        e[:, 2], e[:, 3] = np.minimum(e[:, 2], INSERT + e[:, 3]), np.minimum(e[:, 3], INSERT + e[:, 2])
        e[:, :2] = np.minimum(e[:, :2], INSERT + e[:, 2:3])
        cost[node] = e

    letter, target = optimal_arcs(cost, first, base, keep, change, to)
    paths = least_paths(letter, target, base * 4 + START)
    return cost[base, START], ["".join(LETTERS[x] for x in p) for p in paths]


def optimal_arcs(cost, first, base, keep, change, to):
    """(letter, target), one row a letter and a column a node: the arcs of least cost; letter 0 if none."""
    n = len(cost)
    has_row = np.ones(n, bool)
    has_row[np.append(base[1:], n) - 1] = False
    state, node = np.arange(4)[None, :], np.arange(n)[:, None]
    letter, target = np.zeros((4, n, 4), np.int64), np.tile((node * 4 + state)[None], (4, 1, 1))
    at = np.flatnonzero(has_row)
    after = cost[at + 1]
    arcs = ((1, at, DELETE + after, (at[:, None] + 1) * 4 + state),
            (2, np.arange(n), INSERT + cost[:, NEXT], node * 4 + NEXT[None, :]),
            (3, at, keep + np.take_along_axis(after, np.maximum(to, 0), 1), (at[:, None] + 1) * 4 + np.maximum(to, 0)),
            (4, at, change[:, None] + after[:, NEXT], (at[:, None] + 1) * 4 + NEXT[None, :]))
    for k, where, price, goes in arcs:
        best = price == cost[where]
        letter[k - 1][where] = np.where(best, k, 0)
        target[k - 1][where] = np.where(best, goes, target[k - 1][where])
    return letter.reshape(4, -1), target.reshape(4, -1)


def least_paths(letter: np.ndarray, target: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The letters of the least path from each start, by prefix doubling over all nodes.

    ``letter`` and ``target`` have a row for each possible arc of a node (letter 0: no arc; a node without
    arcs ends its path). Arcs of one node have different letters."""
    n = letter.shape[1]

    def choose(rank):
        key = np.where(letter > 0, letter * (n + 1) + rank[target], np.iinfo(np.int64).max)
        arc = key.argmin(0)
        return letter[arc, np.arange(n)], target[arc, np.arange(n)]

    rank, at = choose(np.zeros(n, np.int64))
    ends = rank == 0
    pointers = [at]
    while not ends[at].all():  # the audits of 2n letters: their first half, then that of the node n letters on
        rank = np.unique(rank * (n + 1) + rank[at], return_inverse=True)[1]
        at = at[at]
        pointers.append(at)
    first, at = choose(rank)
    path = starts[:, None]
    for jump in [at, *pointers[1:]]:
        path = np.concatenate([path, jump[path]], 1)
    letters = first[path]
    return [row[:k] for row, k in zip(letters, (letters > 0).sum(1))]


def repaired_turns(audit: str, roles: list[str], texts: list[str]):
    """[(role, text)] after the edits of an audit."""
    out, state, i = [], START, 0
    for x in audit:
        if x == "K":
            state = INITIALS.index(roles[i][:1]) + 1
            out.append((roles[i], texts[i]))
        elif x != "D":
            state = int(NEXT[state])
            out.append(("user" if state == 2 else "assistant", texts[i] if x == "R" else ""))
        i += x != "I"
    return out


def _conversations(batches):
    """Lists of (key, rows) of whole conversations, rows as dicts, from batches sorted by conversation."""
    rows, key = [], None
    for b in batches:
        ready = []
        for r in b.to_pylist():
            if rows and r["conv_id"] != key:
                ready.append((key, rows))
                rows = []
            key = r["conv_id"]
            rows.append(r)
        if ready:
            yield ready
    if rows:
        yield [(key, rows)]


def _repair(found: list) -> dict:
    """Result columns of some conversations."""
    out = {k: [] for k in ("conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired")}
    initials, gone, cut, sizes, kept = [], [], [], [], []
    for key, rows in found:
        rows = [r for r in rows if not r["gone"]]
        turns = {r["turn"] for r in rows if r["turn"] is not None}
        seen, count = set(), dict.fromkeys(FAULTS, 0)
        for r in rows:
            fault = ("blank" if r["blank"] else "duplicate" if r["same"] in seen else "truncated" if r["cut"] else None)
            seen.add(r["same"])
            if fault:
                count[fault] += 1
            gone.append(fault in ("blank", "duplicate"))
            cut.append(fault == "truncated")
        first = [r["role"][:1] for r in rows]
        initials += [INITIALS.find(x) if x else 3 for x in first]
        sizes.append(len(rows))
        kept.append(rows)
        out["conv_id"].append(key)
        out["gaps"].append(max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        out["illegal"].append(sum(p not in LEGAL for p in zip(first, first[1:])))
        for f in FAULTS:
            out[f].append(count[f])
    initials = np.array(initials, np.int64)
    initials[initials < 0] = 3
    cost, audits = cheapest_audits(initials, np.array(gone, bool), np.array(cut, bool), np.array(sizes, np.int64))
    out["cost"], out["audit"] = cost.tolist(), audits
    out["repaired"] = [[{"role": a, "text": b} for a, b in repaired_turns(x, [r["role"] for r in rows], [r["text"] for r in rows])]
                       for x, rows in zip(audits, kept)]
    return out


def repair_turns(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) per conversation of
    ``rows`` (conv_id, turn, role, text); ``repaired``: array of (role, text). ``gone`` names a boolean
    column of rows that are not read."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"))
    facts = rows.withColumns({
        "blank": ~F.col("text").rlike(NOT_SPACE), "cut": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
        "same": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))})
    facts = facts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        for ready in _conversations(batches):
            short = [x for x in ready if len(x[1]) <= ALONE]
            for group in [short, *([x] for x in ready if len(x[1]) > ALONE)]:
                if group:
                    c = _repair(group)
                    yield pa.record_batch([pa.array(c[f.name], f.type) for f in schema], schema=schema)

    key = rows.schema["conv_id"].dataType.simpleString()
    kind = StructType.fromDDL(f"conv_id {key}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                              "audit string, repaired array<struct<role:string,text:string>>")
    schema = to_arrow_schema(kind)
    return facts.mapInArrow(run, kind)


def damage_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows with planted faults, by crc32 of ``conv_id:turn`` modulo
    20: 0 drops the row (it stays, marked as gone), 1 empties its text, 2 removes its sentence ends, 3
    repeats it, 4 sets its role to user. Nulls read as one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    d = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    d = d.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                 F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                 .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("gone"), "kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.withColumn("copy", F.explode(copies)).drop("copy", "kind")


def repair_digest(rows: DataFrame) -> DataFrame:
    """Repair of the damaged rows, with a digest of the repaired conversation in place of it."""
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return repair_turns(damage_turns(rows), "gone").select(
        "conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
