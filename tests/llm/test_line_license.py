import textwrap
from collections import defaultdict

from ratewise.llm.license_scan import bigrams, scan_licenses
from ratewise.llm.license_texts import NAMES, TEXTS, templates
from ratewise.llm.line_dedup import dedup_lines


def brute_lines(rows):
    first, seen = {}, defaultdict(list)
    for d, t in sorted((d, t) for d, t in rows if t is not None):
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if "".join(w).strip(" \t\n\r\x0b\x0c"):
                if w in first:
                    seen[d].append(i)
                else:
                    first[w] = (d, i)
    out = {}
    for d, t in rows:
        lines = [] if t is None else t.split("\n")
        gone = {p for i in seen[d] for p in (i, i + 1, i + 2)}
        out[d] = (None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def _lines(df):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(df).collect()}


def test_lines_against_brute_force(make_docs):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd\nq"), (4, "r\n" * 12), (5, None), (6, ""), (7, "a\nb"),
            (8, "\n\n\n\n\n"), (9, "\n \n\t\n"), (10, "a\nb\nc"), (11, "\n".join(f"l{i % 40}" for i in range(3000)))]
    got = _lines(make_docs(rows))
    assert got == brute_lines(rows)
    assert got[10][0] == "" and got[2][0] == "x\ny"


def test_lines_of_odd_tables(make_docs, spark):
    assert dedup_lines(make_docs([])).count() == 0
    twice = dedup_lines(make_docs([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")])).collect()
    assert sorted((r["doc_id"] is None, r["text"]) for r in twice) == [(False, ""), (False, ""), (True, "a\nb\nc")]
    clash = spark.createDataFrame([(1, "a\nb\nc", "x")], "doc_id long, text string, n_lines string")
    assert dedup_lines(clash).first()["n_lines"] == 3


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def brute_licenses(rows, known, threshold=0.8):
    """Every unit against every template, windows joined where they share words."""
    known = [(k, len(words_of(t)), set(bigrams(t))) for k, t in known if bigrams(t)]
    sets = lambda w: set(zip(w, w[1:]))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        at = [(w, i) for i, line in enumerate(lines) for w in words_of(line)]
        words, where = [w for w, _ in at], [i for _, i in at]
        units = [("line", i, words_of(line)) for i, line in enumerate(lines)] + [("text", -1, words)] * (len(lines) > 1)
        best, windows = {}, defaultdict(set)
        for k, size, b in known:
            b = {tuple(g.split(" ")) for g in b}
            for unit, i, w in units:
                dice = 2 * len(sets(w) & b) / (len(sets(w)) + len(b))
                if dice >= threshold:
                    best[unit, i, k] = max(best.get((unit, i, k), 0), dice)
            for s in range(max(len(words) - size, 0) + 1 if sets(words) & b else 0):
                w = words[s:s + size]
                dice = 2 * len(sets(w) & b) / (len(sets(w)) + len(b))
                if dice >= threshold:
                    windows[k].add((s, min(s + size, len(words)), dice))
        out += [(d, i, k, dice, unit, i) for (unit, i, k), dice in best.items()]
        for k, found in windows.items():
            while found:
                group, covered = [], set()
                for f in sorted(found):
                    if not group or f[0] in covered:
                        group.append(f)
                        covered |= set(range(f[0], f[1]))
                found -= set(group)
                s, e, dice = min(group, key=lambda f: (-f[2], f[0] - f[1], f[0]))
                out.append((d, where[s], k, dice, "window", where[e - 1]))
    return sorted(out)


def _licenses(df, *args):
    got = [(r["doc_id"], r["line"], r["license"], r["dice"], r["unit"], r["last_line"]) for r in scan_licenses(df, *args).collect()]
    return sorted(got)


def test_licenses_against_brute_force(make_docs, sf_docs):
    grant, whole = TEXTS["MIT"]
    rows = [(1, "hello\nReleased under the MIT License.\nbye"), (2, grant), (3, grant.replace(". ", ".\n").replace(", ", "\n")),
            (4, "licensed UNDER the   apache-license (version 2.0)"), (5, None), (6, ""), (7, "MIT"), (8, "MIT License"),
            (9, grant.replace("copies", "units").replace("sell", "rent")), (10, "x " * 3000),
            (11, "one two released under the mit license, three " * 3), (12, whole + "\nand more\n" + whole), (13, "\n\n MIT \n License \n"),
            (14, TEXTS["ISC"][0][:300]), (15, "SPDX-License-Identifier: BSD-3-Clause")]
    rows += [(r["doc_id"] + 100, r["text"]) for r in sf_docs.collect()]
    got = _licenses(make_docs(rows))
    assert got == brute_licenses(rows, templates())
    found = {x[:3] for x in got}
    assert {(1, 1, "MIT"), (2, 0, "MIT"), (3, -1, "MIT"), (11, 0, "MIT"), (15, 0, "BSD-3-Clause")} <= found


def test_licenses_of_other_lists_and_thresholds(make_docs):
    rows = [(1, "a b c d e f\ng a b c x y"), (2, "a a a a a b"), (3, "c d e f g a b"), (4, "b c d " * 50), (5, "a b")]
    known = [("k", "a b c d"), ("k", "a b c x y"), ("l", "a a a a b"), ("l", "b c d b"), ("m", "one")]
    for threshold in (0.5, 0.8, 1.0):
        assert _licenses(make_docs(rows), known, threshold) == brute_licenses(rows, known, threshold)


def wrapped(text, width, mark):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


def test_whole_licence_files_and_wrapped_headers(make_docs):
    """What a source tree holds: files with a title and a copyright line, headers in comments above code."""
    code = "\n".join(f"def f{i}(a, b):\n    return a * {i} + b" for i in range(40))
    header = {k: TEXTS[k][0] for k in ("Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "EPL-2.0")}
    rows, want = [], {}
    for k in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC"):
        want[len(rows)] = k
        rows.append((len(rows), f"{NAMES[k]}\n\nCopyright (c) 2021 Some One\n\n{wrapped(TEXTS[k][-1], 78, '')}\n"))
    for width, mark in ((76, "# "), (60, " * "), (100, "// ")):
        for k, t in header.items():
            want[len(rows)] = k
            rows.append((len(rows), f"Copyright 2020 Some One\n{wrapped(t, width, mark)}\n\n{code}"))
    want[len(rows)] = "MIT"
    rows.append((len(rows), "We like this tool, which was released under the MIT License in 2015, and use it daily. " * 2))
    rows.append((len(rows), code))
    got = _licenses(make_docs(rows))
    best = {}
    for d, _, k, dice, _, _ in got:
        best[d] = max(best.get(d, (0, "")), (dice, k))
    assert {d: k for d, (_, k) in best.items()} == want
    assert all(dice > 0.9 for dice, _ in best.values())
    apache = [x for x in got if x[0] == 4 and x[2] == "Apache-2.0" and x[4] == "window"]
    assert [(x[1], x[5] > 5) for x in apache] == [(1, True)]


def test_licenses_of_odd_tables(make_docs, spark):
    assert scan_licenses(make_docs([])).count() == 0
    assert scan_licenses(make_docs([(1, "MIT License now")]), known=[]).count() == 0
    got = scan_licenses(make_docs([(None, "Released under the MIT License."), (None, "Released under the MIT License.")]))
    assert got.where("unit = 'line' and doc_id is null").count() == 2
    clash = spark.createDataFrame([("x", "Released under the MIT License.", "l", 1)], "doc_id string, text string, license string, line int")
    assert {(r["doc_id"], r["line"], r["license"]) for r in scan_licenses(clash).collect()} == {("x", 0, "MIT")}


def test_line_dedup_keeps_columns_of_any_name(spark):
    kind = "doc_id long, text string, _id int, _mark string, _a int, _m int, l string, s int, e int, d int, a int, mark int, n_lines string"
    text = "one\ntwo\nthree\nfour"
    docs = spark.createDataFrame([(i, text, 1, "m", 2, 3, "l", 4, 5, 6, 7, 8, "old") for i in (1, 2, None)], kind)
    got = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    assert {i: (r["text"], r["n_lines"], r["n_removed"]) for i, r in got.items()} == {None: (text, 4, 0), 1: ("", 4, 4), 2: ("", 4, 4)}
    assert all((r["_id"], r["_mark"], r["_a"], r["_m"], r["l"], r["s"], r["e"], r["d"], r["a"], r["mark"]) == (1, "m", 2, 3, "l", 4, 5, 6, 7, 8) for r in got.values())
