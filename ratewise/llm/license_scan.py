"""Licence scan: Dice coefficient over word bigrams against templates.

A text is normalised (lower case, runs of letters and digits as words, all else drops out, comment marks
included). A unit is compared with a template by their sets of word bigrams. Units are
``line``: each line; ``text``: the whole text where it has several lines; ``window``: for each template every run of
as many consecutive words as the template has, across lines and within them (the whole text where it is
shorter). With threshold t a template of b bigrams can only match units of t/(2-t) b to (2-t)/t b bigrams, and only
units that share at least t/(2-t) b with it: these bounds prune templates, first by document, then by
line and window, and lose nothing; what is left is compared exactly.

Result: (doc_id, line, license, dice, unit, last_line). A line or text has one row for each licence with a
matching template, dice of the best one. Matching windows of one licence that share words are one row: line
and last_line are those of its best window (ties: the longest, then the first). Lines count from 0; line and
last_line are -1 for the whole text. Defined results: null or empty texts and units of fewer than two words
match nothing; repeated rows match each for itself; a null doc_id stays null; an empty table gives no rows;
other columns are ignored; ties between licences all stay (versions of one licence differ in a word).
Documents stay where they are: no shuffle; the templates are a fixed list in the task's code.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratewise.llm.common import map_batches
from ratewise.llm.license_texts import templates
from ratewise.llm.wordhash import text_batches

THRESHOLD = 0.8
_TOKENS = re.compile(r"[^\W_]+|\n")


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised as the units are."""
    words = [w for w in _TOKENS.findall(text.lower()) if w != "\n"]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _distinct(known) -> list[tuple[str, int, tuple[str, ...]]]:
    """(licence, words, bigrams) of the templates that differ in these."""
    found = {(k, sum(w != "\n" for w in _TOKENS.findall(t.lower())), tuple(bigrams(t))) for k, t in known}
    return sorted(x for x in found if x[2])


class Matcher:
    """The templates, with an index from bigrams to the templates that have them."""

    def __init__(self, known: tuple[tuple[str, str], ...], threshold: float):
        self.threshold, self.templates = threshold, _distinct(known)
        self.low, self.high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
        pairs = sorted({g for _, _, b in self.templates for g in b})
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for g in pairs for w in g.split(" ")}))}
        self.span = len(self.number) + 1
        code = np.array([self.number[a] * self.span + self.number[b] for a, b in (g.split(" ") for g in pairs)], np.int64)
        place = {g: i for i, g in enumerate(pairs)}
        has = [[] for _ in pairs]
        for t, (_, _, b) in enumerate(self.templates):
            for g in b:
                has[place[g]].append(t)
        order = np.argsort(code)
        self.codes, has = code[order], [has[i] for i in order]
        self.n_has = np.array([len(h) for h in has], np.int64)
        self.first_has = np.cumsum(self.n_has) - self.n_has
        self.has = np.array(list(chain.from_iterable(has)), np.int64)
        self.need = np.array([self.low * len(b) for _, _, b in self.templates])

    def scan(self, texts: list[str | None]):
        """(text, unit, line, last line, licence, dice) of all matches in a run of texts."""
        if not self.templates:
            return
        parts = [_TOKENS.findall((t or "").lower()) for t in texts]
        size = np.array([len(p) for p in parts])
        v = np.fromiter(map({**self.number, "\n": -1}.get, chain.from_iterable(parts), repeat(0)), np.int64, int(size.sum()))
        doc = np.repeat(np.arange(len(parts)), size)[v >= 0]
        v = v[v >= 0]
        at = np.flatnonzero((v[:-1] > 0) & (v[1:] > 0) & (doc[:-1] == doc[1:]))
        code = v[at] * self.span + v[at + 1]
        g = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[g] == code
        # distinct (text, bigram), then one row for each template that has the bigram
        both = np.unique(doc[at[hit]] * len(self.codes) + g[hit])
        d, g = both // len(self.codes), both % len(self.codes)
        n = self.n_has[g]
        k = np.repeat(self.first_has[g] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        key, shared = np.unique(np.repeat(d, n) * len(self.templates) + self.has[k], return_counts=True)
        key = key[shared >= self.need[key % len(self.templates)]]
        for i in np.unique(key // len(self.templates)).tolist():
            for row in self._units(parts[i], (key[key // len(self.templates) == i] % len(self.templates)).tolist()):
                yield i, *row

    def _dice(self, shared: int, n: int, b: int) -> float:
        return 2 * shared / (n + b) if self.low * b <= n <= self.high * b else 0.0

    def _units(self, tokens: list[str], of: list[int]):
        """Matches of one text with the templates ``of``, each of which shares enough bigrams with it."""
        breaks = np.array([w == "\n" for w in tokens])
        line = np.cumsum(breaks)[~breaks]
        words = [w for w in tokens if w != "\n"]
        ids: dict[tuple[str, str], int] = {}
        pairs = np.array([ids.setdefault(p, len(ids)) for p in zip(words, words[1:])], np.int64)
        inside = line[:-1] == line[1:]
        best: dict[tuple, float] = {}
        windows: dict[str, list] = {}
        for t in of:
            license, w, b = self.templates[t]
            own = np.zeros(len(ids), bool)
            own[[ids[p] for p in (tuple(g.split(" ")) for g in b) if p in ids]] = True
            hits = own[pairs]
            if breaks.any():
                dice = self._dice(int(own.sum()), len(ids), len(b))
                best["text", -1, license] = max(best.get(("text", -1, license), 0.0), dice)
            some = np.flatnonzero(hits & inside)
            lines, count = np.unique(line[some], return_counts=True)
            for x in lines[count >= self.need[t]].tolist():
                lo, hi = np.searchsorted(line, (x, x + 1)).tolist()
                unit = set(pairs[lo:hi - 1].tolist())
                dice = self._dice(int(own[list(unit)].sum()), len(unit), len(b))
                best["line", x, license] = max(best.get(("line", x, license), 0.0), dice)
            for start, dice in self._windows(pairs, hits, own, w - 1, t):
                windows.setdefault(license, []).append((start, min(start + w, len(words)), dice))
        for (unit, x, license), dice in sorted(best.items()):
            if dice >= self.threshold:
                yield unit, x, x, license, dice
        for license, found in sorted(windows.items()):
            found.sort()
            group, end = [], 0
            for start, stop, dice in [*found, (len(words), 0, 0.0)]:
                if group and start >= end:
                    a, z, dice_ = min(group, key=lambda f: (-f[2], f[0] - f[1], f[0]))
                    yield "window", int(line[a]), int(line[z - 1]), license, dice_
                    group = []
                group.append((start, stop, dice))
                end = max(end, stop)

    def _windows(self, pairs: np.ndarray, hits: np.ndarray, own: np.ndarray, m: int, t: int):
        """(first word, dice) of the matching windows of ``m`` bigrams: where enough hits lie, the sets are
        carried from one start to the next."""
        run = np.concatenate(([0], np.cumsum(hits)))
        starts = np.arange(max(len(pairs) - m, 0) + 1)
        b = len(self.templates[t][2])
        count, shared, lo, hi = Counter(), 0, 0, 0
        for s in np.flatnonzero(run[np.minimum(starts + m, len(pairs))] - run[starts] >= self.need[t]).tolist():
            if s >= hi:
                count, shared, lo, hi = Counter(), 0, s, s
            stop = min(s + m, len(pairs))
            for p in pairs[hi:stop].tolist():
                count[p] += 1
                shared += count[p] == 1 and bool(own[p])
            for p in pairs[lo:s].tolist():
                count[p] -= 1
                if not count[p]:
                    del count[p]
                    shared -= bool(own[p])
            lo, hi = s, stop
            dice = self._dice(shared, len(count), b)
            if dice >= self.threshold:
                yield s, dice


@functools.lru_cache(maxsize=2)
def matcher_of(known: tuple[tuple[str, str], ...], threshold: float) -> Matcher:
    """One matcher a Python worker."""
    return Matcher(known, threshold)


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Matches of all lines, whole texts and windows with the templates ``known`` (licence, text)."""
    known = tuple(map(tuple, known if known is not None else templates()))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, line long, license string, dice double, unit string, last_line long"

    def run(batches):
        matcher = matcher_of(known, threshold)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_batches(texts):
                rows = list(matcher.scan(texts[lo:hi]))
                if rows:
                    i, unit, line, last, license, dice = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([lo + x for x in i])), pa.array(line, pa.int64()), pa.array(license),
                         pa.array(dice), pa.array(unit), pa.array(last, pa.int64())],
                        names=["doc_id", "line", "license", "dice", "unit", "last_line"])

    return map_batches(docs.select("doc_id", "text"), run, schema)


def oracle() -> str:
    """DuckDB SQL for ``scan_licenses`` over documents; windows of the (document, template) pairs that share enough."""
    rows = ", ".join("({}, '{}', {}, [{}])".format(i, k, w, ", ".join(f"'{x}'" for x in b))
                     for i, (k, w, b) in enumerate(_distinct(templates())))
    return rf"""
WITH t(t, license, w, b) AS (VALUES {rows}), tb AS (
  SELECT t, license, w, len(b) AS m, unnest(b) AS g FROM t
), l AS (
  SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS s FROM documents
), lw AS (
  SELECT doc_id, line, list_filter(regexp_split_to_array(lower(s), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM l
), words AS (
  SELECT doc_id, line, word, row_number() OVER (PARTITION BY doc_id ORDER BY line, i) - 1 AS p
  FROM (SELECT doc_id, line, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM lw)
), bg AS MATERIALIZED (
  SELECT doc_id, line, p, word || ' ' || lead(word) OVER o AS g, lead(line) OVER o = line AS inside
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p) QUALIFY lead(word) OVER o IS NOT NULL
), u AS (
  SELECT doc_id, 'line' AS unit, line, g FROM bg WHERE inside
  UNION ALL SELECT doc_id, 'text', -1, g FROM bg WHERE doc_id IN (SELECT doc_id FROM l WHERE line > 0)
), n AS (
  SELECT doc_id, unit, line, count(DISTINCT g) AS n FROM u GROUP BY ALL
), near AS (
  SELECT doc_id, unit, line, t, any_value(license) AS license, any_value(m) AS m, count(DISTINCT g) AS s FROM u JOIN tb USING (g) GROUP BY ALL
), units AS (
  SELECT doc_id, line, license, max(2 * s / (n + m)) AS dice, unit, line AS last_line
  FROM near JOIN n USING (doc_id, unit, line) WHERE 2 * s / (n + m) >= {THRESHOLD} GROUP BY ALL
), worth AS (
  SELECT doc_id, t, any_value(license) AS license, any_value(w) AS w, any_value(m) AS m
  FROM bg JOIN tb USING (g) GROUP BY doc_id, t HAVING count(DISTINCT g) >= {THRESHOLD / (2 - THRESHOLD) - 1e-9} * any_value(m)
), starts AS (
  SELECT doc_id, t, license, w, m, unnest(range(0, greatest(k - w, 0) + 1)) AS p0, k
  FROM worth JOIN (SELECT doc_id, count(*) AS k FROM words GROUP BY doc_id) USING (doc_id)
), win AS (
  SELECT s.doc_id, s.t, s.license, s.p0, any_value(least(s.p0 + s.w, s.k)) AS p1,
    2 * count(DISTINCT bg.g) FILTER (WHERE tb.g IS NOT NULL) / (count(DISTINCT bg.g) + any_value(s.m)) AS dice
  FROM starts s JOIN bg ON bg.doc_id = s.doc_id AND bg.p BETWEEN s.p0 AND s.p0 + s.w - 2
  LEFT JOIN tb ON tb.t = s.t AND tb.g = bg.g GROUP BY ALL HAVING dice >= {THRESHOLD}
), edge AS (
  SELECT *, p0 >= coalesce(max(p1) OVER (PARTITION BY doc_id, license ORDER BY p0, p1, dice, t
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fresh FROM win
), isle AS (
  SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id, license ORDER BY p0, p1, dice, t) AS isle FROM edge
), best AS (
  SELECT * FROM isle QUALIFY row_number() OVER (PARTITION BY doc_id, license, isle ORDER BY dice DESC, p1 - p0 DESC, p0) = 1
)
SELECT doc_id, line::BIGINT AS line, license, dice, unit, last_line::BIGINT AS last_line FROM units
UNION ALL
SELECT b.doc_id, f.line::BIGINT, b.license, b.dice, 'window', z.line::BIGINT
FROM best b JOIN words f ON f.doc_id = b.doc_id AND f.p = b.p0 JOIN words z ON z.doc_id = b.doc_id AND z.p = b.p1 - 1
"""
