"""Benchmark decontamination by latent semantic retrieval.

1. Words (runs of letters and digits, lower case) are hashed to ``TERMS`` terms; passages are 64 words.
2. One pass counts in how many passages each term occurs, over all documents and items. The TF-IDF matrix A
   of all these passages is multiplied into a random test matrix in a second, G = A'A W, summed over tasks by
   Spark. From (W, G) the driver takes the leading right singular vectors and values of A (randomised SVD,
   Nystroem form): matrices whose size is a parameter, however many documents there are.
3. A third pass slides windows of about each benchmark item's length over every text, projects them to the
   scaled latent space by running sums, and takes those whose cosine with an item reaches ``COSINE``.
4. Candidates are verified on the words themselves: the longest common subsequence with the item, over the
   window and a third of its length to either side, as a share of the item; and the same for the item's answer
   (its last sentence, or a given column). A document leaks an item whose share reaches ``LCS``, or, as a
   paraphrase, ``LCS_PARAPHRASE`` with an answer share of ``ANSWER``.

Items go in blocks of ``ITEM_BLOCK`` (a pass each), so what is sent to tasks is bounded. Very long texts
are cut into overlapping pieces. Nothing is capped: every window over the cosine is verified.

Defined results: null texts and texts without words leak nothing; items of fewer than ``LEAST_WORDS``
words, too short to tell, are not searched; null doc_ids and item_ids are ids like any other and stay null;
repeated documents and items each have rows of their own (one per doc_id, row and item); ties go to the
first window; an empty table on either side gives no rows. drop_leaks goes by the texts, so that documents
that share a doc_id, or have none, are told apart; other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.bag_minhash import BROADCAST_IDS
from ratewise.llm.common import map_batches, unused
from ratewise.llm.wordhash import hash_words, text_batches
from ratewise.session import cut_lineage

TERMS, RANK, OVERSAMPLE, PASSAGE = 1 << 14, 32, 8, 64
COSINE, LCS, LCS_PARAPHRASE, ANSWER, LEAST_WORDS = 0.25, 0.8, 0.55, 0.75, 5
ITEM_BLOCK, PIECE, SUMMED, GRAIN = 2000, 1 << 15, 1 << 20, 3


def terms_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.uint16) & np.uint16(TERMS - 1)


def _passages(term: np.ndarray, offsets: np.ndarray):
    """(passages, PASSAGE) of terms, filled up with ``TERMS``, and the passage of each word."""
    n = np.diff(offsets)
    per = -(-n // PASSAGE)
    first = np.cumsum(per) - per
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(term)) - offsets[:-1][doc] + first[doc] * PASSAGE
    rows = np.full(int(per.sum()) * PASSAGE, TERMS, np.int32)
    rows[at] = term
    return rows.reshape(-1, PASSAGE), at // PASSAGE


def _by_term(term: np.ndarray):
    """Order of words by term (a radix sort of 16 bits keeps passages in order) and the starts of terms."""
    order = np.argsort(term, kind="stable")
    t = term[order]
    at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.zeros(0, np.int64)
    return order, t, at


def _texts(batches):
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for lo, hi in text_batches(texts):
            words, offsets = hash_words(texts[lo:hi], True)
            if len(words):
                yield terms_of(words), offsets


def passage_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(passages with each term, passages), over all documents."""
    def run(batches):
        df, n = np.zeros(TERMS + 1, np.int64), 0
        for term, offsets in _texts(batches):
            rows, passage = _passages(term, offsets)
            n += len(rows)
            order, t, _ = _by_term(term)
            p = passage[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
            df[:TERMS] += np.bincount(t[new], minlength=TERMS)
        df[TERMS] = n
        on = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(df[on])], names=["term", "n"])

    rows = map_batches(docs.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(TERMS + 1, np.int64)
    df[rows["term"].to_numpy(int)] = rows["n"].to_numpy(int)
    return df[:TERMS], int(df[TERMS])


def _add(total: np.ndarray, held: list):
    """Add to each term's row the rows of the passages that its occurrences stand in, eight at a time."""
    if not held:
        return
    shift = np.cumsum([0, *(len(y) for _, _, y in held)])
    y = np.concatenate([*(y for _, _, y in held), np.zeros((1, total.shape[1]), np.float32)])
    passage = np.concatenate([p + d for (_, p, _), d in zip(held, shift)]).astype(np.int32)
    order, t, at = _by_term(np.concatenate([t for t, _, _ in held]))
    n = np.diff(np.append(at, len(t)))
    per = -(-n // 8)
    first = np.cumsum(per) - per
    rows = np.full(int(per.sum()) * 8, len(y) - 1, np.int32)
    rows[np.arange(len(t)) - np.repeat(at, n) + np.repeat(first * 8, n)] = passage[order]
    rows = rows.reshape(-1, 8)
    sums = np.empty((len(rows), total.shape[1]), np.float32)
    for lo in range(0, len(rows), 1 << 13):
        sums[lo:lo + (1 << 13)] = np.einsum("ijk->ik", y[rows[lo:lo + (1 << 13)]])
    total[t[at]] += np.add.reduceat(sums, first, axis=0)


def latent_space(docs: DataFrame, items: DataFrame, fit_docs: int | None = None, seed: int = 7) -> np.ndarray | None:
    """(TERMS, RANK): each term's IDF times its latent coordinates, scaled by the singular values. The items
    are passages as well, so that their words have coordinates in any corpus. ``fit_docs`` fits the space on
    about so many documents, chosen by a hash of the text; by default on all."""
    df, n = passage_counts(docs.select("text").union(items.select("text")))
    if not n:
        return None
    sample = docs.select("text")
    if fit_docs:
        every = -(-docs.count() // fit_docs)
        sample = sample.where(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(max(every, 1))) == 0)
    fitted = sample.union(items.select("text"))
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)
    width = RANK + OVERSAMPLE
    test = np.random.default_rng(seed).standard_normal((TERMS, width)).astype(np.float32)

    def run(batches):
        z = np.zeros((TERMS + 1, width), np.float32)
        z[:TERMS] = test * idf[:, None]
        weight = np.append(idf ** 2, np.float32(0))
        total, held, size = np.zeros((TERMS, width)), [], 0
        for term, offsets in _texts(batches):
            rows, passage = _passages(term, offsets)
            y = np.empty((len(rows), width), np.float32)
            for lo in range(0, len(rows), 1 << 10):
                y[lo:lo + (1 << 10)] = np.einsum("ijk->ik", z[rows[lo:lo + (1 << 10)]])
            # every passage weighs the same: rows of A have unit length but for repeated terms
            y /= weight[rows].sum(axis=1)[:, None]
            held.append((term, passage, y))
            size += len(term)
            if size >= SUMMED:
                _add(total, held)
                held, size = [], 0
        _add(total, held)
        total *= idf[:, None]
        on = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(on), *(pa.array(total[on, j]) for j in range(width))],
                                         names=["term", *(f"g{j}" for j in range(width))])

    names = [f"g{j}" for j in range(width)]
    sums = map_batches(fitted, run, "term long, " + ", ".join(f"{x} double" for x in names))
    rows = sums.groupBy("term").agg(*[F.sum(x).alias(x) for x in names]).orderBy("term").toPandas()
    g = np.zeros((TERMS, width))
    g[rows["term"].to_numpy(int)] = rows[names].to_numpy()
    # A'A ~ G (W'G)^-1 G': with W'G = L L', the singular vectors of G L'^-1
    core = test.T @ g
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > values.max() * 1e-10
    u, s, _ = np.linalg.svd(g @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    if not len(s):
        return None
    # a space that spans every passage sets them all apart: a quarter of their number at most
    rank = min(RANK, max(1, n // 4), int((s > s[0] * 1e-8).sum()))
    return (idf[:, None] * u[:, :rank] / s[:rank]).astype(np.float32)


def lcs(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a bit per item word."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in text:
        m = masks.get(w)
        if m:
            hit = state & m
            state = ((state + hit) | (state & ~m)) & full
    return len(item) - state.bit_count()


def last_sentence(text: str) -> str:
    parts = [p for p in text.replace("\n", " ").replace("!", ".").replace("?", ".").split(".") if p.strip()]
    return parts[-1] if parts else ""


class _Items:
    """A block of benchmark items, by window length."""

    def __init__(self, rows, space: np.ndarray):
        self.ids = [r[0] for r in rows]
        words, at = hash_words([r[1] for r in rows], True)
        answers, bt = hash_words([r[2] for r in rows], True)
        self.words = [words[at[i]:at[i + 1]] for i in range(len(rows))]
        self.answers = [answers[bt[i]:bt[i + 1]].tolist() for i in range(len(rows))]
        self.lists = [w.tolist() for w in self.words]
        self.tables = np.zeros((len(rows), 4096), bool)
        longest = max((len(w) for w in self.words), default=0)
        self.low_words, self.has_word = np.zeros((len(rows), longest), np.int64), np.zeros((len(rows), longest), bool)
        for i, w in enumerate(self.words):
            self.low_words[i, :len(w)], self.has_word[i, :len(w)] = w & np.uint64(4095), True
        self.latent = np.zeros((len(rows), space.shape[1]), np.float32)
        self.by_window: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w) < LEAST_WORDS:
                continue
            self.tables[i, (w & np.uint64(4095)).astype(int)] = True
            v = space[terms_of(w)].sum(axis=0)
            self.latent[i] = v / max(float(np.linalg.norm(v)), 1e-12)
            # windows of three strides; strides of 1, 2, 3, 4, 6, 8, 12 ... grains
            steps = [1, *(x << j for j in range(len(w).bit_length()) for x in (2, 3))]
            step = min(steps, key=lambda x: abs(np.log(3 * GRAIN * x / len(w))))
            self.by_window.setdefault(3 * GRAIN * step, []).append(i)

    def search(self, words: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> dict:
        """(text, item) -> (LCS share, answer share, cosine, start, end) of the best leaking window."""
        rank, widest = space.shape[1], 3 * max(self.by_window, default=0)
        low = np.concatenate((words & np.uint64(4095), np.zeros(widest, np.uint64))).astype(np.int32)
        x = np.zeros((-(-len(words) // GRAIN), GRAIN, rank), np.float32)
        x.reshape(-1, rank)[:len(words)] = space[terms_of(words)]
        grains = np.einsum("ijk->ik", x)
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        tables, found = self.tables.ravel(), {}
        for window, items in self.by_window.items():
            stride = window // 3
            per = stride // GRAIN
            n = -(-len(grains) // per)
            x = np.zeros((n + 2, per, rank), np.float32)
            x.reshape(-1, rank)[:len(grains)] = grains
            strides = np.einsum("ijk->ik", x)
            # a window counts for the text of its middle word; those at the ends reach over, as if misplaced
            sums = np.zeros((n + 2, rank), np.float32)
            sums += strides
            sums[1:] += strides[:-1]
            sums[2:] += strides[:-2]  # row i: the window that ends with stride i
            sums /= np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-12)[:, None]
            needs = np.array([LCS_PARAPHRASE * len(self.words[i]) for i in items])
            views = np.lib.stride_tricks.sliding_window_view(low, window + 2 * stride)
            latent = self.latent[items].T.copy()
            for lo in range(0, len(sums), 1 << 13):
                cosine = sums[lo:lo + (1 << 13)] @ latent
                w, j = np.divmod(np.flatnonzero(cosine >= COSINE), len(items))
                if not len(w):
                    continue
                item, need, start = np.asarray(items)[j], needs[j], (lo + w - 2) * stride
                text = text_of[np.clip(start + window // 2, 0, len(words) - 1)]
                # of the window and a third of its length to either side, the words that the item may have:
                # the common subsequence is no longer
                a = np.maximum(start - stride, offsets[:-1][text])
                b = np.minimum(start + window + stride, offsets[1:][text])
                at = views[a]
                at += (item.astype(np.int32) * 4096)[:, None]
                hits = tables[at]
                short = np.flatnonzero(b - a < hits.shape[1])
                hits[short] &= np.arange(hits.shape[1]) < (b - a)[short, None]
                some = np.flatnonzero(np.count_nonzero(hits, axis=1) >= need)
                for p in some[self._present(low, a[some], b[some], item[some], need[some])]:
                    self._verify(found, int(text[p]), int(item[p]), words, int(a[p]), int(b[p]), float(cosine[w[p], j[p]]))
        return found

    def _present(self, low, a, b, item, need) -> np.ndarray:
        """Where as many of the item's words as needed occur in the region at all."""
        out = np.zeros(len(a), bool)
        for c in range(0, len(a), 1 << 11):
            n = len(a[c:c + (1 << 11)])
            size = b[c:c + n] - a[c:c + n]
            row = np.repeat(np.arange(n), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a[c:c + n], size)
            there = np.zeros((n, 4096), bool)
            there[row, low[at]] = True
            i = item[c:c + n]
            count = (there[np.arange(n)[:, None], self.low_words[i]] & self.has_word[i]).sum(axis=1)
            out[c:c + n] = count >= need[c:c + n]
        return out

    def _verify(self, found, text, item, words, a, b, cosine):
        region = words[a:b].tolist()
        share = lcs(self.lists[item], region) / len(self.lists[item])
        if share < LCS_PARAPHRASE:
            return
        answer = self.answers[item]
        kept = lcs(answer, region) / len(answer) if answer else share
        if share < LCS and kept < ANSWER:
            return
        old = found.get((text, item))
        if old is None or (share, kept, cosine) > old[:3]:
            found[text, item] = (share, kept, cosine, a, b)


def _pieces(words: np.ndarray, offsets: np.ndarray, overlap: int):
    """(text, first word, words) of the texts, long ones in overlapping pieces."""
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        while b - a > PIECE + overlap:
            yield i, a, a + PIECE + overlap
            a += PIECE
        if b > a:
            yield i, a, b


def find_leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """(doc_id, item_id, lcs, answer, cosine, first_word, n_words) of the leaked items of each document."""
    return _leaks(docs, benchmark, answer).drop("mark")


def _leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """The rows of :func:`find_leaks` with ``mark``, a hash of the document's text."""
    schema = "doc_id long, item_id long, lcs double, answer double, cosine double, first_word long, n_words long, mark long"
    spark = docs.sparkSession
    space = latent_space(docs, benchmark)
    n_blocks = -(-benchmark.count() // ITEM_BLOCK)
    out = spark.createDataFrame([], schema)
    if space is None:
        return out
    text = F.coalesce(F.col("text"), F.lit(""))
    said = F.coalesce(F.col(answer), F.lit("")) if answer else F.lit(None).cast("string")
    items = benchmark.select("item_id", text.alias("t"), said.alias("s"))
    for block in range(n_blocks):
        # about ITEM_BLOCK items; twice as many would be as well
        rows = items.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(n_blocks)) == block).collect() if n_blocks > 1 else items.collect()
        rows = sorted(((r["item_id"], r["t"], last_sentence(r["t"]) if r["s"] is None else r["s"]) for r in rows),
                      key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        out = out.union(map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("mark")), _searcher(rows, space), schema))
    return out


def _searcher(rows: list, space: np.ndarray):
    def run(batches):
        items = _Items(rows, space)
        overlap = 3 * max(items.by_window, default=0)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            result = []
            for lo, hi in text_batches(texts):
                words, offsets = hash_words(texts[lo:hi], True)
                group, size, best = [], 0, {}
                pieces = list(_pieces(words, offsets, overlap))
                for k, (i, a, b) in enumerate(pieces):
                    group.append((i, a, b))
                    size += b - a
                    if size >= PIECE or k == len(pieces) - 1:
                        part = np.concatenate([words[x:y] for _, x, y in group])
                        at = np.concatenate(([0], np.cumsum([y - x for _, x, y in group])))
                        for (p, item), v in items.search(part, at, space).items():
                            doc, x, _ = group[p]
                            v = (*v[:3], v[3] - at[p] + x - offsets[doc], v[4] - v[3])
                            if (doc, item) not in best or v[:3] > best[doc, item][:3]:
                                best[doc, item] = v
                        group, size = [], 0
                result += [(lo + doc, items.ids[item], *v) for (doc, item), v in sorted(best.items())]
            if result:
                doc, *rest = zip(*result)
                types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), *(pa.array([x.item() if hasattr(x, "item") else x for x in c], t) for c, t in zip(rest, types)),
                     batch.column(2).take(pa.array(doc))],
                    names=["doc_id", "item_id", "lcs", "answer", "cosine", "first_word", "n_words", "mark"])

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no benchmark item, with all their columns."""
    marks = cut_lineage(_leaks(docs, benchmark).select("mark").distinct())
    own = unused(docs.columns, "_mark")
    marks = marks.select(F.col("mark").alias(own))
    few = marks.count() <= BROADCAST_IDS
    return docs.withColumn(own, F.xxhash64("text")).join(F.broadcast(marks) if few else marks, own, "left_anti").select(*docs.columns)
