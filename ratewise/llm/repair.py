"""Token ids as files of Re-Pair grammars.

Documents in ascending doc_id order are cut into shards of about ``SHARD_TOKENS`` ids (a longer document
has a shard of its own). In each shard frequent pairs of symbols are replaced by nonterminals, round by
round, the pairs of a round non-overlapping from left to right; no symbol spans two documents. A shard's
file holds the rules, their expansion lengths, the symbols and each document's first symbol and first id,
so that a document, or any range of its ids, is decoded without the rest.

Files are rows of a Parquet table (part, seq, n_docs, n_tokens, payload): the payload is the format below,
Spark's writer makes it safe against lost tasks and puts it in any store. (part, seq) is shard order.

    magic RPR1 | u32 terminals, rules, symbols, documents, bytes per symbol | u8 doc_id flags
    left, right: symbols of the rules | u32 expansion lengths | symbols
    u64 first symbol of each document and the end | u64 first id of each and the end | i64 doc_ids

Defined results: a null text is the empty string (one end id); null doc_ids come first and stay null; rows
of equal doc_id go by a hash of the text, then by the text; repeated rows each have a place of their own;
an empty table gives an empty file table; other columns are ignored.
"""

from __future__ import annotations

import functools
import operator
import string
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import map_batches, shuffle_partitions, stored
from ratewise.llm.wordhash import hash_raw, text_batches

END_ID, SHARD_TOKENS, LEAST_COUNT, ROUNDS = 2, 1 << 20, 16, 12
CACHED_WORDS, ENCODED_CHARS, LONG_WORD = 1_200_000, 2 << 20, 256

#: The printable bytes that byte-level BPE keeps as they are; the others follow from 256 on.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([*_KEPT, *(b for b in range(256) if b not in _KEPT)], [*_KEPT, *range(256, 256 + 256 - len(_KEPT))]))
#: ASCII letters, and marks but the apostrophe, which may start a piece of its own with the letters after it.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[ord(c) for c in string.ascii_letters]] = True
_MARK[[ord(c) for c in string.punctuation if c != "'"]] = True
_ID = operator.attrgetter("id")


def _folded(text: str) -> str:
    """The text in lower case where the tokenizer's own folding surely agrees: Latin-1 texts without
    the start of a special token, whose strings are told apart by case."""
    if "<|" in text:
        return text
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def _spread(table: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs ``table[start:start + n]`` side by side."""
    at = np.repeat(start - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return table[at]


class Encoder:
    """Whole texts to ids, with ``end_id`` after each.

    ``by_word`` is for tokenizers that compose, lower, drop white space, split off runs of letters and map
    bytes to characters before their BPE: the ids of a text are then those of its parts between ASCII
    white space, which are kept in a bounded cache under their 64-bit hashes (words of over ``LONG_WORD``
    bytes are encoded each time). The cache is three arrays over sorted hashes and the ids side by side; when
    it would exceed ``CACHED_WORDS``, the words of the last batch stay."""

    def __init__(self, path: str, by_word: bool, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.terminals = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.type = np.uint16 if self.terminals <= 1 << 16 else np.uint32
        self.end = np.array([end_id], self.type)
        self.cache = np.zeros(0, np.uint64)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.type)
        self.marks: dict[bytes, np.ndarray] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def _mark(self, marks: bytes) -> np.ndarray:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self._ids(marks.decode())
            if len(marks) <= LONG_WORD:
                self.marks[marks] = ids
        return ids

    def _learn(self, buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids side by side, ids per word) of the words at ``buf[first:last]``. A run of Latin letters is one
        piece to the pre-tokenizer, and so are the marks that may follow: the run goes straight to the
        library's model. All else is encoded in one go and told apart by where each id starts."""
        n_word = len(first)
        if not n_word:
            return np.zeros(0, self.type), np.zeros(0, np.int64)
        size = last - first
        b, off = _spread(buf, first, size), np.cumsum(size) - size
        letter = _LETTER[b]
        wide = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] != 0x97) & (b[1:] != 0xB7))  # both bytes of a Latin-1 letter
        letter[wide], letter[wide + 1] = True, True
        n_letters = np.add.reduceat(letter, off, dtype=np.int64)
        n_marks = np.add.reduceat(_MARK[b], off, dtype=np.int64)
        core = np.arange(len(b)) < np.repeat(off + n_letters, size)
        plain = (n_letters > 0) & (n_letters + n_marks == size) & (np.add.reduceat(letter & core, off, dtype=np.int64) == n_letters)
        b[(b >= 65) & (b <= 90)] += 32
        upper = wide + 1
        b[upper[b[upper] <= 0x9E]] += 32
        # the letters of all plain words, a space after each
        take = np.flatnonzero(core & np.repeat(plain, size))
        n = n_letters[plain]
        joined = np.full(len(take) + len(n), 32, np.uint8)
        joined[np.arange(len(take)) + np.repeat(np.arange(len(n)), n)] = b[take]
        text = joined.tobytes().decode("latin-1")
        pieces = list(map(self.tokenizer.model.tokenize, (text if text.isascii() else text.translate(_BYTES | {32: 32})).split(" ")[:-1]))
        n_ids = np.zeros((n_word, 2), np.int64)
        n_ids[plain, 0] = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = [np.fromiter(map(_ID, chain.from_iterable(pieces)), self.type, int(n_ids.sum()))]
        start = np.zeros((n_word, 2), np.int64)
        start[plain, 0] = np.cumsum(n_ids[plain, 0]) - n_ids[plain, 0]
        # the marks behind them, each kind once
        at, raw = np.flatnonzero(plain & (n_marks > 0)), b.tobytes()
        ends = (off + size)[at]
        kinds: dict[bytes, int] = {}
        which = np.array([kinds.setdefault(raw[x:y], len(kinds)) for x, y in zip((ends - n_marks[at]).tolist(), ends.tolist())], np.int64)
        marks = [self._mark(m) for m in kinds]
        n_kind = np.array([len(m) for m in marks], np.int64)
        n_ids[at, 1] = n_kind[which]
        start[at, 1] = len(ids[0]) + (np.cumsum(n_kind) - n_kind)[which]
        ids += marks
        rest = np.flatnonzero(~plain)
        if len(rest):
            words = [bytes(buf[x:y]).decode("utf-8", "surrogatepass") for x, y in zip(first[rest].tolist(), last[rest].tolist())]
            e = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            at = np.fromiter((o[0] for o in e.offsets), np.int64)
            cut = np.searchsorted(at, np.cumsum([0] + [len(w) + 1 for w in words]))
            n_ids[rest, 0] = np.diff(cut)
            start[rest, 0] = sum(map(len, ids)) + cut[:-1]
            ids.append(np.array(e.ids, self.type))
        return _spread(np.concatenate(ids), start.ravel(), n_ids.ravel()), n_ids.sum(axis=1)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)"""
        if not self.by_word:
            parts = [np.append(self._ids(t), self.end) for t in texts]
            return np.concatenate(parts), np.array([len(p) for p in parts])
        h, first, last, offsets, buf = hash_raw([_folded(t).encode("utf-8", "surrogatepass") for t in texts])
        h = np.where(last - first > LONG_WORD, np.uint64(0), h)  # encoded by themselves below
        order = np.argsort(h)
        fresh = np.ones(len(h), bool)
        fresh[1:] = np.diff(h[order]) != 0
        where = order[fresh]
        each, which = h[where], np.empty(len(h), np.int64)
        which[order] = np.cumsum(fresh) - 1
        at = np.searchsorted(self.cache, each)
        known = np.zeros(len(each), bool)
        if len(self.cache):
            known = self.cache[np.minimum(at, len(self.cache) - 1)] == each
        new = np.flatnonzero(~known & (each != 0))
        ids, n = self._learn(buf, first[where[new]], last[where[new]])
        start, size = np.zeros(len(each), np.int64), np.zeros(len(each), np.int64)
        start[known], size[known] = self.start[at[known]], self.size[at[known]]
        start[new], size[new] = len(self.ids) + np.cumsum(n) - n, n
        table = np.concatenate((self.ids, ids))
        if len(self.cache) + len(new) <= CACHED_WORDS:
            self.cache, self.ids = np.insert(self.cache, at[new], each[new]), table
            self.start, self.size = np.insert(self.start, at[new], start[new]), np.insert(self.size, at[new], n)
        elif len(each) <= CACHED_WORDS:
            self.cache, self.size = each[each != 0], size[each != 0]
            self.ids, self.start = _spread(table, start[each != 0], self.size), np.cumsum(self.size) - self.size
        far = np.flatnonzero(h == 0)
        if len(far):
            ids, n = self._learn(buf, first[far], last[far])
            which[far] = len(each) + np.arange(len(far))
            start, size = np.concatenate((start, len(table) + np.cumsum(n) - n)), np.concatenate((size, n))
            table = np.concatenate((table, ids))
        # the ids of each word where it stands, an end id after each text
        n_word = size[which]
        ends = np.concatenate(([0], np.cumsum(n_word)))
        per = np.diff(ends[offsets]) + 1
        out = np.empty(int(ends[-1]) + len(texts), self.type)
        stop = np.cumsum(per) - 1
        body = np.ones(len(out), bool)
        body[stop] = False
        out[stop] = self.end
        out[body] = _spread(table, start[which], n_word)
        return out, per


@functools.lru_cache(maxsize=1)
def encoder_of(path: str, by_word: bool) -> Encoder:
    """One encoder a Python worker: later tasks of the worker find the words that earlier ones met."""
    return Encoder(path, by_word)


def compress(ids: np.ndarray, per_doc: np.ndarray, terminals: int, least: int = LEAST_COUNT, rounds: int = ROUNDS):
    """(left, right, symbols, first symbol of each document and the end)."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(per_doc) - 1] = True
    most = max((1 << 16) - terminals, 1 << 12)  # symbols of two bytes where the vocabulary leaves room
    left, right = [], []
    for _ in range(rounds):
        room = most - sum(map(len, left))
        if room <= 0 or len(seq) < 2:
            break
        # pairs share 2^18 counters; a counter bounds its pairs from above, the exact counts follow
        h = (seq[:-1] * np.uint32(0x9E3779B1) + seq[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(14)
        h[last[:-1]] = 1 << 18
        counts = np.bincount(h, minlength=(1 << 18) + 1)
        counts[1 << 18] = 0
        need = max(least, int(counts.max()) // 16)
        if counts.max() < least:
            break
        at = np.flatnonzero((counts >= need)[h])
        pairs, which, n = np.unique((seq[at].astype(np.int64) << 32) | seq[at + 1], return_inverse=True, return_counts=True)
        chosen = np.flatnonzero(n >= need)
        if len(chosen) > room:
            chosen = np.sort(chosen[np.argsort(-n[chosen], kind="stable")[:room]])
        if not len(chosen):
            if need == least:
                break
            need = least
            continue
        number = np.full(len(pairs), -1)
        number[chosen] = np.arange(len(chosen))
        number = number[which]
        at, number = at[number >= 0], number[number >= 0]
        new_run = np.ones(len(at), bool)
        new_run[1:] = at[1:] != at[:-1] + 1
        run = np.maximum.accumulate(np.where(new_run, at, 0))
        take = (at - run) % 2 == 0
        at, number = at[take], number[take]
        base = terminals + sum(map(len, left))
        left.append(pairs[chosen] >> 32)
        right.append(pairs[chosen] & 0xFFFFFFFF)
        seq[at] = base + number
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
    none = np.zeros(0, np.int64)
    first = np.concatenate(([0], np.flatnonzero(last) + 1))
    return np.concatenate(left or [none]), np.concatenate(right or [none]), seq, first


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, terminals: int) -> np.ndarray:
    """All ids that the symbols stand for, level by level of the rules."""
    symbols = symbols.astype(np.int64)
    while (rule := symbols >= terminals).any():
        out = np.repeat(symbols, 1 + rule)
        at = np.flatnonzero(rule) + np.arange(int(rule.sum()))
        r = symbols[rule] - terminals
        out[at], out[at + 1] = left[r], right[r]
        symbols = out
    return symbols


def pack(doc_ids: list, ids: np.ndarray, per_doc: np.ndarray, terminals: int) -> bytes:
    left, right, seq, first = compress(ids, per_doc, terminals)
    length = np.ones(terminals + len(left), np.uint32)
    for i in range(len(left)):
        length[terminals + i] = length[left[i]] + length[right[i]]
    kind = "<u2" if terminals + len(left) <= 1 << 16 else "<u4"
    flags = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        b"RPR1", struct.pack("<5I", terminals, len(left), len(seq), len(doc_ids), int(kind[-1])), flags.tobytes(),
        left.astype(kind).tobytes(), right.astype(kind).tobytes(), length[terminals:].astype("<u4").tobytes(),
        seq.astype(kind).tobytes(), first.astype("<u8").tobytes(),
        np.concatenate(([0], np.cumsum(per_doc))).astype("<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes()])


class Shard:
    """One shard file, read lazily: nothing is expanded before it is asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"RPR1":
            raise ValueError("not a Re-Pair shard")
        self.terminals, rules, symbols, n, size = struct.unpack_from("<5I", payload, 4)
        at, kind = 24, f"<u{size}"

        def take(count, kind):
            nonlocal at
            a = np.frombuffer(payload, kind, count, at)
            at += a.nbytes
            return a

        flags = take(n, "u1")
        self.left, self.right, lengths = take(rules, kind), take(rules, kind), take(rules, "<u4")
        self.symbols, self.first_symbol, self.first_id = take(symbols, kind), take(n + 1, "<u8"), take(n + 1, "<u8")
        self.doc_ids = [None if f else int(d) for d, f in zip(take(n, "<i8"), flags)]
        self.length = np.concatenate((np.ones(self.terminals, np.int64), lengths))

    def all_ids(self) -> np.ndarray:
        """All ids of the shard: each rule is expanded once, then copied to where it is used."""
        rules = expand(np.arange(self.terminals, len(self.length)), self.left, self.right, self.terminals)
        table = np.concatenate((np.arange(self.terminals), rules)).astype(np.uint32)
        start = np.cumsum(self.length) - self.length
        n = self.length[self.symbols]
        at = np.repeat(start[self.symbols] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return table[at]

    def ids(self, document: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document (by its place in the shard): only the symbols that
        cover them are expanded."""
        total = int(self.first_id[document + 1] - self.first_id[document])
        start, stop, _ = slice(start, stop).indices(total)
        symbols = self.symbols[int(self.first_symbol[document]):int(self.first_symbol[document + 1])]
        ends = np.cumsum(self.length[symbols])
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
        ids = expand(symbols[a:b + 1], self.left, self.right, self.terminals)
        skip = start - (int(ends[a - 1]) if a else 0)
        return ids[skip:skip + max(stop - start, 0)]


def write_shards(docs: DataFrame, tokenizer_path: str, by_word: bool = False, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The file table of all documents, written under the shared scratch root."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    d = d.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", "_h")
    d = d.sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    schema = "part int, seq int, n_docs long, n_tokens long, payload binary"

    def run(batches):
        encoder = encoder_of(tokenizer_path, by_word)
        part, seq = TaskContext.get().partitionId(), 0
        held_ids, held, per, size = [], [], [], 0

        def file():
            payload = pack(held_ids, np.concatenate(held), np.concatenate(per), encoder.terminals)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held_ids)], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "seq", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in text_batches(texts, ENCODED_CHARS):
                ids, n = encoder(texts[lo:hi])
                ends, a = np.concatenate(([0], np.cumsum(n))), 0
                while a < len(n):
                    b = int(np.searchsorted(ends, ends[a] + shard_tokens - size, side="right")) - 1
                    if b > a or not size:
                        b = max(b, a + 1)
                        held_ids += doc_ids[lo + a:lo + b]
                        held.append(ids[ends[a]:ends[b]])
                        per.append(n[a:b])
                        size += int(ends[b] - ends[a])
                        a = b
                    if a < len(n):
                        yield file()
                        seq, held_ids, held, per, size = seq + 1, [], [], [], 0
        if held_ids:
            yield file()

    return stored(map_batches(d, run, schema), "token-shards")


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, seq) of every document, from the files alone."""
    def run(batches):
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = Shard(payload)
                ids = shard.all_ids().astype("<u4")
                at = shard.first_id.astype(np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(shard.doc_ids, pa.int64()),
                     pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = map_batches(files.select("part", "seq", "payload"), run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # one row a shard within its part, one row a part over all
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("s"))
    parts = parts.select("part", F.coalesce(F.sum("s").over(before(Window.orderBy("part"))), F.lit(0)).alias("p0"))
    inside = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before(
        Window.partitionBy("part").orderBy("seq"))), F.lit(0)).alias("s0"))
    starts = inside.join(parts, "part").select("part", "seq", (F.col("p0") + F.col("s0")).alias("s0"))
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("s0") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "seq")
