"""Substring deduplication by Rabin-Karp hashes of every window of ``window`` consecutive words.

Words are maximal runs of other than ASCII white space, unchanged. A word is removed where a window
that covers it has a word sequence which also starts in a document with a smaller doc_id; windows are
judged on the input, so a chain of copies all point at its least document. Covering windows merge into
maximal intervals of words.

The work in Spark: rows go to parts of about ``PART_BYTES`` by a hash of the row. A part hashes all its
windows (polynomials over word hashes, rolled by running sums) and sends each distinct hash once, with
the least doc_id that has it, to the bucket that an independent second hash names. A bucket compares
the parts' hashes and answers one bit for each: some other part has it in a smaller document. The
answers meet the part's texts again (the shuffle of texts is made once and used twice), where bits and
the part's own order say which windows repeat. A passage in a third of all documents thus reaches its
bucket once a part, a group of copies is dealt over all parts, and no key gathers rows. Two windows
count as equal if 64 hash bits and the bucket agree: some 85 bits at the number of buckets that a
100 TB corpus has.

Defined results: a null text has no words and becomes the empty string, as does one without words; a
text shorter than the window keeps all its words (joined by one space); equal doc_ids, repeated rows
included, do not repeat each other; a null doc_id counts as smaller than any other, two of them as
equal; an empty table gives no rows; other columns stay, save that ``text`` is set to the kept words and
``n_words``, ``n_removed`` and ``removed`` are set. Memory: a part, or one text where that is longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import shuffle_partitions
from ratewise.llm.wordhash import hash_raw, mix64

WINDOW = 13
PART_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
NULL_ID = -(1 << 63)
#: Odd multipliers of the two polynomials.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _rolled(words: np.ndarray, base: int, window: int) -> np.ndarray:
    """The polynomial of every ``window`` consecutive word hashes, modulo 2^64."""
    with np.errstate(over="ignore"):
        power = np.full(len(words), base, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        run = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power, out=run[1:])
        n = len(words) - window + 1
        back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        return mix64((run[window:] - run[:n]) * back)


class Part:
    """The windows of a part's texts, the same for the same rows in whatever order they come."""

    def __init__(self, rows: pa.Table, window: int, buckets: int):
        self.row, self.window = rows.column("row").combine_chunks(), window
        ids = self.row.field("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        self.raw = [t.encode() for t in self.row.field("text").fill_null("").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], self.raw[i]))
        hashes, _, _, offsets, _ = hash_raw([self.raw[i] for i in order])
        counts = np.diff(offsets)
        self.order, self.counts = order, counts
        n = max(0, len(hashes) - window + 1)
        text = np.repeat(np.arange(len(order)), counts)[:n]
        at = np.flatnonzero(np.arange(n) + window <= offsets[1:][text]) if n else np.zeros(0, np.int64)
        self.text, self.at = text[at], at - offsets[text[at]]
        self.ids = ids[order][self.text]
        if not len(at):
            self.inverse = self.first = self.bucket = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        self.hash, first, self.inverse = np.unique(_rolled(hashes, BASES[0], window)[at], return_index=True, return_inverse=True)
        self.first = self.ids[first]
        self.bucket = (_rolled(mix64(hashes), BASES[1], window)[at[first]] % np.uint64(buckets)).astype(np.int64)

    def blocks(self):
        """(bucket, positions of its distinct hashes, by first document), buckets in ascending order."""
        by = np.lexsort((self.first, self.bucket))
        found, starts = np.unique(self.bucket[by], return_index=True)
        return zip(found.tolist(), np.split(by, starts[1:]))

    def covered(self, elsewhere: np.ndarray):
        """For each row of the part: (words kept, number of words, removed intervals)."""
        gone = elsewhere[self.inverse] | (self.ids > self.first[self.inverse]) if len(self.at) else np.zeros(0, bool)
        text, at = self.text[gone], self.at[gone]
        new = np.ones(len(at), bool)
        new[1:] = (text[1:] != text[:-1]) | (at[1:] > at[:-1] + self.window)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(at)) - 1 if len(at) else start
        bounds = np.searchsorted(text[start], np.arange(len(self.order) + 1))
        out = [None] * len(self.order)
        for k, i in enumerate(self.order):
            spans = [(int(at[s]), int(at[e]) + self.window) for s, e in zip(start[bounds[k]:bounds[k + 1]], end[bounds[k]:bounds[k + 1]])]
            words = self.raw[i].split()
            for s, e in reversed(spans):
                del words[s:e]
            out[i] = (b" ".join(words).decode(), int(self.counts[k]), spans)
        return out


def _placed(docs: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """(part, row): the rows dealt to parts, and the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), -(-size // part_bytes))
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "removed")]
    part = F.pmod(F.xxhash64(F.lit(13), F.col("doc_id"), F.col("text")), F.lit(parts)).cast("int")
    return docs.select(part.alias("part"), F.struct(*columns).alias("row")), size


def repeated_words(docs: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``text`` set to its kept words, and ``n_words`` (before), ``n_removed`` and
    ``removed``, the maximal removed intervals as (start, end) word positions of the input."""
    placed, size = _placed(docs, part_bytes)
    buckets = max(shuffle_partitions(docs.sparkSession), -(-size // bucket_bytes))

    def emit(rows: pa.Table) -> pa.Table:
        p = Part(rows, window, buckets)
        blocks = list(p.blocks())
        return pa.table({
            "bucket": pa.array([b for b, _ in blocks], pa.int32()),
            "part": pa.array([rows.column("part")[0].as_py()] * len(blocks), pa.int32()),
            "hashes": pa.array([p.hash[k].tobytes() for _, k in blocks], pa.binary()),
            # differences: mostly zeros, which the shuffle's compression takes away
            "ids": pa.array([np.diff(p.first[k], prepend=0).tobytes() for _, k in blocks], pa.binary())})

    def compare(blocks: pa.Table) -> pa.Table:
        raw = blocks.column("hashes").to_pylist()
        ends = np.cumsum([len(x) // 8 for x in raw])
        hashes = np.frombuffer(b"".join(raw), np.uint64)
        ids = np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in blocks.column("ids").to_pylist()])
        order = np.lexsort((ids, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        least = np.empty_like(ids)
        least[order] = ids[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
        bits = [np.packbits(x).tobytes() for x in np.split(ids > least, ends[:-1])]
        return pa.table({"part": blocks.column("part"), "bucket": blocks.column("bucket"), "bits": pa.array(bits, pa.binary())})

    kept = placed.schema["row"].dataType
    schema = f"row {kept.simpleString()}, kept string, n_words long, removed array<struct<start:int,end:int>>"

    def apply(rows: pa.Table, answers: pa.Table) -> pa.Table:
        p = Part(rows, window, buckets)
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
        elsewhere = np.zeros(len(p.hash), bool)
        for b, k in p.blocks():
            elsewhere[k] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=len(k)).astype(bool)
        found = p.covered(elsewhere)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({"row": p.row, "kept": pa.array([f[0] for f in found], pa.string()),
                         "n_words": pa.array([f[1] for f in found], pa.int64()),
                         "removed": pa.array([[{"start": s, "end": e} for s, e in f[2]] for f in found], span)})

    sent = placed.groupBy("part").applyInArrow(emit, "bucket int, part int, hashes binary, ids binary")
    answers = sent.groupBy("bucket").applyInArrow(compare, "part int, bucket int, bits binary")
    done = placed.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(apply, schema)
    columns = [F.col("kept").alias("text") if f.name == "text" else F.col("row")[f.name].alias(f.name) for f in kept.fields]
    removed = F.aggregate("removed", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return done.select(*columns, "n_words", removed.cast("long").alias("n_removed"), "removed")


def window_digest(docs: DataFrame) -> DataFrame:
    """Per document: its words, those removed, and a digest of what is kept."""
    return repeated_words(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
