"""Near-duplicate detection with BagMinHash over the multiset of five-word shingles.

Weights are the shingles' counts, discretised to integers. Each shingle has a Poisson process per level
of a hierarchy of weight intervals (0,1], (1,2], (2,4], (4,8] ...: the rate is the interval's width, and a
point counts where its uniform weight cell is within the shingle's count. A point falls on one of the
registers, and the earliest of each register is the signature: two agree in a register with probability
sum(min) / sum(max), the weighted Jaccard similarity. Points are drawn in ascending time up to the time
at which all registers are filled, so that a text costs its shingles plus the registers, not the product.

Equal texts are one node. Signatures are banded; the members of a band's bucket are compared with the
bucket's least document, exactly, over the whole multisets. Buckets that then still hold several
components are compared in full: in pairs of blocks of bounded size, across components; pairs whose
signatures reach the threshold less three standard errors are compared exactly. Components of the exact
links are the classes. No bucket is gathered in one task and no pair is dropped for size.

Two texts at the threshold share a band with probability 0.99995 at 25 bands of 5 registers.

Defined results: a null text is the empty string; texts without words belong together only if equal;
texts of one to four words have one shingle of all their words; rows of one doc_id are one document (the
links of any hold for all); null doc_ids are not classified and have a null class; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import components, map_batches, stored, unused
from ratewise.llm.wordhash import hash_words, mix64, text_batches
from ratewise.session import cut_lineage

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 25, 5, 0.8
REGISTERS = BANDS * ROWS
BLOCK = 256  # bucket members per block of the full comparison
BROADCAST_IDS = 200_000  # ids of 8 bytes that may be broadcast; more are joined by shuffle
_STEP = np.uint64(0x9E3779B97F4A7C15)
_COEFFICIENTS = mix64(np.arange(1, 65, dtype=np.uint64))


def shingles(words: np.ndarray, offsets: np.ndarray, k: int = SHINGLE):
    """(text number, shingle hash, count) of the distinct shingles of each text, sorted."""
    n = np.diff(offsets)
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), per)
    first = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(offsets[:-1], per)
    left = np.minimum(offsets[1:][text] - first, k)
    with np.errstate(over="ignore"):
        h = np.zeros(len(text), np.uint64)
        for j in range(k):
            on = left > j
            h += np.where(on, words[np.minimum(first + j, max(len(words) - 1, 0))] * _COEFFICIENTS[j], 0).astype(np.uint64) if len(words) else 0
    h = mix64(h)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(text: np.ndarray, ids: np.ndarray, counts: np.ndarray, n_texts: int, m: int = REGISTERS) -> np.ndarray:
    """(n_texts, m) signatures of 32 bits; rows of texts without shingles are zero."""
    weight = np.bincount(text, counts, n_texts)
    doc, seed, rate, low, most = [text], [ids], [np.ones(len(ids))], [np.zeros(len(ids))], [counts.astype(float)]
    lo = 1
    while (on := np.flatnonzero(counts > lo)).size:  # the next level of the hierarchy, for the shingles that reach it
        doc.append(text[on])
        seed.append(mix64(ids[on] ^ np.uint64(lo)))
        rate.append(np.full(on.size, float(lo)))
        low.append(np.full(on.size, float(lo)))
        most.append(counts[on].astype(float))
        lo *= 2
    doc, seed, rate, low, most = map(np.concatenate, (doc, seed, rate, low, most))
    time, step = np.zeros(len(doc)), np.zeros(len(doc), np.uint64)
    first, won = np.full(n_texts * m, np.inf), np.zeros(n_texts * m, np.uint32)
    until = m * (np.log(m) + 1) / np.maximum(weight, 1)
    todo = np.ones(n_texts, bool)
    pending = (np.zeros(len(doc)), np.zeros(len(doc), np.uint64))  # the next point of each stream, once drawn

    def draw(s):
        with np.errstate(over="ignore"):
            step[s] += np.uint64(1)
            z = mix64(seed[s] + step[s] * _STEP)
            time[s] += -np.log(((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate[s]
        pending[0][s], pending[1][s] = time[s], mix64(z ^ _STEP)

    draw(np.arange(len(doc)))
    while len(doc) and todo.any():
        s = np.flatnonzero(todo[doc] & (pending[0] <= until[doc]))
        while s.size:
            t, z = pending[0][s], pending[1][s]
            cell = low[s] + 1 + np.floor((z >> np.uint64(44)).astype(float) / (1 << 20) * rate[s])
            fits = cell <= most[s]
            key = doc[s][fits] * m + ((z[fits] >> np.uint64(32)) & np.uint64(0xFFF)).astype(np.int64) * m // 4096
            tf = t[fits]
            np.minimum.at(first, key, tf)
            best = tf == first[key]
            won[key[best]] = (z[fits][best] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            draw(s)
            s = s[pending[0][s] <= until[doc[s]]]
        todo = (weight > 0) & np.isinf(first.reshape(n_texts, m)).any(axis=1)
        until[todo] *= 2
    return won.reshape(n_texts, m)


def similarity(a: list[str], b: list[str], k: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of text pairs; 0 where either is empty."""
    n = len(a)
    text, h, c = shingles(*hash_words([*a, *b]), k)
    total = np.bincount(text, c, 2 * n)
    pair = text % n
    order = np.lexsort((h, pair))
    pair, h, c = pair[order], h[order], c[order]
    same = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
    both = np.bincount(pair[same], np.minimum(c[same], c[same + 1]), n)
    return both / np.maximum(total[:n] + total[n:] - both, 1)


def signed(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, signature, weight): one pass over the texts; mark is the MD5 of the text."""
    d = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("mark"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in text_batches(texts):
                text, h, c = shingles(*hash_words(texts[lo:hi]), k)
                sig = signatures(text, h, c, hi - lo)
                weight = np.bincount(text, c, hi - lo).astype(np.int64)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(weight)],
                    names=["doc_id", "mark", "signature", "weight"])

    return map_batches(d, run, "doc_id long, mark binary, signature binary, weight long")


def among(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``docs`` whose doc_id is (not) in ``ids``: by broadcast up to a counted bound, else by shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", how)


def verified(pairs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the threshold."""
    ids = cut_lineage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = stored(among(docs.select("doc_id", "text"), ids), "near-texts")
    j = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    j = j.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for lo, hi in text_batches([(x or "") + (y or "") for x, y in zip(ta, tb)]):
                near = similarity(ta[lo:hi], tb[lo:hi], k) >= threshold
                part = batch.slice(lo, hi - lo).select([0, 1])
                yield part.filter(pa.array(near))

    return map_batches(j, run, "a long, b long")


def across_components(members: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """Links (a, b) that join the components which a bucket's members are in, compared in full.

    ``members``: (bucket, n, id, component, signature, text). A bucket of n goes to n / BLOCK blocks and
    each pair of blocks to a group of its own, so a group holds about 2 BLOCK rows whatever the bucket's
    size. Pairs of different components whose signatures agree in the threshold less three standard errors
    are compared exactly, in the first bucket that they share, until their components are joined; no pair
    is ever a row."""
    margin = threshold - 3 * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    m = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("bucket", "band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                 "id", "component", "signature", "text", "own")

    def compare(pdf):
        ids, comp, own, band = (pdf[c].to_numpy() for c in ("id", "component", "own", "band"))
        x, y, band = pdf["x"].iloc[0], pdf["y"].iloc[0], int(band[0])
        sig = np.stack([np.frombuffer(s, np.uint32) for s in pdf["signature"]])
        text, h, c = shingles(*hash_words(pdf["text"].tolist()), k)
        at = np.searchsorted(text, np.arange(len(pdf) + 1))
        total = np.bincount(text, c, len(pdf))
        parent = {v: v for v in comp.tolist()}

        def root(v):
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        links = []
        for i in np.flatnonzero(own == x):
            j = np.flatnonzero((own == y) & (comp != comp[i]) & ((ids > ids[i]) if x == y else True))
            same = sig[j] == sig[i]
            near = same.mean(axis=1)
            shared = same.reshape(len(j), BANDS, ROWS).all(axis=2)
            fair = np.minimum(total[j], total[i]) >= threshold * np.maximum(total[j], total[i])
            first = shared.argmax(axis=1) == band if len(j) else np.zeros(0, bool)
            on = np.flatnonzero((near >= margin) & fair & first)
            hi, ci = h[at[i]:at[i + 1]], c[at[i]:at[i + 1]]
            for o in on[np.argsort(-near[on], kind="stable")].tolist():
                b = int(j[o])
                r, t = root(int(comp[i])), root(int(comp[b]))
                if r == t:
                    continue
                hb, cb = h[at[b]:at[b + 1]], c[at[b]:at[b + 1]]
                p = np.minimum(np.searchsorted(hb, hi), len(hb) - 1)
                both = np.minimum(ci, cb[p])[hb[p] == hi].sum()
                if both >= threshold * (total[i] + total[b] - both) - 1e-9:
                    parent[max(r, t)] = min(r, t)
                    links.append((int(min(ids[i], ids[b])), int(max(ids[i], ids[b]))))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return m.groupBy("bucket", "x", "y").applyInPandas(compare, "a long, b long").distinct()


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """(doc_id, copy_of, class_id) per row: the least doc_id with an equal text, and with a text linked
    to it through pairs that reach the threshold."""
    s = stored(signed(docs, k), "signatures")
    same = cut_lineage(s.where("doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("id")))
    nodes = s.where("weight > 0").join(same, "mark").where("doc_id = id").dropDuplicates(["mark"]).select("id", "signature")
    nodes = stored(nodes, "nodes")
    size = 4 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * size + 1, F.lit(size))))
    bands = nodes.select("id", F.posexplode(keys).alias("band", "bucket"))
    least = bands.groupBy("bucket").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    filled = stored(bands.join(least, "bucket"), "buckets")
    star = cut_lineage(filled.where("id <> a").select("a", F.col("id").alias("b")).distinct())
    links = stored(verified(star, docs, threshold, k), "links")
    # what one comparison a member left open: buckets of three or more that hold several components
    comp = components(links)
    rest = filled.where("n > 2").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rest = cut_lineage(rest.join(mixed, "bucket", "left_semi").select("bucket", "band", "n", "id", "component"))
    ids = rest.select(F.col("id").alias("doc_id")).distinct()
    texts = among(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), cut_lineage(ids))
    texts = texts.withColumnRenamed("doc_id", "id").join(nodes, "id")
    more = cut_lineage(across_components(rest.join(texts, "id"), threshold, k))
    final = comp if more.isEmpty() else components(links.union(more))
    out = s.select("doc_id", "mark").join(same, "mark", "left").join(final, "id", "left")
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("copy_of"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id")).alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each class, the least doc_id (null last), with all their columns.

    Rows are documents of their own even where doc_ids repeat or are null: such tables are told apart by a
    row number, written with them once."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        classes = cut_lineage(near_classes(docs))
        return among(docs, classes.where("doc_id <> class_id").select("doc_id").distinct(), "left_anti")
    own, named = unused(docs.columns, "_row"), unused(docs.columns, "_named")
    rows = stored(docs.withColumn(own, F.monotonically_increasing_id()), "numbered-rows")
    classes = cut_lineage(near_classes(rows.select(F.col(own).alias("doc_id"), "text")))
    names = rows.select(F.col(own).alias("doc_id"), F.col("doc_id").alias(named))
    least = F.min_by("doc_id", F.struct(F.col(named).isNull(), F.col(named), F.col("doc_id")))
    kept = classes.join(names, "doc_id").groupBy("class_id").agg(least.alias(own)).select(own)
    return rows.join(kept, own, "left_semi").select(*docs.columns)
