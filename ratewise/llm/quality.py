"""Quality classifier from compressed sizes.

Two zstandard dictionaries are trained, on good and on bad labelled texts. Each whole text is compressed
with either and with none, in equal pieces of at most ``PIECE`` bytes that each start from the dictionary
alone, so that it weighs the same all along a long text; the normalised difference of the summed sizes,
with the mean sizes per byte of a piece, goes through a logistic curve calibrated on other labelled texts,
weighted to the label counts of all training rows.

Fitting uses at most ``sample_rows`` documents a class, chosen by a hash of doc_id: about half of them for
the dictionaries, whole texts in samples of up to ``SAMPLE`` bytes, which the driver gets (keep the row bound
to what it can hold), and the others for the curve, whole texts as in scoring, of which it gets five numbers each. Where
the samples are too few to train on, a dictionary is their last ``DICTIONARY_BYTES`` as they are. Scoring
reads every whole text and nothing but the text.

Defined results: a null text is the empty string; labels that are null or whose doc_id has no document
are not used; a doc_id labelled twice counts with its lower label; with labels of one class or none
every score is the share of label 1 (one half where there are none). Repeated rows score alike; an
empty table gives no rows. Other columns stay, save that score_quality sets its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import map_batches, unused

SAMPLE_ROWS, DICTIONARY_BYTES, LEVEL, THRESHOLD = 4000, 112640, 3, 0.3
#: Bytes of a piece: a longer one learns from its own start, and the dictionary no longer matters.
PIECE = 4096
#: Bytes of a training sample: longer texts give several.
SAMPLE = 8192


@dataclass
class QualityModel:
    prior: float
    good: bytes | None = None
    bad: bytes | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None


def held_out(doc_id) -> Column:
    """Rows that are never learned from: crc32 of doc_id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _dictionary(samples: list[bytes]) -> bytes:
    """Raw or trained content; few samples are used as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:] or b" "


def _pieces(text: bytes) -> list[bytes]:
    """The text in the fewest equal pieces of at most ``PIECE`` bytes; an empty text is one piece."""
    step = max(-(-len(text) // max(-(-len(text) // PIECE), 1)), 1)
    return [text[i:i + step] for i in range(0, max(len(text), 1), step)]


def _samples(text: bytes) -> list[bytes]:
    return [text[i:i + SAMPLE] for i in range(0, len(text), SAMPLE)]


class _Features:
    def __init__(self, good: bytes, bad: bytes):
        self.packers = [zstandard.ZstdCompressor(level=LEVEL)]
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        rows = []
        for t in texts:
            parts = _pieces(t)
            rows.append([x / len(parts) for x in (len(t), *(sum(len(p.compress(x)) for x in parts) for p in self.packers))])
        n, plain, good, bad = np.array(rows, float).reshape(-1, 4).T
        per = n + 32
        return np.stack([(bad - good) / np.maximum(good, bad), plain / per, good / per, bad / per, np.log(per)], axis=1)


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray):
    """Weighted logistic regression by Newton steps with a small ridge."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    z = np.c_[z[:, :-1], z[:, :-1] ** 2, z[:, -1:]]
    beta = np.zeros(z.shape[1])
    ridge = 0.05 * w.sum() / len(w)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        h = (z * (w * p * (1 - p))[:, None]).T @ z + (ridge + 1e-9) * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(h, z.T @ (w * (y - p)) - ridge * beta), -4, 4)
    return mean, scale, beta


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from the labelled rows that are not held out; one more pass over ``docs`` for the curve."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    ids = {}
    for y in (0, 1):
        picked = known.where(F.col("y") == y).select(F.col("doc_id").alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
        # at most sample_rows ids: a proven bound
        rows = docs.select("doc_id").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select(F.xxhash64("doc_id").alias("h"), "doc_id")
        ids[y] = sorted({tuple(r) for r in rows.distinct().collect()})
    if min(len(ids[0]), len(ids[1])) < 2:
        return QualityModel(prior)
    learn = docs.sparkSession.createDataFrame([(d, y) for y in (0, 1) for _, d in ids[y][::2]], known.schema)
    rows = docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id").select(
        "y", F.xxhash64("doc_id").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    rows = sorted(rows.collect())
    good, bad = (_dictionary([p for r in rows if r["y"] == y for p in _samples(r["text"].encode())]) for y in (1, 0))
    del rows
    # again at most sample_rows ids a class
    held = docs.sparkSession.createDataFrame([(d, y) for y in (0, 1) for _, d in ids[y][1::2]], known.schema)
    texts = docs.select("doc_id", "text").join(F.broadcast(held), "doc_id").select("y", "text")

    def run(batches):
        features = _Features(good, bad)
        for b in batches:
            x = features([(t or "").encode() for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    rows = sorted((r["y"], r["x"]) for r in map_batches(texts, run, "y int, x array<double>").collect())
    x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows], float)
    w = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    return QualityModel(prior, good, bad, *_curve(x, y, w * len(w) / w.sum()))


def score_quality(docs: DataFrame, model: QualityModel, column: str = "quality_score") -> DataFrame:
    """``docs`` with ``column``, a score in [0, 1], set; one pass over the texts, nothing is shuffled."""
    docs = docs.drop(column)
    schema = docs.select("*", F.lit(0.0).alias(column)).schema
    at = docs.columns.index("text")

    def run(batches):
        features = _Features(model.good, model.bad) if model.good is not None else None
        for b in batches:
            scores = np.full(b.num_rows, model.prior)
            if features is not None and b.num_rows:
                x = (features([(t or "").encode() for t in b.column(at).to_pylist()]) - model.mean) / model.scale
                # row by row: a matrix product rounds by the size of the batch
                z = (np.c_[x, x ** 2, np.ones(len(x))] * model.weights).sum(axis=1)
                scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores)], names=[*b.schema.names, column])

    return map_batches(docs, run, schema)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    score = unused(docs.columns, "quality_score")
    return score_quality(docs, fit_quality(docs, labels), score).where(F.col(score) >= threshold).select(*docs.columns)
