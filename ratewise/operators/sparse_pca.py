"""Principal components of 0/1 indicator rows, given as the positions of their ones.

The centred covariance C = (A'A - c c' / n) / (n - 1), c the column counts, is never formed on a wide
vocabulary. A vocabulary of at most ``EXACT`` tokens gives the product A'A (a bounded matrix, summed by
the executors) and its eigenvectors directly. A wider one is worked on in blocks of ``TILE`` tokens, which
stay distributed: a block Krylov basis is built by products A'(A z), each a join of tiles of A with blocks
of z and a sum, made orthonormal by small Gram matrices, and restarted from its Ritz vectors until the
leading eigenvalues settle. The driver holds small square matrices only.

Component signs are fixed so that the largest absolute loading is positive (the first one, of equals).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ratewise.session import checkpoint_dir

EXACT = 1024
TILE = 4096
KEEP = StorageLevel.MEMORY_AND_DISK


def loadings(rows: DataFrame, width: int, k: int, ones: str = "ones", exact: int = EXACT, tile: int = TILE,
             tolerance: float = 1e-10) -> tuple[DataFrame, list[float], list[float]]:
    """(position, loading) of the top ``k`` components (fewer where ``width`` is less), the mean's
    projection on each, and their variances. ``ones``: array of distinct positions below ``width``."""
    n = rows.count()
    k = min(k, width)
    if width <= exact or not n:
        vectors, shift, variance = _exact(rows, n, width, k, ones)
        table = rows.sparkSession.createDataFrame(
            [(i, v) for i, v in enumerate(vectors.tolist())], "position int, loading array<double>")
        return table, shift, variance
    return _krylov(rows, n, width, k, ones, tile, tolerance)


def project(rows: DataFrame, id_col: str, table: DataFrame, shift: list[float], k: int, prefix: str,
            ones: str = "ones") -> DataFrame:
    """(id_col, prefix0 .. prefix{k-1}): the centred rows on the components of :func:`loadings`; columns
    beyond them are 0. ``id_col`` names each row once."""
    cells = rows.select(id_col, F.explode(ones).alias("position")).join(table, "position")
    have = len(shift)
    sums = cells.groupBy(id_col).agg(F.lit(0).alias("_"), *[F.sum(F.col("loading")[j]).alias(f"s{j}") for j in range(have)])
    out = rows.select(id_col).join(sums, id_col, "left")
    return out.select(id_col, *[
        (F.coalesce(F.col(f"s{j}"), F.lit(0.0)) - shift[j] if j < have else F.lit(0.0)).alias(f"{prefix}{j}") for j in range(k)])


def _signs(best: np.ndarray) -> np.ndarray:
    return np.where(best < 0, -1.0, 1.0)


# ---- narrow vocabularies ------------------------------------------------------------------
def _exact(rows: DataFrame, n: int, width: int, k: int, ones: str):
    def gram(batches):
        total = np.zeros((width, width), np.int64)
        for b in batches:
            at = b.column(0)
            dense = np.zeros((b.num_rows, width), np.float32)
            dense[np.repeat(np.arange(b.num_rows), at.value_lengths().fill_null(0).to_numpy()), at.flatten().to_numpy()] = 1
            total += np.rint(dense.T @ dense).astype(np.int64)  # counts within a batch are exact as floats
        yield pa.record_batch({"g": pa.array([total.tobytes()], pa.binary())})

    if not n or not width:
        return np.zeros((width, k)), [0.0] * k, [0.0] * k
    parts = rows.select(ones).mapInArrow(gram, "g binary").rdd.map(lambda r: np.frombuffer(r[0], np.int64))
    g = parts.treeReduce(lambda a, b: a + b).reshape(width, width).astype(float)
    c = np.diag(g)
    values, vectors = np.linalg.eigh((g - np.outer(c, c) / n) / max(1, n - 1))
    order = np.argsort(-values, kind="stable")[:k]
    v = vectors[:, order]
    v = v * _signs(v[_first_largest(np.abs(v)), np.arange(k)])
    return v, (c @ v / n).tolist(), np.maximum(values[order], 0).tolist()


def _first_largest(a: np.ndarray) -> np.ndarray:
    """Row of each column's largest value, the first of those that are equal but for rounding."""
    return (a >= a.max(0) * (1 - 1e-9)).argmax(0)


# ---- wide vocabularies --------------------------------------------------------------------
class _Operator:
    """Products with the centred covariance over distributed blocks (block, rows x columns)."""

    def __init__(self, rows: DataFrame, n: int, width: int, ones: str, tile: int):
        self.n, self.blocks = n, -(-width // tile)
        self.size = lambda block: min(tile, width - block * tile)
        self.parts = max(1, min(self.blocks, rows.sparkSession.sparkContext.defaultParallelism))

        def tiles(p, it):
            counts, flat = [], []
            for r in it:
                counts.append(len(r[0] or ()))
                flat.extend(r[0] or ())
            if flat:
                row, col = np.repeat(np.arange(len(counts)), counts), np.array(flat, np.int64)
                block = col // tile
                order = np.lexsort((row, block))
                found, starts = np.unique(block[order], return_index=True)
                for b, at in zip(found.tolist(), np.split(order, starts[1:])):
                    yield b, (p, len(counts), row[at], col[at] - b * tile)

        self.tiles = rows.select(ones).rdd.mapPartitionsWithIndex(tiles).partitionBy(self.parts).persist(KEEP)
        self.by_rows = self.tiles.map(lambda t: (t[1][0], (t[0], *t[1][1:]))).persist(KEEP)
        self.counts = self._back(self.by_rows.mapValues(lambda t: (t, np.ones((t[1], 1))))).persist(KEEP)

    def _back(self, joined: RDD) -> RDD:
        """(block, A' y) from ((part, (tile, y)))."""
        size = self.size

        def back(x):
            (block, _, row, col), y = x[1]
            out = np.zeros((size(block), y.shape[1]))
            np.add.at(out, col, y[row])
            return block, out

        every = self.tiles.context.parallelize(range(self.blocks), self.parts)
        sums = joined.map(back).reduceByKey(lambda a, b: a + b, self.parts)
        return every.map(lambda b: (b, 0)).leftOuterJoin(sums, self.parts).map(
            lambda x: (x[0], x[1][1] if x[1][1] is not None else np.zeros((size(x[0]), 1))))

    def times(self, z: RDD) -> RDD:
        """C z."""
        def forth(x):
            (part, n_rows, row, col), block = x[1]
            out = np.zeros((n_rows, block.shape[1]))
            np.add.at(out, row, block[col])
            return part, out

        y = self.tiles.join(z, self.parts).map(forth).reduceByKey(lambda a, b: a + b, self.parts)
        w = self._back(self.by_rows.join(y, self.parts))
        mean = inner(self.counts, z) / self.n  # 1 x columns
        n = self.n
        return w.join(self.counts, self.parts).mapValues(
            lambda x: (x[0] - x[1] @ mean) / (n - 1) if x[0].shape[1] == mean.shape[1] else -(x[1] @ mean) / (n - 1))

    def random(self, columns: int) -> RDD:
        size = self.size
        return self.tiles.context.parallelize(range(self.blocks), self.parts).map(
            lambda b: (b, np.random.default_rng([7, b]).normal(size=(size(b), columns)))).partitionBy(self.parts)


def inner(a: RDD, b: RDD) -> np.ndarray:
    """a' b, a small matrix."""
    return a.join(b).map(lambda x: x[1][0].T @ x[1][1]).treeReduce(lambda x, y: x + y)


def _orthonormal(w: RDD, basis: RDD | None) -> RDD:
    """Columns of ``w`` made orthogonal to ``basis`` and orthonormal, dependent ones left out."""
    for _ in range(2):
        if basis is not None:
            c = inner(basis, w)
            w = w.join(basis).mapValues(lambda x, c=c: x[0] - x[1] @ c)
        w = w.persist(KEEP)
        values, vectors = np.linalg.eigh(inner(w, w))
        good = values > max(values.max(), 0) * 1e-12
        t = vectors[:, good] / np.sqrt(values[good])
        w = w.mapValues(lambda x, t=t: x @ t)
    return w.persist(KEEP)


def _krylov(rows: DataFrame, n: int, width: int, k: int, ones: str, tile: int, tolerance: float,
            depth: int = 5, restarts: int = 40):
    checkpoint_dir(rows.sparkSession)
    op = _Operator(rows, n, width, ones, tile)
    start, before = op.random(k + 8), None
    for _ in range(restarts):
        last = basis = _orthonormal(start, None)
        images = []
        for _ in range(depth):
            images.append(op.times(last).persist(KEEP))
            last = _orthonormal(images[-1], basis)
            if not last.first()[1].shape[1]:
                break
            basis = basis.join(last).mapValues(lambda x: np.hstack(x)).persist(KEEP)
        images.append(op.times(last).persist(KEEP))
        image = images[0]
        for more in images[1:]:
            image = image.join(more).mapValues(lambda x: np.hstack(x))
        small = inner(basis, image)[:, :inner(basis, basis).shape[0]]
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)[:k + 8]
        start = basis.mapValues(lambda x, v=vectors[:, order]: x @ v).persist(KEEP)
        start.checkpoint()
        values = np.maximum(values[order], 0)
        start.count()
        if before is not None and np.abs(values[:k] - before).max() <= tolerance * max(values[0], 1e-300):
            break
        before = values[:k]
    v = start.mapValues(lambda x: x[:, :k])
    largest = v.map(lambda x: (x[0], x[1][_first_largest(np.abs(x[1])), np.arange(x[1].shape[1])])).collect()
    best = np.array([b for _, b in sorted(largest, key=lambda x: x[0])])
    sign = _signs(best[_first_largest(np.abs(best)), np.arange(best.shape[1])])
    shift = (inner(op.counts, v)[0] * sign / n).tolist()
    cells = v.flatMap(lambda x: [(x[0] * tile + i, r.tolist()) for i, r in enumerate(x[1] * sign)])
    table = rows.sparkSession.createDataFrame(cells, "position int, loading array<double>")
    return table, shift, values[:k].tolist()
