"""Product quantisation of integer vectors by cover-tree Lloyd rounds.

A vector is cut into equal consecutive parts; each part position has a codebook of ``entries``. Tasks
turn their vectors once into blocks of at most ``BLOCK``, each with a cover tree per part position: a
node holds a centre point, the radius of its subtree and the range of its points, whose sums are
differences of cumulative sums. A Lloyd round walks the trees from their roots with the codebook at
hand. If the triangle inequality says that no other entry can be nearest (or tied) for any point of a
node's ball, the whole subtree goes to one entry with its count and sum; ambiguous nodes open their
children, and ambiguous leaves compare their points exactly. All numbers that decide are integers, so
the result does not depend on how vectors are dealt to blocks.

The work in Spark: one pass builds the blocks and writes them as a table in the shared scratch folder;
each round is a pass over it that yields one row a task and entry, summed by (part, entry, component).
The codebooks (parts x entries x components) are all that the driver holds or sends.

Defined results: rows are dropped whose vector is null or holds a null, NaN or infinite component; each
component x becomes floor(scale * x), and those beyond +-2^24 become that bound; shorter vectors are
filled up with zeros to the longest, and that to a multiple of ``parts`` (empty vectors are all zeros);
entries start as the parts of the smallest ids (ties by vector, null ids last) and are fewer where rows
are; equal distances take the lower entry; unused entries stay; rows that repeat all stay; an empty
table gives no rows. Other columns stay, save that ``code`` and ``error`` are set.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ratewise.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 2048
LEAF = 16
BOUND = 1 << 24
TREE = "struct<points:binary,place:binary,nodes:binary,radius:binary>"


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: in floats where they can't pass 2^53."""
    most = max([1, *(int(np.abs(x).max()) for x in (a, b) if x.size)])
    kind = np.float64 if (2 * most) ** 2 * max(1, a.shape[1]) < 1 << 53 else np.int64
    a, b = a.astype(kind), b.astype(kind)
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


class CoverTree:
    """A cover tree over integer rows. Children of a node of scale s have centres more than s / 2 apart
    and hold the points within s / 2 of them; the node's own centre is one of them.

    ``points`` are in tree order (``place``: their rows of the input), ``nodes`` rows are (start, end,
    first child, children) with the centre at ``start``, ``radius`` the exact greatest distance."""

    def __init__(self, points, place, nodes, radius):
        self.points, self.place, self.nodes, self.radius = points, place, nodes, radius

    @classmethod
    def build(cls, x: np.ndarray) -> CoverTree:
        place = np.arange(len(x))
        far = np.sqrt(square_distances(x, x[:1])[:, 0]).astype(float)
        nodes, radius = [[0, len(x), 0, 0]], [far.max()]
        todo = [(0, far.max())]
        while todo:
            at, scale = todo.pop()
            start, end = nodes[at][:2]
            if radius[at] == 0 or end - start <= LEAF:
                continue
            half = min(scale, radius[at]) / 2
            rest, groups = place[start:end], []
            while len(rest):
                d = np.sqrt(square_distances(x[rest], x[rest[:1]])[:, 0])
                near = d <= half
                groups.append((rest[near], d[near].max()))
                rest = rest[~near]
            nodes[at][2:] = len(nodes), len(groups)
            for members, r in groups:
                place[start:start + len(members)] = members
                todo.append((len(nodes), half))
                nodes.append([start, start + len(members), 0, 0])
                radius.append(r)
                start += len(members)
        return cls(x[place], place, np.array(nodes, np.int64), np.array(radius, float))

    def assign(self, entries: np.ndarray):
        """(ranges (start, end, entry) of points in tree order, entry of single points by position, their
        positions): each point in one of the two, with the lowest of its nearest entries."""
        ranges, singles, front = [], [], np.zeros(1, np.int64)
        while len(front):
            start, end, child, children = self.nodes[front].T
            d = square_distances(self.points[start], entries)
            best = d.argmin(1)
            d = np.sqrt(d.astype(float))
            least = d[np.arange(len(front)), best]
            d[np.arange(len(front)), best] = np.inf
            reach = (least + 2 * self.radius[front]) * (1 + 1e-9) + 1e-9
            sure = (self.radius[front] == 0) | (d.min(1) > reach)
            ranges.append(np.stack([start[sure], end[sure], best[sure]], 1))
            leaf = ~sure & (children == 0)
            singles += [np.arange(s, e) for s, e in zip(start[leaf], end[leaf])]
            inner = ~sure & (children > 0)
            front = np.concatenate([np.arange(c, c + n) for c, n in zip(child[inner], children[inner])] or [np.zeros(0, np.int64)])
        at = np.concatenate(singles) if singles else np.zeros(0, np.int64)
        return np.concatenate(ranges), square_distances(self.points[at], entries).argmin(1), at

    def sums(self, entries: np.ndarray):
        """(count, sum) of the points of each entry, whole subtrees by cumulative sums."""
        ranges, nearest, at = self.assign(entries)
        run = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=run[1:])
        count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        np.add.at(count, ranges[:, 2], ranges[:, 1] - ranges[:, 0])
        np.add.at(total, ranges[:, 2], run[ranges[:, 1]] - run[ranges[:, 0]])
        np.add.at(count, nearest, 1)
        np.add.at(total, nearest, self.points[at])
        return count, total

    def codes(self, entries: np.ndarray):
        """(entry, squared distance) of every row of the input, in its order."""
        ranges, nearest, at = self.assign(entries)
        code = np.zeros(len(self.points), np.int64)
        for s, e, k in ranges:
            code[s:e] = k
        code[at] = nearest
        gap = self.points - entries[code]
        out = np.empty_like(code), np.empty_like(code)
        out[0][self.place], out[1][self.place] = code, (gap * gap).sum(1)
        return out

    def packed(self) -> dict:
        return {"points": self.points.astype(np.int32).tobytes(), "place": self.place.astype(np.int32).tobytes(),
                "nodes": self.nodes.astype(np.int32).tobytes(), "radius": self.radius.tobytes()}

    @classmethod
    def unpacked(cls, t: dict) -> CoverTree:
        read = lambda k: np.frombuffer(t[k], np.int32).astype(np.int64)
        place = read("place")
        return cls(read("points").reshape(len(place), -1), place, read("nodes").reshape(-1, 4), np.frombuffer(t["radius"], float))


@contextmanager
def batches_of(spark, rows: int):
    """Spark hands Python at most ``rows`` rows at once in jobs that run within."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def integer_vectors(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """(row, v): the rows that are kept, as one struct, and their integer vector."""
    v = F.col(vector).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(float(-BOUND))), F.lit(float(BOUND)))).cast("int"))
    row = [c for c in vectors.columns if c not in (vector, "code", "error")]
    return vectors.where(v.isNotNull() & ~odd).select(F.struct(*row).alias("row"), whole.alias("v"))


def _blocks(kept: DataFrame, width: int, parts: int, block: int) -> DataFrame:
    """(rows, trees): blocks of rows with a cover tree for each part position, as a stored table."""
    m = width // parts

    def pack(rows, vectors):
        x = np.zeros((len(vectors), width), np.int64)
        for i, v in enumerate(vectors):
            x[i, :len(v)] = v
        return pa.record_batch({"rows": pa.array([rows], schema.field("rows").type),
                                "trees": pa.array([[CoverTree.build(x[:, p * m:(p + 1) * m]).packed() for p in range(parts)]], schema.field("trees").type)})

    def run(batches):
        rows, vectors = [], []
        for b in batches:
            rows += b.column("row").to_pylist()
            vectors += b.column("v").to_pylist()
            while len(rows) >= block:
                yield pack(rows[:block], vectors[:block])
                rows, vectors = rows[block:], vectors[block:]
        if rows:
            yield pack(rows, vectors)

    kind = StructType.fromDDL(f"rows array<{kept.schema['row'].dataType.simpleString()}>, trees array<{TREE}>")
    schema = to_arrow_schema(kind)
    return stored(kept.mapInArrow(run, kind), "vector-blocks")


def lloyd_round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all blocks."""
    def run(batches):
        total = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
        for batch in batches:
            for trees in batch.column("trees").to_pylist():
                for (count, s), t, book in zip(total, trees, books):
                    c, more = CoverTree.unpacked(t).sums(book)
                    count += c
                    s += more
        out = [(p, k, int(count[k]), s[k].tolist()) for p, (count, s) in enumerate(total) for k in np.flatnonzero(count)]
        part, entry, n, sums = zip(*out) if out else ((), (), (), ())
        yield pa.record_batch({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()),
                               "n": pa.array(n, pa.int64()), "sums": pa.array(sums, pa.list_(pa.int64()))})

    with batches_of(blocks.sparkSession, 8):
        found = blocks.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
        found = found.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "x"))
        found = found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = [b.copy() for b in books]
    for r in found:
        if r["at"] is not None:
            out[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return out


def vector_codes(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK):
    """(rows, codebooks): every kept row's other columns with ``code`` (entries in part order, two hex
    digits each) and ``error`` (squared distances, summed over the parts), and the final codebooks, one
    array (entries, components) a part."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, vector, scale)
    width = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-width // parts) * parts
    m = width // parts
    first = kept.orderBy(F.col("row")[id_col].asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r["v"])] = r["v"]
    books = [start[:, p * m:(p + 1) * m] for p in range(parts)]
    blocks = _blocks(kept, width, parts, block)
    for _ in range(rounds if len(first) else 0):
        books = lloyd_round(blocks, books)

    def coded(batches):
        for b in batches:
            for i, trees in enumerate(b.column("trees").to_pylist()):
                found = [CoverTree.unpacked(t).codes(book) for t, book in zip(trees, books)]
                codes = ["".join(f"{k:02x}" for k in row) for row in zip(*(c.tolist() for c, _ in found))]
                yield pa.record_batch({
                    "rows": b.column("rows").slice(i, 1), "code": pa.array([codes], pa.list_(pa.string())),
                    "error": pa.array([sum(e for _, e in found).tolist()], pa.list_(pa.int64()))})

    row_type = kept.schema["row"].dataType.simpleString()
    with batches_of(spark, 8):
        done = stored(blocks.mapInArrow(coded, f"rows array<{row_type}>, code array<string>, error array<long>"), "vector-codes")
    done = done.select(F.explode(F.arrays_zip("rows", "code", "error")).alias("r"))
    return done.select(*[F.col("r.rows")[f].alias(f) for f in kept.schema["row"].dataType.names], "r.code", "r.error"), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for b in books for entry in b.tolist() for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def code_digest(vectors: DataFrame) -> DataFrame:
    """Code and error of every kept vector, the errors of its label, and a digest of the codebooks."""
    rows, books = vector_codes(vectors.select("vec_id", "embedding", "label"))
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
