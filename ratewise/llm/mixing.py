"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in Spark
expressions only.

1. Documents are cut into blocks of at most ``block_words`` words (or one block a document).
2. Each source gets a target in words: its weight's share of the mix, at most ``cap`` times its size,
   the excess shared among the others by weight.
3. The blocks of a source are permuted by a seeded hash. Whole passes give every block, a last partial
   pass gives the blocks of the permutation up to the rest of the target: the source's exact quota.
4. A tree halves the output shards. At each node the quota vector is split by sequential hypergeometric
   draws, as dealing the shuffled blocks would split it: shard totals are exact and disjoint.
5. Each shard takes its range of every source's permutation and is ordered by a second hash.

Defined results: a null source is a source of its own, last; null texts have size 0; a source whose
documents have no words has target 0; an empty table gives no rows; repeated rows count as rows, and rows
that share a doc_id but differ in any column are different rows. The choice depends only on the seed, the
rows and the settings, not on partitions (of rows that agree in every column, any may stand for another).
The tables of sources and tree nodes have one row or array entry per source: meant for up to some 10,000
sources, each with any number of rows; blocks are never gathered by source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import NOT_SPACE, few_files, numbered, stored
from ratewise.session import cut_lineage

#: Fixed values of the mix: weights by source order (repeating), size of the mix, most passes.
WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
BLOCK_WORDS, SHARDS, SEED = 256, 16, 17
#: Up to so many sources (of at most some 2 KB each) the table of cuts is broadcast to the texts.
BROADCAST_SOURCES = 10_000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source_no, source, source_size, target) from rows (source, size), one row per source.

    The final shares are a common level x weight, but at most cap x size: sorted by cap x size / weight,
    the first source that the level leaves uncapped fixes the level. Windows here run over the table of
    sources only."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = s.withColumn("source_no", F.row_number().over(order) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1))
    s = s.withColumn("limit", F.col("source_size") * F.lit(cap))
    ratio = Window.orderBy(F.col("limit") / F.col("w"), "source_no")
    every = ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier, rest = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(share)
    level = (total - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("w").over(rest)
    s = s.withColumn("level", F.when(level * F.col("w") <= F.col("limit"), level))
    s = s.withColumn("level", F.max("level").over(every))
    return s.select("source_no", "source", "source_size",
                    F.least("limit", F.coalesce(F.col("level") * F.col("w"), F.col("limit"))).alias("target"))


def hypergeometric(u: Column, draws: Column, good: Column, total: Column) -> Column:
    """How many of ``draws`` from ``total`` are among its ``good``, by inversion of ``u`` in [0, 1).

    Weights run by the ratio of neighbouring terms over nine standard deviations around the mean, all
    values that a double can tell apart."""
    m, k, n = draws.cast("double"), good.cast("double"), total.cast("double")
    mean = F.when(n > 0, m * k / F.greatest(n, F.lit(1.0))).otherwise(0.0)
    dev = F.sqrt(F.greatest(mean * (1 - k / F.greatest(n, F.lit(1.0))), F.lit(0.0))) * 9 + 3
    low = F.greatest(F.lit(0.0), m + k - n, F.floor(mean - dev)).cast("long")
    high = F.least(m, k, F.ceil(mean + dev)).cast("long")
    steps = F.sequence(low, F.greatest(high, low))

    def following(w, x):  # term at x + 1 over term at x
        return w * (k - x) * (m - x) / ((x + 1) * F.greatest(n - k - m + x + 1, F.lit(1.0)))

    mass = F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), lambda acc, x: F.struct(
        following(acc["w"], x.cast("double")).alias("w"), (acc["sum"] + acc["w"]).alias("sum")), lambda acc: acc["sum"])
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), low.alias("at"), (u * mass).alias("goal"))
    return F.aggregate(steps, start, lambda acc, x: F.struct(
        following(acc["w"], x.cast("double")).alias("w"), (acc["sum"] + acc["w"]).alias("sum"),
        F.when(acc["sum"] <= acc["goal"], x).otherwise(acc["at"]).alias("at"), acc["goal"].alias("goal")),
        lambda acc: acc["at"])


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, cuts) from (source_no, quota): ascending ends of each shard's range of the draws.

    ``shards`` is a power of two. One row per tree node with the vector of all sources."""
    q = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("q"))
    q = q.select(F.lit(0).alias("node"), "q")
    width = shards
    while width > 1:
        size = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        start = F.struct(F.floor(size / 2).cast("long").alias("draws"), size.alias("total"),
                         F.array().cast("array<bigint>").alias("left"))

        level = F.lit(width)

        def deal(acc, x):
            u = F.pmod(F.xxhash64(F.lit(seed), level, F.col("node"), x["source_no"]), F.lit(1 << 52)) / float(1 << 52)  # noqa: B023
            got = F.when(acc["total"] <= x["quota"], acc["draws"]).otherwise(
                hypergeometric(u, acc["draws"], x["quota"], acc["total"]))
            return F.struct((acc["draws"] - got).alias("draws"), (acc["total"] - x["quota"]).alias("total"),
                            F.concat(acc["left"], F.array(got)).alias("left"))

        q = cut_lineage(q.withColumn("left", F.aggregate("q", start, deal, lambda acc: acc["left"])))
        part = lambda f: F.transform("q", lambda x, i: F.struct(x["source_no"].alias("source_no"), f(x, i).alias("quota")))
        left = part(lambda x, i: F.get("left", i))
        right = part(lambda x, i: x["quota"] - F.get("left", i))
        q = q.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), left.alias("q")),
                                       F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))).alias("n")).select("n.*")
        width //= 2
    leaf = q.select("node", F.explode("q").alias("x")).select("node", "x.*")
    by = Window.partitionBy("source_no").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    leaf = leaf.withColumn("end", F.sum("quota").over(by))
    return leaf.groupBy("source_no").agg(F.array_sort(F.collect_list("end")).alias("cuts"))


def row_mark(docs: DataFrame) -> Column:
    """A hash of a whole row, in which NULL differs from any value."""
    return F.xxhash64(*[x for c in docs.columns for x in (F.col(c).isNull(), F.col(c))])


def block_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "mark", "block")


def block_place(seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), "shard", "doc_id", "mark", "block", "pass")


ORDER = ["key", "doc_id", "mark", "block", "row"]


def _dealt(docs: DataFrame, block_words: int | None, weights, share: float, cap: float, shards: int, seed: int):
    """(rows, blocks, sources): every input row, all numbered blocks with their copies, and per source its
    number of blocks, its quota and the cuts that the tree gives its draws.

    Blocks are checkpointed once, numbered; what follows from them and from the tables of sources is computed
    again where it is used."""
    files = few_files(docs.sparkSession)
    sized = cut_lineage(docs.select("doc_id", "source", n_words("text").alias("size"), row_mark(docs).alias("mark"))
                        .withColumn("row", F.monotonically_increasing_id()))
    targets = cut_lineage(source_targets(sized, weights, share, cap))
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(sized["source"])
    per = F.lit(block_words) if block_words else F.greatest("size", F.lit(1))
    b = rows.where("size > 0").select(
        "row", "doc_id", "mark", "source_no", "source_size", "target", "size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / per).cast("long"))).alias("block"))
    b = b.withColumn("words", F.least(per, F.col("size") - F.col("block") * per).cast("long")).withColumn("key", block_key(seed))
    b = numbered(b.drop("size"), ["source_no"], ORDER, "words", files=files)
    passes = F.floor(F.col("target") / F.col("source_size")).cast("int")
    rest = F.col("target") - passes * F.col("source_size")
    b = b.withColumn("passes", passes).withColumn("copies", passes + F.when(
        F.col("before") + F.col("words") / 2 <= rest, 1).otherwise(0))
    quota = b.groupBy("source_no").agg(F.sum("copies").cast("long").alias("quota"), F.count(F.lit(1)).alias("blocks"),
                                       F.max("passes").alias("passes"))
    quota = cut_lineage(quota.coalesce(files))
    cuts = split_quotas(quota.select("source_no", "quota"), shards, seed)
    sources = quota.join(cuts, "source_no").join(targets.select("source_no", "source"), "source_no")
    return rows, b, cut_lineage(sources.coalesce(files))


def mix_blocks(docs: DataFrame, block_words: int | None = BLOCK_WORDS, weights=WEIGHTS, share: float = SHARE,
               cap: float = CAP, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, draws): every input row (row, doc_id, source_no, size, source_size, target), and the blocks
    that the mix takes (row, doc_id, mark, source_no, block, first_word, words, pass, shard, place)."""
    rows, b, sources = _dealt(docs, block_words, weights, share, cap, shards, seed)
    meta = sources.select("source_no", "blocks", "cuts")
    d = b.where("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).join(meta, "source_no")
    draw = F.col("pass").cast("long") * F.col("blocks") + F.col("rank")
    d = d.withColumn("shard", F.size(F.filter("cuts", lambda c: c <= draw))).withColumn("place", block_place(seed))
    first = F.col("block") * (F.lit(block_words) if block_words else F.lit(0))
    return rows.drop("source"), d.select("row", "doc_id", "mark", "source_no", "block", first.alias("first_word"), "words", "pass", "shard", "place")


def shuffled(draws: DataFrame) -> DataFrame:
    """The draws in output order: by shard, and within a shard by the second hash. Range partitions may
    cut a shard into several files, so no shard has to fit in one task."""
    keys = ["shard", "place", "row", "block", "pass"]
    return draws.repartitionByRange(*keys).sortWithinPartitions(*keys)


def mix_digest(docs: DataFrame) -> DataFrame:
    """Per document, read back from the written shards: the words and blocks that the mix takes of it, and
    the shards that they are in."""
    rows, draws = mix_blocks(docs)
    written = stored(shuffled(draws).select("row", "shard", "words"), "mixed-blocks")
    taken = written.groupBy("row").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("n_blocks"),
                                       F.array_sort(F.collect_set("shard")).alias("shards"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
        F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))


def _cut_keys(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, passes, extra, cuts) per source: the place in the permutation (``ORDER``) before which blocks
    get one copy more than ``passes`` (NULL: all or none, as ``more`` says), and where shards begin, as (pass,
    place)."""
    place = F.struct(*ORDER).alias("place")
    s = sources.withColumn("extra", F.col("quota") - F.col("passes") * F.col("blocks"))
    ends = s.select("source_no", F.posexplode("cuts").alias("shard", "cut"), "blocks")
    ends = ends.select("source_no", F.floor(F.col("cut") / F.col("blocks")).cast("int").alias("pass"), (F.col("cut") % F.col("blocks")).alias("rank"))
    ends = ends.unionByName(s.where("extra < blocks").select("source_no", F.lit(-1).alias("pass"), F.col("extra").alias("rank")))
    at = blocks.select("source_no", "rank", place)
    found = ends.join(at, ["source_no", "rank"]).groupBy("source_no").agg(
        F.max(F.when(F.col("pass") < 0, F.col("place"))).alias("extra"),
        F.collect_list(F.when(F.col("pass") >= 0, F.struct("pass", "place"))).alias("cuts"))
    return s.select("source_no", "source", "passes").join(found, "source_no").drop("source_no")


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
                  shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents with all their columns, whole documents as blocks: one that is taken twice
    stands twice. Rows come in shard and place order, which part files follow when they are written.

    A document finds its copies and shards by comparing its place in its source's permutation with the
    places where the tree cuts it, so its text moves once, straight to its place."""
    _, blocks, sources = _dealt(docs, None, weights, share, cap, shards, seed)
    cuts = cut_lineage(_cut_keys(blocks, sources).coalesce(few_files(docs.sparkSession)))
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    d = docs.select(F.struct(*docs.columns).alias("d"), F.col("doc_id"), F.col("source").alias("of"), row_mark(docs).alias("mark"),
                    F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("row"),
                    F.coalesce(F.col("text").rlike(NOT_SPACE), F.lit(False)).alias("words"))
    d = d.where("words").withColumn("key", block_key(seed)).withColumn("place", F.struct(*ORDER))
    d = d.join(cuts, F.col("of").eqNullSafe(F.col("source")))
    copies = F.col("passes") + F.when(F.col("extra").isNull() | (F.col("place") < F.col("extra")), 1).otherwise(0)
    d = d.withColumn("pass", F.explode(F.filter(F.sequence(F.lit(0), copies), lambda i: i < copies)))
    here = F.struct(F.col("pass"), F.col("place"))
    d = d.withColumn("shard", F.size(F.filter("cuts", lambda c: c <= here)))
    d = d.select("d", "shard", block_place(seed).alias("place"), "doc_id", "mark", "pass")
    keys = ["shard", "place", "doc_id", "mark", "pass"]
    return d.repartitionByRange(*keys).sortWithinPartitions(*keys).select("d.*")
