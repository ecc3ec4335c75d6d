"""Order MinHash fingerprints with Spark expressions only.

The words of a text (split at ASCII white space) give its k-mers of ``k`` words; the n-th occurrence
of a k-mer counts as an element of its own. Each register ranks all elements by their hash less the
register's own start, modulo the range of hashes: a ring on which the ``bins`` registers start at equal
distances. The ``pick`` first elements from there, however far they lie, are put back into text order, and
their k-mer hashes hashed as a tuple: reordering changes the tuple, so likeness follows the edit distance
and not only the shared k-mers. One sorted hash pass serves all registers. Each register alone is as with a
permutation of its own; those that share elements, as in texts of fewer k-mers than registers, go together,
so that likeness spreads more around the same mean.

Defined results: a null text is the empty string; a text of 1 to k - 1 words has one k-mer of all its
words; a text of fewer than ``pick`` k-mers has all of them in every register; a text without words has
every register empty. Fingerprint: ``bins`` fields of 8 hex digits,
joined by colons, an empty register with none. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import SPACE, let, position_in, range_bounds, shuffle_partitions

RUN = 31  # an occurrence number is found in this many halvings: any array length


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = 5, bins: int = 64, pick: int = 2) -> DataFrame:
    """``df`` with the Order MinHash of column ``text`` as ``name``; ``bins`` is a power of two."""
    shift = 64 - (bins.bit_length() - 1)
    none = F.array().cast("array<bigint>")
    words = F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r")), SPACE)
    d = df.withColumn("_w", F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))
    last = F.greatest(F.size("_w") - k, F.lit(0))
    d = d.withColumn("_h", F.when(F.size("_w") == 0, none).otherwise(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)])))).drop("_w")
    # only where a k-mer repeats: (hash, position) sorted, so that its occurrences stand side by side in text order
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    halvings = F.array(*[F.lit(1 << j) for j in reversed(range(RUN - 1))])

    high = F.lit(-1 << 32)
    pack = lambda v, at: v.bitwiseAND(high).bitwiseOR(at.cast("long"))  # noqa: E731  32 bits of hash, then the position

    def nth(x, i):
        s = F.col("_s")
        run = F.aggregate(halvings, F.lit(0), lambda acc, step: F.when(
            (i - acc >= step) & (F.get(s, i - acc - step)["h"] == x["h"]), acc + step).otherwise(acc))
        return pack(F.xxhash64(x["h"], F.when((i > 0) & (F.get(s, i - 1)["h"] == x["h"]), run).otherwise(0)), x["at"])

    # the occurrence-numbered k-mers by hash; sorting longs is several times faster than sorting structs
    d = d.withColumn("_e", F.sort_array(F.when(F.col("_s").isNull(), F.transform(
        "_h", lambda h, i: pack(F.xxhash64(h, F.lit(0)), i))).otherwise(F.transform("_s", nth)))).drop("_h", "_s")
    e = F.col("_e")
    bin_of = lambda x: F.shiftright(x, shift)  # noqa: E731  -bins / 2 to bins / 2 - 1, in the order of the longs
    starts = F.filter(F.transform(e, lambda x, i: F.when((i == 0) | (bin_of(F.get(e, i - 1)) != bin_of(x)), i)),
                      lambda i: i.isNotNull())

    def register(i):
        near = F.filter(F.array(*[F.get(e, F.when(F.size(e) > j, (i + j) % F.size(e))) for j in range(pick)]), lambda x: x.isNotNull())
        ordered = F.sort_array(F.transform(near, lambda x: F.struct(
            x.bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), F.shiftrightunsigned(x, 32).alias("v"))))
        word = F.xxhash64(F.transform(ordered, lambda x: x["v"])).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.struct(bin_of(F.get(e, i)).cast("int").alias("bin"), F.lpad(F.hex(word), 8, "0").alias("value"))

    half = bins // 2

    def ring(r):
        # a register without an element of its own goes on to the next that has one, the last ones to the first
        before = lambda j: F.when(j == 0, -half - 1).otherwise(F.get(r, j - 1)["bin"])
        up = F.flatten(F.transform(r, lambda x, j: F.array_repeat(x["value"], x["bin"] - before(j))))
        full = F.concat(up, F.array_repeat(F.get(r, F.lit(0))["value"], bins - F.size(up)))
        return F.when(F.size(r) == 0, F.array_repeat(F.lit(""), bins)).otherwise(
            F.concat(F.slice(full, half + 1, half), F.slice(full, 1, half)))

    fields = let(let(F.transform(starts, register), ring), lambda x: F.array_join(x, ":"))
    return d.withColumn(name, fields).drop("_e")


def likeness(a: Column, b: Column, bins: int = 64) -> Column:
    """Share of the registers filled in either fingerprint that agree; 1 for equal fingerprints."""
    def compare(x, y):
        filled = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: (F.get(x, i) != "") | (F.get(y, i) != "")))
        same = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: (F.get(x, i) != "") & (F.get(x, i) == F.get(y, i))))
        return same / F.greatest(filled, F.lit(1))

    parts = let(F.struct(F.split(a, ":").alias("a"), F.split(b, ":").alias("b")), lambda p: compare(p["a"], p["b"]))
    return F.when(a == b, F.lit(1.0)).otherwise(parts)


def with_next(docs: DataFrame, cols: list[str], make) -> DataFrame:
    """``make(docs)`` with, for each of ``cols``, ``next_<col>`` from the next document by doc_id.

    After the last document comes the first. Text moves once: rows go to buckets of contiguous doc_id
    (quantile bounds, 8 a shuffle partition), and each bucket also gets a copy of the first row after
    it, so that a window within the bucket sees every neighbour. Null doc_ids come first; rows of
    equal doc_id go by text."""
    n = 8 * shuffle_partitions(docs.sparkSession)
    cuts = range_bounds(docs.select(F.col("doc_id").cast("double")), "doc_id", n)
    bounds = F.array(*[F.lit(x) for x in cuts]) if cuts else F.array().cast("array<double>")
    d = docs.withColumn("_bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(
        position_in(F.col("doc_id").cast("double"), bounds, len(cuts))))
    # one row a bucket, so bounded by n: the first document of the bucket that follows (the first of all at the end)
    firsts = d.groupBy("_bucket").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-1 << 63)).alias("id"))).alias("f"))
    by = Window.orderBy("_bucket")
    firsts = firsts.select(F.col("_bucket").alias("_own"), F.col("f.id").alias("_id"), F.coalesce(
        F.lag("_bucket").over(by), F.max("_bucket").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"))
    j = d.join(F.broadcast(firsts), (F.coalesce(d["doc_id"], F.lit(-1 << 63)) == firsts["_id"]))
    head = j.groupBy("_to").agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*", F.col("_to").alias("_bucket"))
    both = make(d).withColumn("_edge", F.lit(0)).unionByName(make(head).withColumn("_edge", F.lit(1)))
    w = Window.partitionBy("_bucket").orderBy("_edge", "doc_id", "text")
    out = both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return out.where("_edge = 0").drop("_edge", "_bucket")


def edited_fingerprints(docs: DataFrame, k: int = 5, bins: int = 64, pick: int = 2) -> DataFrame:
    """Each text, its edited form (the last half replaced by the start of the next document) and the
    fingerprints of both and of the next document."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = with_next(d, ["text", "fingerprint"], lambda x: with_fingerprint(x, "text", "fingerprint", k, bins, pick))
    half = F.floor(F.length("text") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.length("text") - half),
                                        F.substr("next_text", F.lit(1), half))).drop("next_text")
    d = d.withColumn("n_chars", F.length("text").cast("long")).drop("text")
    return with_fingerprint(d, "edited", "edited_fingerprint", k, bins, pick)


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    d = edited_fingerprints(docs)
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
