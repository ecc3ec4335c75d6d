"""Helpers shared by the corpus operators: numbering, components, search in bounds, scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.session import cut_lineage, scratch_path

#: Separators of words: the ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch root and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows in a batch that Spark hands to Python: a few MB of common documents.
ARROW_ROWS = 1000


def few_files(spark: SparkSession) -> int:
    """How many files a narrow table is checkpointed in: an eighth of the shuffle partitions, which wide rows
    set, but two a core. Hadoop's local file system starts a process for each file that it makes."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-shuffle_partitions(spark) // 8))


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of ``ARROW_ROWS`` rows, so that a worker holds little at a time.
    The batch size is a setting of the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(run, schema)


def unused(columns, name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column used inside a lambda may be put there as its whole expression by the optimizer (a filter
    pushed below a projection, projections merged), and then runs for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbered(df: DataFrame, group: list[str], order: list[str], value: str | None = None,
             partitions: int | None = None, files: int | None = None) -> DataFrame:
    """``df`` with ``rank`` (0-based row number within ``group`` by ``order``) and, if ``value`` is
    named, ``before`` (the sum of ``value`` over the earlier rows of the group).

    No group is gathered in one task: rows are range-partitioned by (group, order) and sorted, so a
    large group spans many partitions; the offsets come from one row per (partition, group). The
    ordered rows are checkpointed, since a second evaluation could draw other range bounds, in at most
    ``files`` files if that is given. The result is a function of that checkpoint. Group columns must not
    be null. Empty in, empty out. ``df`` should be narrow."""
    keys = group + order
    n = partitions or shuffle_partitions(df.sparkSession)
    r = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    r = r.withColumn("_at", F.monotonically_increasing_id())
    r = cut_lineage(r.coalesce(files) if files else r)
    r = r.withColumn("_part", F.shiftright("_at", 33))
    v = F.col(value) if value else F.lit(0)
    local = Window.partitionBy("_part", *group).orderBy("_at")
    r = r.withColumn("_n", F.row_number().over(local) - 1)
    r = r.withColumn("_v", F.coalesce(F.sum(v).over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ends = r.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_c"), F.sum(v).alias("_s"))
    across = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_part", *group, F.coalesce(F.sum("_c").over(across), F.lit(0)).alias("_c0"),
                       F.coalesce(F.sum("_s").over(across), F.lit(0)).alias("_s0"))
    out = r.join(ends, ["_part", *group]).withColumn("rank", (F.col("_n") + F.col("_c0")).cast("long"))
    if value:
        out = out.withColumn("before", F.col("_v") + F.col("_s0"))
    return out.drop("_at", "_part", "_n", "_v", "_c0", "_s0")


def position_in(value: Column, bounds: Column, size: int) -> Column:
    """How many of the ascending array ``bounds`` (of at most ``size`` numbers) are <= ``value``."""
    steps, s = [], 1
    while s <= size:
        steps.insert(0, s)
        s *= 2
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(x) for x in steps]), F.lit(0),
        lambda acc, step: F.when((acc + step <= F.size(bounds)) & (F.get(bounds, acc + step - 1) <= value),
                                 acc + step).otherwise(acc))


def range_bounds(df: DataFrame, col: str, n: int) -> list:
    """About ``n - 1`` distinct quantiles of a numeric column (``n`` bounds what the driver gets)."""
    cuts = df.approxQuantile(col, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    return sorted(set(cuts))


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) for the endpoints of ``links`` (a, b); component: the least id reached.

    Alternating large-star and small-star steps: each is one aggregation over directed links, so a
    node with very many links is combined on the map side and never gathered. Each round is
    checkpointed; the loop ends when a round changes nothing (the round count grows as the logarithm
    of the number of nodes), and raises if ``rounds`` do not suffice."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        j = both.join(low, "a")
        if large:
            j = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            return j.where("a <> b").distinct()
        return j.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            low.select("a", F.col("m").alias("b")).where("a <> b")).distinct()

    nodes = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    e = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        e = cut_lineage(star(star(e, True), False))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return nodes.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
