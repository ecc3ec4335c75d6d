"""Sharding by balanced label propagation.

A node is a text: rows of equal texts are one node and stay together. Nodes are linked where they share a
line of some length: a star per line to the least of its nodes, split into stars of about ``STAR`` where
many share it. Nodes start on the shard hashed from themselves and move towards their neighbours' shards,
round by round: a round joins the links with the shards, counts votes, lets a hashed half of the nodes with
something to gain ask to move, and admits as much as two shards hand each other and the wanted shard's free
quota allows (in expectation: a hash admits a share of those who ask). Then what stands above the mean on a
shard, and all nodes without links, level the sizes: from the large to the small, each size class raises
the smallest shards to a common level. A text that would fill more than a shard takes whole shards for
itself, and its rest goes as any node.

Sizes end near equal (``bytes`` law): they differ by about the size of the smallest class's nodes.

Defined results: a null text has size 1 and the CRC of no bytes, and equals the empty text; links to missing
nodes, to oneself and repeated links are ignored; rows of equal doc_id are separate rows; an empty table
gives no rows; other columns stay, save text and the columns that are set. Only tables of one row per shard,
pair of shards, size class or text larger than a shard reach the driver; rows of a shard are numbered
without gathering it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import numbered, position_in
from ratewise.session import cut_lineage

SHARDS, ROUNDS = 16, 5
CLASSES = (16384, 2048, 256)  # least sizes of the classes of loose nodes that are dealt one after the other
#: Lines of at least so many characters link the texts that share them, in stars of about so many nodes.
LINE_CHARS, STAR = 24, 64


def water_fill(loads: list[float], amount: float) -> list[float]:
    """By how much each of the loads rises when ``amount`` lifts the lowest to a common level."""
    order = sorted(loads)
    level, n, rest = order[0] if order else 0, 0, amount
    for i, x in enumerate(order):
        need = (x - level) * i
        if need > rest:
            break
        rest, level, n = rest - need, x, i + 1
    level += rest / max(n, 1)
    return [max(level - x, 0.0) for x in loads]


def _cuts(widths: list[float]):
    """Ascending inner bounds of intervals of the given widths, for ``position_in``."""
    out, at = [], 0.0
    for w in widths[:-1]:
        at += w
        out.append(at)
    return F.array(*[F.lit(float(x)) for x in out])


def _loads(df: DataFrame, shards: int) -> list[float]:
    found = {r["shard"]: float(r["s"]) for r in df.groupBy("shard").agg(F.sum("size").alias("s")).collect()}
    return [found.get(i, 0.0) for i in range(shards)]


def _admitted(asked: DataFrame, free: list[float], shards: int):
    """The share of what is asked that may move from each shard to each other, as an array by from * shards
    + to.

    What two shards want to hand each other changes places; free quota goes to the rest in proportion.
    One row per pair of shards is collected."""
    wish = [[0.0] * shards for _ in range(shards)]
    for r in asked.groupBy("now", "want").agg(F.sum("size").alias("s")).collect():
        wish[r["now"]][r["want"]] = float(r["s"])
    swap = [[min(wish[i][j], wish[j][i]) for j in range(shards)] for i in range(shards)]
    rest = [sum(wish[i][j] - swap[i][j] for i in range(shards)) for j in range(shards)]
    part = [[swap[i][j] + (min(free[j], rest[j]) * (wish[i][j] - swap[i][j]) / rest[j] if rest[j] else 0.0) for j in range(shards)]
            for i in range(shards)]
    return F.array(*[F.lit(part[i][j] / wish[i][j] if wish[i][j] else 0.0) for i in range(shards) for j in range(shards)])


def _unit(*of):
    return F.pmod(F.xxhash64(*of), F.lit(1 << 40)) / float(1 << 40)


def cut_links(state: DataFrame, links: DataFrame) -> int:
    """How many links join nodes of different shards."""
    at = state.select("id", "shard")
    j = links.join(at.withColumnsRenamed({"id": "a", "shard": "sa"}), "a").join(at.withColumnsRenamed({"id": "b", "shard": "sb"}), "b")
    return j.where("sa <> sb").count()


def settle(linked: DataFrame, e: DataFrame, quota: float, shards: int, rounds: int, seed: int, used: list[float]) -> DataFrame:
    """(id, size, shard) of the linked nodes after the rounds; ``e`` has every link both ways."""
    state = cut_lineage(linked.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(shards)).cast("int")))
    for r in range(rounds):
        at = state.select(F.col("id").alias("b"), "shard")
        votes = e.join(at, "b").groupBy("a", "shard").agg(F.count(F.lit(1)).alias("v")).withColumnRenamed("a", "id")
        votes = votes.join(state.select("id", "size", F.col("shard").alias("now")), "id")
        own = F.max(F.when(F.col("shard") == F.col("now"), F.col("v")))
        best = F.max(F.struct("v", (F.col("shard") == F.col("now")).alias("stay"), F.xxhash64("id", "shard").alias("tie"), "shard"))
        want = votes.groupBy("id", "size", "now").agg(best.alias("best"), F.coalesce(own, F.lit(0)).alias("own"))
        want = want.where("best.v > own").select("id", "size", "now", F.col("best.shard").alias("want"))
        asked = cut_lineage(want.where(_unit(F.lit(seed + r), "id") < 0.5))
        if asked.isEmpty():
            break
        loads = _loads(state, shards)
        share = _admitted(asked, [max(quota - x - u, 0.0) for x, u in zip(loads, used)], shards)
        moves = asked.where(_unit(F.lit(seed - 1 - r), "id") < F.get(share, F.col("now") * shards + F.col("want"))).select("id", "want")
        state = cut_lineage(state.join(moves, "id", "left").select("id", "size", F.coalesce("want", "shard").alias("shard")))
    return state


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, seed: int = 29,
              used: list[float] | None = None) -> DataFrame:
    """``nodes`` (id, size) with ``shard``; ``links`` (a, b) join ids. ``used``: what shards hold already."""
    used = used or [0.0] * shards
    total = float(nodes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"])
    quota = max(water_fill(used, total)[i] + used[i] for i in range(shards))
    e = links.select("a", "b").where("a <> b")
    e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    known = nodes.select(F.col("id").alias("b"))
    e = cut_lineage(e.join(known, "b", "left_semi").join(known.withColumnRenamed("b", "a"), "a", "left_semi"))
    ends = cut_lineage(e.select(F.col("a").alias("id")).distinct())
    state = settle(nodes.select("id", "size").join(ends, "id", "left_semi"), e, quota, shards, rounds, seed, used)
    # above the quota: the last ones of a shard, by a hash, become loose
    state = cut_lineage(numbered(state.withColumn("order", F.xxhash64(F.lit(seed + 1), "id")), ["shard"], ["order", "id"], "size"))
    room = F.get(F.array(*[F.lit(max(quota - u, 0.0)) for u in used]), F.col("shard"))
    inside = F.col("before") + F.col("size") <= room
    done = [state.where(inside).select("id", "size", "shard")]
    loose = nodes.select("id", "size").join(ends, "id", "left_anti").union(state.where(~inside).select("id", "size"))
    size_class = F.lit(len(CLASSES))
    for i, least in reversed(list(enumerate(CLASSES))):
        size_class = F.when(F.col("size") >= least, i).otherwise(size_class)
    loose = loose.withColumn("class", size_class).withColumn("order", F.xxhash64(F.lit(seed), "id"))
    loose = cut_lineage(numbered(loose, ["class"], ["order", "id"], "size"))
    loads = [x + u for x, u in zip(_loads(done[0], shards), used)]
    sums = {r["class"]: float(r["s"]) for r in loose.groupBy("class").agg(F.sum("size").alias("s")).collect()}
    for c in sorted(sums):
        cuts = _cuts(water_fill(loads, sums[c]))
        part = loose.where(F.col("class") == c).select(
            "id", "size", position_in(F.col("before") + F.col("size") / 2, cuts, shards - 1).alias("shard"))
        done.append(part)
        loads = [x + y for x, y in zip(loads, _loads(part, shards))]
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return cut_lineage(out)


def line_links(texts: DataFrame, least: int = LINE_CHARS, star: int = STAR) -> DataFrame:
    """(a, b) for ``texts`` (id, text): stars of the texts that share a line of ``least`` characters."""
    lines = texts.select("id", F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) >= least)
    lines = cut_lineage(lines.select("id", F.xxhash64("line").alias("line")).distinct())
    shared = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = lines.join(shared, "line").withColumn("star", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / star)))
    hubs = stars.groupBy("line", "star").agg(F.min("id").alias("b"))
    return stars.join(hubs, ["line", "star"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _whole_shards(rows: DataFrame, large: list, mean: float, shards: int):
    """Rows of texts larger than a shard: (id, shard) of those that fill whole shards, (id, size) of the
    rest, and what the shards hold then."""
    r = rows.where(F.col("node").isin([n for n, _ in large])).select("id", "node", "size")
    r = cut_lineage(numbered(r, ["node"], ["id"], "size"))
    used, first, pieces = [0.0] * shards, {}, {}
    for node, size in large:
        first[node], pieces[node] = sum(pieces.values()), int(size // mean)
    shard, full = F.lit(None).cast("int"), F.lit(False)
    piece = F.floor((F.col("before") + F.col("size") / 2) / mean).cast("int")
    for node, _ in large:
        mine = F.col("node") == node
        shard = F.when(mine, piece + first[node]).otherwise(shard)
        full = F.when(mine, piece < pieces[node]).otherwise(full)
    r = cut_lineage(r.select("id", "node", "size", shard.alias("shard"), full.alias("full")))
    for i, x in enumerate(_loads(r.where("full"), shards)):
        used[i] = x
    return r, used


def place_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Each row's size, CRC, shard and slot (its number within the shard). Other columns but text stay."""
    text = F.coalesce("text", F.lit(""))
    others = [c for c in docs.columns if c not in ("doc_id", "text", "size", "text_crc32", "shard", "slot")]
    with_text = docs.select(
        F.struct("doc_id", *others).alias("d"), F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("node"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = cut_lineage(with_text.drop("text").withColumn("id", F.monotonically_increasing_id()))
    nodes = cut_lineage(rows.groupBy(F.col("node").alias("id")).agg(F.sum("size").alias("size")))
    mean = max(float(rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"]) / shards, 1.0)
    # at most one text a shard can be larger than the mean
    large = [(r["id"], r["size"]) for r in nodes.where(F.col("size") > mean).orderBy("id").collect()]
    links = cut_lineage(line_links(with_text.select(F.col("node").alias("id"), "text")))
    fixed, used = None, None
    if large:
        fixed, used = _whole_shards(rows, large, mean, shards)
        rest = fixed.where("not full").groupBy(F.col("node").alias("id")).agg(F.sum("size").alias("size"))
        nodes = cut_lineage(nodes.where(~F.col("id").isin([n for n, _ in large])).union(rest))
    placed = propagate(nodes, links, shards, rounds, used=used).select(F.col("id").alias("node"), "shard")
    narrow = rows.select("id", "node", F.coalesce("doc_id", F.lit(-1 << 63)).alias("order"))
    if fixed is None:
        order = narrow.join(placed, "node")
    else:
        full = fixed.where("full").select("id", F.col("shard").alias("own"))
        order = narrow.join(full, "id", "left").join(placed, "node", "left").withColumn("shard", F.coalesce("own", "shard"))
    slots = numbered(order.select("id", "order", "shard"), ["shard"], ["order", "id"]).select("id", "shard", F.col("rank").alias("slot"))
    return rows.join(slots, "id").select("d.*", "size", "text_crc32", "shard", "slot")


def shard_digest(docs: DataFrame) -> DataFrame:
    return place_documents(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
