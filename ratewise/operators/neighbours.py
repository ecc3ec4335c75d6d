"""Neighbourhood prediction: candidates, top-k by similarity, and the prediction ladder.

For a pair (u, i) the candidates are u's training ratings (j, r_uj), including j = i when u rated
i in training. Prediction ladder:

    u has no training rating               -> default (3.0)
    some candidate has similarity > 0      -> sum(s * r) / sum(|s|) over the top-k by similarity
    otherwise                              -> mean of u's training ratings

Ties in similarity are broken by neighbour id (ascending); similarities are rounded to 9 decimals
before ranking so float summation order cannot reorder them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators import similarity as sim_ops
from ratewise.operators.scope import id_dictionary
from ratewise.operators.stats import item_stats as _item_stats
from ratewise.operators.stats import latest_ratings
from ratewise.operators.stats import user_stats as _user_stats
from ratewise.session import cut_lineage, finished, stored

DEFAULT_PREDICTION = 3.0
OUT_DECIMALS = 6
#: Candidates of a pair in one list.
LIST = 1 << 12


def knn_candidates(pairs: DataFrame, train: DataFrame, include_self: bool = True) -> DataFrame:
    """(user_id, business_id, neighbour_id, neighbour_stars): pairs x the user's training ratings."""
    r = train.select("user_id", F.col("business_id").alias("neighbour_id"),
                     F.col("stars").alias("neighbour_stars"))
    cand = pairs.select("user_id", "business_id").join(r, "user_id")
    if not include_self:
        cand = cand.filter(F.col("neighbour_id") != F.col("business_id"))
    return cand


def positive(similarities: Callable[[], DataFrame]) -> DataFrame:
    """(lo, hi, similarity) of the positive similarities, for :func:`knn_top_k`: stored, so that the ratings and the
    shuffles that made them need no disk any more when the neighbours are sought."""
    return finished(lambda: similarities().where("similarity > 0").select("lo", "hi", "similarity"), "similar")


def knn_top_k(candidates: DataFrame, sims: DataFrame, k: int = 3) -> DataFrame:
    """(user_id, business_id, rank, neighbour_id, similarity, neighbour_stars) for the k most
    similar neighbours with positive similarity. ``sims`` is keyed by the unordered pair (lo, hi)
    (see :func:`similarity.pair_similarity`).

    The candidates of a pair travel as lists, of which each leaves its k best
    (:func:`_nearest_of_lists`). The rest is ``row_number() <= k``, planned as a WindowGroupLimit.
    """
    scored = _nearest_of_lists(candidates, sims.filter(F.col("similarity") > 0), k)
    w = Window.partitionBy("user_id", "business_id").orderBy(
        F.col("similarity").desc(), F.col("neighbour_id").asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("user_id", "business_id", "rank", "neighbour_id", "similarity", "neighbour_stars"))


def _nearest_of_lists(candidates: DataFrame, pos: DataFrame, k: int) -> DataFrame:
    """(user_id, business_id, neighbour_id, similarity, neighbour_stars): the k most similar candidates of each
    list, by the positive similarities ``pos``.

    The items of ``pos`` get numbers; candidates without a number on either side have no similarity and go. The others
    are gathered to lists in the order in which the join with the user's ratings leaves them, without a sort of their
    rows. Lists travel packed, many to a row, to the bucket of the asked item (its number modulo the shuffle
    partitions), where they meet its similarities. A task holds the similarities of one bucket and streams
    through the lists. A list has ``LIST`` candidates at most. The result is stored, so that these shuffles are gone
    before the ranks are made."""
    kinds = dict(candidates.dtypes)
    n = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = cut_lineage(id_dictionary(pos.select(F.col("lo").alias("id")).union(pos.select("hi")), "id", "number"))
    index = sim_ops._small(index, index.count())
    # of two ids of which one is NULL, least and greatest are both the other; the lowest bit says NULL
    flag = {c: F.shiftleft("number", 1) + F.col(c).isNull().cast("int") for c in ("business_id", "neighbour_id")}
    asked = candidates.withColumn("id", F.coalesce("business_id", "neighbour_id")).join(index, "id").withColumn("a", flag["business_id"]).drop("id", "number")
    asked = asked.withColumn("id", F.coalesce("neighbour_id", "business_id")).join(index, "id").withColumn("b", flag["neighbour_id"])
    known = pos.join(index.toDF("lo", "a"), "lo").join(index.toDF("hi", "b"), "hi").select("a", "b", "similarity")
    rows = known.mapInArrow(_pack_known(n), sim_ops.PACKED).unionByName(
        asked.select("user_id", "a", "b", "neighbour_stars").mapInArrow(_pack_lists(n, LIST), sim_ops.PACKED))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "kind")
    found = stored(rows.mapInArrow(_nearest(k), f"user_id {kinds['user_id']}, a long, b long, similarity double, neighbour_stars {kinds['neighbour_stars']}"), "nearest")
    ids = index.toDF("id", "number")
    for c, at in (("business_id", "a"), ("neighbour_id", "b")):
        found = found.withColumn("number", F.shiftright(at, 1)).join(ids, "number").withColumn(c, F.when(F.col(at) % 2 == 0, F.col("id"))).drop("id", "number")
    return found.select("user_id", "business_id", "neighbour_id", "similarity", "neighbour_stars")


def _pack_known(n: int):
    """Similarities of (a, b) to the bucket of either, as keys in ascending order."""
    def run(batches):
        for batch in sim_ops._gathered(batches):
            a, b, s = (batch.column(c).to_numpy() for c in ("a", "b", "similarity"))
            both = np.flatnonzero(a != b)
            key = np.concatenate((a << 32 | b, b[both] << 32 | a[both]))
            order = np.lexsort((key, (key >> 32) % n))
            key, s = key[order], np.concatenate((s, s[both]))[order]
            for p, mine in sim_ops._runs((key >> 32) % n):
                yield sim_ops._pack(0, p, key=pa.array(np.diff(key[mine], prepend=0)), similarity=pa.array(s[mine]))

    return run


def _pack_lists(n: int, most: int):
    """Candidates as lists: (user_id, a, size) of each, and all their (b, stars) one after the other."""
    def run(batches):
        for batch in sim_ops._gathered(batches):
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            user = batch.column("user_id").dictionary_encode().indices.fill_null(-1).to_numpy()
            order = np.lexsort((b, user, a, (a >> 1) % n))
            a, user = a[order], user[order]
            new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (user[1:] != user[:-1]))))
            size = np.diff(np.append(new, len(a)))
            k, place = sim_ops._spread(np.zeros(len(size), np.int64), -(-size // most))  # longer lists in several
            start, size = new[k] + place * most, np.minimum(size[k] - place * most, most)
            for p, mine in sim_ops._runs((a[start] >> 1) % n):
                at, rows = start[mine], order[start[mine][0]:start[mine][-1] + size[mine][-1]]
                yield sim_ops._pack(1, p, lists=_row(user_id=batch.column("user_id").take(pa.array(order[at])), a=pa.array(np.diff(a[at], prepend=0)),
                                                     size=pa.array(size[mine].astype(np.int32))),
                                    flat=_row(b=sim_ops.narrow(np.diff(b[rows], prepend=0)), stars=sim_ops.few(batch.column("neighbour_stars").take(pa.array(rows)))))

    return run


def _row(**columns) -> pa.Array:
    """All rows of ``columns`` as one list of structs."""
    rows = pa.StructArray.from_arrays([*columns.values()], names=[*columns])
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)


def _nearest(k: int):
    def best(keys: np.ndarray, similarity: np.ndarray, packed: pa.RecordBatch):
        lists, flat = (pa.RecordBatch.from_struct_array(packed.column(c).flatten()) for c in ("lists", "flat"))
        size, a, b = lists.column("size").to_numpy(), lists.column("a").to_numpy().cumsum(), flat.column("b").to_numpy().cumsum(dtype=np.int64)
        of = np.repeat(np.arange(len(size)), size)
        key = a[of] >> 1 << 32 | b >> 1
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == key)
        s, of = similarity[at[hit]], of[hit]
        # as Spark sorts: NaN first, then by id (numbers are in the order of ids), NULL before all
        order = np.lexsort((np.where(b[hit] & 1, -1, b[hit]), np.where(np.isnan(s), 0.0, -s), ~np.isnan(s), of))
        of = of[order]
        new = np.concatenate(([True], of[1:] != of[:-1]))[:len(of)]
        order = order[np.arange(len(of)) - np.maximum.accumulate(np.where(new, np.arange(len(of)), 0)) < k]
        of, mine = np.repeat(np.arange(len(size)), size)[hit[order]], hit[order]
        return pa.RecordBatch.from_pydict({
            "user_id": lists.column("user_id").take(pa.array(of)), "a": pa.array(a[of]), "b": pa.array(b[mine]), "similarity": pa.array(s[order]),
            "neighbour_stars": sim_ops.plain(flat.column("stars")).take(pa.array(mine))})

    def run(batches):
        for _, packs in groupby(sim_ops._unpacked(batches), lambda x: x[1]):
            held, keys, similarity = [], None, None
            for kind, _, packed in packs:
                if kind == 0:
                    held.append(packed)
                elif held:
                    if keys is None:
                        keys = np.concatenate([x.column("key").to_numpy().cumsum() for x in held])
                        order = np.argsort(keys, kind="stable")
                        keys, similarity = keys[order], np.concatenate([x.column("similarity").to_numpy() for x in held])[order]
                    yield best(keys, similarity, packed)

    return run


def weighted_average(top: DataFrame) -> DataFrame:
    """(user_id, business_id, weighted) = sum(s * r) / sum(|s|) over the kept neighbours."""
    return top.groupBy("user_id", "business_id").agg(
        F.try_divide(F.sum(F.col("similarity") * F.col("neighbour_stars")),
                     F.sum(F.abs("similarity"))).alias("weighted"))


def predict_ladder(pairs: DataFrame, weighted: DataFrame, ustats: DataFrame,
                   default: float = DEFAULT_PREDICTION) -> DataFrame:
    """Apply the ladder: weighted -> user mean -> default."""
    out = (pairs.select("user_id", "business_id")
           .join(weighted, ["user_id", "business_id"], "left")
           .join(ustats.select("user_id", "user_mean"), "user_id", "left"))
    return out.select("user_id", "business_id",
                      F.coalesce("weighted", "user_mean", F.lit(float(default))).alias("prediction"))


def knn_predict(train: DataFrame, pairs: DataFrame, min_overlap: int = 75, k: int = 3,
                denominator: str = "sum", include_self: bool = True,
                heavy_user_degree: int = sim_ops.DEFAULT_HEAVY_USER_DEGREE,
                default: float = DEFAULT_PREDICTION, decimals: int | None = OUT_DECIMALS,
                order_by: list[str] | None = None, unique: bool = False) -> DataFrame:
    """Item-kNN prediction for every row of ``pairs``: (user_id, business_id, prediction).

    Repeated training ratings of a (user, item) count once (:func:`stats.latest_ratings` with
    ``order_by``); a pair listed several times is predicted once and gets a row each time.
    ``unique`` says that neither input repeats a (user, item), which saves both steps."""
    if not unique:
        train = latest_ratings(train, order_by)
    train = train.select("user_id", "business_id", F.col("stars").cast("double"))
    asked = pairs.select("user_id", "business_id")
    pairs = asked if unique else asked.distinct()
    istats = _item_stats(train)
    ustats = _user_stats(train)
    cand = knn_candidates(pairs, train, include_self)
    # pair_similarity reduces its input to distinct unordered pairs itself, so the candidates go
    # in directly (one aggregate instead of a distinct over ordered pairs first)
    sims = positive(lambda: sim_ops.pair_similarity(train, cand, min_overlap, denominator, heavy_user_degree,
                                                    istats=istats, ustats=ustats))
    top = knn_top_k(cand, sims, k)
    # every row of the pairs asks the ladder, so repeats come back as they were listed
    pred = predict_ladder(asked, weighted_average(top), ustats, default)
    if decimals is not None:
        pred = pred.withColumn("prediction", F.round("prediction", decimals))
    return pred
