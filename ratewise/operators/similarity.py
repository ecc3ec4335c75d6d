"""Item-item similarity restricted to the item pairs a prediction actually needs.

sim(i, j) is computed over the users who rated both items, with ratings centred by each item's
mean over ALL its ratings:

    num = sum c_vi * c_vj,   den_i = sum c_vi^2,   den_j = sum c_vj^2
    sim = num / (sqrt(den_i) + sqrt(den_j))        denominator="sum" (reference behaviour)
    sim = num / (sqrt(den_i) * sqrt(den_j))        denominator="product" (textbook Pearson)

and 0 when fewer than ``min_overlap`` users are common or a denominator is 0.

Plan, and why it holds at scale
-------------------------------
The co-rater sums are a sparse product over users, as large as the needed pairs, while its terms (one
per user and two of its ratings) are many times more. So terms are never shuffled: they are made and
summed in the task that has their pair.

* Items get dense numbers in the order of their ids (:func:`scope.id_dictionary`); pairs and ratings travel
  as numbers. A needed pair belongs to the bucket of its lower item (``lo`` modulo the buckets), whose task
  gets the pairs first, as a sorted array, and has four sums for each of them.
* Users are split by degree (``heavy_user_degree``, D). A light user's ratings are one sorted list; each
  bucket that has an item of the list gets the list from that item on. Its task pairs the bucket's items
  with what follows and adds the terms whose pair is needed. What is shuffled is at most half a list per
  rating and at most a list per bucket; a task packs its lists by bucket and compresses them. Ratings travel as
  stars, which compress well, and lose the items' means in the task that sums.
* A heavy user's ratings are never all paired. Up to ``CHUNK`` of them travel as a light user's list does; of a
  user with more, which are never gathered, a bucket gets the ratings of its own items and all others in chunks of
  ``CHUNK`` item numbers. For each own item the task looks up its needed partners within the list, or the list's
  ratings among its partners, whichever are fewer.

Buckets grow with ratings and needed pairs, so that a task holds a bounded number of pairs; lists and
chunks stream through it. Needed pairs whose items cannot reach ``min_overlap`` (min degree below it) are
pruned before any of this, and with them the ratings of items in no needed pair; the result is exact,
nothing is sampled or capped.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.scope import id_dictionary
from ratewise.operators.stats import item_stats as _item_stats
from ratewise.operators.stats import user_stats as _user_stats
from ratewise.session import cut_lineage, stored

DEFAULT_HEAVY_USER_DEGREE = 500
#: Hash values of item pairs: a needed pair sets its own, at most so many rows are broadcast.
MASK = 1 << 19
SIM_DECIMALS = 9
#: Buckets of items, one a core and at most so many, or more where a bucket would have on average more
#: ratings or needed pairs than these.
BUCKETS, BUCKET_RATINGS, BUCKET_PAIRS = 32, 1 << 23, 1 << 21
#: Item numbers that a heavy user's list spans; terms that a task makes at once; rows of tables that are broadcast;
#: bytes that a task packs at once.
CHUNK, TERMS, BROADCAST_ROWS, PACK_BYTES = 1 << 16, 1 << 21, 1 << 20, 32 << 20


def centred_ratings(train: DataFrame, istats: DataFrame | None = None) -> DataFrame:
    """(user_id, business_id, stars, centred) with centred = stars - item mean."""
    istats = istats if istats is not None else _item_stats(train)
    return (train.join(istats.select("business_id", "item_mean"), "business_id")
            .select("user_id", "business_id", "stars",
                    (F.col("stars") - F.col("item_mean")).alias("centred")))


def needed_pairs(candidates: DataFrame) -> DataFrame:
    """Distinct (business_id, neighbour_id) pairs from a candidate table."""
    return candidates.select("business_id", "neighbour_id").distinct()


def canonical(df: DataFrame, a: str = "business_id", b: str = "neighbour_id") -> DataFrame:
    """Add the unordered pair key (lo, hi). Similarity is symmetric, so it is computed once per
    unordered pair and joined back in either orientation."""
    return df.withColumn("lo", F.least(a, b)).withColumn("hi", F.greatest(a, b))


def on_pair() -> F.Column:
    """The condition that joins (business_id, neighbour_id) rows with a table of unordered pairs, without
    columns lo and hi in the former."""
    return (F.least("business_id", "neighbour_id") == F.col("lo")) & (F.greatest("business_id", "neighbour_id") == F.col("hi"))


def prune_by_degree(needed: DataFrame, istats: DataFrame, min_overlap: int,
                    a: str = "business_id", b: str = "neighbour_id") -> DataFrame:
    """Drop pairs whose co-rater count cannot reach ``min_overlap`` (it is at most the smaller
    item degree). Exact: such pairs have similarity 0 anyway."""
    if min_overlap <= 1:
        return needed
    deg = istats.filter(F.col("item_degree") >= min_overlap).select("business_id")
    return (needed.join(deg.withColumnRenamed("business_id", a), a, "left_semi")
            .join(deg.withColumnRenamed("business_id", b), b, "left_semi"))


def pair_mask(needed_lohi: DataFrame) -> DataFrame:
    """(h): the hash values that some needed pair has, at most ``MASK`` of them."""
    return needed_lohi.select(_pair_hash()).distinct()


def _pair_hash() -> F.Column:
    return F.pmod(F.xxhash64("lo", "hi"), F.lit(MASK)).cast("int").alias("h")


def masked(terms: DataFrame, needed_lohi: DataFrame) -> DataFrame:
    """``terms`` without those whose pair has a hash value that no needed pair has."""
    return terms.withColumn("h", _pair_hash()).join(F.broadcast(pair_mask(needed_lohi)), "h", "left_semi").drop("h")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def co_rating_stats(centred: DataFrame, needed_lohi: DataFrame, ustats: DataFrame,
                    heavy_user_degree: int = DEFAULT_HEAVY_USER_DEGREE,
                    num_partitions: int | None = None, items: DataFrame | None = None,
                    means: DataFrame | None = None) -> DataFrame:
    """(lo, hi, n_common, num, den_lo, den_hi) for needed unordered pairs (lo <= hi, repeats allowed) with at
    least one common rater and both items in ``items``, by default all. ``num_partitions`` is the number of
    buckets, by default as many as keep ``BUCKET_RATINGS`` and ``BUCKET_PAIRS``.

    With ``means`` (business_id, item_mean) it is the column stars that travels, which compresses to a fraction
    of the centred ratings; a task gets the means as well and subtracts them."""
    needed = needed_lohi.select("lo", "hi").where("lo is not null and hi is not null")
    if items is None:
        items = centred.select("business_id")
    index = cut_lineage(id_dictionary(items.where("business_id is not null"), "business_id", "item")).select("business_id", F.col("item").cast("int"))
    index = _small(index, index.count())
    # numbers first, so that repeats meet as one long, not as two ids
    pairs = needed.join(index.toDF("lo", "a"), "lo").join(index.toDF("hi", "b"), "hi")
    pairs = stored(_distinct_keys(pairs.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("key"))), "pairs")
    pairs = pairs.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("key"), "a", "b")
    live = cut_lineage(pairs.select("a").union(pairs.select("b")).distinct().join(index.toDF("id", "a"), "a"))
    items_live = live.count()
    live = _small(live, items_live)

    # stored once: light lists and both sides of the heavy users read it
    rated = stored(centred.where("user_id is not null").join(live.toDF("item", "business_id"), "business_id").select(
        "user_id", "item", F.col("centred" if means is None else "stars").alias("centred")), "rated")
    cores = rated.sparkSession.sparkContext.defaultParallelism
    n = num_partitions or max(8, min(BUCKETS, cores), -(-rated.count() // BUCKET_RATINGS), -(-pairs.count() // BUCKET_PAIRS))
    heavy_ids = cut_lineage(ustats.filter(F.col("user_degree") > heavy_user_degree).select("user_id", (F.col("user_degree") > CHUNK).alias("many")))
    many = heavy_ids.where("many").select("user_id")
    some = heavy_ids.where("not many").select("user_id")
    many, some = (_small(ids, ids.count()) for ids in (many, some))
    heavy_ids = _small(heavy_ids.select("user_id"), heavy_ids.count())

    rows = (_pair_rows(pairs, n).unionByName(_light_rows(rated.join(heavy_ids, "user_id", "left_anti"), n))
            .unionByName(_light_rows(rated.join(some, "user_id", "left_semi"), n, 3))
            .unionByName(_heavy_rows(rated, many, _small(pairs.select(F.col("a").alias("item")).distinct(), items_live), n)))
    if means is not None:
        rows = rows.unionByName(_mean_rows(live.join(means, live.id == means.business_id).select("a", F.col("item_mean").alias("mean")), n))
    # needed pairs (kind 0) and means reach a task before the ratings that add to them
    rows = rows.repartition(n, F.col("bucket")).sortWithinPartitions("kind")
    sums = rows.mapInArrow(_adder(n), "a int, b int, n_common long, num double, den_lo double, den_hi double")
    return (sums.join(live.toDF("a", "lo"), "a").join(live.toDF("b", "hi"), "b")
            .select("lo", "hi", "n_common", "num", "den_lo", "den_hi"))


#: What tasks get: rows of one kind and bucket, many of them compressed into one. Kind -1: items' means; 0: needed pairs; 1: light
#: users' ratings from the bucket's first item on; 2: ratings of heavy users and, as ``of``, those of the
#: bucket's items; 3: as 1, of heavy users with up to ``CHUNK`` ratings.
PACKED = "kind int, bucket int, data binary"


def _pack(kind: int, bucket: int, **columns) -> pa.RecordBatch:
    batch, out = pa.record_batch(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return pa.record_batch({"kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()),
                            "data": pa.array([out.getvalue().to_pybytes()], pa.binary())})


def _unpack(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def narrow(numbers: np.ndarray) -> pa.Array:
    """``numbers`` in as few bytes each as hold all of them."""
    lo, hi = (int(numbers.min()), int(numbers.max())) if len(numbers) else (0, 0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max)
    return pa.array(numbers.astype(kind, copy=False))


def few(values: pa.Array) -> pa.Array:
    """``values`` as a byte each where there are few different ones; :func:`plain` undoes it."""
    d = values.dictionary_encode()
    return pa.DictionaryArray.from_arrays(d.indices.cast(pa.int8()), d.dictionary) if len(d.dictionary) <= 127 else values


def plain(values: pa.Array) -> pa.Array:
    return values.dictionary_decode() if pa.types.is_dictionary(values.type) else values


def _gathered(batches):
    """``batches`` joined to batches of about ``PACK_BYTES``."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= PACK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _distinct_keys(keys: DataFrame) -> DataFrame:
    """(a, b): the distinct ``key`` values, in two numbers. They travel sorted, as differences, many to a row;
    a task holds the keys of one lower number modulo the shuffle partitions."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(batches):
        for batch in _gathered(batches):
            key = np.unique(batch.column("key").to_numpy())
            bucket = (key >> 32) % n
            order = np.argsort(bucket, kind="stable")
            for p, mine in _runs(bucket[order]):
                yield _pack(0, p, key=pa.array(np.diff(key[order[mine]], prepend=0)))

    def merged(batches):
        for _, packs in groupby(_unpacked(batches), lambda x: x[1]):
            key = np.unique(np.concatenate([b.column("key").to_numpy().cumsum() for _, _, b in packs]))
            for s in range(0, len(key), 1 << 17):
                some = key[s:s + (1 << 17)]
                yield pa.record_batch({"a": pa.array((some >> 32).astype(np.int32)), "b": pa.array((some & 0xFFFFFFFF).astype(np.int32))})

    rows = keys.mapInArrow(dealt, PACKED).repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(merged, "a int, b int")


def _runs(sorted_values: np.ndarray):
    """(value, slice) of each run of equal values."""
    ends = np.flatnonzero(np.diff(sorted_values, append=sorted_values[-1:] + 1)) + 1 if len(sorted_values) else []
    start = 0
    for end in ends:
        yield int(sorted_values[start]), slice(start, int(end))
        start = int(end)


def _unpacked(batches):
    """(kind, bucket, columns) of each packed row."""
    for rows in batches:
        for kind, bucket, data in zip(rows.column("kind").to_pylist(), rows.column("bucket").to_pylist(), rows.column("data")):
            yield kind, bucket, _unpack(data.as_buffer())


def _pair_rows(pairs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            key = np.sort(batch.column("key").to_numpy())
            bucket = (key >> 32) % n
            for p in np.unique(bucket).tolist():
                yield _pack(0, p, key=pa.array(np.diff(key[bucket == p], prepend=0)))

    return pairs.select("key").mapInArrow(run, PACKED)


def _mean_rows(means: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            for p in range(n):
                yield _pack(-1, p, item=batch.column("a"), mean=batch.column("mean"))

    return means.mapInArrow(run, PACKED)


def _light_rows(light: DataFrame, n: int, kind: int = 1) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            offsets, item = _flat(batch.column("i"))
            values = batch.column("c").flatten()
            index = np.arange(len(item))
            for p in np.unique(item % n).tolist():
                # from the bucket's first item on; no list is empty
                first = np.minimum.reduceat(np.where(item % n == p, index, len(item)), offsets[:-1])
                some = first < offsets[1:]
                size = (offsets[1:] - first)[some]
                at = _spread(first[some], size)[1]
                rows = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
                yield _pack(kind, p, items=pa.ListArray.from_arrays(rows, narrow(np.diff(item[at].astype(np.int64), prepend=0))),
                            centred=pa.ListArray.from_arrays(rows, few(values.take(pa.array(at)))))

    rating = F.struct("item", "centred")
    g = light.groupBy("user_id").agg(F.array_sort(F.collect_list(rating)).alias("l"))
    return g.select(F.col("l.item").alias("i"), F.col("l.centred").alias("c")).mapInArrow(run, PACKED)


def _heavy_rows(rated: DataFrame, heavy_ids: DataFrame, lower: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            bucket = batch.column("bucket").to_numpy()
            for p in np.unique(bucket).tolist():
                yield _pack(2, p, **{c: batch.column(c).take(pa.array(np.flatnonzero(bucket == p)))
                                     for c in ("items", "centred", "of", "of_centred")})

    heavy, rating = rated.join(heavy_ids, "user_id", "left_semi"), F.array_sort(F.collect_list(F.struct("item", "centred")))
    # gathered by item numbers, of which a list has CHUNK or a bucket's at most
    own = heavy.join(lower, "item", "left_semi")
    own = own.groupBy("user_id", (F.col("item") % n).alias("bucket"), F.shiftright("item", CHUNK.bit_length() - 1).alias("q")).agg(rating.alias("o"))
    of = heavy.groupBy("user_id", F.shiftright("item", CHUNK.bit_length() - 1).alias("r")).agg(rating.alias("l"))
    both = own.join(of, "user_id").where("q <= r")  # a pair's other item has the higher number
    return both.select("bucket", F.col("l.item").alias("items"), F.col("l.centred").alias("centred"),
                       F.col("o.item").alias("of"), F.col("o.centred").alias("of_centred")).mapInArrow(run, PACKED)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    at = column.offsets.to_numpy().astype(np.int64)
    return at - at[0], column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are NULL) of a list column of doubles; a NULL is 0 among the values."""
    at = column.offsets.to_numpy()
    values = plain(column.values.slice(at[0], at[-1] - at[0]))
    none = values.is_null().to_numpy(zero_copy_only=False)
    return (values.fill_null(0.0) if values.null_count else values).to_numpy(zero_copy_only=False), none


def _spread(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, place) for each k and each of its ``count[k]`` places from ``start[k]`` on."""
    k = np.repeat(np.arange(len(count)), count)
    return k, np.arange(len(k)) + np.repeat(start - (np.cumsum(count) - count), count)


def _pieces(count: np.ndarray):
    """Slices of ``count`` with about TERMS in all, or of one element."""
    ends = np.cumsum(count)
    lo = 0
    while lo < len(count):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TERMS, "right")))
        yield slice(lo, hi)
        lo = hi


class _Sums:
    """The needed pairs of a task, ascending, and their sums."""

    def __init__(self, keys: np.ndarray, means: list[pa.RecordBatch] = ()):
        self.keys = np.sort(keys)
        self.mean = np.zeros(max((int(b.column("item").to_numpy().max()) + 1 for b in means), default=0))
        for b in means:
            self.mean[b.column("item").to_numpy()] = b.column("mean").to_numpy(zero_copy_only=False)
        self.n = np.zeros(len(keys), np.int64)
        self.sums = [np.zeros(len(keys)) for _ in range(3)]  # num, den_lo, den_hi
        self.lookups = 0  # of heavy users
        self.none = None  # how many terms of each sum were NULL, once there are any

    def add(self, at: np.ndarray, lo: tuple, hi: tuple) -> None:
        """Terms of ``lo`` and ``hi``, each (ratings, which are NULL). As in SQL, a NULL term counts as common
        and is left out of the sums."""
        (c_lo, no_lo), (c_hi, no_hi) = lo, hi
        np.add.at(self.n, at, 1)
        num, none = c_lo * c_hi, no_lo | no_hi
        if none.any():
            num[none] = 0.0
            self.none = self.none or [np.zeros(len(self.keys), np.int64) for _ in range(3)]
            for counts, where in zip(self.none, (none, no_lo, no_hi)):
                np.add.at(counts, at[where], 1)
        for total, term in zip(self.sums, (num, c_lo * c_lo, c_hi * c_hi)):
            np.add.at(total, at, term)

    def centred(self, item: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ratings less the items' means, which are NULL); a NULL is 0."""
        c, no = _numbers(column)
        return (np.where(no, 0.0, c - self.mean[item]) if len(self.mean) else c), no

    def light(self, batch: pa.RecordBatch, bucket: int, n: int) -> None:
        """Pairs the bucket's items of each list with those that follow."""
        offsets, item = _flat(batch.column("items"))  # differences
        item = item.cumsum(dtype=np.int64)
        c, no = self.centred(item, batch.column("centred"))
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        own = np.flatnonzero(item % n == bucket)
        # repeated ratings of an item pair with each other both ways: from the first of them on
        new = np.concatenate(([True], (item[1:] != item[:-1]) | (row[1:] != row[:-1])))[:len(item)]
        start = np.maximum.accumulate(np.where(new, np.arange(len(item)), 0))[own]
        count = offsets[1:][row[own]] - start
        for s in _pieces(count):
            k, hi = _spread(start[s], count[s])
            lo = own[s][k]
            key = item[lo] << 32 | item[hi]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == key)
            lo, hi = lo[hit], hi[hit]
            self.add(at[hit], (c[lo], no[lo]), (c[hi], no[hi]))

    def heavy(self, batch: pa.RecordBatch) -> None:
        """Terms of each row's own items with its ratings."""
        offsets, item = _flat(batch.column("items"))
        own_offsets, own = _flat(batch.column("of"))
        self.either(np.repeat(np.arange(len(own_offsets) - 1), np.diff(own_offsets)), own.astype(np.int64), self.centred(own, batch.column("of_centred")),
                    offsets, item.astype(np.int64), self.centred(item, batch.column("centred")))

    def heavy_lists(self, batch: pa.RecordBatch, bucket: int, n: int) -> None:
        """Terms of the bucket's items of each list with those that follow."""
        offsets, item = _flat(batch.column("items"))  # differences
        item = item.cumsum(dtype=np.int64)
        c, no = self.centred(item, batch.column("centred"))
        own = np.flatnonzero(item % n == bucket)
        self.either(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[own], item[own], (c[own], no[own]), offsets, item, (c, no))

    def either(self, row: np.ndarray, own: np.ndarray, own_rating: tuple, offsets: np.ndarray, item: np.ndarray, rating: tuple) -> None:
        """Adds the terms of ``own`` items of a ``row`` with the row's ratings from that item on: looks up the item's
        needed partners in the row, or the ratings among the partners, whichever are fewer."""
        (own_c, own_no), (c, no) = own_rating, rating
        there = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) << 32 | item
        start, end = np.searchsorted(there, row << 32 | own), offsets[1:][row]
        some = np.flatnonzero(end > start)  # the others have no rating from that item on
        row, own, own_c, own_no, start, end = (x[some] for x in (row, own, own_c, own_no, start, end))
        first = np.searchsorted(self.keys, own << 32 | item[start])
        partners = np.searchsorted(self.keys, own << 32 | item[end - 1], "right") - first
        listed = end - start
        for few, count, begin in ((np.flatnonzero(listed <= partners), listed, start), (np.flatnonzero(listed > partners), partners, first)):
            for s in _pieces(count[few]):
                k, place = _spread(begin[few[s]], count[few[s]])
                k = few[s][k]
                if begin is start:
                    key = own[k] << 32 | item[place]
                    at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    hit = np.flatnonzero(self.keys[at] == key)
                    at, mine, other = at[hit], k[hit], place[hit]
                else:
                    want = row[k] << 32 | self.keys[place] & 0xFFFFFFFF
                    lo, hi = np.searchsorted(there, want), np.searchsorted(there, want, "right")
                    hit = np.flatnonzero(hi > lo)
                    j, other = _spread(lo[hit], (hi - lo)[hit])
                    at, mine = place[hit][j], k[hit][j]
                self.lookups += len(place)
                self.add(at, (own_c[mine], own_no[mine]), (c[other], no[other]))

    def batches(self):
        some = np.flatnonzero(self.n)
        for lo in range(0, len(some), 1 << 17):
            at = some[lo:lo + (1 << 17)]
            yield pa.RecordBatch.from_arrays(
                [pa.array((self.keys[at] >> 32).astype(np.int32)), pa.array((self.keys[at] & 0xFFFFFFFF).astype(np.int32)),
                 pa.array(self.n[at]), *(pa.array(x[at], mask=none[at] == self.n[at] if self.none else None)
                                         for x, none in zip(self.sums, self.none or self.sums))],
                names=["a", "b", "n_common", "num", "den_lo", "den_hi"])


def _adder(n: int):
    def run(batches):
        keys, means, sums = [], {}, None
        for kind, bucket, batch in _unpacked(batches):
            if kind == -1:  # those of one bucket will do
                means.setdefault(bucket, []).append(batch)
                continue
            if kind == 0:
                keys.append(batch.column("key").to_numpy().cumsum())
                continue
            if sums is None:
                sums, keys = _Sums(np.concatenate([np.zeros(0, np.int64), *keys]), next(iter(means.values()), [])), []
            if not len(sums.keys):
                continue
            if kind == 1:
                sums.light(batch, bucket, n)
            elif kind == 3:
                sums.heavy_lists(batch, bucket, n)
            else:
                sums.heavy(batch)
        if sums is not None:
            yield from sums.batches()

    return run


def similarity_expr(min_overlap: int, denominator: str = "sum") -> F.Column:
    """Similarity from the co-rating sums; 0 below the overlap or with a zero denominator."""
    if denominator == "sum":
        den = F.sqrt("den_lo") + F.sqrt("den_hi")
    elif denominator == "product":
        den = F.sqrt("den_lo") * F.sqrt("den_hi")
    else:
        raise ValueError(f"denominator must be 'sum' or 'product', got {denominator!r}")
    return (F.when(F.coalesce(F.col("n_common"), F.lit(0)) < min_overlap, F.lit(0.0))
            .when((F.col("den_lo") == 0) | (F.col("den_hi") == 0), F.lit(0.0))
            .otherwise(F.round(F.col("num") / den, SIM_DECIMALS)))


def pair_similarity(train: DataFrame, needed: DataFrame, min_overlap: int = 75,
                    denominator: str = "sum",
                    heavy_user_degree: int = DEFAULT_HEAVY_USER_DEGREE,
                    istats: DataFrame | None = None, ustats: DataFrame | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """(lo, hi, n_common, similarity) for the unordered versions of the needed pairs that
    reach the overlap threshold (all other needed pairs have similarity 0). ``needed`` may hold
    duplicates (e.g. the candidate table itself); only its (business_id, neighbour_id) columns
    are read."""
    istats = istats if istats is not None else _item_stats(train)
    ustats = ustats if ustats is not None else _user_stats(train)
    centred = centred_ratings(train, istats)
    # an item with fewer ratings has no pair that reaches the overlap
    items = istats.filter(F.col("item_degree") >= min_overlap).select("business_id")
    stats = co_rating_stats(centred, canonical(needed).select("lo", "hi"), ustats, heavy_user_degree, num_partitions, items, istats)
    return stats.select("lo", "hi", "n_common",
                        similarity_expr(min_overlap, denominator).alias("similarity"))


def item_similarity(train: DataFrame, needed: DataFrame, min_overlap: int = 75,
                    denominator: str = "sum",
                    heavy_user_degree: int = DEFAULT_HEAVY_USER_DEGREE,
                    istats: DataFrame | None = None, ustats: DataFrame | None = None) -> DataFrame:
    """(business_id, neighbour_id, n_common, similarity) for every needed pair; pairs with no
    common rater get n_common 0 and similarity 0."""
    needed = stored(needed.select("business_id", "neighbour_id"), "needed")  # read twice
    sims = pair_similarity(train, needed, min_overlap, denominator, heavy_user_degree, istats, ustats)
    return (needed.join(sims, on_pair(), "left")
            .select("business_id", "neighbour_id",
                    F.coalesce("n_common", F.lit(0)).alias("n_common"),
                    F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def co_rating_counts(train: DataFrame, needed: DataFrame,
                     heavy_user_degree: int = DEFAULT_HEAVY_USER_DEGREE) -> DataFrame:
    """(business_id, neighbour_id, n_common) for needed pairs sharing at least one rater."""
    istats = _item_stats(train)
    ustats = _user_stats(train)
    needed = stored(needed.select("business_id", "neighbour_id"), "needed")  # read twice
    stats = co_rating_stats(centred_ratings(train, istats), canonical(needed).select("lo", "hi"), ustats, heavy_user_degree, means=istats)
    return (needed.join(stats.select("lo", "hi", "n_common"), on_pair())
            .select("business_id", "neighbour_id", "n_common"))
