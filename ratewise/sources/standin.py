"""Stand-in inputs built from the TPC-H-like parquet tables.

The pipelines read rating CSVs and JSON side tables; the test data is parquet, so these
DataFrame plans derive tables of the same shape (see FIXTURES.md):

  ratings   user = o_custkey, item = l_suppkey, stars = 1 + floor((l_quantity - 1) / 10)
  hold-out  test rows: l_orderkey % 10 = 0; train: the rest minus users with o_custkey % 50 = 0
            (those users become cold users). Duplicate (user, item) ratings keep the one with the
            largest (l_orderkey, l_linenumber, stars).
  business  one row per supplier; text fields from the part whose key equals the supplier key
  user      one row per customer, aggregated from orders, train ratings and events
  checkin   events per user_id as a map event_type -> count
  tip       conversations: item = (7 conv_id + turn) % 150, user = conv_id, likes = turn

Everything is a plan over the parquet scans, so Catalyst prunes columns and pushes filters into the
readers. The two rating tables are kept once a query, since every plan reads them several
times: checkpointed, or with ``compact`` as stored tables, which take less disk.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import cut_lineage, stored
from ratewise.sources.schemas import COMPLIMENTS

# Event types and the hour split that feed the ten compliment counters, in the
# order of COMPLIMENTS (type, morning?) -> hot, more, cute, list, note, plain, cool, funny,
# writer, photos.
COMPLIMENT_EVENTS = [
    ("view", True), ("view", False), ("click", True), ("click", False), ("error", True),
    ("error", False), ("purchase", True), ("purchase", False), ("signup", True), ("signup", False),
]
# Weekday keys of the stand-in opening hours.
HOUR_KEYS = ["Monday", "Tuesday", "Wednesday"]
HOLDOUT_MOD = 10
COLD_USER_MOD = 50


def _latest(col: str) -> F.Column:
    """Value of ``col`` on the rating row with the largest (orderkey, linenumber, stars).

    ``max_by`` is a partial aggregate, so duplicate groups are combined map-side.
    """
    return F.max_by(F.col(col), F.struct("l_orderkey", "l_linenumber", "stars"))


class StandIn:
    """Lazily built stand-in tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, compact: bool = False):
        self.spark = spark
        self.compact = compact
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- ratings -------------------------------------------------------------------------
    @cached_property
    def rated(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select("o_custkey", "l_suppkey",
                        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("stars"),
                        "l_orderkey", "l_linenumber"))

    @staticmethod
    def _dedup(rows: DataFrame, out: str) -> DataFrame:
        """One row per (user, item). Grouped on the numeric keys (sorting two longs is cheaper
        than two strings); the ids become strings, as in the rating files, afterwards."""
        return (rows.groupBy("o_custkey", "l_suppkey").agg(_latest("stars").alias(out))
                .select(F.col("o_custkey").cast("string").alias("user_id"),
                        F.col("l_suppkey").cast("string").alias("business_id"), out))

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        return stored(rows, name) if self.compact else cut_lineage(rows)

    @cached_property
    def train(self) -> DataFrame:
        """(user_id, business_id, stars), one row per pair."""
        return self._kept(self._dedup(self.raw_train.select("o_custkey", "l_suppkey", "stars", "l_orderkey", "l_linenumber"), "stars"), "train")

    @property
    def raw_train(self) -> DataFrame:
        """Every training row of ``rated``, repeats included."""
        return self.rated.filter((F.col("l_orderkey") % HOLDOUT_MOD != 0) & (F.col("o_custkey") % COLD_USER_MOD != 0))

    @property
    def raw_test(self) -> DataFrame:
        """Every held-out row of ``rated``, repeats included."""
        return self.rated.filter(F.col("l_orderkey") % HOLDOUT_MOD == 0)

    @staticmethod
    def named(rows: DataFrame) -> DataFrame:
        """``rows`` with the ids as rating files have them."""
        return rows.select(F.col("o_custkey").cast("string").alias("user_id"), F.col("l_suppkey").cast("string").alias("business_id"),
                           "stars", "l_orderkey", "l_linenumber")

    @cached_property
    def test(self) -> DataFrame:
        """(user_id, business_id, label), one row per held-out pair."""
        return self._kept(self._dedup(self.raw_test, "label"), "test")

    @property
    def pairs(self) -> DataFrame:
        return self.test.select("user_id", "business_id")

    # ---- business profiles -----------------------------------------------------------------
    @staticmethod
    def part_fields(part: DataFrame) -> DataFrame:
        """categories / attributes / hours derived from one part row."""
        kind = F.concat(F.lit("{'type': "), F.col("p_type"), F.lit(", 'big': "),
                        F.when(F.col("p_size") > 25, F.lit("1")).otherwise(F.lit("0")),
                        F.lit(", 'code': 0"), F.col("p_size").cast("string"), F.lit(": x}"))
        # some sizes have leading zeros: digit strings that are equal as integers only
        size = F.when(F.col("p_partkey") % 3 == 0, F.lpad(F.col("p_size").cast("string"), 3, "0")).otherwise(
            F.col("p_size").cast("string"))
        attributes = F.when(F.col("p_size").isNull() | (F.col("p_size") % 10 == 0), F.lit(None)).otherwise(
            F.create_map(F.lit("brand"), F.col("p_brand"),
                         F.lit("size"), size,
                         F.lit("kind"), kind))
        n_hours = (F.col("p_size") % 3 + 1).cast("int")
        hours = F.when(F.col("p_partkey").isNull() | (F.col("p_partkey") % 4 == 0), F.lit(None)).otherwise(
            F.map_from_arrays(F.slice(F.array(*[F.lit(h) for h in HOUR_KEYS]), 1, n_hours),
                              F.array_repeat(F.lit("9:0-17:0"), n_hours)))
        return part.select(
            "p_partkey",
            F.regexp_replace(F.col("p_name"), " ", ", ").alias("categories"),
            attributes.alias("attributes"),
            hours.alias("hours"))

    @cached_property
    def part_business(self) -> DataFrame:
        """One business per part (categories / attributes tests)."""
        p = self.part_fields(self.table("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
        return p.select(F.col("p_partkey").cast("string").alias("business_id"),
                        "categories", "attributes", "hours")

    @cached_property
    def business(self) -> DataFrame:
        """One business per supplier, schema ``schemas.BUSINESS``."""
        s = self.table("supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
        n = self.table("nation").select("n_nationkey", "n_name")
        p = self.part_fields(self.table("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
        item_stats = (self.train.groupBy("business_id")
                      .agg(F.avg("stars").alias("stars"), F.count(F.lit(1)).cast("int").alias("review_count")))
        base = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .join(p, s.s_suppkey == p.p_partkey, "left")
                .select(F.col("s_suppkey").cast("string").alias("business_id"),
                        F.col("s_nationkey").cast("double").alias("latitude"),
                        (F.col("s_suppkey") % 180).cast("double").alias("longitude"),
                        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).cast("int").alias("is_open"),
                        F.col("n_name").alias("state"),
                        "categories", "attributes", "hours"))
        b = base.join(item_stats, "business_id", "left")
        return b.select("business_id", "latitude", "longitude", "stars",
                        F.coalesce(F.col("review_count"), F.lit(0)).alias("review_count"),
                        "is_open", "state", "categories", "attributes", "hours")

    # ---- user profiles ---------------------------------------------------------------------
    @cached_property
    def user(self) -> DataFrame:
        """One profile per customer, schema ``schemas.USER``."""
        c = self.table("customer").select("c_custkey")
        o = self.table("orders").select("o_custkey", "o_orderstatus", "o_orderdate")
        order_stats = (o.groupBy("o_custkey").agg(
            F.count(F.lit(1)).cast("int").alias("review_count"),
            F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("yelping_since"),
            # distinct years form a small bounded domain, so the set stays small
            F.array_join(F.array_sort(F.collect_set(F.year("o_orderdate").cast("string"))), ",").alias("elite"),
            F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("useful"),
            F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("funny"),
            F.count_if(F.col("o_orderstatus") == "P").cast("int").alias("fans")))
        ev = self.table("events").select("user_id", "event_type", "ts")
        morning = F.hour("ts") < 12
        ev_stats = ev.groupBy(F.col("user_id").alias("e_user")).agg(*[
            F.count_if((F.col("event_type") == et) & (morning if am else ~morning)).cast("int")
            .alias(f"compliment_{name}")
            for name, (et, am) in zip(COMPLIMENTS, COMPLIMENT_EVENTS)])
        user_mean = self.train.groupBy("user_id").agg(F.avg("stars").alias("average_stars"))
        n_friends = (F.col("c_custkey") % 5 + 1).cast("int")
        friends = F.when(F.col("c_custkey") % 7 == 0, F.lit("None")).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), n_friends),
                                     lambda x: (F.col("c_custkey") + x).cast("string")), ","))
        u = (c.join(order_stats, c.c_custkey == order_stats.o_custkey, "left")
             .join(ev_stats, c.c_custkey == ev_stats.e_user, "left")
             .withColumn("user_id", F.col("c_custkey").cast("string")))
        u = u.join(user_mean, "user_id", "left")
        return u.select(
            "user_id",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            "yelping_since",
            friends.alias("friends"),
            F.coalesce("useful", F.lit(0)).alias("useful"),
            F.coalesce("funny", F.lit(0)).alias("funny"),
            F.coalesce("fans", F.lit(0)).alias("fans"),
            F.coalesce(F.col("elite"), F.lit("None")).alias("elite"),
            "average_stars",
            *[F.coalesce(f"compliment_{c}", F.lit(0)).alias(f"compliment_{c}") for c in COMPLIMENTS])

    @property
    def known_user(self) -> DataFrame:
        """The profiles of customers whose balance is not negative: the others stand for users that the
        profile file lacks."""
        c = self.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("user_id"))
        return self.user.join(c, "user_id", "left_semi")

    # ---- check-ins and tips ----------------------------------------------------------------
    @cached_property
    def checkin(self) -> DataFrame:
        """(business_id, time MAP<event_type, count>) keyed by events.user_id."""
        ev = self.table("events").select("user_id", "event_type")
        per_type = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).cast("int").alias("n"))
        # one entry per event type: the collected list is bounded by the type domain
        return (per_type.groupBy(F.col("user_id").cast("string").alias("business_id"))
                .agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("time")))

    @cached_property
    def tip(self) -> DataFrame:
        cv = self.table("conversations").select("conv_id", "turn", "text")
        # some of these ids are suppliers, some are not
        return cv.select(((F.col("conv_id") * 7 + F.col("turn")) % 150).cast("string").alias("business_id"),
                         F.col("conv_id").cast("string").alias("user_id"),
                         F.col("turn").cast("int").alias("likes"),
                         "text")
