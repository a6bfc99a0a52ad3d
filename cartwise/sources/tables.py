"""Logical input tables of the recommender, derived from the shared parquet tables.

``events(event_id, ts, user_id, event_type, value, props)`` carries every
input: role = ``user_id``, item = ``props.k``, day = ``to_date(ts)``.

* click log    -- ``click`` / ``view`` / ``signup`` events, one record per
                  (role, tab, day) with an ``{item:count,...}`` payload
* buy log      -- ``purchase`` events, one row per purchase
* active roles -- distinct (role, day) over all events
* catalog      -- distinct items, less a blacklist
* new items    -- ``newdt = 2024-01-01 + item % 30``
* role profile -- last event day per role up to the as-of day
* role daily features -- active (role, day) joined to ``customer``
* CTR counts   -- impressions (click + view) and clicks per item
* avatar log   -- ``props`` text as the ``wear`` attribute text
* order buys   -- ``lineitem`` joined to ``orders`` (the larger buy log)

Every table is a lazy ``DataFrame`` over the parquet scan, so filters and
column pruning reach the reader.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.constants import RANK_BLACKLIST, TAB_APPEARANCE, TAB_CLOTH, TAB_MALL
from cartwise.functions.dates import to_day

# fixed values: event type -> shop screen of the click log.
EVENT_TAB = (("click", TAB_CLOTH), ("view", TAB_MALL), ("signup", TAB_APPEARANCE))
BUY_EVENT = "purchase"
BUY_MALL_TYPE = "MallCloth"
IMPRESSION_EVENTS = ("click", "view")
CLICK_EVENT = "click"
NEW_ITEM_EPOCH = _dt.date(2024, 1, 1)
NEW_ITEM_CYCLE = 30


def item_of(props: str = "props"):
    return F.from_json(F.col(props), "k BIGINT").getField("k")


class ShopData:
    """Lazy accessors for the logical tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    # -- click log ---------------------------------------------------------
    def click_events(self) -> DataFrame:
        """(role_id, child_tab, dt, item_id): one row per click-type event."""
        tab = F.create_map(*[F.lit(x) for pair in EVENT_TAB for x in pair])
        ev = self.events.where(F.col("event_type").isin([e for e, _ in EVENT_TAB]))
        return ev.select(F.col("user_id").alias("role_id"),
                         tab[F.col("event_type")].alias("child_tab"),
                         F.to_date("ts").alias("dt"),
                         item_of().alias("item_id"))

    def click_log(self) -> DataFrame:
        """(role_id, child_tab, item_list, dt): one record per role, tab and day.

        ``item_list`` is ``{k:n,...}`` sorted by item; the list per record is
        bounded by the catalog size, after a map-side pre-aggregation.
        """
        counts = (self.click_events()
                  .groupBy("role_id", "child_tab", "dt", "item_id")
                  .agg(F.count(F.lit(1)).alias("n")))
        recs = counts.groupBy("role_id", "child_tab", "dt").agg(
            F.array_sort(F.collect_list(F.struct("item_id", "n"))).alias("items"))
        text = F.concat(F.lit("{"),
                        F.array_join(F.transform("items", lambda s: F.concat_ws(":", s["item_id"], s["n"])), ","),
                        F.lit("}"))
        return recs.select("role_id", "child_tab", text.alias("item_list"), "dt")

    # -- buy log -----------------------------------------------------------
    def buy_log(self) -> DataFrame:
        """(role_id, item_id, buy_num, price, mall_type, dt): one row per purchase."""
        ev = self.events.where(F.col("event_type") == BUY_EVENT)
        return ev.select(F.col("user_id").alias("role_id"), item_of().alias("item_id"),
                         F.lit(1).cast("bigint").alias("buy_num"),
                         F.col("value").alias("price"),
                         F.lit(BUY_MALL_TYPE).alias("mall_type"),
                         F.to_date("ts").alias("dt"))

    def order_buys(self) -> DataFrame:
        """(role_id, item_id, buy_num, price, dt) from ``lineitem`` x ``orders``."""
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
        od = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(od, li.l_orderkey == od.o_orderkey)
        return j.select(F.col("o_custkey").alias("role_id"), F.col("l_partkey").alias("item_id"),
                        F.col("l_quantity").cast("bigint").alias("buy_num"),
                        F.col("l_extendedprice").alias("price"),
                        F.to_date("o_orderdate").alias("dt"))

    # -- roles ---------------------------------------------------------------
    def active_roles(self) -> DataFrame:
        """(role_id, dt): distinct role and day over all events."""
        return self.events.select(F.col("user_id").alias("role_id"), F.to_date("ts").alias("dt")).distinct()

    def role_profile(self, asof) -> DataFrame:
        """(role_id, role_final_dt, dt): last event day per role up to ``asof``."""
        day = to_day(asof)
        ev = self.events.where(F.to_date("ts") <= F.lit(day))
        return (ev.groupBy(F.col("user_id").alias("role_id"))
                .agg(F.max(F.to_date("ts")).alias("role_final_dt"))
                .withColumn("dt", F.lit(day)))

    def role_daily_features(self) -> DataFrame:
        """(role_id, dt, c_acctbal, c_nationkey, c_mktsegment) per active role and day."""
        cust = self.table("customer").select(F.col("c_custkey").alias("role_id"), "c_acctbal",
                                             F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                                             "c_mktsegment")
        return self.active_roles().join(cust, "role_id")

    # -- items ---------------------------------------------------------------
    def items(self) -> DataFrame:
        return self.events.select(item_of().alias("item_id")).where(F.col("item_id").isNotNull()).distinct()

    def catalog(self, blacklist=RANK_BLACKLIST, items: DataFrame | None = None) -> DataFrame:
        """(item_id): distinct items (of the events, or ``items``) less the blacklist."""
        items = self.items() if items is None else items.select("item_id").distinct()
        return items.where(~F.col("item_id").isin(list(blacklist)))

    def new_items(self) -> DataFrame:
        """(item_id, item_name, newdt)."""
        return self.items().select(
            "item_id", F.concat(F.lit("item_"), F.col("item_id")).alias("item_name"),
            F.date_add(F.lit(NEW_ITEM_EPOCH), F.pmod(F.col("item_id"), F.lit(NEW_ITEM_CYCLE)).cast("int"))
            .alias("newdt"))

    def ctr_counts(self) -> DataFrame:
        """(item_id, imps, clks) as doubles."""
        ev = self.events.where(F.col("event_type").isin(list(IMPRESSION_EVENTS)))
        return (ev.groupBy(item_of().alias("item_id"))
                .agg(F.count(F.lit(1)).cast("double").alias("imps"),
                     F.sum(F.when(F.col("event_type") == CLICK_EVENT, 1).otherwise(0)).cast("double")
                     .alias("clks")))

    def avatar_log(self) -> DataFrame:
        """(event_id, role_id, wear, dt): attribute text per event."""
        return self.events.select("event_id", F.col("user_id").alias("role_id"),
                                  F.col("props").alias("wear"), F.to_date("ts").alias("dt"))
