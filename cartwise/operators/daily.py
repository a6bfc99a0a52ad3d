"""Day-grain event counts.

Everything here is a filter pushed to the scan, an ``explode`` and one
``groupBy`` whose partial aggregate runs map-side, so a hot role or item is
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import BUY_MALL_TYPES, CLICK_TABS, OPEN_TABS, TAB_APPEARANCE
from cartwise.functions.dates import age, day_in, shift, to_day, window_start
from cartwise.functions.payload import entry_parts, explode_payload, payload_entries


def scan_range(log: DataFrame, asof, day_num: int, dt: str = "dt") -> DataFrame:
    """Closed range ``[asof-(day_num-1), asof]`` (F1)."""
    return log.where(F.col(dt).between(F.lit(window_start(asof, day_num)), F.lit(to_day(asof))))


def click_scan(click_log: DataFrame, asof, day_num: int, tabs=CLICK_TABS) -> DataFrame:
    """Click log records in range, non-empty payload, listed tabs."""
    return (scan_range(click_log, asof, day_num)
            .where((F.col("item_list") != "{}") & F.col("child_tab").isin(list(tabs))))


def explode_clicks(click_log: DataFrame) -> DataFrame:
    """(role_id, child_tab, dt, item_id, cnt): one row per payload entry."""
    keep = [c for c in ("role_id", "child_tab", "dt") if c in click_log.columns]
    return explode_payload(click_log.where(F.col("item_list") != "{}"), "item_list", keep=keep)


def log_counts(click_log: DataFrame, asof, day_num: int = 30) -> DataFrame:
    """(role_id, child_tab, age, item_id, cnt, entries, records): the click log in
    range, exploded once and combined map-side.

    ``records`` counts click-log records (each record's first entry), so the
    click branch and the open branch both derive from this one aggregate and
    Spark reuses its shuffle instead of scanning and exploding the log twice.
    Entries whose key is not an integer keep ``item_id`` NULL: they count as
    part of a record, never as a click.
    """
    rows = click_scan(click_log, asof, day_num).select(
        "role_id", "child_tab", "dt", F.posexplode(payload_entries("item_list")).alias("_pos", "_entry"))
    item, val = entry_parts("_entry")
    return (rows.groupBy("role_id", "child_tab", age("dt", asof).alias("age"), item.alias("item_id"))
            .agg(F.sum(F.when(item.isNotNull(), val)).alias("cnt"),
                 F.sum(F.when(item.isNotNull(), 1).otherwise(0)).alias("entries"),
                 F.sum(F.when(F.col("_pos") == 0, 1).otherwise(0)).alias("records")))


def daily_clicks(click_log: DataFrame, asof, day_num: int = 30, counts: DataFrame | None = None) -> DataFrame:
    """(role_id, item_id, age, click_num_day, click_num_dis_day) (A1).

    ``click_num_dis_day`` counts exploded records outside the appearance tab.
    """
    c = counts if counts is not None else log_counts(click_log, asof, day_num)
    return (c.where(F.col("item_id").isNotNull())
            .groupBy("role_id", "item_id", "age")
            .agg(F.sum("cnt").cast("bigint").alias("click_num_day"),
                 F.sum(F.when(F.col("child_tab") != TAB_APPEARANCE, F.col("entries")).otherwise(0))
                 .cast("bigint").alias("click_num_dis_day")))


def daily_buys(buy_log: DataFrame, asof, day_num: int = 30, mall_types=BUY_MALL_TYPES) -> DataFrame:
    """(role_id, item_id, age, buy_num_day): purchases per pair and day (A2)."""
    rows = scan_range(buy_log, asof, day_num).where(F.col("mall_type").isin(list(mall_types)))
    return (rows.groupBy("role_id", "item_id", age("dt", asof).alias("age"))
            .agg(F.count(F.lit(1)).alias("buy_num_day")))


def daily_opens(click_log: DataFrame, asof, day_num: int = 30, tabs=OPEN_TABS,
                counts: DataFrame | None = None) -> DataFrame:
    """(role_id, child_tab, age, open_num_day): click-log records per role, tab, day."""
    c = counts if counts is not None else log_counts(click_log, asof, day_num)
    return (c.where(F.col("child_tab").isin(list(tabs)))
            .groupBy("role_id", "child_tab", "age")
            .agg(F.sum("records").cast("bigint").alias("open_num_day")))


# -- the day-grain history of the pandas-era pipeline ------------------------

def clicked_items(click_log: DataFrame) -> DataFrame:
    """(role_id, item_id, dt, cnt): exploded clicks over all tabs (the click file)."""
    return explode_clicks(click_log).select("role_id", "item_id", "dt", "cnt")


def roles_on(active_roles: DataFrame, day) -> DataFrame:
    """Distinct roles active on ``day``."""
    return active_roles.where(F.col("dt") == F.lit(to_day(day))).select("role_id").distinct()


def restrict(df: DataFrame, roles: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Inner joins used as filters become semi joins (J1): no fan-out, no payload."""
    if roles is not None:
        df = df.join(roles.select("role_id"), "role_id", "left_semi")
    if items is not None:
        df = df.join(items.select("item_id"), "item_id", "left_semi")
    return df


def before(df: DataFrame, asof, dt: str = "dt") -> DataFrame:
    """History strictly before the as-of day."""
    return df.where(F.col(dt) < F.lit(to_day(asof)))


def band(df: DataFrame, asof, days: int, dt: str = "dt") -> DataFrame:
    """``asof - (days+1) < dt < asof`` (F5's seven-day band for ``days=7``)."""
    return df.where((F.col(dt) > F.lit(shift(asof, -(days + 1)))) & (F.col(dt) < F.lit(to_day(asof))))


def on_day(df: DataFrame, day, dt: str = "dt") -> DataFrame:
    """Single-day slice."""
    return df.where(F.col(dt) == F.lit(to_day(day)))


def click_history(clicks: DataFrame, active_roles: DataFrame, catalog: DataFrame, asof) -> DataFrame:
    """(role_id, item_id, age, cnt): clicks before ``asof`` by roles active the day
    before, on catalog items, summed per pair and day (one as-of day of
    ``history_days``)."""
    return history_days(clicks, "cnt", active_roles, catalog, [asof]).drop("asof")


# -- several as-of days in one plan -------------------------------------------

def as_of_days(days) -> list:
    """Sorted distinct as-of days."""
    days = [days] if isinstance(days, str) or not hasattr(days, "__iter__") else days
    return sorted({to_day(d) for d in days})


def active_before(active_roles: DataFrame, days) -> DataFrame:
    """(role_id, asof): roles active on the day before each as-of day."""
    prev = [shift(d, -1) for d in as_of_days(days)]
    return (active_roles.where(day_in("dt", prev))
            .select("role_id", F.date_add("dt", 1).alias("asof")).distinct())


def history_days(log: DataFrame, value: str, active_roles: DataFrame, catalog: DataFrame, days) -> DataFrame:
    """(asof, role_id, item_id, age, value) for every as-of day in one plan: rows
    before each day, by roles active the day before it, on catalog items, summed
    per (as-of, pair, day).

    The log is first summed per (role, item, day) -- one map-side-combined
    shuffle of the raw rows -- and joined to the as-of days on which its role is
    active (one row per role, at most ``len(days)`` days), so a day row is copied
    only to the days that keep it; it maps to one (as-of, pair, age) per copy, so
    no aggregation follows the copy.
    """
    days = as_of_days(days)
    rows = restrict(log.where(F.col("dt") < F.lit(days[-1])).select("role_id", "item_id", "dt", value),
                    items=catalog)
    daily = rows.groupBy("role_id", "item_id", "dt").agg(F.sum(value).cast("bigint").alias(value))
    active = active_before(active_roles, days).groupBy("role_id").agg(F.collect_set("asof").alias("_asofs"))
    spread = (daily.join(active, "role_id")
              .withColumn("asof", F.explode(F.filter("_asofs", lambda a: a > F.col("dt")))))
    return spread.select("asof", "role_id", "item_id", F.datediff("asof", "dt").cast("bigint").alias("age"), value)
