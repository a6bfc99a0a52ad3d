"""Training and test sets (Q10, Q11); the factorisation columns are added by
``plans.factorize.with_factor_features``.

Grain is fixed first (R6, R9, R10): one row per (as-of day, role, item).
Click and buy pair features are full-outer joined, 0-filled, restricted to
the day's buyers, labelled, then joined to role and item features.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.dates import day_in, shift, to_day
from cartwise.operators.daily import as_of_days, history_days, on_day, restrict, roles_on
from cartwise.operators.joins import bounded_broadcast
from cartwise.session import materialize as write_once
from cartwise.plans.pair import (item_features, item_is_new_days, pair_buy_features, pair_click_features,
                                 role_features, role_profile_days)

PAIR = ["role_id", "item_id"]


@dataclass
class Logs:
    """The logical inputs of the pipeline (all lazy)."""

    clicks: DataFrame       # (role_id, item_id, dt, cnt): exploded click log
    buys: DataFrame         # (role_id, item_id, buy_num, price, dt, ...): purchases
    active_roles: DataFrame  # (role_id, dt)
    catalog: DataFrame      # (item_id)
    role_daily: DataFrame   # (role_id, dt, <role features>)
    new_items: DataFrame    # (item_id, item_name, newdt)
    _catalog_rows: int | None = field(default=None, init=False, repr=False)
    _catalog_table: DataFrame | None = field(default=None, init=False, repr=False)

    def catalog_table(self) -> DataFrame:
        """The catalog written once (it is derived from the whole event log and
        filters every history row)."""
        if self._catalog_table is None:
            self._catalog_table = write_once(self.catalog)
        return self._catalog_table

    def catalog_rows(self) -> int:
        """Catalog size, counted once: the proven bound of every item-grain table."""
        if self._catalog_rows is None:
            self._catalog_rows = self.catalog_table().count()
        return self._catalog_rows

    def item_side(self, items: DataFrame) -> DataFrame:
        """Broadcast an item-grain table (one row per catalog item) only when the
        counted catalog is under the broadcast bound; otherwise a shuffle join."""
        return bounded_broadcast(items, self.catalog_rows())

    def written(self) -> "Logs":
        """The logs with the exploded clicks, purchases, active roles and catalog
        written once (the click file of the original ingest step): every as-of
        day then reads them instead of re-deriving them from the raw events."""
        out = Logs(clicks=write_once(self.clicks), buys=write_once(self.buys),
                   active_roles=write_once(self.active_roles), catalog=self.catalog_table(),
                   role_daily=self.role_daily, new_items=self.new_items)
        out._catalog_table, out._catalog_rows = self._catalog_table, self._catalog_rows
        return out


KEY = ["asof"]


class Features:
    """All features of several as-of days in one plan, keyed by ``asof``; each
    grain built on first use.

    History rows are copied once per later as-of day (at most ``len(days)``
    copies) and every aggregate, share, rank and join carries ``asof`` in its
    key, so N training days are one set of shuffles instead of N plans.
    """

    def __init__(self, logs: "Logs", days):
        self.logs, self.days = logs, as_of_days(days)
        # the catalog filters every history row: broadcast it under the counted
        # bound, so a hot item never concentrates a sort-merge semi join in one task
        self._catalog = logs.item_side(logs.catalog_table())

    # the day-grain histories feed the pair aggregate, the shares and the role
    # and item windows: each is written once and read by all of them
    @cached_property
    def click_hist(self) -> DataFrame:
        return write_once(history_days(self.logs.clicks, "cnt", self.logs.active_roles, self._catalog, self.days))

    @cached_property
    def buy_hist(self) -> DataFrame:
        return write_once(history_days(self.logs.buys, "buy_num", self.logs.active_roles, self._catalog,
                                       self.days))

    @cached_property
    def pair_clicks(self) -> DataFrame:
        return pair_click_features(self.click_hist, keys=KEY)

    @cached_property
    def pair_buys(self) -> DataFrame:
        return pair_buy_features(self.buy_hist, keys=KEY)

    @cached_property
    def roles(self) -> DataFrame:
        profile = role_profile_days(self.logs.role_daily, self.logs.active_roles, self.days)
        return role_features(profile, self.click_hist, self.buy_hist, KEY)

    @cached_property
    def items(self) -> DataFrame:
        """(asof, item) grain: catalog x days rows, broadcast only under the bound."""
        items = item_is_new_days(self.logs.catalog_table(), self.logs.new_items, self.days)
        feats = item_features(items, self.click_hist, self.buy_hist, KEY)
        return bounded_broadcast(feats, self.logs.catalog_rows() * len(self.days))


class AsOf:
    """The features of one as-of day, ``asof`` dropped: ``Features`` over that
    day alone, or a filtered view of a keyed ``Features`` already covering it
    (its grains are written tables, so the filter prunes at the scan)."""

    def __init__(self, logs: Logs, asof, features: "Features | None" = None):
        self.logs, self.asof = logs, asof
        self._f = features if features is not None else Features(logs, [asof])
        self._day = F.col("asof") == F.lit(to_day(asof))

    def _view(self, df: DataFrame) -> DataFrame:
        return df.where(self._day).drop("asof")

    @cached_property
    def click_hist(self) -> DataFrame:
        return self._view(self._f.click_hist)

    @cached_property
    def buy_hist(self) -> DataFrame:
        return self._view(self._f.buy_hist)

    @cached_property
    def pair_clicks(self) -> DataFrame:
        return self._view(self._f.pair_clicks)

    @cached_property
    def pair_buys(self) -> DataFrame:
        return self._view(self._f.pair_buys)

    @cached_property
    def roles(self) -> DataFrame:
        return self._view(self._f.roles)

    @cached_property
    def items(self) -> DataFrame:
        """Item grain, broadcast only under the counted catalog bound."""
        return self.logs.item_side(self._view(self._f.items))


def features_as_of(logs: Logs, asof) -> AsOf:
    return AsOf(logs, asof)


def click_buy_outer(pair_clicks: DataFrame, pair_buys: DataFrame, keys=()) -> DataFrame:
    """Full outer join of click and buy pair features, 0-filled."""
    return pair_clicks.join(pair_buys, [*keys, *PAIR], "full").fillna(0)


def label_pairs(pairs: DataFrame, buy_log: DataFrame, asof) -> DataFrame:
    """Rows of roles that bought on ``asof``; ``label`` = pair bought that day (J9,
    R10): ``label_pairs_days`` of one day."""
    day = F.lit(to_day(asof))
    return label_pairs_days(pairs.withColumn("asof", day), buy_log, [asof]).drop("asof")


def label_pairs_days(pairs: DataFrame, buy_log: DataFrame, days) -> DataFrame:
    """``label_pairs`` for every as-of day of ``pairs`` at once (keyed by ``asof``)."""
    pos = (buy_log.where(day_in("dt", as_of_days(days)))
           .select(F.col("dt").alias("asof"), "role_id", "item_id").distinct()
           .withColumn("label", F.lit(1).cast("bigint")))
    buyers = pos.select("asof", "role_id").distinct()
    return (pairs.join(buyers, ["asof", "role_id"], "left_semi")
            .join(pos, ["asof", *PAIR], "left")
            .withColumn("label", F.coalesce(F.col("label"), F.lit(0)).cast("bigint")))


def assemble(pairs: DataFrame, f, keys=()) -> DataFrame:
    """Pair rows joined to role and item features (J6); item side is catalog-sized."""
    return pairs.join(f.roles, [*keys, "role_id"]).join(f.items, [*keys, "item_id"])


def training_rows(logs: Logs, asof_days, materialize: bool | None = None) -> DataFrame:
    """Labelled rows of one or several as-of days in one plan keyed by ``asof``
    (Q10, U1).

    With several days the exploded logs are first written once under the shared
    checkpoint folder (the original's click file), so the plan starts from them.
    """
    days = as_of_days(asof_days)
    if materialize is None:
        materialize = len(days) > 1
    if materialize:
        logs = logs.written()
    return training_rows_from(Features(logs, days), logs.buys, days)


def training_rows_from(f: Features, buy_log: DataFrame, days) -> DataFrame:
    """Labelled rows of ``days`` taken from keyed features that may cover more days
    (e.g. the training days plus the test day in one plan)."""
    days = as_of_days(days)
    pairs = click_buy_outer(f.pair_clicks, f.pair_buys, KEY)
    if set(days) != set(f.days):
        pairs = pairs.where(day_in("asof", days))
    return assemble(label_pairs_days(pairs, buy_log, days), f, KEY)


def day_buyers(buy_log: DataFrame, active_roles: DataFrame, asof) -> DataFrame:
    """Roles that bought on ``asof`` and were active the day before."""
    return restrict(on_day(buy_log, asof).select("role_id").distinct(),
                    roles_on(active_roles, shift(asof, -1)))


def test_rows(logs: Logs, asof) -> DataFrame:
    """Unlabelled rows of the day's buyers."""
    f = Features(logs, [asof])
    pairs = click_buy_outer(f.pair_clicks, f.pair_buys, KEY)
    buyers = day_buyers(logs.buys, logs.active_roles, asof).withColumn("asof", F.lit(to_day(asof)))
    return assemble(pairs.join(buyers, ["asof", "role_id"], "left_semi"), f, KEY)


def train_counts(rows: DataFrame) -> DataFrame:
    """Rows, positive rows and distinct items of a training set."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).cast("bigint").alias("n_positive"),
                    F.countDistinct("item_id").alias("n_items"))
