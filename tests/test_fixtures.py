"""Hand-worked goldens on the literal inputs of FIXTURES §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.constants import TAB_CLOTH
from cartwise.functions.exprs import guarded_ctr
from cartwise.functions.payload import explode_payload, extract_attributes
from cartwise.operators.metrics import item_correlation
from cartwise.operators.ranking import global_ranks
from cartwise.plans.recommend import hit_revenue_at_k


def test_payload_explode(spark):
    rows = [(1, "{9001:2,15:1}"), (2, "{9001: 2, 15: 1}"), (3, "{'9001': 2}"), (4, '{"9001":2}'),
            (5, "{}"), (6, None), (7, "{1:2,1:3}")]
    df = spark.createDataFrame(rows, "id int, item_list string")
    got = sorted(tuple(r) for r in explode_payload(df).collect())
    assert got == [(1, 15, 1), (1, 9001, 2), (2, 15, 1), (2, 9001, 2), (3, 9001, 2), (4, 9001, 2),
                   (7, 1, 2), (7, 1, 3)]


def test_avatar_text(spark):
    rows = [(1, "{'Gender': 1, 'Tshirt': 5, 'Hat': None}"), (2, "{u'Gender': 2L}"), (3, '{"Gender":3}'),
            (4, "[]")]
    df = spark.createDataFrame(rows, "id int, wear string")
    got = {r["id"]: (r["gender"], r["tshirt"], r["pants"], r["hat"], r["hair"])
           for r in extract_attributes(df).collect()}
    assert got == {1: ("1", "5", None, None, None), 2: ("2", None, None, None, None),
                   3: ("3", None, None, None, None), 4: (None, None, None, None, None)}


def _edge_log(spark, asof):
    ages = [0, 1, 2, 3, 4, 7, 8, 21, 22]
    rows = [(1, TAB_CLOTH, "{7:1}", asof - dt.timedelta(days=a)) for a in ages]
    return spark.createDataFrame(rows, "role_id bigint, child_tab string, item_list string, dt date")


def test_window_edges_across_month_end(spark):
    from cartwise.plans.role_item import pair_clicks
    asof = dt.date(2024, 3, 2)  # ages 2.. fall in February of a leap year
    r = pair_clicks(_edge_log(spark, asof), asof, day_num=30).collect()[0]
    assert (r.click_num_day, r.click_num_day3, r.click_num_week, r.click_num_month) == (2, 4, 6, 9)
    assert (r.click_day_week, r.click_day_month, r.final_click_day, r.rn_click_week) == (6, 9, 0, 1)
    # a 7-day scan drops ages 7 and beyond
    r7 = pair_clicks(_edge_log(spark, asof), asof, day_num=7).collect()[0]
    assert r7.click_num_month == 5


def test_pair_windows_exclude_the_asof_day(spark):
    from cartwise.operators.daily import click_history, clicked_items
    from cartwise.plans.pair import pair_click_features
    asof = dt.date(2024, 3, 2)
    clicks = clicked_items(_edge_log(spark, asof))
    active = spark.createDataFrame([(1, asof - dt.timedelta(days=1))], "role_id bigint, dt date")
    catalog = spark.createDataFrame([(7,)], "item_id bigint")
    hist = click_history(clicks, active, catalog, asof)
    assert hist.agg(F.min("age")).first()[0] == 1
    r = pair_click_features(hist).collect()[0]
    assert [r[f"cnt_{n}"] for n in (1, 3, 7, 14, 21)] == [1, 3, 5, 6, 7]
    assert (r.d_dt_click_final, r.d_dt_click_first) == (1, 22)
    assert (r.is_click_dt_1, r.is_click_dt_3, r.is_click_dt_7) == (1, 1, 1)
    assert r.cnt_1_ctr == 1.0  # one pair: its share of the day-1 rows is all of them


def test_rank_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 3, 1])], "id int, v bigint")
    dense = dict(global_ranks(df, {"v": "r"}, "dense").select("id", "r").collect())
    low = dict(global_ranks(df, {"v": "r"}, "min").select("id", "r").collect())
    assert [dense[i] for i in range(4)] == [1, 1, 2, 3]
    assert [low[i] for i in range(4)] == [1, 1, 3, 4]


def test_rank_many_buckets_exact(spark):
    import random
    rnd = random.Random(5)
    vals = [rnd.randint(0, 300) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v bigint")
    got = dict(global_ranks(df, {"v": "r"}, "min", buckets=16).select("id", "r").collect())
    for i, v in enumerate(vals[:200]):
        assert got[i] == 1 + sum(1 for u in vals if u > v)
    dense = dict(global_ranks(df, {"v": "r"}, "dense", buckets=16).select("id", "r").collect())
    distinct = sorted(set(vals), reverse=True)
    for i, v in enumerate(vals[:200]):
        assert dense[i] == distinct.index(v) + 1


def test_guarded_ctr(spark):
    df = spark.createDataFrame([(o,) for o in [None, 2, 4, 5, 10]], "opens bigint")
    got = [r[0] for r in df.select(guarded_ctr(F.lit(3), "opens", 5)).collect()]
    assert got == [0.0, 0.0, 0.0, 0.6, 0.3]


def test_label_grain(spark):
    from cartwise.plans.training import click_buy_outer, features_as_of, label_pairs, Logs
    asof = dt.date(2024, 1, 25)
    d = lambda n: asof - dt.timedelta(days=n)
    clicks = spark.createDataFrame([(1, 10, d(2), 3), (1, 12, d(1), 1)],
                                   "role_id bigint, item_id bigint, dt date, cnt bigint")
    buys = spark.createDataFrame([(1, 10, 1, 2.0, asof), (1, 10, 1, 2.0, asof), (1, 11, 1, 5.0, asof)],
                                 "role_id bigint, item_id bigint, buy_num bigint, price double, dt date")
    logs = Logs(clicks=clicks, buys=buys,
                active_roles=spark.createDataFrame([(1, d(1))], "role_id bigint, dt date"),
                catalog=spark.createDataFrame([(10,), (11,), (12,)], "item_id bigint"),
                role_daily=spark.createDataFrame([(1, d(1), 1.0)], "role_id bigint, dt date, c_acctbal double"),
                new_items=spark.createDataFrame([], "item_id bigint, item_name string, newdt date"))
    f = features_as_of(logs, asof)
    got = sorted(tuple(r) for r in label_pairs(click_buy_outer(f.pair_clicks, f.pair_buys), buys, asof)
                 .select("role_id", "item_id", "label").collect())
    assert got == [(1, 10, 1), (1, 12, 0)]  # item 11 was never clicked: no row


def test_hit_at_k(spark):
    ranked = spark.createDataFrame([(1, 100 + i, float(p)) for i, p in enumerate([0, 2, 4, 9, 24, 25])],
                                   "role_id bigint, item_id bigint, position double") \
        .withColumn("position", F.col("position").cast("bigint"))
    purchases = spark.createDataFrame([(1, 100 + i, float(i + 1)) for i in range(6)]
                                      + [(1, 106, 7.0), (1, 978, 8.0)],
                                      "role_id bigint, item_id bigint, price double")
    r = hit_revenue_at_k(ranked, purchases).first()
    assert [r[f"hit_{k}"] for k in (1, 3, 5, 10, 15, 20, 25)] == [1, 2, 3, 4, 4, 4, 5]
    assert [r[f"revenue_{k}"] for k in (1, 3, 5, 10, 25)] == [1.0, 3.0, 6.0, 10.0, 15.0]
    assert (r.total, r.missed, r.skipped) == (6, 1, 1)
    rates = [r[f"hit_rate_{k}"] for k in (1, 3, 5, 10, 15, 20, 25)]
    assert rates == sorted(rates)


def test_correlation_guards(spark):
    rows = [("r1", "A", 2), ("r2", "A", 2), ("r3", "A", 2), ("r1", "B", 1), ("r2", "B", 2), ("r3", "B", 3),
            ("r1", "C", 1), ("r2", "C", 4), ("r3", "C", 9), ("r1", "D", 5), ("r4", "D", 1)]
    ids = {"A": 1, "B": 2, "C": 3, "D": 4}
    df = spark.createDataFrame([(int(r[1:]), ids[i], q) for r, i, q in rows], "role_id bigint, item_id bigint, num bigint")
    got = {(r.item1, r.item2): (r.n_roles, r.corr) for r in item_correlation(df, [1, 2], [2, 3, 4]).collect()}
    assert got[(1, 2)] == (3, None)         # A has zero variance
    assert got[(1, 4)] == (1, None)         # one shared role only
    assert got[(2, 3)][1] == pytest.approx(0.989743318610787)  # numpy corrcoef
    assert got[(2, 2)][1] == pytest.approx(1.0)


@pytest.mark.parametrize("bucketing", ["log2", "quantile"])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_bucketings_agree_with_brute_force(spark, bucketing, descending):
    import random
    rnd = random.Random(11)
    vals = [rnd.choice([0, 1, 1, 2, 3, 7, 8, 15, 16, 1000, 1023, 1024]) + rnd.randint(0, 3) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v bigint")
    for method in ("dense", "min"):
        got = dict(global_ranks(df, {"v": "r"}, method, descending=descending, bucketing=bucketing)
                   .select("id", "r").collect())
        order = sorted(set(vals), reverse=descending)
        for i, v in enumerate(vals):
            if method == "dense":
                assert got[i] == order.index(v) + 1
            else:
                better = [u for u in vals if (u > v if descending else u < v)]
                assert got[i] == 1 + len(better)


def test_open_windows_are_strict(spark):
    """Opens count ages < N (day = age 0 only), clicks ages <= N."""
    from cartwise.constants import TAB_MALL
    from cartwise.plans.role_item import role_opens
    asof = dt.date(2024, 1, 30)
    rows = [(1, tab, "{7:1}", asof - dt.timedelta(days=a)) for a in (0, 1, 3, 7) for tab in (TAB_CLOTH, TAB_MALL)]
    log = spark.createDataFrame(rows, "role_id bigint, child_tab string, item_list string, dt date")
    r = role_opens(log, asof, 30).first()
    assert (r.UIMallCloth_day, r.UIMallCloth_day3, r.UIMallCloth_week, r.UIMallCloth_month) == (1, 2, 3, 4)
    assert (r.UIMall_day, r.UIMall_day3, r.UIMall_week, r.UIMall_month) == (1, 2, 3, 4)


def test_undefined_ratios_are_zero(spark):
    """X / 0 and 0 / 0 give 0, never an infinity or NaN."""
    from cartwise.functions.exprs import safe_ratio
    df = spark.createDataFrame([(1, 0), (0, 0), (3, 2), (None, 1)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.0, 0.0, 1.5, 0.0]


@pytest.mark.parametrize("n_items", [None, 1500])
def test_bucketed_grid_is_every_pair_once(spark, n_items):
    from cartwise.operators.joins import bucketed_grid
    keys = spark.createDataFrame([(r,) for r in (1, 2, 3, 7)], "role_id bigint")
    items = spark.createDataFrame([(i,) for i in range(1500)], "item_id bigint")
    grid = bucketed_grid(keys, items, items_per_bucket=256, n_items=n_items)  # 6 buckets
    got = sorted(tuple(r) for r in grid.select("role_id", "item_id").collect())
    assert got == sorted((r, i) for r in (1, 2, 3, 7) for i in range(1500))
