"""Boosted trees: exact splits, leaf-wise shape, ends by patience, same for any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.constants import GBT_LEAVES
from cartwise.plans import boosting
from cartwise.plans.boosting import BINS, LEAST_CURVATURE, LEAST_ROWS, Boosted, Tree, best_split
from cartwise.plans.models import fit_report, train_gbt


def planted(spark, n=3000, signal=True, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    p = 0.05 + (0.8 * (x[:, 0] > 0.6) * (x[:, 1] > 0.5) if signal else 0)
    y = rng.random(n) < p
    rows = [(i, 1, *(float(v) for v in r), None if i % 50 == 0 else float(r[0]), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "role_id int, item_id int, a double, b double, c double, d double, e double, label int")


def test_best_split_equals_a_plain_search():
    rng = np.random.default_rng(1)
    x, g, h = rng.integers(0, BINS, (500, 3)), rng.normal(size=500), rng.random(500) * 0.25
    hist = np.zeros((3, 3, BINS))
    for f in range(3):
        for v, out in ((g, 0), (h, 1), (np.ones(500), 2)):
            hist[out, f] = np.bincount(x[:, f], v, BINS)
    want = (-np.inf, None, None)
    for f in range(3):
        for z in range(BINS - 1):
            side = x[:, f] <= z
            if min(side.sum(), (~side).sum()) < LEAST_ROWS or min(h[side].sum(), h[~side].sum()) < LEAST_CURVATURE:
                continue
            gain = g[side].sum() ** 2 / h[side].sum() + g[~side].sum() ** 2 / h[~side].sum() - g.sum() ** 2 / h.sum()
            if gain > want[0] + 1e-9:
                want = (gain, f, z)
    got = best_split(hist)
    assert got[1:] == want[1:] and got[0] == pytest.approx(want[0])


def test_first_tree_equals_a_plain_leaf_wise_tree(spark):
    """One tree on all rows and columns against a plain best-first search."""
    df = planted(spark, 500)
    model = boosting.fit(df, ["a", "b", "c"], F.col("role_id").cast("bigint"), F.lit(False), rounds=1, part=1.0, columns=1.0)
    rows = np.array([[r.a, r.b, r.c, r.label] for r in df.collect()])
    bins = np.stack([1 + np.searchsorted(c, rows[:, i], "left") for i, c in enumerate(model.cuts)], axis=1)
    p = 1 / (1 + np.exp(-model.base))
    g, h = p - rows[:, 3], np.full(len(rows), p * (1 - p))

    def split(side, depth):
        best = None
        for f in range(3):
            for z in range(BINS - 1):
                left = side & (bins[:, f] <= z)
                right = side & (bins[:, f] > z)
                if depth == 4 or min(left.sum(), right.sum()) < LEAST_ROWS or min(h[left].sum(), h[right].sum()) < LEAST_CURVATURE:
                    continue
                gain = (g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum()
                        - g[side].sum() ** 2 / h[side].sum())
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, left, right)
        return best

    leaves = [(np.ones(len(rows), bool), 0)]
    while len(leaves) < GBT_LEAVES:
        found = [(split(s, d), i) for i, (s, d) in enumerate(leaves)]
        found = [(x, i) for x, i in found if x]
        if not found:
            break
        (_, left, right), i = max(found, key=lambda t: t[0][0])
        depth = leaves.pop(i)[1]
        leaves += [(left, depth + 1), (right, depth + 1)]
    want = np.zeros(len(rows))
    for side, _ in leaves:
        want[side] = -0.02 * g[side].sum() / h[side].sum()
    tree = model.trees[0]
    assert tree.leaf_count() == len(leaves) > 4
    assert tree.value[tree.leaves(bins.astype(np.uint8))] == pytest.approx(want, abs=1e-7)


def test_signal_is_learned_and_noise_keeps_the_constant(spark):
    model, _ = train_gbt(planted(spark), rounds=60)
    r = fit_report(spark, model).first()
    assert r.holdout_loss < 0.8 * r.constant_loss
    assert all(t.leaf_count() <= GBT_LEAVES for t in model.trees) and max(t.leaf_count() for t in model.trees) > 8
    noise, _ = train_gbt(planted(spark, 800, signal=False), patience=4)
    r = fit_report(spark, noise).first()
    assert r.holdout_loss <= r.constant_loss and r.rounds == r.best_round + 4 < 1000


def test_partitioning_does_not_change_the_trees(spark):
    df = planted(spark, 1200)
    a, b = (train_gbt(d, rounds=17)[0] for d in (df.coalesce(1), df.repartition(5)))
    assert a.losses == b.losses and a.fitted == 17
    for x, y in zip(a.trees, b.trees):
        assert (x.feature == y.feature).all() and (x.bin == y.bin).all() and (x.value == y.value).all()


def test_saved_model_scores_alike(spark, tmp_path):
    tree = Tree(np.full(32, -1), np.zeros(32, np.int64), np.zeros(32))
    tree.feature[1], tree.bin[1], tree.value[2], tree.value[3] = 0, 2, -1.0, 2.0
    model = Boosted(["a"], [[0.5, 1.5, 2.5]], -0.5, [tree], [0.3, 0.2], 2)
    rows = spark.createDataFrame([(0.0,), (1.5,), (1.6,), (9.0,), (None,)], "a double")
    again = boosting.load(spark, boosting.save(model, spark, f"file://{tmp_path}/model"))
    want = [1 / (1 + np.exp(-(-0.5 + v))) for v in (-1, -1, 2, 2, -1)]
    for m in (model, again):
        assert [r.score for r in boosting.score(m, rows).collect()] == pytest.approx(want)
    assert (again.losses, again.fitted, again.best_round, again.features) == ([0.3, 0.2], 2, 1, ["a"])


def test_edges(spark):
    df = planted(spark, 60)
    empty, _ = train_gbt(df.limit(0), features=["a"], rounds=2)
    assert boosting.score(empty, df).count() == 60
    one, _ = train_gbt(df.where("label = 0"), features=["a"], rounds=2)
    assert boosting.score(one, df).where("score > 0.01").count() == 0
    nothing, _ = train_gbt(df.withColumn("a", F.lit(None).cast("double")), features=["a"], rounds=2)
    assert all(t.leaf_count() == 1 for t in nothing.trees)


def test_item_rate_sees_only_earlier_days(spark):
    from cartwise.plans.target_rate import item_rates, with_item_rate
    rng = np.random.default_rng(2)
    rows = [(f"2024-01-{d:02d}", int(rng.integers(6)), int(rng.random() < 0.3)) for d in (3, 4, 6, 9) for _ in range(40)]
    df = spark.createDataFrame(rows, "day string, item_id bigint, label bigint").withColumn("asof", F.col("day").cast("date"))
    items = spark.createDataFrame([(i,) for i in range(8)], "item_id bigint")
    got = {(str(r.asof), r.item_id): r.item_rate for r in item_rates(df, items, ["2024-01-10"]).collect()}

    def plain(day, item):
        past = [r for r in rows if r[0] < day]
        if not past:
            return 0.0
        own = [r[2] for r in past if r[1] == item]
        return (sum(own) + 10 * sum(r[2] for r in past) / len(past)) / (len(own) + 10)

    want = {(d, i): plain(d, i) for d, i in {(r[0], r[1]) for r in rows} | {("2024-01-10", i) for i in range(8)}}
    assert got == pytest.approx(want)
    # other labels on a row's own day or later change nothing
    turned = df.withColumn("label", F.expr("IF(day >= '2024-01-06', 1 - label, label)"))
    again = {(str(r.asof), r.item_id): r.item_rate for r in item_rates(turned).collect()}
    assert all(again[k] == pytest.approx(want[k]) for k in again if k[0] <= "2024-01-06")
    out = with_item_rate(df, item_rates(df))
    assert out.count() == len(rows) and out.where("item_rate IS NULL").count() == 0


def test_evaluation_reads_lists_cut_before_the_shuffle(spark, sf_dir):
    import __spark_entry__ as E
    from cartwise.plans.recommend import hit_revenue_at_k, hit_revenue_from_top, recommend_list
    e = E._evaluation(spark, sf_dir)
    cut = recommend_list(e["scored"], e["top"], e["bought"], limit=25)
    assert "WindowGroupLimit" in cut._jdf.queryExecution().executedPlan().toString()
    whole = recommend_list(e["scored"], e["top"], e["bought"])
    assert cut.count() == whole.where("position < 25").count()
    a = hit_revenue_from_top(cut, e["purchases"], e["logs"].catalog, e["top"], e["bought"]).first()
    b = hit_revenue_at_k(whole, e["purchases"]).first()
    assert a.asDict() == pytest.approx(b.asDict())


def test_histograms_apply_the_trees_only_to_rows_of_the_nodes_asked_for(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(5)
    n, width = 400, 3
    x = rng.integers(0, BINS, (n, width)).astype(np.uint8)
    packed = pa.array([r.tobytes() for r in x], pa.binary())
    label, held = rng.integers(0, 2, n) * 1.0, np.arange(n) % 5 == 0
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(label), pa.array(held), packed, pa.array(np.zeros(n))],
                                       ["key", "label", "held", "x", "margin"])

    def tree(feature, cut, left, right):
        f = np.full(32, -1)
        f[1] = feature
        value = np.zeros(32)
        value[2:4] = left, right
        return Tree(f, np.full(32, cut), value)

    since, now = [tree(0, 20, -0.3, 0.2)], tree(1, 9, 0, 0)
    rows = []
    margin = boosting._margin
    monkeypatch.setattr(boosting, "_margin", lambda m, x, s: (rows.append(len(x)), margin(m, x, s))[1])
    (out,) = boosting._histograms(width, since, now, [2], [0, 2], 0, 1.0, False)([batch])
    mine = ~held & (x[:, 1] <= 9)
    assert rows == [mine.sum()]
    p = 1 / (1 + np.exp(-np.where(x[:, 0] <= 20, -0.3, 0.2)))
    g = np.rint((p - label) * boosting.UNIT).astype(np.int64)
    want = {(2, f, z): (int(g[mine & (x[:, f] == z)].sum()), int((mine & (x[:, f] == z)).sum()))
            for f in (0, 2) for z in set(x[mine][:, f].tolist())}
    assert {(r["node"], r["feature"], r["bin"]): (r["g"], r["n"]) for r in out.to_pylist()} == want
