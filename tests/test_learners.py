"""Exact top lists, ranking-loss vectors and the factorisation machine against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F


def vectors(rng, n, rank, name, spread=3.0):
    x = rng.normal(size=(n, rank)) * np.exp(rng.normal(size=(n, 1)) * spread / 3)
    return [(int(i), [float(np.float32(c)) for c in r]) for i, r in enumerate(x)], f"{name} bigint, features array<float>"


@pytest.mark.parametrize("n_items,k", [(3000, 25), (40, 25), (10, 25)])
def test_top_products_equal_the_grid(spark, n_items, k):
    from cartwise.plans import top_products as T
    rng = np.random.default_rng(n_items)
    roles, items = vectors(rng, 60, 8, "role_id", 0.5), vectors(rng, n_items, 8, "item_id")
    items[0][5] = (5, items[0][6][1])  # equal scores
    u, v = (np.array([x for _, x in t[0]], np.float32) for t in (roles, items))
    score = np.zeros((60, n_items))
    for i in range(8):
        score += (u[:, i:i + 1] * v[:, i]).astype(np.float64)
    want = {(r, p): (int(i), score[r, i]) for r in range(60)
            for p, i in enumerate(np.lexsort((np.arange(n_items), -score[r]))[:k])}
    lists, scored = T.top_products(spark.createDataFrame(*roles), spark.createDataFrame(*items), k)
    assert {(r.role_id, r.position): (r.item_id, r.score) for r in lists.collect()} == want
    assert scored < 60 * n_items if n_items > 1000 else scored <= 60 * n_items
    none, _ = T.top_products(spark.createDataFrame(*roles).limit(0), spark.createDataFrame(*items), k)
    assert none.count() == 0


def test_recommend_top_is_the_head_of_the_whole_lists(spark):
    import __spark_entry__ as E
    from cartwise.constants import MF_CATALOG_BLACKLIST
    from cartwise.plans.factorize import recommend_fallback
    from cartwise.plans.top_products import recommend_top
    from cartwise.plans.training import day_buyers
    sf = "/root/testdata/sf0.01"
    lg, fs = E._logs(spark, sf), E._factors(spark, sf, E.TEST_ASOF)
    buyers, catalog = day_buyers(lg.buys, lg.active_roles, E.TEST_ASOF), E._mf_catalog(spark, sf)
    rows = lambda df: sorted((r.role_id, r.position, r.item_id, r.score, r.source) for r in df.collect())
    top, _ = recommend_top(buyers, fs, catalog, 25, MF_CATALOG_BLACKLIST)
    assert rows(top) == rows(recommend_fallback(buyers, fs, catalog).where("position < 25"))


def plain_fm(rows, labels, rank, sweeps, penalty, starts, numbers):
    """The same descent with dense arrays: ``rows`` are dicts feature -> x, one per field."""
    theta = {**starts, **numbers}
    p = np.mean(labels)
    base = np.log(p / (1 - p))

    def score(r):
        q = sum(theta[f][1:] * x for f, x in r)
        return base + sum(theta[f][0] * x for f, x in r) + (q @ q - sum(theta[f][1:] @ theta[f][1:] * x * x for f, x in r)) / 2

    def loss():
        y = np.array([score(r) for r in rows])
        return float(np.sum(np.logaddexp(0, y) - labels * y) + penalty / 2 * sum(t @ t for t in theta.values()))

    losses = [loss()]
    for _ in range(sweeps):
        for field in range(len(rows[0])):
            y = np.array([score(r) for r in rows])
            work = y + 4 * (labels - 1 / (1 + np.exp(-y)))
            eq = {}
            for r, full, z in zip(rows, y, work):
                f, x = r[field]
                s = sum((theta[g][1:] * u for j, (g, u) in enumerate(r) if j != field), np.zeros(rank))
                d = x * np.concatenate([[1.0], s])
                a, b = eq.setdefault(f, (np.zeros((rank + 1, rank + 1)), np.zeros(rank + 1)))
                a += np.outer(d, d)
                b += d * (z - full + d @ theta[f])
            for f, (a, b) in eq.items():
                theta[f] = np.linalg.solve(a + 4 * penalty * np.eye(rank + 1), b)
        losses.append(loss())
    return np.array([1 / (1 + np.exp(-score(r))) for r in rows]), losses


def test_fm_equals_a_plain_descent_and_the_loss_falls(spark):
    from cartwise.plans.fm import _start, fit_fm
    rng = np.random.default_rng(4)
    n, rank = 200, 3
    data = [(int(rng.integers(12)), int(rng.integers(8)), float(rng.normal()), float(rng.normal() * 5 + 2)) for _ in range(n)]
    label = [int(rng.random() < (0.8 if (r + i) % 3 == 0 else 0.2)) for r, i, _, _ in data]
    df = spark.createDataFrame([(*r, y) for r, y in zip(data, label)], "role_id int, item_id int, a double, b double, label int")
    got = fit_fm(df.repartition(3), numeric=("a", "b"), rank=rank, sweeps=3, penalty=0.3)
    starts = {}
    for field, (c, size) in enumerate((("role_id", 12), ("item_id", 8))):
        keys = spark.range(size).select(F.col("id").cast("string").alias("k"))
        for r in keys.select("k", _start(F.col("k"), rank, 3, field).alias("v")).collect():
            starts[c, r.k] = np.concatenate([[0.0], r.v])
    draw = np.random.default_rng(3)
    numbers = {c: np.concatenate([[0.0], (draw.random(rank) - 0.5) * 0.1]) for c in ("a", "b")}
    x = np.array([r[2:] for r in data])
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    rows = [[(("role_id", str(r)), 1.0), (("item_id", str(i)), 1.0), ("a", u), ("b", w)] for (r, i, _, _), (u, w) in zip(data, x)]
    want, losses = plain_fm(rows, np.array(label, float), rank, 3, 0.3, starts, numbers)
    assert got.losses == pytest.approx(losses, rel=1e-8)
    assert all(b < a for a, b in zip(got.losses, got.losses[1:]))
    scores = {(r.role_id, r.item_id, r.a, r.b): r.score for r in got.rows.collect()}
    assert [scores[r] for r in data] == pytest.approx(want.tolist(), abs=1e-8)
    assert got.tables["role_id"].count() == 12


def test_fm_edges(spark):
    from cartwise.plans.fm import fit_fm
    df = spark.createDataFrame([(1, None, 0.5, 1), (1, 2, None, 0), (2, None, 1.0, 0)],
                               "role_id int, item_id int, a double, label int")
    out = fit_fm(df, numeric=("a",), rank=2, sweeps=1)
    assert out.rows.where("score > 0 AND score < 1").count() == 3
    assert fit_fm(df.limit(0), numeric=("a",), rank=2, sweeps=1).rows.count() == 0


def planted_clicks(spark, seed=1):
    """Roles like one third of the items each; some items are popular with everybody."""
    rng = np.random.default_rng(seed)
    rows, held = [], {}
    for role in range(150):
        own = rng.choice(np.arange(role % 3, 60, 3), 9, replace=False)
        held[role] = int(own[0])
        rows += [(role, int(i), int(rng.integers(1, 4))) for i in own[1:]]
        rows += [(role, int(60 + i), 1) for i in rng.choice(5, 2, replace=False)]
    return spark.createDataFrame(rows, "role_id bigint, item_id bigint, num bigint"), held


def test_ranking_loss_beats_popularity_and_any_partitioning_gives_the_same(spark):
    from cartwise.plans.ranking_loss import fit_ranking
    train, held = planted_clicks(spark)
    fs = fit_ranking(train.coalesce(1), rank=6, epochs=8)
    u = {r.role_id: np.array(r.features) for r in fs.roles.collect()}
    v = {r.item_id: np.array(r.features) for r in fs.items.collect()}
    assert len(u) == 150 and len(v) == 65 and {len(x) for x in [*u.values(), *v.values()]} == {7}
    seen, popular = {}, {}
    for r in train.collect():
        seen.setdefault(r.role_id, set()).add(r.item_id)
        popular[r.item_id] = popular.get(r.item_id, 0) + 1
    hit = lambda key: np.mean([held[r] in sorted((i for i in v if i not in seen[r]), key=lambda i: -key(r, i))[:10]
                               for r in held])
    learned, base = hit(lambda r, i: u[r] @ v[i]), hit(lambda r, i: popular[i])
    assert learned > base + 0.2
    again = fit_ranking(train.repartition(7), rank=6, epochs=8)
    assert {r.role_id: r.features for r in again.roles.collect()} == {k: x.tolist() for k, x in u.items()}
    assert {r.item_id: r.features for r in again.items.collect()} == {k: x.tolist() for k, x in v.items()}


def test_ranking_loss_edges(spark):
    from cartwise.plans.ranking_loss import fit_ranking
    train, _ = planted_clicks(spark)
    assert fit_ranking(train.limit(0), epochs=1).roles.count() == 0
    one = fit_ranking(train.limit(1), rank=3, epochs=1)
    assert one.roles.count() == one.items.count() == 1


def test_fm_number_pass_reads_rows_once_with_the_steps_before_it():
    """A numeric column's sums, steps of other columns since the last write included, from plain batches."""
    import pyarrow as pa
    from cartwise.plans.fm import _kept, _lists, _names, _number_equations
    rng = np.random.default_rng(2)
    n, rank = 50, 3
    y, q, x0, x1, label = rng.normal(size=n), rng.normal(size=(n, rank)), rng.normal(size=n), rng.normal(size=n), rng.integers(0, 2, n) * 1.0
    batch = pa.RecordBatch.from_arrays([pa.array([*label[:-1], None]), pa.array(y), _lists(q), pa.array(x0), pa.array(x1)],
                                       ["label", "y", "q", "x0", "x1"])
    old, new, t = (rng.normal(size=rank + 1) * 0.1 for _ in range(3))
    s = q - x0[:, None] * old[1:]
    y2 = y - x0 * (old[0] + s @ old[1:]) + x0 * (new[0] + s @ new[1:])
    q2 = s + x0[:, None] * new[1:]
    s = q2 - x1[:, None] * t[1:]
    d = x1[:, None] * np.hstack([np.ones((n, 1)), s])
    r = 4 * (label - 1 / (1 + np.exp(-y2))) + x1 * t[0] + x1 * (s @ t[1:])
    (got,) = _number_equations("x1", t, [("x0", old, new)], rank)([batch.slice(0, 20), batch.slice(20)])
    row = got.to_pylist()[0]
    a, b = d.T @ d, d[:-1].T @ r[:-1]  # the row without a label has no response
    assert list(row) == _names(rank)
    assert [row[f"b{i}"] for i in range(rank + 1)] == pytest.approx(b.tolist())
    assert all(row[f"a{i}_{j}"] == pytest.approx(a[i, j]) for i in range(rank + 1) for j in range(i + 1))
    (kept,) = _kept([("x0", old, new)], rank)([batch])
    assert np.allclose(kept.column("y"), y2) and np.allclose(kept.column("q").to_pylist(), q2)
    assert not list(_number_equations("x1", t, [], rank)([]))
