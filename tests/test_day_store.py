"""Day store and day bitmaps."""

import os
import random

from pyspark.sql import functions as F


def files(path):
    """File -> (size, modified) of the data files; paths of the checked folder only."""
    return {os.path.join(d, f): (os.stat(os.path.join(d, f)).st_size, os.stat(os.path.join(d, f)).st_mtime_ns)
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def store_of(spark, tmp_path, name, rows):
    from cartwise.sources.day_store import DayStore
    df = spark.createDataFrame(rows, "role_id bigint, n bigint, dt date")
    return DayStore(spark, name, f"file://{tmp_path}/{name}", buckets=4).create(df).load(df)


def rows_of(seed, days=(1, 2, 3)):
    import datetime
    rng = random.Random(seed)
    return [(rng.randrange(20), rng.randrange(9), datetime.date(2024, 1, d)) for d in days for _ in range(50)]


def test_reloading_a_day_changes_only_its_files(spark, tmp_path):
    rows = rows_of(1)
    store = store_of(spark, tmp_path, "reload_a", rows)
    before = files(tmp_path / "reload_a")
    changed = [(r, n + 1, d) for r, n, d in rows if d.day == 2]
    store.load(spark.createDataFrame(changed, "role_id bigint, n bigint, dt date"))
    after = files(tmp_path / "reload_a")
    same = lambda fs, day: {k: v for k, v in fs.items() if f"dt=2024-01-0{day}" in k}
    assert same(before, 1) == same(after, 1) != {} and same(before, 3) == same(after, 3) != {}
    assert not set(same(before, 2)) & set(same(after, 2))
    want = sorted([r for r in rows if r[2].day != 2] + changed)
    assert sorted(tuple(r) for r in store.read().select("role_id", "n", "dt").collect()) == want
    assert {r.dt.day for r in store.read(["2024-01-03"]).collect()} == {3}
    from cartwise.sources.day_store import DayStore
    found = DayStore(spark, "reload_b", f"file://{tmp_path}/reload_a", buckets=4).create(store.read().select("role_id", "n", "dt"))
    assert found.read().count() == len(want)


def test_joins_on_the_role_need_no_exchange(spark, tmp_path):
    a, b = (store_of(spark, tmp_path, f"join_{i}", rows_of(i)) for i in (3, 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.totals("n", "x").join(b.totals("n", "y"), "role_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        got = {r.role_id: (r.x, r.y) for r in j.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    total = lambda s: {r: sum(n for x, n, _ in rows_of(s) if x == r) for r in range(20)}
    assert got == {r: (total(3)[r], total(4)[r]) for r in got} and len(got) > 15


def test_bitmaps_equal_sets_of_days(spark):
    from cartwise.operators import day_bits as B
    rng = random.Random(5)
    days = 150
    rows = [(k, rng.choice([1, 2, 63, 64, 65, 128, 129, 150, rng.randint(1, 150), 151, 0])) for k in range(60) for _ in range(rng.randint(1, 8))]
    df = spark.createDataFrame(rows, "k int, age int")
    words = B.day_words(df, ["k"], days)
    w = F.col("days")
    cut = B.words_for(days) * B.WORD
    for by in (0, 1, 63, 64, 70):
        out = words.select("k", B.shifted(w, by, days).alias("days")).select(
            "k", *[B.active_in(w, n).alias(f"n{n}") for n in (1, 7, 64, 65, 150)], B.last_age(w, days).alias("last"),
            B.first_age(w, days).alias("first")).collect()
        for r in out:
            ages = {a + by for k, a in rows if k == r.k and 1 <= a and 1 <= a + by <= cut and a <= cut}
            assert [r[f"n{n}"] for n in (1, 7, 64, 65, 150)] == [sum(a <= n for a in ages) for n in (1, 7, 64, 65, 150)]
            assert (r["last"], r["first"]) == (min(ages, default=None), max(ages, default=None))
    half = [B.day_words(df.where(c), ["k"], days) for c in ("age < 65", "age >= 65")]
    both = B.merged(half[0].unionByName(half[1]), ["k"], days)
    assert sorted((r.k, r.days) for r in both.collect()) == sorted((r.k, r.days) for r in words.collect())
