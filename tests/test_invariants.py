"""Invariants on whole tables and plan checks."""

from pyspark.sql import functions as F

import __spark_entry__ as E


def test_windows_nested(spark, sf_dir):
    p = E.q_pair_click_features(spark, sf_dir)
    bad = p.where((F.col("cnt_1") > F.col("cnt_3")) | (F.col("cnt_3") > F.col("cnt_7"))
                  | (F.col("cnt_7") > F.col("cnt_14")) | (F.col("cnt_14") > F.col("cnt_21"))
                  | (F.col("d_dt_click_final") > F.col("d_dt_click_first")))
    assert bad.count() == 0


def test_no_future_event_in_training_path(spark, sf_dir):
    from cartwise.plans.training import features_as_of
    f = features_as_of(E._logs(spark, sf_dir), E.TRAIN_ASOF)
    assert f.click_hist.where(F.col("age") < 1).count() == 0
    assert f.buy_hist.where(F.col("age") < 1).count() == 0


def test_one_row_per_pair(spark, sf_dir):
    rows = E.q_training_rows(spark, sf_dir)
    assert rows.count() == rows.select("role_id", "item_id").distinct().count()


def test_positions_are_a_permutation_prefix(spark, sf_dir):
    ranked = E.q_recommend_list(spark, sf_dir)
    per_role = ranked.groupBy("role_id").agg(F.count("*").alias("n"), F.min("position").alias("lo"),
                                             F.max("position").alias("hi"),
                                             F.countDistinct("position").alias("d"))
    assert per_role.where((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))) \
        .count() == 0


def test_hit_at_k_monotone(spark, sf_dir):
    r = E.q_hit_revenue_at_k(spark, sf_dir).first()
    hits = [r[f"hit_{k}"] for k in (1, 3, 5, 10, 15, 20, 25)]
    assert hits == sorted(hits) and hits[-1] <= r.total


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_is_jvm_only_and_partitioned(spark, sf_dir):
    plan = _plan(E.q_role_item_features(spark, sf_dir))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan


def test_filters_reach_the_scan(spark, sf_dir):
    df = E.q_daily_buys(spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(event_type,purchase)" in pushed and "GreaterThanOrEqual(ts," in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text


def test_no_python_udf_anywhere(spark, sf_dir):
    for name in ("pair_click_features", "training_rows", "recommend_list", "cross_features", "item_correlation"):
        plan = _plan(E.queries()[name](spark, sf_dir))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_keyed_multi_day_equals_single_days(spark, sf_dir):
    from cartwise.plans.training import training_rows
    logs = E._logs(spark, sf_dir)
    days = ["2024-01-23", "2024-01-24", "2024-01-25"]
    multi = training_rows(logs, days)
    cols = sorted(multi.columns)
    got = sorted(tuple(r) for r in multi.select(*cols).collect())
    want = sorted(tuple(r) for d in days for r in training_rows(logs, [d]).select(*cols).collect())
    assert got == want and len(got) > 0


def test_day_view_of_keyed_features_equals_single_day(spark, sf_dir):
    from cartwise.plans.training import Features
    logs = E._logs(spark, sf_dir)
    shared = E._evaluation(spark, sf_dir, E.TEST_ASOF, logs=logs,
                           features=Features(logs, ["2024-01-24", E.TEST_ASOF]))["cand"]
    alone = E.q_candidate_features(spark, sf_dir)
    cols = sorted(alone.columns)
    assert sorted(map(tuple, shared.select(*cols).collect())) == sorted(map(tuple, alone.select(*cols).collect()))


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    final = plan[plan.find("== Final Plan =="):] if "== Final Plan ==" in plan else plan
    return final[:final.find("== Initial Plan ==")] if "== Initial Plan ==" in final else final


def test_flagship_shuffle_budget(spark, sf_dir):
    final = _final_plan(E.q_role_item_features(spark, sf_dir))
    assert final.count("Exchange hashpartitioning") <= 5
    assert "SinglePartition" not in final


def test_training_plan_has_no_single_partition_exchange(spark, sf_dir):
    from cartwise.plans.training import training_rows
    final = _final_plan(training_rows(E._logs(spark, sf_dir), ["2024-01-24", "2024-01-25"]))
    assert "SinglePartition" not in final and "EvalPython" not in final
