"""The streaming day counts equal the batch day counts on the whole click log."""

from pyspark.sql import functions as F

from cartwise.operators.daily import daily_clicks
from cartwise.sources.files import scratch_path
from cartwise.sources.tables import ShopData
from cartwise.streaming.daily import click_log_stream, daily_click_counts, latest_counts, start_daily_counts


def test_stream_matches_batch(spark, sf_dir):
    log = ShopData(spark, sf_dir).click_log()
    src = scratch_path(spark, "click-log-src")
    log.write.parquet(src)
    sink, ckpt = scratch_path(spark, "daily-sink"), scratch_path(spark, "daily-ckpt")
    start_daily_counts(daily_click_counts(click_log_stream(spark, src)), sink, ckpt).awaitTermination()
    got = latest_counts(spark, sink)
    asof = "2024-01-30"
    batch = daily_clicks(log, asof, 30).select(
        "role_id", "item_id", F.date_sub(F.lit(asof).cast("date"), F.col("age").cast("int")).alias("dt"),
        "click_num_day", "click_num_dis_day")
    expect = sorted(tuple(r) for r in batch.collect())
    assert sorted(tuple(r) for r in got.collect()) == expect
    assert len(expect) > 0
    assert got.agg(F.max("dt")).first() == log.agg(F.max("dt")).first()  # the open days are there
