"""Day-grain click counts (A1) as a Structured Streaming query.

The original has no streaming; this re-expresses its first aggregation for
click-log records that arrive as files: the same payload explode and the same
per (role, item, day) sums. Update mode emits a day's row whenever it changes, so
open days are in the result as well; the watermark drops closed days from the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.constants import CLICK_TABS, TAB_APPEARANCE
from cartwise.functions.payload import explode_payload

CLICK_LOG_SCHEMA = "role_id BIGINT, child_tab STRING, item_list STRING, dt DATE"


def click_log_stream(spark: SparkSession, path: str, schema: str = CLICK_LOG_SCHEMA) -> DataFrame:
    """Click-log records from parquet files landing under ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def daily_click_counts(records: DataFrame, lateness: str = "1 day", tabs=CLICK_TABS) -> DataFrame:
    """(role_id, item_id, dt, click_num_day, click_num_dis_day) per finished day."""
    rows = records.where((F.col("item_list") != "{}") & F.col("child_tab").isin(list(tabs)))
    rows = explode_payload(rows, "item_list", keep=["role_id", "child_tab", "dt"])
    rows = rows.withColumn("day_ts", F.col("dt").cast("timestamp")).withWatermark("day_ts", lateness)
    agg = rows.groupBy("role_id", "item_id", F.window("day_ts", "1 day").alias("day")).agg(
        F.sum("cnt").cast("bigint").alias("click_num_day"),
        F.sum(F.when(F.col("child_tab") != TAB_APPEARANCE, 1).otherwise(0)).cast("bigint")
        .alias("click_num_dis_day"))
    return agg.select("role_id", "item_id", F.to_date(F.col("day.start")).alias("dt"),
                      "click_num_day", "click_num_dis_day")


def start_daily_counts(counts: DataFrame, sink_path: str, checkpoint_location: str, available_now: bool = True):
    """Writes the days each trigger changed, open days included, to a parquet folder of
    the trigger. A trigger that runs again overwrites its own folder, so restarts
    leave no double rows. ``checkpoint_location`` belongs on shared storage."""

    def put(rows: DataFrame, trigger: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink_path}/trigger={trigger}")

    writer = (counts.writeStream.outputMode("update").foreachBatch(put)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_counts(spark: SparkSession, sink_path: str) -> DataFrame:
    """The last written counts of every (role, item, day)."""
    rows = spark.read.parquet(sink_path)
    last = F.max_by(F.struct("click_num_day", "click_num_dis_day"), "trigger").alias("c")
    return rows.groupBy("role_id", "item_id", "dt").agg(last).select("role_id", "item_id", "dt", "c.*")
