"""File readers and the day slug (S1-S4, S7, S8, P6) on data derived from the tables."""

import datetime as dt

from pyspark.sql import functions as F

from cartwise.functions.dates import day_slug
from cartwise.sources.files import (read_catalog, read_day, read_delimited, read_indexed_csv, read_with_sidecar,
                                    scratch_path, write_by_day, write_delimited)
from cartwise.sources.tables import ShopData


def test_delimited_round_trip(spark, sf_dir):
    log = ShopData(spark, sf_dir).click_log()
    path = write_delimited(log, scratch_path(spark, "t-log"))
    back = read_delimited(spark, path, ["role_id", "child_tab", "item_list", "dt"], {"role_id": "bigint", "dt": "date"})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, log.collect()))


def test_indexed_csv_drops_the_saved_index(spark, sf_dir):
    cat = ShopData(spark, sf_dir).catalog()
    path = scratch_path(spark, "t-indexed")
    cat.select(F.monotonically_increasing_id().alias("idx"), "item_id").write.option("header", True).csv(path)
    back = read_indexed_csv(spark, path, ["item_id"], {"item_id": "bigint"})
    assert back.columns == ["item_id"]
    assert sorted(r[0] for r in back.collect()) == sorted(r[0] for r in cat.collect())


def test_catalog_file(spark, sf_dir):
    cat = ShopData(spark, sf_dir).catalog()
    path = write_delimited(cat, scratch_path(spark, "t-catalog"))
    assert read_catalog(spark, path).count() == cat.count()


def test_sidecar_names_drop_last_five(spark, sf_dir):
    feats = ShopData(spark, sf_dir).role_daily_features()
    data = write_delimited(feats, scratch_path(spark, "t-feats"))
    names_path = scratch_path(spark, "t-names")
    names = feats.columns + ["x1", "x2", "x3", "x4", "x5"]
    spark.createDataFrame([(n + "\tmeta",) for n in names], "value string").coalesce(1).write.text(names_path)
    back = read_with_sidecar(spark, data, names_path, 5)
    assert back.columns == feats.columns and back.count() == feats.count()


def test_split_by_day_prunes(spark, sf_dir):
    feats = ShopData(spark, sf_dir).role_daily_features()
    path = write_by_day(feats, scratch_path(spark, "t-days"))
    day = dt.date(2024, 1, 24)
    one = read_day(spark, path, day)
    assert one.count() == feats.where(F.col("dt") == F.lit(day)).count()
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_day_slug(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "dt date")
    assert df.select(day_slug("dt"), day_slug("dt", 1)).first() == ("0301", "0229")
