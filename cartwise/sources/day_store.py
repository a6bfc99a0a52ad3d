"""A table of days, dealt by role.

One parquet table per log, partitioned by day and bucketed by role. Loading a day replaces
the files of the days it holds and no others (dynamic partition overwrite), so a late or
repeated load is the same as a first one. Tables with equally many buckets join and
aggregate on the role without an exchange, and a range of days prunes the other folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.dates import day_in
from cartwise.operators.daily import as_of_days

BUCKETS = 16


class DayStore:
    """``name`` in the session's catalog, files below ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS, day: str = "dt",
                 key: str = "role_id"):
        self.spark, self.name, self.path, self.buckets, self.day, self.key = spark, name, path, buckets, day, key

    def create(self, like: DataFrame) -> "DayStore":
        """The empty table with the columns of ``like``; days already below the path are found again."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS `{self.name}` ({columns}) USING parquet PARTITIONED BY (`{self.day}`) "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            self.spark.sql(f"MSCK REPAIR TABLE `{self.name}`")
        return self

    def load(self, rows: DataFrame) -> "DayStore":
        """Replace the days that ``rows`` hold. Rows are dealt by bucket first, so a day has
        one file per bucket, not one per task and bucket."""
        columns = [c for c in self.spark.table(self.name).columns if c != self.day] + [self.day]
        dealt = rows.select(*columns).repartition(self.buckets, self.key)
        mode, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # an insert into a table takes the session's mode, not a writer's option
        try:
            dealt.write.insertInto(self.name, overwrite=True)
        finally:
            conf.set(mode, before)
        return self

    def read(self, days=None) -> DataFrame:
        """All days, or the given ones (the others' folders are not listed or read)."""
        table = self.spark.table(self.name)
        return table if days is None else table.where(day_in(self.day, as_of_days(days)))

    def totals(self, value: str, out: str, days=None) -> DataFrame:
        """(role_id, out): summed ``value`` per role, without an exchange."""
        return self.read(days).groupBy(self.key).agg(F.sum(value).cast("bigint").alias(out))
