"""Which micro-batch first brought a key: a bucketed table that each batch adds its new keys to.

Asking for a batch's new keys deals out that batch's keys only; the table, which holds each key once, is joined in
place. So running totals are sums of what each batch added, and no tick groups what earlier ones wrote.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


class FirstSeen:
    """(key, batch_id) rows stored under ``path``; the session's catalog names them by the path's digest."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.name = "first_seen_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (key STRING, batch_id BIGINT) USING parquet "
                  f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{where}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, keys: DataFrame, batch_id: int) -> int:
        """Add the keys (column key) that no batch has brought yet; returns how many this batch brought first.

        A replayed batch finds its own keys there, adds none and returns the same number.
        """
        dealt = keys.select(F.col("key").cast("string")).where("key IS NOT NULL").repartition(self.buckets, "key").distinct()
        new = dealt.join(self.rows().select("key"), "key", "left_anti")
        new.select("key", F.lit(batch_id).cast("bigint").alias("batch_id")).sortWithinPartitions("key").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        mine = self.rows().where(F.col("batch_id") == batch_id)
        return dealt.join(mine, "key", "left_semi").count()
