"""The set of URLs a crawl has seen, kept between rounds.

URLs are stored normalised in hash buckets (a bucketed Parquet table). Asking which candidates are new deals out
the candidates into the same buckets and joins bucket by bucket: the set itself, which grows with the crawl, is
read in place and never shuffled. A round adds its URLs as one more file per bucket; `compact` merges them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.urls import normalize_url


class SeenUrls:
    """The set stored under ``path``, in ``buckets`` buckets (fixed when it is first written).

    The bucketing is named in the session's catalog under ``name``; the URLs are files under ``path`` alone, so another
    session opens the same set by giving the same path and number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name = f"seen_urls_{uuid.uuid4().hex[:12]}"
        self._open(self.path)

    def _open(self, path: str) -> None:
        where = path.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {self.name} (url STRING) USING parquet CLUSTERED BY (url) SORTED BY (url) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{where}'")

    def urls(self) -> DataFrame:
        return self.spark.table(self.name)

    def _dealt(self, urls: DataFrame) -> DataFrame:
        """Distinct normalised URLs (column url), dealt out by the set's buckets."""
        named = urls.select(normalize_url(F.col("url")).alias("url")).where("url IS NOT NULL")
        return named.repartition(self.buckets, "url").distinct()

    def new(self, urls: DataFrame) -> DataFrame:
        """The distinct normalised URLs that the set does not hold."""
        return self._dealt(urls).join(self.urls(), "url", "left_anti")

    def add(self, urls: DataFrame) -> None:
        """Add URLs; those that are there already are not stored again. A bucket gets one file."""
        self.new(urls).sortWithinPartitions("url").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def compact(self, path: str) -> "SeenUrls":
        """The same set rewritten under another path, one file per bucket."""
        out = SeenUrls(self.spark, path, self.buckets)
        out.add(self.urls())
        return out

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
