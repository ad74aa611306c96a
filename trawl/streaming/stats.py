"""Running crawl statistics over a stream of crawl-log rows (Structured Streaming).

A stateful groupBy(worker_id) aggregation in complete mode; the key space is the
worker pool, so no watermark is needed. Each trigger writes the whole result as a version of
its own, and a reader takes the newest finished one, so it never meets a half-written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trawl.operators.crawl import worker_stats

CRAWL_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("worker_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("processing_time", T.DoubleType()),
])


def stream_worker_stats(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str,
                        available_now: bool = True, poll: str = "5 seconds") -> StreamingQuery:
    stats = worker_stats(spark.readStream.schema(CRAWL_LOG).json(log_dir))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/version={batch_id:09d}")

    w = (stats.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=poll)
    return w.start()


def read_worker_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest finished version of the published statistics."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "version=*/_SUCCESS"))
    if not done:
        raise FileNotFoundError(f"no finished version under {out_dir}")
    return spark.read.parquet(max(str(s.getPath().getParent()) for s in done))
