"""Incremental index build from a directory of crawl files (Structured Streaming).

readStream (file source, explicit schema, maxFilesPerTrigger as the back-pressure bound)
-> foreachBatch: split off corrupt files and envelopes without page_data into a quarantine
table that names their file, keep each URL's latest fetch, build docs + postings for the
batch with the same batch functions, and write every table partitioned by batch_id with
dynamic partition overwrite, so a replayed batch after a failure rewrites its own
partition instead of appending duplicates. Document frequencies are computed when the
index is read (`read_streamed_index`), not kept as state. The checkpoint makes restarts
resume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trawl.operators.index import Index, docs_table, postings_table
from trawl.sources.crawl_files import (CORRUPT, CRAWL_OUTPUT_READ, FILE_PREFIX, crawl_corpus, is_good, latest_fetches,
                                       split_bad)
from trawl.streaming.first_seen import FirstSeen

MAX_FILES_PER_TRIGGER = 100
SOURCE_FILE = "source_file"


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def index_batch(out_dir: str):
    """foreachBatch function: one micro-batch of envelopes -> docs / postings / quarantine."""
    out = out_dir.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch is bounded by maxFilesPerTrigger; keeping it (and its cleaned
        # text) means the files are parsed once and the HTML is cleaned once.
        batch = batch.persist()
        good, bad = split_bad(batch)
        corpus = crawl_corpus(latest_fetches(good.drop(SOURCE_FILE))).persist()
        try:
            _write(docs_table(corpus), f"{out}/docs", batch_id)
            _write(postings_table(corpus), f"{out}/postings", batch_id)
            _write(bad.select("url", "file_path", CORRUPT, SOURCE_FILE), f"{out}/quarantine", batch_id)
            # Running index stats per tick: one row per micro-batch, from this batch's files and the
            # tables of keys that earlier batches brought.
            spark = batch.sparkSession
            written = spark.read.parquet(f"{out}/postings/batch_id={batch_id}").select("term").persist()
            new_docs = FirstSeen(spark, f"{out}/first_docs").merge(corpus.select(F.col("doc_id").alias("key")), batch_id)
            new_terms = FirstSeen(spark, f"{out}/first_terms").merge(written.select(F.col("term").alias("key")), batch_id)
            counts = batch.agg(F.count_if(is_good(batch)).alias("envelopes"),
                               F.count_if(~is_good(batch)).alias("quarantined"))
            _write(counts.select("envelopes", "quarantined",
                                 corpus.select(F.count(F.lit(1))).scalar().alias("docs"),
                                 written.select(F.count(F.lit(1))).scalar().alias("postings"),
                                 written.select(F.count_distinct("term")).scalar().alias("terms"),
                                 F.lit(new_docs).cast("bigint").alias("new_docs"),
                                 F.lit(new_terms).cast("bigint").alias("new_terms")),
                   f"{out}/batch_stats", batch_id)
            written.unpersist()
        finally:
            corpus.unpersist()
            batch.unpersist()

    return run


def stream_index(spark: SparkSession, input_dir: str, out_dir: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                 clean_source: str | None = None, poll: str = "1 second",
                 archive_dir: str | None = None, pattern: str = f"{FILE_PREFIX}*",
                 multiline: bool = True) -> StreamingQuery:
    """Start the ingest. available_now processes what is there and stops (tests, batch
    catch-up); otherwise it polls every `poll`. clean_source="delete" removes processed
    files, "archive" moves them under archive_dir (both lag one batch behind, as the file
    source does). pattern and multiline: the crawler's one object per raw_* file by default;
    "part-*" and False for JSON Lines."""
    reader = (spark.readStream.schema(CRAWL_OUTPUT_READ).option("multiLine", multiline)
              .option("pathGlobFilter", pattern).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            if not archive_dir:
                raise ValueError("clean_source='archive' needs archive_dir")
            reader = reader.option("sourceArchiveDir", archive_dir)
    rows = reader.json(input_dir).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    writer = rows.writeStream.foreachBatch(index_batch(out_dir)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow query to process everything; a failure is raised, and so is
    a timeout, after the query was stopped (its output so far is not the whole result)."""
    done = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination() or True
    if not done:
        query.stop()
        raise TimeoutError(f"the stream did not finish within {timeout_s} s")


def batch_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """batch_id, envelopes, quarantined, docs, postings, terms (distinct within the batch), new_docs, new_terms (that
    no earlier batch brought)."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/batch_stats")


def tick_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """batch_id, total_documents, total_terms, quarantined after each micro-batch, counted from the start.

    A document or term counts from the batch that first brought it, which `FirstSeen` decided when the batch was
    written; there is one row per batch, so the running sums are over a small table.
    """
    ticks = batch_stats(spark, out_dir)
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0)).cast("long")
    return ticks.select("batch_id", total("new_docs").alias("total_documents"), total("new_terms").alias("total_terms"),
                        total("quarantined").alias("quarantined"))


def read_streamed_index(spark: SparkSession, out_dir: str) -> Index:
    """The index the ingest has written so far. A page crawled again in a later batch
    replaces its earlier version: only each document's latest batch is kept."""
    out = out_dir.rstrip("/")
    docs = spark.read.parquet(f"{out}/docs")
    latest = docs.groupBy("doc_id").agg(F.max("batch_id").alias("batch_id"))
    keep = ["doc_id", "batch_id"]
    return Index(docs=docs.join(latest, keep, "left_semi").drop("batch_id"),
                 postings=spark.read.parquet(f"{out}/postings").join(latest, keep, "left_semi").drop("batch_id"))


def compact_streamed_index(spark: SparkSession, out_dir: str, index_path: str) -> Index:
    """Periodic compaction: rewrite the per-batch output as one bucketed index (docs,
    postings and term stats partitioned for pruning), then read it back."""
    from trawl.sources.index_store import read_index, write_index

    write_index(read_streamed_index(spark, out_dir), index_path)
    return read_index(spark, index_path)
