"""Crawl-output envelopes: schema, sink (S2), file source (S1) and corpus adapter.

One envelope per fetched page: url, timestamp (yyyyMMdd_HHmmss), worker_id, file_path,
processed=false, page_data{...}, index_result{success, worker_id, content_hash
"pending"} - the fields the crawler's sink fills; the indexing outcome it is handed is
not recorded.

Files: the crawler writes one pretty-printed JSON object per file named raw_*.json.
`read_crawl_output` reads that layout (multiLine) or JSON Lines, with an explicit
schema and PERMISSIVE mode: truncated files and envelopes without page_data are
returned separately by `split_bad`, never retried forever.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.html import clean_text, page_title
from trawl.functions.text import term_count
from trawl.session import fs_uri, scratch_path

PAGE_DATA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("content", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("content_length", T.IntegerType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fetch_time", T.TimestampType()),
])
INDEX_RESULT = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("worker_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("error", T.StringType()),
])
CRAWL_OUTPUT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("worker_id", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("page_data", PAGE_DATA),
    T.StructField("index_result", INDEX_RESULT),
])
CORRUPT = "_corrupt_record"
CRAWL_OUTPUT_READ = T.StructType(CRAWL_OUTPUT.fields + [T.StructField(CORRUPT, T.StringType())])
FILE_PREFIX = "raw_"
DUMP_DIR = "crawl_output"


def crawl_envelope(fetched: DataFrame, dump_dir: str = DUMP_DIR, with_word_count: bool = False) -> DataFrame:
    """Fetched pages (url, status_code, content, content_type, headers, fetch_time,
    worker_id, page_id) -> envelopes + file_name (raw_<worker>_<timestamp>_<page_id>.json).

    index_result.word_count is 0 as the crawler writes it; with_word_count=True fills it
    with the page's index-term count instead."""
    ts = F.date_format("fetch_time", "yyyyMMdd_HHmmss")
    name = F.concat(F.lit(FILE_PREFIX), F.col("worker_id").cast("string"), F.lit("_"), ts, F.lit("_"),
                    F.col("page_id").cast("string"), F.lit(".json"))
    return fetched.select(
        F.col("url"), ts.alias("timestamp"), F.col("worker_id").cast("int").alias("worker_id"),
        F.concat(F.lit(dump_dir + "/"), name).alias("file_path"), F.lit(False).alias("processed"),
        F.struct(F.col("url"), F.col("status_code").cast("int").alias("status_code"), F.col("content"),
                 F.col("content_type"), F.octet_length("content").cast("int").alias("content_length"),
                 F.col("headers"), F.col("fetch_time")).alias("page_data"),
        F.struct(F.lit(True).alias("success"), F.lit(0.0).alias("processing_time"),
                 F.col("worker_id").cast("int").alias("worker_id"), F.lit("").alias("title"),
                 (term_count(clean_text(F.col("content"))) if with_word_count else F.lit(0)).alias("word_count"),
                 F.lit("pending").alias("content_hash"),
                 F.lit(None).cast("string").alias("error")).alias("index_result"),
        name.alias("file_name"),
    )


def flatten(envelopes: DataFrame) -> DataFrame:
    """Flat view of envelopes for comparisons (no raw content, no timestamps of 'now')."""
    return envelopes.select(
        "url", "timestamp", "worker_id", "file_path", "processed",
        F.col("page_data.status_code").alias("status_code"),
        F.col("page_data.content_type").alias("content_type"),
        F.col("page_data.content_length").alias("content_length"),
        F.md5(F.col("page_data.content")).alias("content_md5"),
        F.col("index_result.success").alias("success"),
        F.col("index_result.worker_id").alias("result_worker_id"),
        F.col("index_result.word_count").alias("word_count"),
        F.col("index_result.content_hash").alias("content_hash"))


def write_crawl_output(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Scalable sink: JSON Lines, many envelopes per file (Spark's JSON writer)."""
    envelopes.drop("file_name").write.mode(mode).json(path)


def write_crawl_files(envelopes: DataFrame, directory: str) -> int:
    """The crawler's layout: one pretty-printed JSON file per envelope, named raw_*.json.

    For handing pages to programs that expect that layout; inside Spark use `write_crawl_output`, which writes
    many pages per file. The write is committed in two steps. Tasks stage their files in a folder of their attempt
    under <dir>/_incoming (hidden from file sources) and list them in a table, which Spark's own commit protocol
    keeps to the attempts that count; only when all tasks have ended are the listed files renamed into <dir>, so
    a poll sees whole files only, and a failed job or lost attempt leaves nothing. Renaming again is harmless. Works
    on any file system pyarrow can open (local, HDFS, S3, GCS). Returns the number of files.
    """
    spark = envelopes.sparkSession
    body = envelopes.select("file_name", F.to_json(F.struct(*[c.name for c in CRAWL_OUTPUT.fields])).alias("json"))
    uri, run = fs_uri(spark, directory), uuid.uuid4().hex

    def stage(batches):
        import json
        import uuid

        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(uri)
        folder = f"_incoming/{run}/{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/{folder}", recursive=True)
        for pdf in batches:
            for name, text in zip(pdf["file_name"], pdf["json"]):
                with fs.open_output_stream(f"{root}/{folder}/{name}") as out:
                    out.write((json.dumps(json.loads(text), indent=2) + "\n").encode("utf-8"))
            yield pd.DataFrame({"folder": folder, "name": pdf["file_name"]})

    def publish(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(uri)
        for pdf in batches:
            for folder, name in zip(pdf["folder"], pdf["name"]):
                staged, final = f"{root}/{folder}/{name}", f"{root}/{name}"
                if fs.get_file_info(staged).type != pafs.FileType.File:
                    continue  # an earlier attempt of this task renamed it
                try:
                    fs.move(staged, final)
                except OSError:  # a store that does not rename onto a file of that name
                    fs.copy_file(staged, final)
            yield pd.DataFrame({"n": [len(pdf)]})

    listed = scratch_path(spark, "crawl-files-listed")
    try:
        body.mapInPandas(stage, "folder string, name string").write.parquet(listed)
        files = spark.read.parquet(listed)
        return int(files.mapInPandas(publish, "n long").agg(F.sum("n")).first()[0] or 0)
    finally:
        _remove_staged(uri, run)


def _remove_staged(uri: str, run: str, quiet_checks: int = 3) -> None:
    """Delete the staged files of a run. Tasks of a failed job may write on for a moment until they are
    stopped, so the folder must stay away for a few checks."""
    import time

    import pyarrow.fs as pafs

    fs, root = pafs.FileSystem.from_uri(uri)
    folder, gone = f"{root}/_incoming/{run}", 0
    while gone < quiet_checks:
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)
            gone = 0
        else:
            gone += 1
        time.sleep(0.2)


def read_crawl_output(spark: SparkSession, path: str, multiline: bool = True,
                      pattern: str = f"{FILE_PREFIX}*") -> DataFrame:
    """Envelopes from crawl files (explicit schema, corrupt rows kept in _corrupt_record)."""
    return (spark.read.schema(CRAWL_OUTPUT_READ).option("multiLine", multiline)
            .option("pathGlobFilter", pattern).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def is_good(df: DataFrame):
    return F.col(CORRUPT).isNull() & F.col("page_data").isNotNull()


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good envelopes, quarantined rows): unparseable files and null page_data."""
    good = is_good(df)
    return df.filter(good).drop(CORRUPT), df.filter(~good)


def latest_fetches(envelopes: DataFrame) -> DataFrame:
    """One envelope per url: the one fetched last (then of the greatest file path)."""
    cols = [c for c in envelopes.columns if c != "url"]
    last = F.max_by(F.struct(*cols), F.struct(F.col("page_data.fetch_time"), F.col("file_path")))
    return envelopes.groupBy("url").agg(last.alias("e")).select("url", *[F.col(f"e.{c}").alias(c) for c in cols])


def crawl_corpus(envelopes: DataFrame) -> DataFrame:
    """Envelopes (one per url) -> corpus rows; doc_id is a 64-bit hash of the url (no arrival order)."""
    return envelopes.select(
        F.xxhash64("url").alias("doc_id"), F.col("url"),
        page_title(F.col("page_data.content")).alias("title"),
        clean_text(F.col("page_data.content")).alias("clean_text"))


def header_counts(envelopes: DataFrame) -> DataFrame:
    """header, pages (envelopes carrying it), distinct_values: over the fetched headers map."""
    h = envelopes.select(F.explode(F.map_entries("page_data.headers")).alias("h"))
    return h.groupBy(F.col("h.key").alias("header")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_distinct("h.value").alias("distinct_values"))
