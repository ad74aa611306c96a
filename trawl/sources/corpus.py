"""Corpus adapters: driver tables -> the `corpus` schema the index builder reads.

corpus: doc_id BIGINT, url STRING, title STRING, clean_text STRING
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.html import NO_TITLE, clean_text, page_title


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """`read_table` with at least one task per core, for CPU-heavy work on a small file.

    Only a scan of fewer splits (Parquet row groups) than cores is redistributed; a larger
    one is left as it is. Looking at a plain scan's splits starts no job.
    """
    table, cores = read_table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def pages_corpus(pages: DataFrame) -> DataFrame:
    """Raw web pages (page_id, url, html): cleaned to text and titled."""
    return pages.select(
        F.col("page_id").cast("bigint").alias("doc_id"),
        F.col("url"),
        page_title(F.col("html")).alias("title"),
        clean_text(F.col("html")).alias("clean_text"),
    )


def documents_corpus(documents: DataFrame) -> DataFrame:
    """Plain-text documents: no HTML to clean, so every title is "No Title"."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(NO_TITLE).alias("title"),
        F.coalesce(F.col("text"), F.lit("")).alias("clean_text"),
    )


def load_corpus(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    if kind == "pages":
        return pages_corpus(read_spread(spark, sf_dir, "pages"))
    if kind == "documents":
        return documents_corpus(read_spread(spark, sf_dir, "documents"))
    raise ValueError(f"unknown corpus {kind!r}")
