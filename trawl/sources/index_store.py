"""Index sink and source: Parquet tables texts / docs / postings / term_stats / doc_terms.

* texts (doc_id, url, title, length, indexed_at, clean_text) are written where they were
  cleaned, one folder per task (text_part): text is never shuffled. docs holds the same
  rows without the text, split by doc_bucket, and names each document's text_part, so a
  snippet lookup reads only the parts of its documents.
* postings and term_stats are split by term_bucket = hash(term) mod B and sorted by term
  inside each file. Search joins on (term, term_bucket), so dynamic partition pruning
  reads only the buckets of the batch's query terms, and Parquet row-group min/max
  statistics skip row groups inside them. Postings are dealt out by (term_bucket, slice)
  once; that exchange and one sort serve the merge of repeated documents and the write.
* block_stats (term, doc_block, doc_count, best), split by term_bucket, bounds what a block of
  documents can score for a term; term_stats sums it. A build writes its rows as two columns of
  postings (block_doc_count, block_best), which readers leave out.
* doc_terms (doc_id, terms with their document frequency), split by doc_bucket, is the
  document-to-terms direction that suggestions read.

Bucket and slice counts follow from the number of indexed tokens, which the docs table
gives before the postings are built. Writes replace the whole index directory; the
incremental path is the streaming ingest, which writes per micro-batch.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.index import (BLOCK_BEST, BLOCK_DOCS, BUCKET, DOC_BLOCK, DOC_BUCKET, SLICE, TEXT_PART, Index,
                                   block_stats, doc_block, doc_bucket, docs_table, document_terms, postings_table,
                                   stored_block_stats, term_bucket, with_block_stats)

TOKENS_PER_BUCKET = 50_000_000   # about 1 GB of postings
TOKENS_PER_SLICE = 500_000       # about one file's share of a bucket
TOKENS_PER_TASK = 500_000        # slices are dealt to tasks by hash: small ones keep the tasks about even
DERIVED_SLICES = 2               # slices of the postings in a slice of the tables made from them
MIN_BUCKETS = 16
DOCS_PER_BLOCK = 10_000
MIN_BLOCKS = 64
SPLIT_BYTES = 32 << 20           # a map task of the build reads at most this much, so its shuffle output fits in memory
TEXT_GROUP_BYTES = 16 << 20      # row groups of texts, which cannot be split further
DENSE = "zstd"  # of the wide tables: texts, postings and document terms
LAYOUT = "term_buckets int, doc_buckets int, doc_blocks int"
TEXT_COLUMNS = ["doc_id", "url", "title", "length", "indexed_at", "clean_text"]


def bucket_counts(tokens: int) -> tuple[int, int]:
    """(buckets, slices of a bucket) for so many indexed tokens."""
    buckets = max(MIN_BUCKETS, -(-tokens // TOKENS_PER_BUCKET))
    return buckets, max(1, -(-tokens // (buckets * TOKENS_PER_SLICE)))


@contextmanager
def _small_splits(spark: SparkSession):
    """Scans read at most SPLIT_BYTES a task, or less if the session says so; its own setting is put back."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) if before else SPLIT_BYTES
    spark.conf.set(key, str(min(own, SPLIT_BYTES)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _split_write(df: DataFrame, path: str, mode: str, key: str, order: list[str], codec: str = "snappy") -> None:
    """Write split by ``key``. The rebalance hint shuffles by it and lets AQE cut a large
    value into several files and merge small ones."""
    (df.hint("rebalance", key).sortWithinPartitions(key, *order)
     .write.mode(mode).option("compression", codec).partitionBy(key).parquet(path))


def _tasks(tokens: int) -> int:
    return max(1, -(-tokens // TOKENS_PER_TASK))


def _deal(df: DataFrame, key: str, by, slices: int, tokens: int) -> DataFrame:
    """Rows partitioned by (``key``, slice of ``by``). The number of tasks follows from the number of tokens, so a
    task's share of rows is bounded at any size of the corpus."""
    return df.withColumn(SLICE, F.pmod(F.xxhash64(by, F.lit(3)), F.lit(slices)).cast("int")).repartition(
        _tasks(tokens), key, SLICE)


@dataclass(frozen=True)
class _DealtByBucket:
    """Rows partitioned by (term_bucket, slice of doc_id): the rows of a posting share both.

    With ``doc_blocks`` a slice holds whole document blocks, so a task holds all postings of a term in a block; blocks
    are dealt to the slices in turn, and the block is a further column (added behind the exchange)."""

    buckets: int
    slices: int
    tokens: int | None = None
    doc_blocks: int = 0

    def __call__(self, rows: DataFrame) -> DataFrame:
        if BUCKET not in rows.columns:
            rows = rows.withColumn(BUCKET, term_bucket(F.col("term"), self.buckets))
        tokens = self.buckets * self.slices * TOKENS_PER_SLICE if self.tokens is None else self.tokens
        if not self.doc_blocks:
            return _deal(rows, BUCKET, F.col("doc_id"), self.slices, tokens)
        block = doc_block(F.col("doc_id"), self.doc_blocks)
        return rows.withColumn(SLICE, block % self.slices).repartition(_tasks(tokens), BUCKET, SLICE).withColumn(
            DOC_BLOCK, block)


_dealt_by_bucket = _DealtByBucket


def _write_derived(spark: SparkSession, path: str, mode: str, doc_buckets: int, doc_blocks: int, tokens: int) -> None:
    """block_stats, term_stats and doc_terms from the stored postings.

    Postings dealt by document blocks hold their block_stats; others are combined before they are shuffled. The pairs of
    doc_terms meet term_stats in tasks whose number follows from the number of tokens, by hash (nothing is sorted), and are
    dealt out once, by the split doc_terms is written in, and grouped and sorted where they arrive."""
    stored = spark.read.parquet(f"{path}/postings")
    slices = -(-bucket_counts(tokens)[1] // DERIVED_SLICES)

    blocks = stored_block_stats(stored, doc_blocks) if BLOCK_DOCS in stored.columns else block_stats(stored, doc_blocks)
    _split_write(blocks, f"{path}/block_stats", mode, BUCKET, ["term", DOC_BLOCK], DENSE)
    by_term = spark.read.parquet(f"{path}/block_stats").groupBy("term", BUCKET).agg(F.sum("doc_count").alias("doc_count"))
    _split_write(by_term, f"{path}/term_stats", mode, BUCKET, ["term"], DENSE)

    def by_doc(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(slices)).cast("int")
        return rows.withColumn(SLICE, doc_bucket(F.col("doc_id"), doc_buckets) * slices + part).repartitionById(
            doc_buckets * slices, F.col(SLICE))

    stats = spark.read.parquet(f"{path}/term_stats").select("term", "doc_count").hint("shuffle_hash")
    terms = document_terms(stored.select("term", "doc_id").repartition(_tasks(tokens), "term"), stats, deal=by_doc)
    (terms.drop(SLICE).withColumn(DOC_BUCKET, doc_bucket(F.col("doc_id"), doc_buckets))
     .sortWithinPartitions(DOC_BUCKET, "doc_id").write.mode(mode).option("compression", DENSE)
     .partitionBy(DOC_BUCKET).parquet(f"{path}/doc_terms"))


def _write_layout(spark: SparkSession, path: str, buckets: int, doc_buckets: int, doc_blocks: int) -> None:
    (spark.createDataFrame([(buckets, doc_buckets, doc_blocks)], LAYOUT)
     .coalesce(1).write.mode("overwrite").json(f"{path}/layout"))


def _unique_ids(spark: SparkSession, path: str) -> bool:
    """Whether no doc_id of the stored docs (null is one) is in two rows."""
    ids = spark.read.parquet(f"{path}/docs").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.where("n > 1").limit(1).count() == 0


def _write_texts_and_docs(docs: DataFrame, path: str, mode: str, doc_buckets: int | None) -> tuple[int, int, int]:
    """texts and docs; returns (indexed tokens, doc buckets, doc blocks)."""
    spark = docs.sparkSession
    rows = docs.withColumn("indexed_at", F.current_timestamp()) if "indexed_at" not in docs.columns else docs
    (rows.select(*TEXT_COLUMNS, F.spark_partition_id().alias(TEXT_PART))
     .write.mode(mode).option("compression", DENSE).option("parquet.block.size", TEXT_GROUP_BYTES)
     .partitionBy(TEXT_PART).parquet(f"{path}/texts"))
    meta = spark.read.parquet(f"{path}/texts").drop("clean_text")
    tokens, n_docs = meta.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    doc_buckets = doc_buckets or bucket_counts(tokens)[0]
    _split_write(meta.withColumn(DOC_BUCKET, doc_bucket(F.col("doc_id"), doc_buckets)), f"{path}/docs", mode,
                 DOC_BUCKET, ["doc_id"])
    return tokens, doc_buckets, max(MIN_BLOCKS, n_docs // DOCS_PER_BLOCK)


def build_and_write_index(corpus: DataFrame, path: str, mode: str = "overwrite", term_buckets: int | None = None,
                          doc_buckets: int | None = None) -> None:
    """Index a corpus: the cleaned texts are written first, then postings are built from
    the stored texts, so HTML is cleaned once."""
    path, spark = path.rstrip("/"), corpus.sparkSession
    tokens, doc_buckets, doc_blocks = _write_texts_and_docs(docs_table(corpus), path, mode, doc_buckets)
    buckets, slices = bucket_counts(tokens)
    buckets = term_buckets or buckets
    texts = spark.read.parquet(f"{path}/texts").select("doc_id", "title", "clean_text")
    with _small_splits(spark):
        (with_block_stats(postings_table(texts, _dealt_by_bucket(buckets, slices, tokens, doc_blocks), _unique_ids(spark, path)))
         .sortWithinPartitions(BUCKET, "term", SLICE, DOC_BLOCK, "doc_id").drop(SLICE, DOC_BLOCK)
         .write.mode(mode).option("compression", DENSE).partitionBy(BUCKET).parquet(f"{path}/postings"))
        _write_derived(spark, path, mode, doc_buckets, doc_blocks, tokens)
    _write_layout(spark, path, buckets, doc_buckets, doc_blocks)


def write_index(index: Index, path: str, mode: str = "overwrite", term_buckets: int | None = None,
                doc_buckets: int | None = None) -> None:
    """Write an (already built) index in the stored layout."""
    path, spark = path.rstrip("/"), index.docs.sparkSession
    tokens, doc_buckets, doc_blocks = _write_texts_and_docs(index.docs, path, mode, doc_buckets)
    buckets = term_buckets or bucket_counts(tokens)[0]
    _split_write(index.postings.drop(BUCKET).withColumn(BUCKET, term_bucket(F.col("term"), buckets)),
                 f"{path}/postings", mode, BUCKET, ["term", "doc_id"])
    with _small_splits(spark):
        _write_derived(spark, path, mode, doc_buckets, doc_blocks, tokens)
    _write_layout(spark, path, buckets, doc_buckets, doc_blocks)


def read_index(spark: SparkSession, path: str) -> Index:
    path = path.rstrip("/")
    layout = spark.read.schema(LAYOUT).json(f"{path}/layout").first()
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    return Index(docs=table("docs"), postings=table("postings").drop(BLOCK_DOCS, BLOCK_BEST), _term_stats=table("term_stats"),
                 term_buckets=layout.term_buckets, doc_buckets=layout.doc_buckets, _texts=table("texts"),
                 _doc_terms=table("doc_terms"), complete=True, doc_blocks=layout.doc_blocks,
                 _block_stats=table("block_stats"))
