"""Ranked search by block bounds, postings joined slice by slice, suggestions in groups of queries."""

import pytest
from pyspark.sql import functions as F

from trawl.operators import index as ix
from trawl.operators import search as srch
from trawl.plans.catalog import stored_index
from trawl.plans.inputs import queries_table
from trawl.session import scratch_path
from trawl.sources.index_store import build_and_write_index, read_index


@pytest.fixture(scope="module")
def idx(spark, sf):
    return stored_index(spark, sf, "documents")


@pytest.fixture(scope="module")
def skewed(spark):
    """400 documents of which a few mention a rare word often; a common word is in all."""
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("u").alias("url"), F.lit("No Title").alias("title"),
        F.concat(F.lit("common "), F.repeat(F.lit("filler "), (F.col("id") % 5).cast("int")), F.when(
            F.col("id") < 100, F.lit("rarely ")).otherwise(F.lit("")), F.repeat(F.lit("rarely "), F.when(
                F.col("id").isin(7, 70), 40).otherwise(0))).alias("clean_text"))
    path = scratch_path(spark, "skewed-index")
    build_and_write_index(docs, path, term_buckets=2, doc_buckets=2)
    return read_index(spark, path)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_block_bounds_are_bounds(spark, sf, idx):
    queries = queries_table(spark, sf)
    scores = srch.search_scores(idx, queries).withColumn(ix.DOC_BLOCK, ix.doc_block(F.col("doc_id"), idx.doc_blocks))
    met = scores.join(srch.block_bounds(idx, queries), ["query_id", ix.DOC_BLOCK], "left")
    assert met.where("bound IS NULL OR score > bound + 1e-5").count() == 0 and scores.count() > 0


@pytest.mark.parametrize("n", [1, 3, 50])
def test_early_stop_equals_exhaustive(spark, sf, idx, n):
    queries = queries_table(spark, sf)
    assert _rows(srch.search_topk(idx, queries, n, early_stop=True)) == _rows(
        srch.search_topk(idx, queries, n, early_stop=False))


def test_blocks_are_skipped(spark, skewed):
    queries = spark.createDataFrame([(1, "rarely common"), (2, "filler"), (3, "rarely")], "query_id long, query string")
    every = dict(srch.block_bounds(skewed, queries).groupBy("query_id").count().collect())
    kept = dict(srch.blocks_to_score(skewed, queries, 2).groupBy("query_id").count().collect())
    assert every[3] > 30 and kept[3] <= 4 and kept[1] <= 4
    assert kept[2] <= every[2]
    for n in (2, 5, 400):
        assert _rows(srch.search_topk(skewed, queries, n, early_stop=True)) == _rows(
            srch.search_topk(skewed, queries, n, early_stop=False))


def test_postings_of_frequent_terms_are_sliced(spark, skewed, monkeypatch):
    queries = spark.createDataFrame([(q, "common rarely") for q in range(50)], "query_id long, query string")
    whole = _rows(srch.search_scores(skewed, queries))
    monkeypatch.setattr(srch, "POSTINGS_PER_SLICE", 20)
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        assert {r["term"]: r["slices"] for r in srch.frequent_terms(skewed).collect()}["common"] == 20
        assert _rows(srch.search_scores(skewed, queries)) == whole
        joined = srch._with_postings(skewed, srch._distinct_terms(skewed, queries).where("term = 'common'"))
        assert "term_slice" in joined._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1].split("\n")[0]
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == 50 * 400 and len(per_task) > 1 and max(per_task) < 50 * 400 * 0.6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_suggestions_in_groups_of_queries(spark, sf, idx, monkeypatch):
    words = [r["term"] for r in idx.term_stats.orderBy("term").limit(400).collect()]
    queries = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "query_id long, query string")
    whole = _rows(srch.suggestions(idx, queries, 3))
    monkeypatch.setattr(srch, "GROUP_CHUNKS", 1)
    assert whole and _rows(srch.suggestions(idx, queries, 3)) == whole
