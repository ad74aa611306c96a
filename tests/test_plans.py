"""Physical-plan properties the scale design relies on."""

import pytest

from trawl.plans.catalog import QUERIES
from trawl.operators import search as srch
from trawl.plans.catalog import stored_index
from trawl.plans.inputs import queries_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def idx(spark, sf):
    return stored_index(spark, sf, "pages")


def test_topk_uses_partial_window_group_limit_and_pruning(spark, sf, idx):
    plan = _plan(srch.search_topk(idx, queries_table(spark, sf), 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("dynamicpruningexpression(term_bucket") >= 2  # postings + term_stats
    assert "Generate" in plan and "BroadcastHashJoin" in plan         # query side is broadcast
    # A stated number of queries bounds the top-k side, so docs are pruned too.
    assert "dynamicpruningexpression(doc_bucket" in _plan(srch.search(idx, "inon ering de", 5))


def test_plain_tf_search_prunes_buckets(spark, sf, idx):
    assert "dynamicpruningexpression(term_bucket" in _plan(srch.search_tf(idx, queries_table(spark, sf)))


def test_postings_build_shuffles_once(spark, sf):
    from trawl.operators.index import postings_table
    from trawl.sources.corpus import load_corpus
    from trawl.sources.index_store import _dealt_by_bucket

    plan = _plan(postings_table(load_corpus(spark, sf, "documents")))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan  # map-side partial aggregation before the exchange
    # The write path: one exchange by bucket and slice serves the aggregation and the write,
    # and no text column passes it.
    texts = load_corpus(spark, sf, "documents").select("doc_id", "title", "clean_text")
    plan = _plan(postings_table(texts, _dealt_by_bucket(16, 2)).sortWithinPartitions("term_bucket", "term", "doc_id"))
    (exchange,) = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "term_bucket" in exchange and "term_slice" in exchange
    below = plan[plan.index(exchange):].splitlines()[1]
    assert "clean_text" not in below


def test_building_a_result_starts_no_job(spark, sf, idx):
    from trawl.operators import crawl as cr
    from trawl.plans.inputs import robots_table, visited_urls
    from trawl.sources.corpus import read_table

    queries, pages = queries_table(spark, sf), read_table(spark, sf, "pages")
    robots = robots_table(spark, sf)
    group = "no-job-at-construction"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for make in (srch.search_topk, srch.search_snippets, srch.suggestions, srch.search_tf, srch.search_scores,
                     srch.matching_docs, srch.search_response, srch.query_term_idf):
            make(idx, queries)
        links = cr.page_links(pages)
        cr.frontier_step(links, visited_urls(links), cr.robots_policy(robots), 100)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_cartesian_or_nested_loop_joins(spark, sf):
    for key, fn in QUERIES.items():
        if key.startswith("stream_"):
            continue
        plan = _plan(fn(spark, sf))
        assert "CartesianProduct" not in plan, key
        assert "BroadcastNestedLoopJoin" not in plan, key
        for python in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"):
            assert python not in plan, (key, python)


def test_tokenize_analyses_each_text_once(spark, sf):
    from trawl.plans.catalog import q_tokenize

    plan = _plan(q_tokenize(spark, sf))
    assert "Filter (size(" not in plan
    assert sum("split(" in line for line in plan.splitlines()) == 1


def test_the_stored_build_bounds_the_rows_of_a_task(spark):
    """The number of tasks follows from the number of tokens, not from spark.sql.shuffle.partitions."""
    from trawl.sources.index_store import TOKENS_PER_TASK, _dealt_by_bucket, bucket_counts

    tokens = 1_000 * TOKENS_PER_TASK
    tok = spark.range(10).selectExpr("cast(id as string) AS term", "id AS doc_id")
    dealt = _dealt_by_bucket(*bucket_counts(tokens), tokens)(tok)
    assert dealt.rdd.getNumPartitions() >= 1_000
    assert _dealt_by_bucket(*bucket_counts(10), 10)(tok).rdd.getNumPartitions() == 1


def test_derived_tables_of_an_index_shuffle_their_rows_once(spark, sf, idx):
    from trawl.operators.index import BUCKET, DOC_BLOCK, block_stats, document_terms
    from trawl.sources.index_store import _deal

    plan = _plan(block_stats(idx.postings, 64, lambda p: _deal(p, BUCKET, p[DOC_BLOCK], 2, 10_000_000)))
    assert plan.count("Exchange hashpartitioning") == 1
    plan = _plan(document_terms(idx.postings.select("term", BUCKET, "doc_id"), idx.term_stats, ("term", BUCKET),
                                lambda p: _deal(p.withColumn("doc_bucket", p["doc_id"] % 4), "doc_bucket", p["doc_id"], 2,
                                                10_000_000)))
    assert plan.count("doc_bucket#") and plan.count("REPARTITION_BY_NUM") == 1
    assert "Exchange hashpartitioning(doc_id" not in plan
