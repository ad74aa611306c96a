"""Index and search properties on the sf0.001 tables (the reference ships no tests)."""

import pytest
from pyspark.sql import functions as F

from trawl.operators import index as ix
from trawl.operators import search as srch
from trawl.plans.catalog import stored_index
from trawl.plans.inputs import queries_table


@pytest.fixture(scope="module")
def idx(spark, sf):
    return stored_index(spark, sf, "documents")


def test_postings_properties(idx):
    p = idx.postings
    bad_pos = p.filter(
        (F.size("positions") != F.col("frequency")) | (F.get("positions", 0) != F.col("first_pos"))
        | (F.array_sort("positions") != F.col("positions")) | (F.size(F.array_distinct("positions")) != F.col("frequency")))
    assert bad_pos.count() == 0
    per_doc = p.groupBy("doc_id").agg(F.sum("frequency").alias("s"), F.max(F.element_at("positions", -1)).alias("mx"))
    mism = per_doc.join(idx.docs, "doc_id").filter((F.col("s") != F.col("length")) | (F.col("mx") >= F.col("length")))
    assert mism.count() == 0
    ts = ix.term_stats(p)
    assert ts.join(idx.term_stats, ["term", "doc_count"], "left_anti").count() == 0


def test_search_topk_bounds_and_order(spark, sf, idx):
    q = queries_table(spark, sf)
    r = srch.search_topk(idx, q, 3)
    assert r.groupBy("query_id").count().filter("count > 3").count() == 0
    rows = r.orderBy("query_id", "rank").collect()
    for a, b in zip(rows, rows[1:]):
        if a.query_id == b.query_id:
            assert (a.score, -a.doc_id) >= (b.score, -b.doc_id)
    ids = {row.query_id for row in rows}
    assert {7, 8, 6, 5}.isdisjoint(ids)  # empty, blank, unknown, unstemmed: no hits
    assert srch.search_topk(idx, q, 0).count() == 0
    with pytest.raises(ValueError):
        srch.search_topk(idx, q, -1)


def test_duplicate_term_doubles_score(spark, idx):
    q = spark.createDataFrame([(1, "de"), (2, "de de")], "query_id long, query string")
    s = srch.search_scores(idx, q)
    one = {r.doc_id: r.score for r in s.filter("query_id = 1").collect()}
    two = {r.doc_id: r.score for r in s.filter("query_id = 2").collect()}
    assert one and one.keys() == two.keys()
    assert all(abs(two[d] - 2 * one[d]) < 1e-5 for d in one)


def test_suggestions_exclude_query_terms(spark, sf, idx):
    q = queries_table(spark, sf)
    s = srch.suggestions(idx, q, 5)
    qt = srch.query_terms(q).select("query_id", "term")
    assert s.join(qt, ["query_id", "term"]).count() == 0
    assert s.groupBy("query_id").count().filter("count > 5").count() == 0


def test_search_tf_analyses_query(spark, idx):
    q = spark.createDataFrame([(1, "Running RUNNING the")], "query_id long, query string")
    tf = srch.search_tf(idx, q)
    want = (idx.postings.filter(F.col("term") == "runn")
            .select("doc_id", (F.col("frequency") * 2).cast("bigint").alias("tf_score")))
    assert sorted(tf.select("doc_id", "tf_score").collect()) == sorted(want.collect())


def test_search_response_one_row_per_query(spark, sf, idx):
    q = queries_table(spark, sf)
    r = srch.search_response(idx, q)
    assert r.count() == q.count()


def test_partitioning_does_not_change_postings(spark, sf):
    from trawl.sources.corpus import load_corpus

    c = load_corpus(spark, sf, "documents")
    a = ix.postings_table(c)
    b = ix.postings_table(c.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5)))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_shuffle_joins_give_the_same_rows(spark, sf, idx):
    q = queries_table(spark, sf)
    run = lambda: [sorted(map(tuple, f(idx, q).collect())) for f in (
        lambda i, x: srch.search_topk(i, x, 3), lambda i, x: srch.suggestions(i, x, 3), srch.search_tf,
        lambda i, x: srch.search_snippets(i, x, 2))]
    want = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = srch.search_topk(idx, q, 3)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert run() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_queries_fill_several_chunks(spark, idx):
    terms = [r.term for r in idx.term_stats.where("doc_count > 3").orderBy("term").limit(300).collect()]
    q = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "query_id long, query string")
    bits = srch._query_bits(q.select("query_id").distinct())
    assert bits.select("chunk", "bit").distinct().count() == len(terms)
    assert 5 <= bits.select("chunk").distinct().count() <= 12
    assert bits.where("bit NOT BETWEEN 0 AND 63").count() == 0


@pytest.mark.parametrize("n", [5, 100])
def test_suggestions_equal_exhaustive_with_a_narrow_query(spark, sf, idx, n):
    rare = idx.term_stats.filter("doc_count = 1 AND term rlike '^[a-z]+$'").orderBy("term").first().term
    q = queries_table(spark, sf).unionByName(spark.createDataFrame([(99, rare)], "query_id long, query string"))
    got = sorted(map(tuple, srch.suggestions(idx, q, n).collect()))
    qd = srch.query_terms(q).select("query_id", "term").distinct()
    m = idx.postings.select("term", "doc_id").join(qd, "term").select("query_id", "doc_id").distinct()
    co = (m.join(idx.postings.select("doc_id", "term"), "doc_id").groupBy("query_id", "term")
          .agg(F.count(F.lit(1)).alias("doc_count")).join(qd, ["query_id", "term"], "left_anti"))
    top = srch._top_per_query(co, n, [F.col("doc_count").desc(), F.col("term").asc()])
    want = sorted(map(tuple, top.select("query_id", F.col("rank").cast("int"), "term",
                                        F.col("doc_count").cast("bigint")).collect()))
    assert got == want and any(r[0] == 99 for r in got)


def test_single_query_helpers(spark, idx):
    q = spark.createDataFrame([(0, "inon ering de")], "query_id long, query string")
    assert sorted(map(tuple, srch.search(idx, "inon ering de", 4).collect())) == sorted(
        map(tuple, srch.search_topk(idx, q, 4).drop("query_id").collect()))
    assert srch.suggest(idx, "inon ering de", 3).count() == 3
    assert srch.search(idx, "   ").count() == 0 and srch.suggest(idx, "").count() == 0


def test_bucket_counts_are_recorded(spark, sf):
    from trawl.session import scratch_path
    from trawl.sources.corpus import load_corpus
    from trawl.sources.index_store import build_and_write_index, read_index

    p = scratch_path(spark, "test-buckets")
    build_and_write_index(load_corpus(spark, sf, "documents"), p, term_buckets=7, doc_buckets=5)
    i7 = read_index(spark, p)
    assert (i7.term_buckets, i7.doc_buckets) == (7, 5)
    assert i7.postings.select("term_bucket").distinct().count() == 7
    q = spark.createDataFrame([(1, "inon ering de"), (2, "de de la")], "query_id long, query string")
    ref = stored_index(spark, sf, "documents")
    assert sorted(map(tuple, srch.search_topk(i7, q, 5).collect())) == sorted(
        map(tuple, srch.search_topk(ref, q, 5).collect()))


def test_missing_documents_are_dropped_before_ranking(spark, sf, idx):
    from trawl.operators.index import Index

    q = spark.createDataFrame([(1, "inon ering de")], "query_id long, query string")
    full = srch.search_topk(idx, q, 3).collect()
    missing = full[0].doc_id
    partial = Index(docs=idx.docs.filter(F.col("doc_id") != missing), postings=idx.postings,
                    _term_stats=idx.term_stats, term_buckets=idx.term_buckets, doc_buckets=idx.doc_buckets)
    got = srch.search_topk(partial, q, 3).collect()
    assert len(got) == 3 and [r.doc_id for r in got][:2] == [r.doc_id for r in full][1:]
    assert len(srch.search_topk(partial, q, 3, check_docs=False).collect()) == 2


def test_large_scores_fit(spark):
    from trawl.operators.index import Index

    docs = spark.createDataFrame([(1, "u", "t"), (2, "v", "t")], "doc_id long, url string, title string")
    postings = spark.createDataFrame([("a", 1, 2_000_000_000, 200, False)],
                                     "term string, doc_id long, frequency int, first_pos int, in_title boolean")
    q = spark.createDataFrame([(1, "a a")], "query_id long, query string")
    r = srch.search_topk(Index(docs=docs, postings=postings), q, 1).first()
    assert r.doc_score == int(r.score * 1000) > 2**31


def test_bucket_counts_follow_the_tokens():
    from trawl.sources.index_store import MIN_BUCKETS, TOKENS_PER_BUCKET, bucket_counts

    assert bucket_counts(0) == (MIN_BUCKETS, 1)
    assert bucket_counts(100 * TOKENS_PER_BUCKET)[0] == 100


def test_stored_texts_keep_their_documents(spark, sf, idx):
    joined = idx.docs.join(idx._texts.select("doc_id", "text_part", "clean_text"), ["doc_id", "text_part"])
    assert joined.count() == idx.docs.count() == idx.docs.select("doc_id").distinct().count()
    assert idx.docs.where("indexed_at IS NULL").count() == 0
    exact = idx.postings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    stored = idx.doc_terms.select("doc_id", F.size("terms").alias("n"))
    assert exact.exceptAll(stored).count() == 0 and stored.exceptAll(exact).count() == 0
