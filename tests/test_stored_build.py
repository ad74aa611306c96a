"""The stored build groups tokens inside their row and merges the rows of a repeated document."""

import pytest
from pyspark.sql import functions as F

from trawl.operators.index import block_stats, document_postings, doc_block, postings_table, term_bucket, term_stats
from trawl.session import scratch_path
from trawl.sources.index_store import _dealt_by_bucket, build_and_write_index, read_index

ROWS = [(1, "u1", "Cats and Dogs", "cats dogs Cats, running é the cats  x"), (2, "u2", None, "cats a b dogs"),
        (1, "u1", "other", "dogs cats zebra"), (1, "u1", "other", "dogs cats zebra"), (3, "u3", "", "the of and"),
        (4, "u4", "s", "s ss ing ed"), (None, "u5", "dog", "dogs dog"), (None, "u6", "dog", "dog x"), (5, "u7", "t", None)]


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(ROWS, "doc_id long, url string, title string, clean_text string")


def _rows(df):
    return sorted((tuple(r) for r in df.select("term", "doc_id", "frequency", "first_pos", "positions", "in_title").collect()),
                  key=str)


def test_dealt_postings_equal_plain_ones(corpus):
    for blocks in (0, 64):
        assert _rows(postings_table(corpus, _dealt_by_bucket(3, 2, None, blocks))) == _rows(postings_table(corpus))


def test_a_text_is_one_row_per_term_before_the_exchange(corpus):
    one = corpus.where("doc_id = 2")
    assert sorted((r.term, r.positions) for r in document_postings(one).collect()) == [("b", "1"), ("cat", "0"), ("dog", "2")]
    plan = postings_table(corpus, _dealt_by_bucket(3, 2))._jdf.queryExecution().executedPlan().toString()
    # Tokens collected by a hash aggregate were sorted twice on the way (and spilled); one sort is left.
    assert "ObjectHashAggregate" not in plan and plan.count("Sort [") == 1


def test_a_document_is_one_row_per_bucket_in_the_exchange(corpus):
    from trawl.operators.index import bucket_postings

    # Null and repeated titles, an empty stem and a null document included; a row per posting was shuffled before.
    texts = corpus.withColumn("title", F.when(F.col("doc_id") != 2, F.col("title")))
    rows = bucket_postings(texts, 3)
    lines = rows.select("doc_id", "term_bucket", F.explode(F.split("packed", "\n")).alias("line"))
    line = F.concat("term", F.lit(" "), "positions", F.when(F.col("in_title"), "+").when(F.col("in_title").isNull(), "?").otherwise(""))
    plain = document_postings(texts).select("doc_id", term_bucket(F.col("term"), 3).alias("term_bucket"), line.alias("line"))
    assert sorted(map(str, lines.collect())) == sorted(map(str, plain.collect()))
    assert rows.where("doc_id <> 1").groupBy("doc_id", "term_bucket").count().where("count > 1").count() == 0
    plan = postings_table(texts, _dealt_by_bucket(3, 2, None, 64))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(split(packed") < plan.index("Exchange") < plan.index("Generate inline")


def test_blocks_are_dealt_evenly(spark):
    """A slice by hash held up to four times the blocks of the mean, and its task as many postings."""
    rows = spark.range(20_000).selectExpr("'x' AS term", "id AS doc_id")
    dealt = _dealt_by_bucket(16, 99, 800_000_000, 240)(rows).select("term_slice", "doc_block").distinct()
    sizes = [r["count"] for r in dealt.groupBy("term_slice").count().collect()]
    assert sorted(set(sizes)) == [2, 3] and len(sizes) == 99


def test_derived_tables_need_no_aggregate_or_sort_merge(spark, corpus, monkeypatch):
    """block_stats are filtered from the stored postings, doc_terms are joined by hash in tasks bounded by the tokens."""
    from trawl.sources import index_store

    asked = []
    real = index_store.document_terms

    def seen(pairs, stats, *keys, **deal):
        out = real(pairs, stats, *keys, **deal)
        asked.append((pairs, out._jdf.queryExecution().executedPlan().toString(),
                      spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return out

    monkeypatch.setattr(index_store, "document_terms", seen)
    monkeypatch.setattr(index_store, "TOKENS_PER_TASK", 2)
    before, path = spark.conf.get("spark.sql.files.maxPartitionBytes"), scratch_path(spark, "derived")
    build_and_write_index(corpus, path)
    ((pairs, plan, split),) = asked
    assert pairs.rdd.getNumPartitions() > 5 and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # The build's scans are bounded, and the session's setting is put back.
    assert int(split.rstrip("b")) <= index_store.SPLIT_BYTES
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    stored = spark.read.parquet(f"{path}/postings")
    firsts = stored.where("block_best IS NOT NULL").select("term", doc_block(F.col("doc_id"), 64).alias("b"))
    assert firsts.count() == firsts.distinct().count() == read_index(spark, path).block_stats.count()
    assert not {"block_best", "block_doc_count"} & set(read_index(spark, path).postings.columns)


def test_stored_tables_equal_plain_ones(spark, corpus):
    path = scratch_path(spark, "stored-build")
    build_and_write_index(corpus, path)
    idx, plain = read_index(spark, path), postings_table(corpus)
    assert _rows(idx.postings) == _rows(plain)
    stats = lambda df, *c: sorted((tuple(r) for r in df.select(*c).collect()), key=str)
    assert stats(idx.term_stats, "term", "doc_count") == stats(term_stats(plain), "term", "doc_count")
    columns = ("term", "doc_block", "doc_count", F.round("best", 6))
    assert stats(idx.block_stats, *columns) == stats(block_stats(plain, idx.doc_blocks), *columns)
    terms = idx.doc_terms.select("doc_id", F.explode("terms").alias("t")).select("doc_id", "t.term", "t.df")
    assert stats(terms, "doc_id", "term", "df") == stats(
        plain.join(term_stats(plain), "term").select("doc_id", "term", F.col("doc_count").alias("df")), "doc_id", "term", "df")


def test_postings_are_not_shuffled_to_meet_few_queries(spark, sf):
    from trawl.operators import search as srch
    from trawl.plans.catalog import stored_index
    from trawl.plans.inputs import queries_table

    idx, queries = stored_index(spark, sf, "pages"), queries_table(spark, sf)
    for df in (srch.search_topk(idx, queries, 5), srch.search_topk(idx, queries, 5, early_stop=True), srch.matching_docs(idx, queries)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(term#" not in plan and "term_slice" not in plan
    # A table whose size the planner does not know is joined as before, and gives the same rows.
    rows = spark.createDataFrame([tuple(r) for r in queries.collect()], "query_id long, query string").repartition(2)
    assert sorted(srch.search_topk(idx, rows, 5).collect()) == sorted(srch.search_topk(idx, queries, 5).collect())
    assert sorted(srch.search_topk(idx, rows, 5, early_stop=True).collect()) == sorted(srch.search_topk(idx, queries, 5).collect())
