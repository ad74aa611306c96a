"""Every registered query against its DuckDB oracle at sf0.001 (the driver gate runs sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from trawl.plans.catalog import QUERIES

TABLES = "events documents pages benchmark conversations labels".split()
FAST = ["tokenize", "postings", "postings_pages", "term_doc_count", "doc_lengths", "index_stats", "index_stats_ext",
        "stopword_share", "clean_text", "page_title", "page_first_title", "query_terms", "query_term_idf",
        "search_scores", "search_topk", "search_topk_blocks", "search_topk_pages", "search_snippets", "matching_docs", "suggestions",
        "suggestions_pages", "search_tf", "normalize_url", "valid_url", "page_links", "pages_by_domain",
        "robots_policy", "frontier_step", "frontier_allowed", "frontier_sizes", "crawl_stats", "worker_stats",
        "crawl_throughput", "to_crawl_output", "scan_crawl_output", "index_roundtrip", "header_counts",
        "search_response", "import_legacy_index"]


def _rows(pdf):
    def norm(v):
        if isinstance(v, float):
            return round(v, 6)
        return v
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_documented():
    assert set(oracle_sql()) - set(queries()) == set()
    assert set(QUERIES) - set(oracle_sql()) == set()


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, sf, con, key):
    s = queries()[key](spark, sf).toPandas()
    d = con.execute(oracle_sql()[key]).df()
    assert _rows(s) == _rows(d)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "url", "title", "score", "doc_score", "snippet"]
    assert df.count() > 0
    assert not any(isinstance(v, float) and math.isnan(v) for r in df.collect() for v in r)
