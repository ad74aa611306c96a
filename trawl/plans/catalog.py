"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Search keys read a stored index: the corpus is indexed once per session and corpus,
written to the shared checkpoint folder, and read back (the lineage is cut there, so
search never re-cleans or re-tokenises the corpus).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.html import clean_text, first_title, page_title
from trawl.functions.text import analyze
from trawl.functions.urls import is_valid_url, normalize_url, raw_hrefs
from trawl.operators import crawl as cr
from trawl.operators import index as ix
from trawl.operators import search as srch
from trawl.plans.inputs import (crawl_log, fetched_pages, in_progress_urls, queries_table, robots_table,
                                visited_urls)
from trawl.session import scratch_path
from trawl.sources import crawl_files as cf
from trawl.sources.corpus import load_corpus, read_spread, read_table
from trawl.sources.index_store import build_and_write_index, read_index
from trawl.sources.legacy_index import export_legacy_index, import_legacy_index
from trawl.sources.seen_urls import SeenUrls
from trawl.streaming.ingest import finish, read_streamed_index, stream_index, tick_stats
from trawl.streaming.stats import read_worker_stats, stream_worker_stats

_STORED: dict[tuple[str, str, str], str] = {}


def stored_index(spark: SparkSession, sf_dir: str, kind: str) -> ix.Index:
    """Build, write and read back the index of a corpus (once per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    if key not in _STORED:
        path = scratch_path(spark, f"index-{kind}")
        build_and_write_index(load_corpus(spark, sf_dir, kind), path)
        _STORED[key] = path
    return read_index(spark, _STORED[key])


def _postings_out(p: DataFrame) -> DataFrame:
    return p.select("term", "doc_id", "frequency", "first_pos",
                    F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


def q_tokenize(spark, sf):
    c = load_corpus(spark, sf, "documents")
    # A row filter would be pushed below the projection and analyse every text a second time.
    kept = F.filter(F.array(F.struct(analyze(F.col("clean_text")).alias("terms"))), lambda x: F.size(x["terms"]) > 0)
    t = c.select("doc_id", F.inline(kept))
    return t.select("doc_id", F.size("terms").cast("int").alias("n_terms"), F.array_join("terms", " ").alias("terms"))


def q_postings(spark, sf):
    return _postings_out(ix.postings_table(load_corpus(spark, sf, "documents")))


def q_postings_pages(spark, sf):
    return _postings_out(ix.postings_table(load_corpus(spark, sf, "pages")))


def q_term_doc_count(spark, sf):
    return ix.term_stats(ix.postings_table(load_corpus(spark, sf, "documents")))


def q_doc_lengths(spark, sf):
    return ix.docs_table(load_corpus(spark, sf, "documents")).select("doc_id", "length")


def q_index_stats(spark, sf):
    return ix.index_stats(stored_index(spark, sf, "documents"))


def q_index_stats_ext(spark, sf):
    return ix.index_stats_ext(stored_index(spark, sf, "documents"))


def q_stopword_share(spark, sf):
    return ix.stopword_share(load_corpus(spark, sf, "documents"))


def q_clean_text(spark, sf):
    return read_spread(spark, sf, "pages").select("page_id", clean_text(F.col("html")).alias("clean_text"))


def q_page_title(spark, sf):
    return read_spread(spark, sf, "pages").select("page_id", page_title(F.col("html")).alias("title"))


def q_page_first_title(spark, sf):
    return read_spread(spark, sf, "pages").select("page_id", first_title(F.col("html")).alias("title"))


def q_query_terms(spark, sf):
    return srch.query_terms(queries_table(spark, sf)).select(
        "query_id", F.col("term_pos").cast("int").alias("term_pos"), "term")


def q_query_term_idf(spark, sf):
    return srch.query_term_idf(stored_index(spark, sf, "documents"), queries_table(spark, sf)).select(
        "query_id", "term", "qtf", "doc_count", F.round("idf", 9).alias("idf"))


def q_search_scores(spark, sf):
    return srch.search_scores(stored_index(spark, sf, "documents"), queries_table(spark, sf))


def q_search_topk(spark, sf):
    return srch.search_topk(stored_index(spark, sf, "documents"), queries_table(spark, sf), 5)


def q_search_topk_pages(spark, sf):
    return srch.search_topk(stored_index(spark, sf, "pages"), queries_table(spark, sf), 5)


def q_search_topk_blocks(spark, sf):
    """Ranked search with the early stop: only document blocks that can hold a result are scored."""
    return srch.search_topk(stored_index(spark, sf, "documents"), queries_table(spark, sf), 5, early_stop=True)


def q_search_missing_docs(spark, sf):
    """Ranked search where the document table lacks every seventh document that the postings name."""
    whole = stored_index(spark, sf, "documents")
    partial = ix.Index(docs=whole.docs.where(F.col("doc_id") % 7 != 0), postings=whole.postings,
                       _term_stats=whole.term_stats, term_buckets=whole.term_buckets, doc_buckets=whole.doc_buckets,
                       _texts=whole._texts)
    return srch.search_topk(partial, queries_table(spark, sf), 5)


def q_search_snippets(spark, sf):
    return srch.search_snippets(stored_index(spark, sf, "pages"), queries_table(spark, sf), 5)


def q_matching_docs(spark, sf):
    return srch.matching_docs(stored_index(spark, sf, "documents"), queries_table(spark, sf))


def q_suggestions(spark, sf):
    return srch.suggestions(stored_index(spark, sf, "documents"), queries_table(spark, sf), 5)


def q_suggestions_pages(spark, sf):
    return srch.suggestions(stored_index(spark, sf, "pages"), queries_table(spark, sf), 5)


def q_search_tf(spark, sf):
    return srch.search_tf(stored_index(spark, sf, "documents"), queries_table(spark, sf))


def q_search_response(spark, sf):
    """The combined response per query, projected to comparable text: ranked doc ids
    ("rank:doc_id,...") and suggested terms, in order."""
    r = srch.search_response(stored_index(spark, sf, "pages"), queries_table(spark, sf), 5, 5)
    return r.select(
        "query_id", F.size("results").alias("n_results"),
        F.array_join(F.transform("results", lambda x: F.concat_ws(":", x["rank"], x["doc_id"])), ",").alias("results"),
        F.array_join("suggestions", ",").alias("suggestions"))


def q_normalize_url(spark, sf):
    return read_spread(spark, sf, "pages").select("page_id", normalize_url(F.col("url")).alias("url"))


def q_valid_url(spark, sf):
    """The predicate on every page URL (href_pos -1) and on every raw href as written."""
    pages = read_spread(spark, sf, "pages")
    own = pages.select("page_id", F.lit(-1).alias("href_pos"), "url")
    hrefs = pages.select("page_id", F.posexplode(raw_hrefs(F.col("html"))).alias("href_pos", "url"))
    return own.unionByName(hrefs).select("page_id", F.col("href_pos").cast("int").alias("href_pos"), "url",
                                         is_valid_url(F.col("url")).alias("valid"))


def q_page_links(spark, sf):
    return cr.page_links(read_spread(spark, sf, "pages"))


def q_pages_by_domain(spark, sf):
    return cr.pages_by_domain(read_spread(spark, sf, "pages"))


def q_robots_policy(spark, sf):
    return cr.robots_policy(robots_table(spark, sf))


def stored_links(spark, sf):
    """The links of all pages, extracted once and written, as a crawl round reads them several times."""
    path = scratch_path(spark, "links")
    cr.page_links(read_spread(spark, sf, "pages")).write.parquet(path)
    return spark.read.parquet(path)


def _crawl_round(spark, sf):
    links = stored_links(spark, sf)
    return links, visited_urls(links), cr.robots_policy(robots_table(spark, sf))


# Page budget of the reference crawler, and pages already crawled before this round: the
# budget left cuts the frontier.
MAX_PAGES = 12000
CRAWLED = 11_900


def q_frontier_step(spark, sf):
    """A round with seeds (every page's own URL) and URLs being fetched (each page's second link)."""
    links, visited, policy = _crawl_round(spark, sf)
    return cr.frontier_step(links, visited, policy, MAX_PAGES, CRAWLED, in_progress=in_progress_urls(links),
                            seeds=read_table(spark, sf, "pages").select("url"))


ROUNDS, ROUND_PAGES = 3, 100


def q_frontier_rounds(spark, sf):
    """Three rounds over the same links, each against the kept set of URLs that the earlier ones left."""
    links, visited, policy = _crawl_round(spark, sf)
    seen = SeenUrls(spark, scratch_path(spark, "seen-urls"), spark.sparkContext.defaultParallelism)
    seen.add(visited)
    rounds = [cr.frontier_round(links, seen, policy, ROUND_PAGES).withColumn("round", F.lit(k + 1)) for k in range(ROUNDS)]
    seen.close()
    return reduce(DataFrame.unionByName, rounds)


def q_frontier_allowed(spark, sf):
    return cr.frontier_allowed(*_crawl_round(spark, sf))


def q_frontier_sizes(spark, sf):
    links, visited, policy = _crawl_round(spark, sf)
    return cr.frontier_sizes(links, visited, policy, in_progress_urls(links))


def q_crawl_stats(spark, sf):
    return cr.crawl_stats(crawl_log(spark, sf))


def q_worker_stats(spark, sf):
    return cr.worker_stats(crawl_log(spark, sf))


def q_crawl_throughput(spark, sf):
    return cr.crawl_throughput(crawl_log(spark, sf))


def q_to_crawl_output(spark, sf):
    return cf.flatten(cf.crawl_envelope(fetched_pages(spark, sf), with_word_count=True))


def q_scan_crawl_output(spark, sf):
    d = scratch_path(spark, "crawl-files")
    cf.write_crawl_output(cf.crawl_envelope(fetched_pages(spark, sf)), d)
    good, _ = cf.split_bad(cf.read_crawl_output(spark, d, multiline=False, pattern="part-*"))
    return cf.flatten(good)


def q_page_files(spark, sf):
    """Every page written as a file of its own (raw_*.json) and read back by that pattern."""
    d = scratch_path(spark, "page-files")
    cf.write_crawl_files(cf.crawl_envelope(fetched_pages(spark, sf)), d)
    good, _ = cf.split_bad(cf.read_crawl_output(spark, d))
    return cf.flatten(good)


def q_header_counts(spark, sf):
    return cf.header_counts(cf.crawl_envelope(fetched_pages(spark, sf)))


def q_index_roundtrip(spark, sf):
    return _postings_out(stored_index(spark, sf, "documents").postings)


def q_import_legacy_index(spark, sf):
    """The index of all documents written as indented JSON objects and imported again."""
    path = scratch_path(spark, "legacy-index")
    export_legacy_index(stored_index(spark, sf, "documents"), path, spark.sparkContext.defaultParallelism, "gzip")
    return _postings_out(import_legacy_index(spark, path).postings)


# Files a micro-batch takes at most (small, so that every run has several batches).
STREAM_FILES = 3
STREAM_PARTS = 8


def _streamed(spark, sf, name: str, **options) -> str:
    """Pages staged as JSON Lines files, indexed by the streaming ingest; returns its folder."""
    root = scratch_path(spark, name)
    cf.write_crawl_output(cf.crawl_envelope(fetched_pages(spark, sf)).repartition(STREAM_PARTS, "url"), f"{root}/in")
    finish(stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=STREAM_FILES,
                        pattern="part-*", multiline=False, **options))
    return root


def q_stream_index(spark, sf):
    """Pages dumped as crawl files, indexed by the streaming ingest, read back."""
    idx = read_streamed_index(spark, f"{_streamed(spark, sf, 'stream-index')}/out")
    return _postings_out(idx.postings).join(idx.docs.select("doc_id", "url"), "doc_id").drop("doc_id")


def q_stream_tick_stats(spark, sf):
    """Documents, terms and quarantined files after the last of the ingest's micro-batches."""
    ticks = tick_stats(spark, f"{_streamed(spark, sf, 'stream-ticks')}/out")
    return ticks.orderBy(F.desc("batch_id")).limit(1).drop("batch_id")


def q_stream_clean_source(spark, sf):
    """The ingest with processed files deleted behind it: every page is indexed all the same, and only the files of
    the last batch are left."""
    root = _streamed(spark, sf, "stream-clean", clean_source="delete")
    left = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{root}/in")
    return read_streamed_index(spark, f"{root}/out").docs.select(
        "url", "title", "length", left.select(F.count("path")).scalar().alias("files_left"))


def q_stream_replay(spark, sf):
    """Every micro-batch run again from the start, as after the loss of the checkpoint: the same index."""
    root = _streamed(spark, sf, "stream-replay")
    finish(stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt-again", max_files_per_trigger=STREAM_FILES,
                        pattern="part-*", multiline=False))
    idx = read_streamed_index(spark, f"{root}/out")
    return _postings_out(idx.postings).join(idx.docs.select("doc_id", "url"), "doc_id").drop("doc_id")


def q_stream_worker_stats(spark, sf):
    """The crawl log written as JSON files, aggregated by a streaming query, read back."""
    root = scratch_path(spark, "stream-stats")
    crawl_log(spark, sf).write.json(f"{root}/log")
    finish(stream_worker_stats(spark, f"{root}/log", f"{root}/out", f"{root}/ckpt"))
    return read_worker_stats(spark, f"{root}/out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokenize": q_tokenize,
    "postings": q_postings,
    "postings_pages": q_postings_pages,
    "term_doc_count": q_term_doc_count,
    "doc_lengths": q_doc_lengths,
    "index_stats": q_index_stats,
    "index_stats_ext": q_index_stats_ext,
    "stopword_share": q_stopword_share,
    "clean_text": q_clean_text,
    "page_title": q_page_title,
    "page_first_title": q_page_first_title,
    "query_terms": q_query_terms,
    "query_term_idf": q_query_term_idf,
    "search_scores": q_search_scores,
    "search_topk": q_search_topk,
    "search_topk_pages": q_search_topk_pages,
    "search_topk_blocks": q_search_topk_blocks,
    "search_missing_docs": q_search_missing_docs,
    "search_snippets": q_search_snippets,
    "matching_docs": q_matching_docs,
    "suggestions": q_suggestions,
    "suggestions_pages": q_suggestions_pages,
    "search_tf": q_search_tf,
    "search_response": q_search_response,
    "normalize_url": q_normalize_url,
    "valid_url": q_valid_url,
    "page_links": q_page_links,
    "pages_by_domain": q_pages_by_domain,
    "robots_policy": q_robots_policy,
    "frontier_step": q_frontier_step,
    "frontier_rounds": q_frontier_rounds,
    "frontier_allowed": q_frontier_allowed,
    "frontier_sizes": q_frontier_sizes,
    "crawl_stats": q_crawl_stats,
    "worker_stats": q_worker_stats,
    "crawl_throughput": q_crawl_throughput,
    "to_crawl_output": q_to_crawl_output,
    "scan_crawl_output": q_scan_crawl_output,
    "index_roundtrip": q_index_roundtrip,
    "import_legacy_index": q_import_legacy_index,
    "page_files": q_page_files,
    "header_counts": q_header_counts,
    "stream_index": q_stream_index,
    "stream_worker_stats": q_stream_worker_stats,
    "stream_tick_stats": q_stream_tick_stats,
    "stream_clean_source": q_stream_clean_source,
    "stream_replay": q_stream_replay,
}
