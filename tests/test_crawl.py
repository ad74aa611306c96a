"""Robots policy rows, frontier set algebra, crawl statistics."""

import datetime as dt

from pyspark.sql import functions as F

from trawl.operators import crawl as cr
from trawl.plans.inputs import ROBOTS_BODIES

EXPECTED = [(False, 3), (True, 0), (True, 0), (True, 7), (True, 0), (True, 0), (False, 0), (True, 0)]


def test_robots_rows(spark):
    rows = [(f"d{i + 1}", b) for i, b in enumerate(ROBOTS_BODIES)] + [("d9", None)]
    got = cr.robots_policy(spark.createDataFrame(rows, "domain string, body string")).orderBy("domain").collect()
    assert [(r.allowed, r.crawl_delay_s) for r in got] == EXPECTED + [(True, 0)]


def test_frontier(spark):
    links = spark.createDataFrame(
        [(1, "http://a/", 0, "http://a/x"), (1, "http://a/", 1, "http://b/y"), (2, "http://c/", 0, "http://a/x"),
         (2, "http://c/", 1, "https://a/z"), (2, "http://c/", 2, "http://d/w")],
        "page_id long, src_url string, link_pos int, dst_url string")
    visited = spark.createDataFrame([("http://a/x",)], "url string")
    in_prog = spark.createDataFrame([("http://d/w",)], "url string")
    policy = spark.createDataFrame([("http://b", False, 0), ("https://a", True, 4)],
                                   "domain string, allowed boolean, crawl_delay_s long")
    got = cr.frontier_allowed(links, visited, policy, in_prog).orderBy("url").collect()
    assert [(r.url, r.crawl_delay_s) for r in got] == [("https://a/z", 4)]
    assert cr.frontier_step(links, visited, policy, 0, in_progress=in_prog).count() == 0
    sizes = cr.frontier_sizes(links, visited, policy, in_prog).first()
    assert (sizes.frontier, sizes.visited, sizes.in_progress, sizes.robots_cached) == (2, 1, 1, 2)


def test_worker_stats(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(t, 1, "crawled", 0.0), (t, 1, "indexed", 2.0), (t, 1, "indexed", 4.0), (t, 2, "other", 9.0),
         (t + dt.timedelta(seconds=10), 2, "failed", 1.0)],
        "ts timestamp, worker_id long, action string, processing_time double")
    w = {r.worker_id: r for r in cr.worker_stats(log).collect()}
    assert (w[1].pages_indexed, w[1].total_processing_time, w[1].avg_processing_time) == (2, 6.0, 3.0)
    assert (w[2].pages_failed, w[2].avg_processing_time) == (1, 0.0)
    th = cr.crawl_throughput(log).first()
    assert (th.pages_crawled, th.elapsed_s, th.pages_per_second) == (1, 10.0, 0.1)
    assert cr.crawl_throughput(log.filter(F.col("action") != "crawled")).count() == 0


def test_seeds_join_the_frontier(spark):
    urls = ["https://a.org/x", "https://b.org", "https://c.org/y", "https://d.org/z"]
    links = spark.createDataFrame([], "page_id long, src_url string, link_pos int, dst_url string")
    visited = spark.createDataFrame([("https://B.org",)], "url string")
    seeds = spark.createDataFrame([(u,) for u in urls] + [("HTTPS://C.org/y",), (":bad",)], "url string")
    policy = spark.createDataFrame([], "domain string, allowed boolean, crawl_delay_s long")
    got = cr.frontier_step(links, visited, policy, 3, crawled=1, seeds=seeds).collect()
    assert [r.url for r in got] == ["https://a.org/x", "https://c.org/y"]
    assert cr.frontier_step(links, visited, policy, 1, crawled=1, seeds=seeds).count() == 0


def test_host_case_does_not_open_a_closed_domain(spark):
    links = spark.createDataFrame([(1, "http://q/", 0, "http://ex.com/a"), (1, "http://q/", 1, "http://ok.com/b"),
                                   (1, "http://q/", 2, "http://seen.com/c")],
                                  "page_id long, src_url string, link_pos int, dst_url string")
    visited = spark.createDataFrame([("http://SEEN.com/c",)], "url string")
    policy = spark.createDataFrame([("http://Ex.COM", False, 0), ("http://ex.com", True, 9), ("http://ok.com", True, 2)],
                                   "domain string, allowed boolean, crawl_delay_s long")
    got = cr.frontier_allowed(links, visited, policy).collect()
    assert [(r.url, r.crawl_delay_s) for r in got] == [("http://ok.com/b", 2)]


def test_registered_round_cuts_at_its_budget(spark, sf):
    from trawl.plans.catalog import CRAWLED, MAX_PAGES, QUERIES

    assert QUERIES["frontier_step"](spark, sf).count() == MAX_PAGES - CRAWLED
    assert QUERIES["frontier_sizes"](spark, sf).first().in_progress > 0
