"""The kept set of seen URLs and the cut-off by range counts."""

import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import crawl as cr
from trawl.session import scratch_path
from trawl.sources.seen_urls import SeenUrls


def _urls(spark, urls):
    return spark.createDataFrame([(u, 1) for u in urls], "url string, n int")


def test_set_keeps_and_reopens(spark):
    path = scratch_path(spark, "seen-test")
    seen = SeenUrls(spark, path, 4)
    assert seen.urls().count() == 0
    seen.add(_urls(spark, ["http://A.x/1", "http://a.x/1", "http://a.x/2#f", None, "not a url at all %%"]))
    held = {r["url"] for r in seen.urls().collect()}
    assert {"http://a.x/1"} <= held and seen.urls().count() == len(held)
    seen.add(_urls(spark, [*held, "http://b.x/"]))
    assert seen.urls().count() == len(held) + 1
    again = SeenUrls(spark, path, 4)
    assert {r["url"] for r in again.new(_urls(spark, ["http://b.x/", "http://c.x/", "http://C.x/"])).collect()} == {"http://c.x/"}
    small = again.compact(scratch_path(spark, "seen-compact"))
    assert sorted(small.urls().collect()) == sorted(again.urls().collect())
    for s in (seen, again, small):
        s.close()


def test_only_candidates_are_shuffled(spark):
    seen = SeenUrls(spark, scratch_path(spark, "seen-plan"), 8)
    seen.add(spark.range(5000).select(F.concat(F.lit("http://x.y/"), "id").alias("url")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = seen.new(spark.range(100).select(F.concat(F.lit("http://x.y/"), F.col("id") * 100).alias("url")))
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert "LeftAnti" in plan and new.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        seen.close()


@pytest.mark.parametrize("small", [1, 40])
def test_nth_smallest(spark, monkeypatch, small):
    monkeypatch.setattr(cr, "SMALL_RANGE", small)
    monkeypatch.setattr(cr, "CUT_POINTS", 3)
    rng = random.Random(small)
    urls = sorted({f"http://{rng.choice('aaaab')}/{'z' * rng.randint(0, 3)}{rng.randint(0, 500)}" for _ in range(300)})
    df = _urls(spark, rng.sample(urls, len(urls))).repartition(3)
    for n in (1, 2, 77, len(urls)):
        assert cr.nth_smallest(df, n) == urls[n - 1]
    assert cr.nth_smallest(df, 0) is None and cr.nth_smallest(df, len(urls) + 1) is None
    assert cr.nth_smallest(df.limit(0), 1) is None


def test_rounds_go_on_where_the_last_one_stopped(spark):
    links = spark.createDataFrame([(f"http://h.x/{i:03}",) for i in range(50)], "dst_url string")
    policy = spark.createDataFrame([("http://h.x", True, 1)], "domain string, allowed boolean, crawl_delay_s long")
    seen = SeenUrls(spark, scratch_path(spark, "seen-rounds"), 3)
    seen.add(_urls(spark, ["http://h.x/000", "http://h.x/007"]))
    got = [[r["url"][-3:] for r in cr.frontier_round(links, seen, policy, 20).orderBy("url").collect()] for _ in range(4)]
    left = [f"{i:03}" for i in range(50) if i not in (0, 7)]
    assert got == [left[:20], left[20:40], left[40:], []]
    assert cr.frontier_round(links, seen, policy, 5, crawled=9).count() == 0
    seen.close()
