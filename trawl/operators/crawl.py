"""Crawl-side operators: links, robots policy, the next frontier, crawl statistics.

Fetching is not done here: a crawl round runs over already fetched pages, and the
frontier is set algebra on DataFrames (distinct + left-anti joins + a robots join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.html import trim_ws
from trawl.functions.urls import domain_key, extract_links, normalize_url
from trawl.session import scratch_path
from trawl.sources.seen_urls import SeenUrls

# Crawl-log actions that count (fixed values); other actions count nothing.
CRAWLED, INDEXED, FAILED = "crawled", "indexed", "failed"


def page_links(pages: DataFrame) -> DataFrame:
    """page_id, src_url, link_pos, dst_url: de-duplicated out-links in document order.

    Deduplication happens per page inside its row (array_distinct), before the explode,
    so it never shuffles.
    """
    return pages.select(
        "page_id", F.col("url").alias("src_url"),
        F.posexplode(extract_links(F.col("html"), F.col("url"))).alias("link_pos", "dst_url"),
    ).select("page_id", "src_url", F.col("link_pos").cast("int").alias("link_pos"), "dst_url")


def pages_by_domain(pages: DataFrame) -> DataFrame:
    """domain (scheme://host[:port], the robots key), pages: page count per domain."""
    return (pages.select(domain_key(F.col("url")).alias("domain"))
            .groupBy("domain").agg(F.count(F.lit(1)).alias("pages")))


def _robots_step(acc, line):
    t = trim_ws(line)
    parts = F.split(t, ":", 2)
    field = F.lower(trim_ws(F.get(parts, 0)))
    value = trim_ws(F.get(parts, 1))
    skip = (t == "") | F.startswith(t, F.lit("#")) | (F.size(parts) != 2)
    star = acc["agent"] == "*"
    delay = value.try_cast("bigint")
    is_int = value.rlike(r"^[+-]?[0-9]+$") & delay.isNotNull()
    return F.struct(
        F.when(~skip & (field == "user-agent"), value).otherwise(acc["agent"]).alias("agent"),
        F.when(~skip & (field == "disallow") & star & (value == "/"), F.lit(False))
        .otherwise(acc["allowed"]).alias("allowed"),
        F.when(~skip & (field == "crawl-delay") & star & is_int, delay).otherwise(acc["delay"]).alias("delay"),
    )


def robots_policy(robots: DataFrame) -> DataFrame:
    """(domain, body) -> domain, allowed, crawl_delay_s.

    Only the immediately preceding User-agent line counts and it must be exactly "*";
    "Disallow: /" denies for good; the last valid integer Crawl-delay wins; Allow lines
    and path rules are ignored; trailing comments are not stripped. A domain without
    a body is allowed with delay 0. One fold over the body's lines per row: no shuffle.
    """
    init = F.struct(F.lit(None).cast("string").alias("agent"), F.lit(True).alias("allowed"),
                    F.lit(0).cast("bigint").alias("delay"))
    r = F.aggregate(F.split(F.coalesce(F.col("body"), F.lit("")), "\n"), init, _robots_step)
    return robots.select("domain", r.alias("r")).select(
        "domain", F.col("r.allowed").alias("allowed"), F.col("r.delay").alias("crawl_delay_s"))


def seed_urls(seeds: DataFrame) -> DataFrame:
    """Seed list (url) -> normalised URLs; unparseable seeds are dropped."""
    return seeds.select(normalize_url(F.col("url")).alias("url")).filter(F.col("url").isNotNull())


def _candidates(links: DataFrame, visited: DataFrame | SeenUrls, in_progress: DataFrame | None,
                seeds: DataFrame | None = None) -> DataFrame:
    cand = links.select(F.col("dst_url").alias("url"))
    if seeds is not None:
        cand = cand.unionByName(seed_urls(seeds))
    if isinstance(visited, SeenUrls):
        new = visited.new(cand)
        return new if in_progress is None else new.join(in_progress.select(
            normalize_url(F.col("url")).alias("url")).distinct(), "url", "left_anti")
    cand = cand.distinct()
    seen = visited.select("url")
    if in_progress is not None:
        seen = seen.unionByName(in_progress.select("url"))
    return cand.join(seen.select(normalize_url(F.col("url")).alias("url")).distinct(), "url", "left_anti")


def _policy_by_domain(policy: DataFrame) -> DataFrame:
    """One row per domain key: a host counts in lower case, as in the candidate URLs; of
    several rows any denial and the longest delay hold."""
    key = F.coalesce(domain_key(F.col("domain")), F.col("domain"))
    return policy.groupBy(key.alias("domain")).agg(F.bool_and("allowed").alias("allowed"),
                                                  F.max("crawl_delay_s").alias("crawl_delay_s"))


def frontier_allowed(links: DataFrame, visited: DataFrame | SeenUrls, policy: DataFrame,
                     in_progress: DataFrame | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """New URLs (not visited, not in progress) that robots allow: url, domain, crawl_delay_s.

    Candidates are the link targets plus the normalised seed URLs, if given. A `SeenUrls` set as ``visited`` is
    joined in place, bucket by bucket; any other table is normalised and shuffled. URLs of
    domains without a policy row are allowed with delay 0.
    """
    cand = _candidates(links, visited, in_progress, seeds).withColumn("domain", domain_key(F.col("url")))
    j = cand.join(_policy_by_domain(policy), "domain", "left")
    return (j.filter(F.coalesce(F.col("allowed"), F.lit(True)))
            .select("url", "domain", F.coalesce("crawl_delay_s", F.lit(0).cast("bigint")).alias("crawl_delay_s")))


def frontier_step(links: DataFrame, visited: DataFrame | SeenUrls, policy: DataFrame, max_pages: int,
                  crawled: int = 0, in_progress: DataFrame | None = None,
                  seeds: DataFrame | None = None) -> DataFrame:
    """One crawl round: the allowed new URLs within the page budget, in URL order.

    The budget (max_pages - crawled) is the feature here. Each task keeps its first
    `budget` URLs and one task merges them, so that task reads budget rows of every other.
    """
    budget = max(max_pages - crawled, 0)
    return frontier_allowed(links, visited, policy, in_progress, seeds).orderBy("url").limit(budget)


# Cut points tried at a time, rows taken to choose them, and rows of a range that is small enough to be sorted.
CUT_POINTS = 63
CUT_SAMPLE = 1_000
SMALL_RANGE = 100_000


def nth_smallest(urls: DataFrame, n: int) -> str | None:
    """The n-th smallest (from 1) of distinct non-null strings in the column url, or None if there are fewer.

    The range that holds it is cut at up to CUT_POINTS of its own values, the rows of each part are counted where they
    are, and the part that holds it is the next range, until one is small. The driver sees counts and cut points.
    Each count reads ``urls`` once, so it should be a stored table.
    """
    inside, before = urls.select("url"), 0
    size = inside.count()
    if n < 1 or size < n:
        return None
    while size > SMALL_RANGE:
        some = [r["url"] for r in inside.orderBy(F.xxhash64("url")).limit(CUT_SAMPLE).collect()]
        points = sorted(some)[::-(-len(some) // CUT_POINTS)]
        # The part of a row: how many cut points are not above it.
        cuts = F.array(*[F.lit(p) for p in points])
        parts = dict(inside.groupBy(F.size(F.filter(cuts, lambda p: p <= F.col("url"))).alias("part")).count().collect())
        for part in range(len(points) + 1):
            held = parts.get(part, 0)
            if before + held >= n:
                break
            before += held
        if part:
            inside = inside.where(F.col("url") >= points[part - 1])
        if part < len(points):
            inside = inside.where(F.col("url") < points[part])
        size = held
    return inside.orderBy("url").offset(n - before - 1).limit(1).first()["url"]


def frontier_round(links: DataFrame, seen: SeenUrls, policy: DataFrame, max_pages: int, crawled: int = 0,
                   in_progress: DataFrame | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """`frontier_step` against a kept set, to which its URLs are added; run at once, the result stored.

    The budget is taken by a filter up to the cut-off URL (`nth_smallest`), so no task merges the others' rows.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "frontier")
    frontier_allowed(links, seen, policy, in_progress, seeds).write.parquet(path)
    allowed = spark.read.parquet(path)
    budget = max(max_pages - crawled, 0)
    last = nth_smallest(allowed, budget)
    taken = allowed.where(F.col("url") <= last) if last is not None else allowed.limit(0) if not budget else allowed
    seen.add(taken)
    return taken


def frontier_sizes(links: DataFrame, visited: DataFrame, policy: DataFrame,
                   in_progress: DataFrame | None = None) -> DataFrame:
    """frontier (new distinct URLs), visited, in_progress, robots_cached: one row."""
    spark = links.sparkSession
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    cols = [n(_candidates(links, visited, in_progress)).alias("frontier"),
            n(visited.select("url").distinct()).alias("visited"),
            (n(in_progress.select("url").distinct()) if in_progress is not None else F.lit(0).cast("bigint"))
            .alias("in_progress"),
            n(policy.select("domain").distinct()).alias("robots_cached")]
    return spark.range(1).select(*cols)


def _counts(log: DataFrame):
    return [F.count_if(F.col("action") == CRAWLED).alias("pages_crawled"),
            F.count_if(F.col("action") == INDEXED).alias("pages_indexed"),
            F.count_if(F.col("action") == FAILED).alias("pages_failed")]


def crawl_stats(log: DataFrame) -> DataFrame:
    """Totals over a crawl log (ts, worker_id, action, processing_time): one row."""
    return log.agg(*_counts(log))


def worker_stats(log: DataFrame) -> DataFrame:
    """Per worker: crawled / indexed / failed, total and average processing time of
    indexed pages (average = total / max(indexed, 1)). Workers that only logged other
    actions still get a zero row."""
    agg = log.groupBy("worker_id").agg(
        *_counts(log),
        F.sum(F.when(F.col("action") == INDEXED, F.col("processing_time")).otherwise(0.0)).alias("total_processing_time"))
    return agg.select(
        "worker_id", "pages_crawled", "pages_indexed", "pages_failed",
        F.round("total_processing_time", 6).alias("total_processing_time"),
        F.round(F.col("total_processing_time") / F.greatest(F.col("pages_indexed"), F.lit(1)), 6)
        .alias("avg_processing_time"))


def crawl_throughput(log: DataFrame) -> DataFrame:
    """pages_crawled, elapsed_s (log span), pages_per_second; no row if nothing crawled."""
    a = log.agg(*_counts(log)[:1],
                (F.unix_micros(F.max("ts").cast("timestamp"))
                 - F.unix_micros(F.min("ts").cast("timestamp"))).alias("span_us"))
    elapsed = F.col("span_us") / F.lit(1_000_000.0)
    return (a.filter(F.col("pages_crawled") > 0)
            .select("pages_crawled", F.round(elapsed, 6).alias("elapsed_s"),
                    F.round(F.col("pages_crawled") / elapsed, 6).alias("pages_per_second")))
