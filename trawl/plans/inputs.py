"""Inputs the registered queries need that the driver tables do not hold directly.

Each builder only reshapes rows of the given tables into the schema a job expects; the
jobs themselves take nothing from how these rows are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import literal_rows
from trawl.sources.corpus import read_table

# Literal queries (fixed values): two hitting queries, a repeated term, a stop word
# first, upper case, an unstemmed word, an unknown word, empty and blank queries.
LITERAL_QUERIES = (
    (1, "inon ering de"),
    (2, "de de la"),
    (3, "that hat"),
    (4, "INON"),
    (5, "running"),
    (6, "zzzz"),
    (7, ""),
    (8, "   "),
)
# Passages of `benchmark` are queries too, with query_id = offset + item_id.
QUERY_ID_OFFSET = 1000


def queries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id BIGINT, query STRING: the literal queries plus every benchmark passage."""
    lits = literal_rows(spark, list(LITERAL_QUERIES), "query_id bigint, query string")
    bench = read_table(spark, sf_dir, "benchmark").select(
        (F.lit(QUERY_ID_OFFSET) + F.col("item_id")).cast("bigint").alias("query_id"),
        F.col("text").alias("query"))
    return lits.unionByName(bench)


# Robots bodies (fixed values): the test rows of the robots parser. The crawl has no
# fetched robots.txt files, so each domain of `pages` is given one of these bodies,
# picked by a simple rule on the domain string.
ROBOTS_BODIES = (
    "User-agent: *\nCrawl-delay: 3\nDisallow: /",
    "User-agent: bot\nDisallow: /",
    "User-agent: *\nDisallow: /private",
    "USER-AGENT: *\nCrawl-delay: 1.5\nCrawl-delay: 7",
    "User-agent: *\nUser-agent: bot\nDisallow: /",
    "# none\n\nno colon here",
    "User-agent: *\nDisallow: /\nAllow: /",
    "User-agent: *\nDisallow: / # all",
)
# Crawl-log actions from event types (fixed mapping); other types stay as unknown actions.
EVENT_ACTIONS = (("view", "crawled"), ("purchase", "indexed"), ("error", "failed"))
# Number of crawl workers of the reference crawler.
CRAWL_WORKERS = 80


def robots_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """domain, body: one robots.txt body per distinct domain of `pages`."""
    from trawl.functions.urls import domain_key

    domains = read_table(spark, sf_dir, "pages").select(domain_key(F.col("url")).alias("domain")).distinct()
    bodies = F.array(*[F.lit(b) for b in ROBOTS_BODIES])
    pick = (F.pmod(F.length("domain") + F.ascii(F.right("domain", F.lit(3))), F.lit(len(ROBOTS_BODIES))) + 1).cast("int")
    return domains.select("domain", F.element_at(bodies, pick).alias("body"))


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ts, worker_id, action, processing_time: `events` read as a crawl action log."""
    ev = read_table(spark, sf_dir, "events")
    mapped = F.when(F.col("event_type") == EVENT_ACTIONS[0][0], F.lit(EVENT_ACTIONS[0][1]))
    for src, dst in EVENT_ACTIONS[1:]:
        mapped = mapped.when(F.col("event_type") == src, F.lit(dst))
    return ev.select("ts", F.pmod(F.col("user_id"), F.lit(CRAWL_WORKERS)).alias("worker_id"),
                     mapped.otherwise(F.col("event_type")).alias("action"),
                     F.col("value").alias("processing_time"))


def visited_urls(links: DataFrame) -> DataFrame:
    """url: the links at even positions of each page's link list count as visited."""
    return links.filter(F.col("link_pos") % 2 == 0).select(F.col("dst_url").alias("url"))


def in_progress_urls(links: DataFrame) -> DataFrame:
    """url: the second link of each page counts as being fetched just now."""
    return links.filter(F.col("link_pos") == 1).select(F.col("dst_url").alias("url"))


# Fetch metadata of the stand-in crawl (fixed values): every page answered 200 with HTML,
# fetched one second apart from a fixed start, by worker page_id mod 80.
FETCH_START = "2024-01-01 00:00:00"
CONTENT_TYPE = "text/html; charset=utf-8"


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, status_code, content, content_type, headers, fetch_time, worker_id."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", "url", F.lit(200).alias("status_code"), F.col("html").alias("content"),
        F.lit(CONTENT_TYPE).alias("content_type"),
        F.create_map(F.lit("Content-Type"), F.lit(CONTENT_TYPE)).alias("headers"),
        (F.to_timestamp(F.lit(FETCH_START)) + F.make_dt_interval(secs=F.col("page_id").cast("decimal(18,6)")))
        .alias("fetch_time"),
        F.pmod(F.col("page_id"), F.lit(CRAWL_WORKERS)).cast("int").alias("worker_id"))
