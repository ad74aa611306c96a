"""Headline benchmark: index build + batch search / suggestions / TF search + crawl round.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one
JSON line. Each step is forced with the no-op sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trawl.operators import crawl as cr  # noqa: E402
from trawl.operators import search as srch  # noqa: E402
from trawl.plans.catalog import stored_links  # noqa: E402
from trawl.plans.inputs import queries_table, robots_table, visited_urls  # noqa: E402
from trawl.session import get_spark, scratch_path  # noqa: E402
from trawl.sources.corpus import load_corpus  # noqa: E402
from trawl.sources.index_store import build_and_write_index, read_index  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app="trawl-bench",
                      driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    times: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()  # start executors before timing (not an operator cost)

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)

    paths = {k: scratch_path(spark, f"bench-index-{k}") for k in ("documents", "pages")}
    timed("index_build_documents",
          lambda: build_and_write_index(load_corpus(spark, sf_dir, "documents"), paths["documents"]))
    timed("index_build_pages",
          lambda: build_and_write_index(load_corpus(spark, sf_dir, "pages"), paths["pages"]))
    docs_idx = read_index(spark, paths["documents"])
    pages_idx = read_index(spark, paths["pages"])
    q = queries_table(spark, sf_dir).cache()
    q.count()
    timed("search_topk", lambda: run(srch.search_topk(docs_idx, q, 10)))
    timed("search_topk_pages", lambda: run(srch.search_topk(pages_idx, q, 10)))
    timed("suggestions", lambda: run(srch.suggestions(docs_idx, q, 5)))
    timed("search_tf", lambda: run(srch.search_tf(docs_idx, q)))
    timed("search_snippets", lambda: run(srch.search_snippets(pages_idx, q, 5)))

    def crawl_round():
        links = stored_links(spark, sf_dir)
        run(cr.frontier_step(links, visited_urls(links), cr.robots_policy(robots_table(spark, sf_dir)), 12000))
    timed("frontier_step", crawl_round)

    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "n_queries": q.count()}))


if __name__ == "__main__":
    main()
