"""Streaming ingest equals the batch index; replays add nothing; bad files are quarantined."""

import json

from pyspark.sql import functions as F

from trawl.operators import index as ix
from trawl.plans.inputs import fetched_pages
from trawl.session import scratch_path
from trawl.sources import crawl_files as cf
from trawl.streaming.ingest import (batch_stats, compact_streamed_index, finish, read_streamed_index, stream_index,
                                    tick_stats)


def test_stream_equals_batch_and_quarantines(spark, sf, tmp_path):
    root = scratch_path(spark, "test-stream")
    env = cf.crawl_envelope(fetched_pages(spark, sf))
    n = cf.write_crawl_files(env, f"{root}/in")
    assert n == env.count()
    in_dir = f"{root}/in".replace("file:", "")
    with open(f"{in_dir}/raw_bad_truncated.json", "w") as f:
        f.write('{"url": "http://x/", "page_data": {')
    with open(f"{in_dir}/raw_bad_null.json", "w") as f:
        json.dump({"url": "http://y/", "page_data": None}, f)
    with open(f"{in_dir}/other.json", "w") as f:
        json.dump({"url": "http://z/", "page_data": {"content": "<title>z</title>"}}, f)

    q = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=20)
    q.awaitTermination(600)
    assert q.exception() is None
    got = read_streamed_index(spark, f"{root}/out")

    batch = ix.build_index(cf.crawl_corpus(cf.split_bad(cf.read_crawl_output(spark, f"{root}/in"))[0]))
    cols = ["term", "doc_id", "frequency", "first_pos", "positions", "in_title"]
    a, b = got.postings.select(cols), batch.postings.select(cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert got.docs.count() == n
    quarantine = spark.read.parquet(f"{root}/out/quarantine")
    # truncated + null page_data; "other.json" is not a raw_ file
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in quarantine.collect()) == [
        "raw_bad_null.json", "raw_bad_truncated.json"]
    last = tick_stats(spark, f"{root}/out").orderBy(F.desc("batch_id")).first()
    assert (last.total_documents, last.quarantined) == (n, 2)
    assert last.total_terms == got.term_stats.count()

    stats = batch_stats(spark, f"{root}/out").agg(F.sum("docs"), F.sum("quarantined"), F.sum("postings")).first()
    assert tuple(stats) == (n, 2, a.count())

    compacted = compact_streamed_index(spark, f"{root}/out", f"{root}/index")
    assert compacted.bucketed
    c = compacted.postings.select(cols)
    assert c.count() == b.count() and c.exceptAll(b).count() == 0

    # A restart from the checkpoint finds nothing new: no duplicates.
    q2 = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    q2.awaitTermination(600)
    assert read_streamed_index(spark, f"{root}/out").postings.count() == a.count()
    assert got.docs.groupBy("doc_id").count().filter(F.col("count") > 1).count() == 0


def test_clean_source_deletes_processed_files(spark, sf):
    import os

    root = scratch_path(spark, "test-stream-clean")
    env = cf.crawl_envelope(fetched_pages(spark, sf))
    n = cf.write_crawl_files(env, f"{root}/in")
    q = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=10,
                     clean_source="delete")
    q.awaitTermination(600)
    assert q.exception() is None
    left = [f for f in os.listdir(f"{root}/in".replace("file:", "")) if f.startswith("raw_")]
    # Files of completed batches are deleted; the last batch's files may lag behind.
    assert len(left) < n
    assert read_streamed_index(spark, f"{root}/out").docs.count() == n


def test_envelope_word_count_option(spark, sf):
    from trawl.operators.index import docs_table
    from trawl.sources.corpus import pages_corpus, read_table

    env = cf.crawl_envelope(fetched_pages(spark, sf), with_word_count=True)
    got = {r.url: r.wc for r in env.select("url", F.col("index_result.word_count").alias("wc")).collect()}
    want = {r.url: r.length for r in docs_table(pages_corpus(read_table(spark, sf, "pages"))).collect()}
    assert got == want


def test_recrawled_page_replaces_older_version(spark, sf):
    root = scratch_path(spark, "test-stream-recrawl")
    env = cf.crawl_envelope(fetched_pages(spark, sf)).limit(3)
    cf.write_crawl_files(env, f"{root}/in")
    stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination(600)
    # The first page is fetched again with new content and lands in a later batch.
    again = (env.limit(1).withColumn("page_data", F.struct(
        *[F.lit("<title>New</title>fresh words").alias("content") if f == "content" else F.col(f"page_data.{f}")
          for f in cf.PAGE_DATA.fieldNames()]))
        .withColumn("file_name", F.concat(F.lit("raw_again_"), F.col("file_name"))))
    cf.write_crawl_files(again, f"{root}/in")
    stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination(600)
    idx = read_streamed_index(spark, f"{root}/out")
    assert idx.docs.count() == 3
    url = again.first().url
    assert idx.docs.filter(F.col("url") == url).first().title == "New"
    terms = {r.term for r in idx.postings.join(idx.docs.filter(F.col("url") == url), "doc_id").collect()}
    assert terms == {"new", "fresh", "word"}


def test_polling_trigger_and_json_lines_sink(spark, sf):
    root = scratch_path(spark, "test-stream-poll")
    env = cf.crawl_envelope(fetched_pages(spark, sf))
    cf.write_crawl_files(env.limit(10), f"{root}/in")
    q = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", available_now=False, poll="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_streamed_index(spark, f"{root}/out").docs.count() == 10

    # JSON Lines sink (many envelopes per file) reads back with multiline=False.
    cf.write_crawl_output(env, f"{root}/jsonl", mode="overwrite")
    back = spark.read.schema(cf.CRAWL_OUTPUT_READ).json(f"{root}/jsonl")
    good, bad = cf.split_bad(back)
    assert good.count() == env.count() and bad.count() == 0
    assert cf.flatten(good).exceptAll(cf.flatten(env)).count() == 0


def test_stream_worker_stats_equals_batch(spark, sf):
    from trawl.operators.crawl import worker_stats
    from trawl.plans.inputs import crawl_log
    from trawl.streaming.stats import read_worker_stats, stream_worker_stats

    root = scratch_path(spark, "test-stream-stats")
    log = crawl_log(spark, sf)
    log.repartition(3).write.json(f"{root}/log")
    q = stream_worker_stats(spark, f"{root}/log", f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(600)
    got = read_worker_stats(spark, f"{root}/out")
    want = worker_stats(log)
    assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).count() == 0


def test_crawl_file_writer_accepts_path_forms(spark, sf, tmp_path):
    import os

    env = cf.crawl_envelope(fetched_pages(spark, sf)).limit(3)
    for i, form in enumerate([str(tmp_path / "a"), "file:" + str(tmp_path / "b"), "file://" + str(tmp_path / "c")]):
        assert cf.write_crawl_files(env, form) == 3
        d = tmp_path / "abc"[i]
        assert len([f for f in os.listdir(d) if f.startswith("raw_")]) == 3
        assert cf.read_crawl_output(spark, form).count() == 3


def test_first_seen_counts_each_key_once(spark):
    from trawl.session import scratch_path
    from trawl.streaming.first_seen import FirstSeen

    path = scratch_path(spark, "first-seen")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    table = FirstSeen(spark, path, 4)
    assert table.merge(keys("a", "b", "b", None), 0) == 2
    assert table.merge(keys("b", "c"), 1) == 1
    assert table.merge(keys("b", "c"), 1) == 1  # replayed
    assert table.merge(keys("a", "c"), 2) == 0 and table.merge(keys(), 3) == 0
    assert sorted(map(tuple, FirstSeen(spark, path, 4).rows().collect())) == [("a", 0), ("b", 0), ("c", 1)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # only the batch's keys are dealt out
        asked = keys("a").repartition(4, "key").distinct().join(table.rows().select("key"), "key", "left_anti")
        plan = asked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_failed_page_file_write_leaves_nothing(spark, sf, tmp_path):
    import os

    import pytest

    env = cf.crawl_envelope(fetched_pages(spark, sf)).limit(20).repartition(4)
    bad = env.withColumn("url", F.when(F.pmod(F.xxhash64("file_name"), F.lit(7)) == 0, F.raise_error(F.lit("lost"))).otherwise(
        F.col("url")))
    with pytest.raises(Exception, match="lost"):
        cf.write_crawl_files(bad, str(tmp_path / "d"))
    left = [f for _, _, files in os.walk(tmp_path / "d") for f in files]
    assert left == []
    assert cf.write_crawl_files(env, str(tmp_path / "d")) == 20
    assert cf.write_crawl_files(env, str(tmp_path / "d")) == 20  # a repeated write replaces its files
    left = [f for _, _, files in os.walk(tmp_path / "d") for f in files if f.endswith(".json")]
    assert len(left) == 20 and all(f.startswith("raw_") for f in left)


def test_clean_source_archive(spark, sf):
    import os

    root = scratch_path(spark, "test-stream-archive")
    n = cf.write_crawl_files(cf.crawl_envelope(fetched_pages(spark, sf)), f"{root}/in")
    q = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=10,
                     clean_source="archive", archive_dir=f"{root}/archive")
    q.awaitTermination(600)
    assert q.exception() is None
    archived = sum(len([f for f in fs if f.startswith("raw_")]) for _, _, fs in os.walk(f"{root}/archive".replace("file:", "")))
    left = len([f for f in os.listdir(f"{root}/in".replace("file:", "")) if f.startswith("raw_")])
    assert archived > 0 and archived + left == n
    assert read_streamed_index(spark, f"{root}/out").docs.count() == n


def test_same_url_twice_in_one_batch(spark, sf):
    root = scratch_path(spark, "test-stream-twice")
    env = cf.crawl_envelope(fetched_pages(spark, sf)).limit(4)
    late = (env.limit(1).withColumn("page_data", F.struct(
        *[F.lit("<title>Late</title>word word").alias(f) if f == "content"
          else (F.col("page_data.fetch_time") + F.expr("INTERVAL 1 DAY")).alias(f) if f == "fetch_time"
          else F.col(f"page_data.{f}") for f in cf.PAGE_DATA.fieldNames()]))
        .withColumn("file_path", F.lit("a_first_in_name_order")))
    cf.write_crawl_output(env.unionByName(late), f"{root}/in")
    finish(stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", pattern="part-*", multiline=False))
    idx = read_streamed_index(spark, f"{root}/out")
    assert idx.docs.count() == 4 and idx.docs.where("title = 'Late'").count() == 1
    assert idx.postings.where(F.size(F.array_distinct("positions")) != F.col("frequency")).count() == 0
    assert {r.term for r in idx.postings.join(idx.docs.where("title = 'Late'"), "doc_id").collect()} == {"l", "word"}  # stems


def test_an_unfinished_stream_is_an_error(spark, sf):
    import pytest

    root = scratch_path(spark, "test-stream-timeout")
    cf.write_crawl_output(cf.crawl_envelope(fetched_pages(spark, sf)).repartition(30), f"{root}/in")
    q = stream_index(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1, pattern="part-*",
                     multiline=False)
    with pytest.raises(TimeoutError):
        finish(q, 1)
    assert not q.isActive
