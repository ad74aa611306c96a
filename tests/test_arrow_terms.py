"""The stored build analyses words in Arrow tasks, and merges rows only where a document is repeated."""

import os
import random
import subprocess
import sys
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import functions as F

from trawl.functions.text import STOP_WORDS, analyze
from trawl.functions.words import packed_rows
from trawl.operators.index import bucket_postings, document_postings, postings_table, term_bucket
from trawl.session import scratch_path
from trawl.sources import index_store
from trawl.sources.index_store import _dealt_by_bucket, build_and_write_index, read_index

SCHEMA = "doc_id long, url string, title string, clean_text string"
COLUMNS = ("term", "doc_id", "frequency", "first_pos", "positions", "in_title")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def _texts():
    r = random.Random(3)
    points = [chr(c) for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 500):
        yield " ".join(f"a{c}b {c}s x{c} {c}" for c in points[i:i + 500])
    ends = ["sses", "ies", "ss", "s", "eed", "ed", "ing", "ization", "ational", "fulness", "ousness", "iveness", "ize", "ate", "al", ""]
    for _ in range(100):
        yield " ".join(r.choice(["", "(", "É", "ab", "İ", "ΟΣ", *STOP_WORDS[:9]]) + r.choice(ends) + r.choice(ends) + r.choice(["", ".", "'"])
                       for _ in range(60))
    yield from ("a\x1fb c\x1cd  e", "", None, "  ", "the of .")


def test_words_of_arrow_tasks_are_those_of_the_column_functions(spark):
    rows = [(i, "u", ["S ab", None, ""][i % 3], t) for i, t in enumerate(_texts())]
    corpus = spark.createDataFrame(rows, SCHEMA).repartition(4)
    line = F.concat("term", F.lit(" "), "positions", F.when(F.col("in_title"), "+").when(F.col("in_title").isNull(), "?").otherwise(""))
    plain = document_postings(corpus).select("doc_id", term_bucket(F.col("term"), 7).alias("term_bucket"), line.alias("line"))
    packed = bucket_postings(corpus, 7)
    assert "MapInArrow" in packed._jdf.queryExecution().executedPlan().toString()
    lines = packed.select("doc_id", "term_bucket", F.explode(F.split("packed", "\n")).alias("line"))
    assert sorted(map(str, lines.collect())) == sorted(map(str, plain.collect()))


def test_bytes_that_are_no_text(spark):
    corpus = spark.range(2).select(F.col("id").alias("doc_id"), F.lit("u").alias("url"), F.expr(
        "cast(X'41FF' as string)").alias("title"), F.expr("cast(X'4142FF20C328' as string)").alias("clean_text"))
    got = bucket_postings(corpus, 1).select(F.explode(F.split("packed", "\n")).alias("line")).select(F.split("line", " ")[0].alias("t"))
    want = corpus.select(F.explode(analyze(F.col("clean_text"))).alias("t"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_rows_are_merged_only_where_a_document_is_repeated(spark, monkeypatch):
    once = [(1, "u", "cat", "cats dogs cats"), (2, "u", None, "dogs x"), (None, "u", "t", "dog")]
    asked, real = [], index_store.postings_table

    def seen(texts, deal, unique):
        asked.append((unique, real(texts, deal, unique)._jdf.queryExecution().executedPlan().toString().count("Window")))
        return real(texts, deal, unique)

    monkeypatch.setattr(index_store, "postings_table", seen)
    for rows in (once, [*once, (1, "v", "dog", "dogs cats")], [*once, (None, "v", "dog", "dogs")]):
        corpus, path = spark.createDataFrame(rows, SCHEMA), scratch_path(spark, "merged")
        build_and_write_index(corpus, path)
        assert _rows(read_index(spark, path).postings) == _rows(postings_table(corpus))
    assert asked[0] == (True, 0) and [u for u, _ in asked] == [True, False, False] and asked[1][1] > 0
    corpus = spark.createDataFrame(once, SCHEMA)
    assert _rows(postings_table(corpus, _dealt_by_bucket(3, 2), unique=True)) == _rows(postings_table(corpus))


def test_a_long_text_of_one_word(spark):
    """Positions are appended, not copied per token: the time stays in proportion to the text."""
    corpus = spark.range(1).select(F.col("id").alias("doc_id"), F.lit("u").alias("url"), F.lit("t").alias("title"),
                                   F.repeat(F.lit("word x"), 150_000).alias("clean_text"))
    (row,) = postings_table(corpus, _dealt_by_bucket(1, 1)).where("term = 'word'").select("frequency", "first_pos").collect()
    assert tuple(row) == (1, 0)
    (row,) = postings_table(corpus, _dealt_by_bucket(1, 1)).where("term = 'xword'").select("frequency", F.col("positions")[70_000]).collect()
    assert tuple(row) == (149_999, 70_001)


def test_workers_need_no_package(tmp_path):
    """An index is built where only the driver can import this package, as before."""
    code = "import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); assert list(f(iter([]))) == [] and 'trawl' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(partial(packed_rows, buckets=3)), cwd=tmp_path,
                         env=env, capture_output=True, timeout=120)
    assert run.returncode == 0, run.stderr
