"""Randomised cross-check: Spark analysis vs the DuckDB SQL of the oracle (separate code)."""

import random

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawl.functions.text import analyze
from trawl.plans.oracle import _with, tokens_cte

SUFFIXES = ["sses", "ies", "ss", "s", "eed", "ed", "ing", "ization", "ational", "fulness", "ousness",
            "iveness", "ize", "ate", "al", "", "é", "'", "(", ")", ".", ","]
STEMS = ["", "a", "ab", "org", "nation", "hope", "run", "the", "it", "ta", "éé", "IZ", "Al"]
PUNCT = ["", "(", '"', "'", "[", "..."]


def _word(r: random.Random) -> str:
    return r.choice(PUNCT) + r.choice(STEMS) + r.choice(SUFFIXES) + r.choice(SUFFIXES) + r.choice(PUNCT)


def _compare(spark, texts):
    rows = list(enumerate(texts))
    got = {r.doc_id: r.t for r in spark.createDataFrame(rows, "doc_id long, clean_text string")
           .select("doc_id", analyze(F.col("clean_text")).alias("t")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE corpus (doc_id BIGINT, clean_text VARCHAR)")
    con.executemany("INSERT INTO corpus VALUES (?, ?)", rows)
    want = {d: [] for d, _ in rows}
    for d, term in con.execute(_with(tokens_cte()) + "SELECT doc_id, term FROM tokens ORDER BY doc_id, pos").fetchall():
        want[d].append(term)
    assert got == want


def test_random_words_match_sql(spark):
    r = random.Random(7)
    texts = [" ".join(_word(r) for _ in range(r.randint(0, 40))) for _ in range(300)]
    _compare(spark, texts)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aeinlstdgzoufv'(.é \t ÉSİ", max_size=30), min_size=1, max_size=20))
def test_hypothesis_texts_match_sql(spark, texts):
    _compare(spark, texts)
