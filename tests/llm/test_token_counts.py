"""Token counts equal the library's own, for every kind of text."""

import random

import numpy as np

from trawl.llm import token_counts as tc
from trawl.llm.tokenizers_io import load_tokenizer, public_path

PATH = public_path("word_bpe_49k.json")


def want(text):
    return len(load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids)


def test_pretokens_cover_unusual_text():
    rng = random.Random(1)
    pool = "aZ0'sßÉéñŁ_-.,<|>  \t\n —İΣ՘中文あ🙂́ﬁ"
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.3:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>x", " I'LL don'T "])
        assert sum(tc.n_pieces(p, PATH) for p in tc.pretokens(text, PATH)) == want(text), text


def test_packed_numbers_round_trip():
    for a in ([], [0], [1, 70000, 2**32 - 1], range(1000)):
        a = np.array(a, dtype="<u4")
        assert (tc.unpacked(tc.packed(a), len(a)) == a).all()


def test_count_edge_rows(spark):
    rows = [(1, None, "w"), (2, "", "w"), (None, "Hello, world's", "w"), (4, "the cat " * 5000, "w"),
            (5, "the cat", "w"), (5, "the cat", "w"), (6, "<|endoftext|> A <|startoftext|>", "w"), (7, "Σίγμας 中文", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in tc.count_tokens(docs, PATH, 64).collect()))
    assert got == sorted((i or 0, len((t or "").encode()), want(t)) for i, t, _ in rows)
    assert tc.count_tokens(docs.limit(0), PATH).count() == 0


def test_query_matches_library(spark, sf):
    from trawl.llm.queries import op1_token_counts

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op1_token_counts(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        assert r["n_tokens"] == want(docs[r["doc_id"]])
        assert r["over_limit"] == (r["n_tokens"] > 2048)
