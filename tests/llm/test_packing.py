"""Packing: every id once, gapless sequences, little padding, the edge rows."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from trawl.llm import packing
from trawl.llm.tokenizers_io import load_ranks, load_tokenizer, public_path

JSON, RANKS = public_path("byte_bpe_50k.json"), public_path("byte_bpe_50k.tiktoken")


def test_rank_file_gives_the_json_ids_over_code_points():
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}" for c in points]
    want = [e.ids for e in load_tokenizer(JSON).encode_batch(texts, add_special_tokens=False)]
    assert want == [load_ranks(RANKS).encode_ordinary(t) for t in texts]


def test_shard_windows_cover_every_id_once():
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(1, 60, n), 0).astype("<u4") for n in [0, 5, 31, 32, 33, 200, 17, 9, 0, 64]]
    seen, sizes = defaultdict(list), []
    for pieces in packing.pack_shard(docs, 32):
        sizes.append(sum(n for _, _, n in pieces))
        for d, s, n in pieces:
            assert n > 0
            seen[d] += range(s, s + n)
    assert all(sorted(seen[d]) == list(range(len(ids))) for d, ids in enumerate(docs))
    assert sizes[:-1] == [32] * (len(sizes) - 1) and 0 < sizes[-1] <= 32


def test_scores_match_plain_bm25():
    docs = [np.array(x, dtype="<u4") for x in ([1, 2, 3, 1], [1, 4], [2, 2, 5, 6, 7], [9])]
    got = packing.ShardIndex(docs).scores(0)
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    for d, ids in enumerate(docs):
        want = 0.0
        for t in {1, 2, 3}:
            df, tf = sum(t in x for x in docs), list(ids).count(t)
            idf = np.log1p((n - df + 0.5) / (df + 0.5))
            want += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ids) / mean)) if tf else 0
        assert got[d] == pytest.approx(want, rel=1e-5)


def test_pack_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "hello world", "c"), (4, "x<|endoftext|>y " * 3, "d"),
            (5, "hello world", "e"), (5, "hello world", "f"), (7, "word " * 6000, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").coalesce(1)
    out = packing.pack(docs, JSON, RANKS).collect()
    tok = load_tokenizer(JSON)
    want = sorted(tok.encode(t or "", add_special_tokens=False).ids + [0] for _, t, _ in rows)
    by_seq = defaultdict(list)
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"]
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 1024
    whole = sorted(sum((list(np.frombuffer(bytes(r["ids"]), "<u4")) for r in sorted(out, key=lambda r: r["start"])
                        if r["doc_id"] == 7), []))
    assert whole == sorted(want[[len(w) for w in want].index(max(map(len, want)))])
    assert sum(r["length"] for r in out) == sum(map(len, want))
    assert zlib.crc32(bytes(out[0]["ids"])) >= 0
    assert packing.pack(docs.limit(0), JSON, RANKS).count() == 0
