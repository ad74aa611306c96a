"""The pipeline against plain versions of its stages."""

import re

import numpy as np
from test_decontamination import seeded, stretch, tok
from test_secrets import brute_base, brute_entropy
from test_simhash import brute_components, brute_fingerprint

from corpus_pipeline import STAGES, run
from trawl.llm import decontamination as dc
from trawl.llm import toxicity as tx
from trawl.llm.common import table
from trawl.llm.tokenizers_io import load_tokenizer, public_path


def contaminated(text, items):
    d, grams = tok(text), set()
    for k in range(len(d) - 3):
        grams.add(tuple(d[k:k + 2]))
    for w in items:
        if len(w) < dc.SHORTEST or not any(tuple(w[k:k + 2]) in grams for k in range(len(w) - 1)):
            continue
        shifts = {i - j for j in range(len(w)) for i in range(len(d)) if d[i] == w[j]}
        for s in shifts:
            b = max(0, -s)
            if sum(x == y for x, y in zip(d[s + b:s + len(w)], w[b:])) < 5:
                continue
            _, n, _, _ = stretch(d[s + b:s + len(w)], w[b:], min(dc.OVERLAP, len(w)))
            if n and seeded(d, w, s):
                return True
    return False


def masked(text):
    base = brute_base(text)
    out, pos = "", 0
    for s, _, e in sorted(base + brute_entropy(text, base)):
        if s >= pos:
            out += text[pos:s] + "[SECRET]"
        pos = max(pos, e)
    return out + text[pos:]


def test_pipeline_equals_plain_stages(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").orderBy("doc_id").collect()]
    model = tx.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    reader = tx.Reader(model)
    kept = [(i, t) for i, t in docs if reader.score(t or "") < tx.THRESHOLD]
    comp = brute_components([brute_fingerprint(t or "") for _, t in kept])
    kept = [x for k, x in enumerate(kept) if comp[k] == k]
    items = [tok(r["text"]) for r in table(spark, sf, "benchmark").collect()]
    kept = [(i, masked(t or "")) for i, t in kept if not contaminated(t or "", items)]
    tokenizer = load_tokenizer(public_path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}
    got = run(spark, sf).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want
    assert sum(r["length"] for r in got) == sum(want.values())


def test_stages_keep_columns_and_survive_odd_rows(spark, sf):
    rows = [(1, None, "en", "s", 0, 1), (1, None, "en", "s", 0, 1), (None, "", "en", None, 0, 2), (None, "some words here", None, "s", 3, 3),
            (3, "word " * 50000, "en", "s", 5, 4), (4, "password = abcdefghij123456", "en", "s", 5, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep_key int")
    clashes = {"secret_base": "lang", "Secret_spans": "lang", "bad_id": "lang", "keep_hash": "n_chars", "tokens": "lang", "fp": "lang"}
    docs = docs.withColumns({k: docs[v] for k, v in clashes.items()})
    for frame in (docs, docs.limit(0)):
        now = frame
        for _, stage in STAGES[:-1]:
            now = stage(spark, now, sf)
            assert now.columns == docs.columns
        out = STAGES[-1][1](spark, now, sf).collect()
        assert all(np.uint64(r["ids_crc32"]) >= 0 for r in out)
        if frame is docs:
            texts = [r["text"] for r in now.collect()]
            assert "password = abcdefghij123456" not in texts and any(re.search("SECRET", t or "") for t in texts)
        else:
            assert not out
