"""Secret scans equal a plain Python scan."""

import hashlib
import math
import random
import re
import time

from pyspark.sql import functions as F

from trawl.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def brute_entropy(t, base):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
        w = m[0]
        if any(re.search(p, w) for p in secrets.ALLOW):
            continue
        hits = []
        for i in range(len(w) - 19):
            x = w[i:i + 20]
            h = -sum(x.count(c) / 20 * math.log2(x.count(c) / 20) for c in set(x))
            if re.fullmatch("[0-9a-f]+", x):
                limit = 3.0
            elif x.upper() == x or x.lower() == x:
                limit = 3.6
            else:
                limit = 3.8
            if sum(c.isdigit() for c in x) >= 2 and h >= limit - 1e-9:
                hits.append(i)
        if hits:
            first, last = hits[0], hits[-1] + 20
            part = w[max(w.rfind("/", 0, first), w.rfind("=", 0, first)) + 1:first] + w[first:last] + re.split("[/=]", w[last:])[0]
            if re.search(secrets.ALLOW_WORDS, part):
                continue
            s, e = m.start() + first, m.start() + last
            if not any(a <= s and e <= b for a, _, b in base):
                out.append((s, 3, e))
    return out


def texts():
    rng = random.Random(11)
    word = lambda pool, n: "".join(rng.choice(pool) for _ in range(n))
    makers = [lambda: rng.choice(["Password", "api_key", "APIKEY", "secret", "toKen", "passwd"])
              + rng.choice(["=", ": ", '" : "', "'='", " ", "=="]) + word("aZ09+/_.=-", rng.randint(5, 30)),
              lambda: "AKIA" + word("AKI09", rng.randint(3, 25)), lambda: word("0123456789abcdef", rng.randint(10, 50)),
              lambda: word(secrets.ALPHABET, rng.randint(15, 60)), lambda: word("é🙂ß \n", 5), lambda: "word " * 3,
              lambda: "secret=token=" + word("ab", 14), lambda: word("ab1", 40), lambda: "home/user/2024/some-long-path-name",
              lambda: "3f2504e0-4f89-11d3-9a0c-0305e82c3301", lambda: word("abcdefgh0123456789", 45),
              lambda: rng.choice(["example", "/sample/", "EXAMPLE_APP_KEY="]) + word(secrets.ALPHABET[:62], 30)]
    out = [rng.choice(["", " ", "\n"]).join(rng.choice(makers)() for _ in range(rng.randint(0, 8))) for _ in range(300)]
    return [None, "", *out, "x " * 50000 + "token = abcdefghijkl"]


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secret_base string")
    got = {r["doc_id"]: r for r in secrets.scan(docs).withColumn(
        "said", secrets.span_text(F.col("secret_spans"))).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        base = brute_base(t or "")
        assert [tuple(s) for s in got[i]["secret_base"]] == base, t
        every = sorted(base + brute_entropy(t or "", base))
        assert [tuple(s) for s in got[i]["secret_spans"]] == every, t
        assert got[i]["said"] == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in every)
    assert secrets.scan(docs.limit(0)).count() == 0


def test_masking(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = secrets.mask_secrets(docs)
    assert out.columns == docs.columns
    for i, t in ((r["doc_id"], r["text"]) for r in out.collect()):
        src = rows[i][1]
        if src is None:
            assert t is None
            continue
        base = brute_base(src)
        want, pos = "", 0
        for s, _, e in sorted(base + brute_entropy(src, base)):
            if s >= pos:
                want += src[pos:s] + "[SECRET]"
            pos = max(pos, e)
        assert t == want + src[pos:]


def test_query_equals_brute_force(spark, sf):
    from trawl.llm.queries import op9_secret_scan

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op9_secret_scan(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        base = brute_base(docs[r["doc_id"]])
        said = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in base) for x in range(3)]


def test_long_texts_stay_linear(spark):
    rng = random.Random(5)
    word = lambda pool, n: "".join(rng.choices(pool, k=n))
    texts = ["ab-" * 333_000 + "9", word(secrets.ALPHABET[:64], 1_000_000),
             "\n".join(word("0123456789abcdef", 32) for _ in range(20_000))]
    began = time.time()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    found = {r["doc_id"]: r["secret_spans"] for r in secrets.scan(docs).collect()}
    assert time.time() - began < 90
    assert not found[0] and found[1]
    assert [tuple(x) for x in found[2]] == brute_base(texts[2])


def test_many_spans_masked(spark):
    rng = random.Random(6)
    text = "é ".join("".join(rng.choices(secrets.ALPHABET[:62], k=24)) for _ in range(3000))
    (kept,) = secrets.mask_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    base = brute_base(text)
    spans = sorted(base + brute_entropy(text, base))
    want, pos = "", 0
    for s, _, e in spans:
        if s >= pos:
            want += text[pos:s] + "[SECRET]"
        pos = max(pos, e)
    assert len(spans) > 1000 and kept["text"] == want + text[pos:]
