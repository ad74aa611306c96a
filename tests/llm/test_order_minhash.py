"""Order min-hash against a plain version, and the pairing with the next document."""

import hashlib
import random

import numpy as np

from trawl.llm import order_minhash as om


def plain_fingerprint(text):
    """Every element ranked under every seed."""
    h = om.kmer_hashes(om.code_points(text))
    if not len(h):
        return [0] * om.SIZE
    seen, elements = {}, []
    for x in (int(v) for v in h):
        occ = seen[x] = seen.get(x, -1) + 1
        elements.append(int(om._mix(np.array([x ^ (occ * int(om._M1) % 2**64)], np.uint64))[0]))
    out = []
    for k in range(om.SIZE):
        factor = int(om._FACTORS[k, 0])
        least = sorted(((e >> 32) * factor % 2**32, pos) for pos, e in enumerate(elements))[:om.TUPLE]
        acc = np.array([len(least)], np.uint64)
        for pos in sorted(p for _, p in least):
            acc = om._mix(acc * om._M1 + h[pos:pos + 1])
        out.append(int(acc[0] >> np.uint64(32)) | 1)
    return out


def test_spread_is_that_of_independent_components():
    """The likeness of a text to itself with its last tenth replaced scatters no more than SIZE independent draws."""
    rng = random.Random(8)
    for size in (100, 400, 2000):
        got = []
        for _ in range(300):
            a = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)]
            b = a[:-size // 10] + [rng.choice("ABCDEFGH") for _ in range(size // 10)]
            got.append(om.likeness(om.fingerprint(om.code_points("".join(a))), om.fingerprint(om.code_points("".join(b)))))
        mean = float(np.mean(got))
        assert 0.3 < mean < 0.9
        assert np.std(got) < 1.25 * (mean * (1 - mean) / om.SIZE) ** 0.5


def test_fingerprint_equals_plain():
    rng = random.Random(4)
    texts = ["", "a", "abcdefg", "abcdefgh", "abababababababababab" * 3, "é🙂ß" * 10]
    texts += ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    texts += ["".join(rng.choice("abcdefghijklmnop \n") for _ in range(3000)) for _ in range(3)] + ["x" * 2500]
    for t in texts:
        assert om.fingerprint(om.code_points(t)).tolist() == plain_fingerprint(t), t[:40]


def test_sensitive_to_order_and_edits():
    rng = random.Random(8)
    parts = ["".join(rng.choice("abcdefghij ") for _ in range(300)) for _ in range(10)]
    whole = "".join(parts)
    near = lambda t: om.likeness(om.fingerprint(om.code_points(whole)), om.fingerprint(om.code_points(t)))
    assert near(whole) == 1
    few = list(whole)
    for p in rng.sample(range(len(few)), 15):
        few[p] = "z"
    assert 0.6 < near("".join(few)) < 1
    moved = "".join(rng.sample(parts, 10))
    assert near(moved) < 0.8 and near("q" * 100) == 0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        own, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(own) // 4
        new = own[:len(own) - q] + nxt[:q]
        a, b, c = (np.array(om.fingerprint(om.code_points(x))) for x in (own, new, nxt))
        out.append((i, len(own), hashlib.sha256(new.encode()).hexdigest(), om.text_of(a), om.text_of(b),
                    float((a == b).mean()), float((a == c).mean())))
    return out


def test_pairs_with_the_next_document(spark):
    rng = random.Random(6)
    rows = [(i * 7 % 1000, "".join(rng.choice("ab é") for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(5000, None), (6000, ""), (None, "no id " * 9), (7000, "long text " * 9000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, range string").repartition(5)
    key = lambda r: (r[0] is None, r[0] or 0)
    for n in (1, 3, 40):
        assert sorted(map(tuple, om.fingerprints(docs, n_ranges=n).collect()), key=key) == brute(rows)
    one = docs.where("doc_id = 7000")
    assert [tuple(r) for r in om.fingerprints(one).collect()] == brute([rows[-1]])
    same = spark.createDataFrame([(1, "same text here"), (1, "same text here")], "doc_id long, text string")
    assert [r["near_next"] for r in om.fingerprints(same).collect()] == [1.0, 1.0]
    nulls = spark.createDataFrame([(None, f"text {i}") for i in range(30)], "doc_id long, text string")
    assert om.fingerprints(nulls, n_ranges=4).count() == 30
    assert om.fingerprints(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    from trawl.llm.queries import op6_order_minhash

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op6_order_minhash(spark, sf).collect())) == brute(rows)
