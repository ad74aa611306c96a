"""SimHash groups equal brute force over every pair."""

import random

import duckdb
import numpy as np
import xxhash

from trawl.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice("Aab Zé\t\n İ") for _ in range(rng.randint(0, 60)))
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_allocation_is_optimal_and_complete():
    rng = random.Random(5)
    for m in (2, 3, 4):
        costs = [[0.0] + [rng.random() * 10 ** t for t in range(5 - m)] for _ in range(m)]
        cost, ts = simhash.allocate(costs, 4 - m)
        from itertools import product
        assert sum(ts) == 4 - m
        assert abs(cost - min(sum(c[t + 1] for c, t in zip(costs, x)) for x in product(range(-1, 5 - m), repeat=m)
                              if sum(x) == 4 - m)) < 1e-9


def test_links_equal_brute_force_for_every_layout(spark, monkeypatch):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:30]:
        x = b
        for _ in range(12):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            fps.add(x)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    want = brute_components(fps)
    for parts in ((2,), (3,), (4,)):
        monkeypatch.setattr(simhash, "PARTS", parts)
        monkeypatch.setattr(simhash, "CHUNK", 500)
        assert len(simhash.plan(nodes, 3)) >= 1
        edges = simhash.blocked(simhash.probes(nodes, simhash.plan(nodes, 3)), 300)
        order = ["k", "v", "a", "b"]
        from functools import partial
        from pyspark.sql import functions as F
        got = (edges.repartition(*order).sortWithinPartitions(*order, F.desc("own"), "fp")
               .mapInArrow(partial(simhash._forest, distance=3), "u long, v long"))
        roots = {r["node"]: r["root"] for r in simhash.components(got).collect()}
        groups = {}
        for x, w in zip(fps, want):
            groups.setdefault(w, set()).add(roots.get(signed(x), signed(x)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_groups_edge_rows(spark):
    same = "one two three four five six seven eight"
    rows = [(5, None, 1), (9, "", 1), (None, " \n", 1), (7, same, 1), (8, same, 1), (8, same, 1), (None, "lonely words", 1),
            (3, "Ab", 1), (4, "long " * 30000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.groups(docs).collect()}
    assert got == {(5, 5), (9, 5), (None, 5), (7, 7), (8, 7), (None, None), (3, 3), (4, 4)}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 4, 5, 7]
    assert simhash.groups(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    from trawl.llm.queries import op4_simhash_groups

    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    want = {d: (f"{f:016x}", rows[c][0]) for (d, _), f, c in zip(rows, fps, comp)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op4_simhash_groups(spark, sf).collect()}
    assert got == want
