"""Decontamination against a plain search over every alignment."""

import itertools
import random
import re

from trawl.llm import decontamination as dc


def tok(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def stretch(a, b, need):
    """Every stretch that is the best one to its end: (score, length, same, start)."""
    best = (-1, 0, 0, 0)
    for end in range(min(len(a), len(b))):
        score, same, top = 0, 0, (-99, 0, 0, 0)
        for i in range(end, -1, -1):
            score += 1 if a[i] == b[i] else -dc.MISS
            same += a[i] == b[i]
            if score >= top[0]:
                top = (score, end - i + 1, same, i)
        if top[1] >= need and top[0] >= 0 and top[:2] > best[:2]:
            best = top
    return best


def seeded(d, w, shift):
    masks = dc.MASKS if len(w) >= dc.SPAN else [tuple(range(len(w)))]
    for m in masks:
        for j in range(len(w) - m[-1]):
            i = j + shift
            if i >= 0 and i + m[-1] < len(d) and all(d[i + o] == w[j + o] for o in m):
                return True
    return False


def brute(docs, items):
    out = {}
    for (did, t), (iid, u) in itertools.product(docs, items):
        d, w = tok(t), tok(u)
        if len(w) < dc.SHORTEST:
            continue
        for shift in range(-len(w) + 1, len(d)):
            if seeded(d, w, shift):
                b = max(0, -shift)
                _, n, same, since = stretch(d[shift + b:], w[b:], min(dc.OVERLAP, len(w)))
                if n:
                    key = (same, -n, -(shift + b + since))
                    out[did, iid] = max(out.get((did, iid), key), key)
    return {k: (s, -n, -f) for k, (s, n, f) in out.items()}


def data():
    rng = random.Random(3)
    words = [a + b for a in "ab cd ef gh ij".split() for b in "x y z é w".split()]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(say(n))) for k, n in enumerate([30, 30, 25, 14, 13, 11, 10, 8, 6, 5, 4, 1, 0])]
    docs = []
    for k in range(80):
        w = say(rng.randint(0, 40))
        it = tok(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(it) - 13)) if rng.random() < 0.4 else 0
        it = it[a:]
        it = [x if rng.random() > rng.choice([0, 0.1, 0.25]) else "swap" for x in it]
        p = rng.randint(0, len(w))
        docs.append((k, ", ".join(w[:p] + it + w[p:]).upper()))
    return docs, items


def test_two_replaced_of_thirteen_are_always_hit():
    for bad in itertools.combinations(range(13), 2):
        assert any(not set(o + p for p in m) & set(bad) for m in dc.MASKS for o in range(13 - m[-1]))


def test_overlaps_equal_brute_force(spark):
    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for limit in (500_000, 100):
        got = {(r["doc_id"], r["item_id"]): (r["matched"], r["aligned"], r["doc_start"])
               for r in dc.overlaps(d, b, seed_limit=limit).collect()}
        assert got == want
    assert len(want) > 20


def test_every_fifth_word_replaced_is_found(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    d = spark.createDataFrame([(p, " ".join("swap" if k % p == p - 1 else w for k, w in enumerate(words))) for p in (4, 5, 6)],
                              "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert {r["doc_id"] for r in dc.overlaps(d, b).collect()} == {5, 6}


def test_document_that_starts_inside_an_item_with_a_repeated_phrase(spark):
    say = lambda c, n: [f"{c}{k}" for k in range(n)]
    phrase, a, y, z = say("p", 8), say("a", 5), say("y", 6), say("z", 10)
    items = [(1, " ".join(a + phrase + y + phrase + z)), (2, " ".join(phrase + phrase + phrase + z))]
    docs = [(1, phrase + z), (2, phrase + y + phrase + z), (3, a + phrase + y), (4, phrase + phrase + z), (5, a + phrase + y + phrase + z)]
    docs = [(i, " ".join([*w, "end"])) for i, w in docs]
    got = {(r["doc_id"], r["item_id"]): (r["matched"], r["aligned"], r["doc_start"]) for r in dc.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)
    assert {(1, 1), (2, 1), (3, 1), (5, 1), (1, 2), (4, 2)} <= set(got)


def test_edge_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, None, 0), (2, "", 0), (None, "x " + text, 0), (3, text, 0), (3, text, 0), (4, "clean words only", 0),
            (5, "pad " * 60000 + text, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(1, text), (2, text), (None, None), (4, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.overlaps(d, b).collect()}
    assert got == {(i, k) for i in (None, 3, 5) for k in (1, 2)}
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert dc.overlaps(d.limit(0), b).count() == 0
    assert dc.drop_contaminated(d, b.limit(0)).count() == len(rows)


def test_query_finds_whole_passages(spark, sf):
    from trawl.llm.queries import op3_decontamination

    docs = [(r["doc_id"], " ".join(tok(r["text"]))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], " ".join(tok(r["text"]))) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, u in items if f" {u} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]) for r in op3_decontamination(spark, sf).collect()}
    assert want and want <= got
    long = {(d, i) for d, t in docs for i, u in items if any(
        f" {' '.join(x)} " in f" {t} " for x in zip(*(u.split()[k:] for k in range(8))))}
    assert got <= long


def test_sql_equals_the_operator(spark):
    import duckdb
    import pandas as pd

    from trawl.llm.queries import ORACLE_SQL

    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = sorted(r[:5] for r in con.execute(ORACLE_SQL["op3_decontamination"]).fetchall())
    got = dc.overlaps(d, b).select("doc_id", "item_id", "matched", "aligned", "doc_start").collect()
    assert sorted(map(tuple, got)) == want
