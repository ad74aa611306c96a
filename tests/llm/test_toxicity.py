"""Toxicity: the composed grammar against a plain reading, and held-out accuracy."""

import random

import numpy as np

from trawl.llm import toxicity as tx


def plain(symbols):
    """The clause rules read one after the other."""
    marked, reach, said, quote, aimed = [], 0, False, False, False
    for s, w in symbols:
        negated = reach > 0
        reach = tx.NEGATION_REACH if s == "N" else reach if s == "Q" else max(0, reach - 1)
        if s == "R":
            said = True
        elif s == "Q":
            quote = not quote
        elif s == "Y":
            aimed = True
        elif s in "IH":
            marked.append((s, w, negated, said or quote))
    out = {}
    for s, w, negated, reported in marked:
        if s == "H" and (negated or reported):
            continue
        name = "insult_reported" if reported else "insult_negated" if negated else "insult" if s == "I" else "threat"
        if aimed and name in ("insult", "threat"):
            name += "_targeted"
        out[name] = out.get(name, 0) + w
    return out


def test_composition_equals_plain_reading():
    rng = random.Random(1)
    for _ in range(4000):
        clause = [(rng.choice(tx.SYMBOLS), rng.choice([1.0, 2.0])) for _ in range(rng.randint(0, 12))]
        assert tx.read_clause(clause) == plain(clause)


def test_matched_clauses_not_words():
    model = tx.Model({"idiot": 2.0, "lowei*": 1.0}, tx.PRIOR)
    read = lambda t: dict(zip(tx.OUTCOMES, tx.Reader(model).features(t)[1:]))
    assert read("You are an IDIOT.")["insult_targeted"] == 2
    assert read("what an idiot! ok")["insult"] == 2
    assert read("He is not an idiot.")["insult_negated"] == 2
    assert read("You aren't an idiot, it isn’t so.")["insult_negated"] == 2
    assert read("you're an idiot")["insult_targeted"] == 2
    assert read("quel temps, l'idiot")["insult"] == 2
    assert read('Fine. Someone said idiot.')["insult_reported"] == 2
    assert read('the word "idiot" here')["insult_reported"] == 2
    assert read("ein loweiung, und loweien")["insult"] == 2
    assert read("xlowei idiots subidiot")["insult"] == 0
    assert read("I will kill you")["threat_targeted"] == tx.SEED_WEIGHT
    assert read("kill the process")["threat"] == tx.SEED_WEIGHT
    assert not any(read("").values())


def test_edge_rows(spark):
    model = tx.Model({"idiot": 2.0}, tx.PRIOR)
    rows = [(1, None, "a"), (2, "", "b"), (None, "You idiot", "c"), (4, "You idiot", "d"), (4, "You idiot", "d"),
            (5, "calm words. " * 40000 + "You idiot!", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = sorted((r["doc_id"] or 0, r["predicted"]) for r in tx.scored(docs, model).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (4, 1), (4, 1), (5, 1)]
    kept = tx.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert tx.scored(docs.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert (tx.fit(docs, none).weights == tx.PRIOR).all()


def test_held_out_accuracy(spark):
    from trawl.llm.queries import op2_toxicity

    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op2_toxicity(spark, sf).where("held_out").collect() if r["doc_id"] in labels]
    y = np.array([labels[r["doc_id"]] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    s = np.array([r["score"] for r in rows])
    assert (s >= 0).all() and (s <= 1).all()
    assert (y & p).sum() / p.sum() >= 0.95 and (y & p).sum() / y.sum() >= 0.85
    order = s.argsort(kind="stable").argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc >= 0.95
