"""Toxicity by a weighted finite-state grammar over clauses.

Words are read by a lexicon automaton (one pass over the text's letters) that gives insults and threats
their weights. A clause that holds one is read, symbol by symbol, by the composition of four transducers:

* negation: an insult or threat within three words after a negation is marked as negated;
* reported speech: one inside quotes or after a reporting verb is marked as reported;
* target: a word that addresses or names people is noted for the clause;
* insult and threat: finish the clause with an outcome - plain, targeted, negated or reported insult,
  targeted or untargeted threat - whose weight is the lexicon weight.

A document's features are its summed outcomes; a logistic model turns them into a score, so isolated
words count only through the clauses they stand in. The insult lexicon (words and word stems) and the
outcome weights are learnt from a bounded sample of labelled rows; the rest of the grammar is fixed.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored, text_or_empty

SAMPLE_ROWS = 12_000     # labelled rows fitted on, at most
CANDIDATES = 4_000       # lexicon candidates with the most toxic documents
STEM = (4, 8)            # lengths of the word beginnings tried as stems
LEAST_DOCS = 5           # toxic documents that hold a candidate, at least
RATIO = 4.0              # how many times more frequent a candidate is in toxic documents, at least
ENTRIES = 200            # steps of the lexicon model, at most
MOST = 3                 # occurrences of one entry that count in a document while learning
HELD_OUT = 1             # crc32(doc_id) mod 3 of rows never learnt from
THRESHOLD = 0.7

# Fixed values of the grammar (English, German, French, Spanish).
INSULTS = ("idiot", "idiots", "stupid", "moron", "morons", "imbecile", "scumbag", "worthless")
THREATS = ("kill", "murder", "strangle", "stab", "töten", "umbringen", "tuer", "égorger", "matar", "matarte")
TARGETS = ("you", "your", "youre", "he", "she", "they", "him", "them", "du", "dich", "dir", "ihr", "euch", "tu", "toi",
           "vous", "ils", "usted", "ustedes", "ellos", "te")
NEGATIONS = ("not", "never", "isnt", "arent", "wasnt", "werent", "dont", "doesnt", "didnt", "cant", "wont", "aint",
             "nobody", "nicht", "kein", "keine", "nie", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "claimed", "quoted", "called", "sagte", "schrieb", "nannte", "disait", "dijo",
           "escribió")
NEGATION_REACH = 3

OUTCOMES = ("insult", "insult_targeted", "insult_negated", "insult_reported", "threat", "threat_targeted")
# Weights before any label is seen: a bias, the logarithm of the length, then one per outcome.
PRIOR = np.array([-3.0, 0.0, 4.0, 4.5, 1.0, 1.0, 1.5, 4.0])
SEED_WEIGHT = 2.0  # of the fixed insults and threats


# ---------------------------------------------------------------- transducers

@dataclass
class Transducer:
    """Deterministic transducer: arcs[state][symbol] = (next state, output); "*" is any other symbol."""

    start: object
    arcs: dict = field(default_factory=dict)
    final: dict = field(default_factory=dict)  # state -> what the clause ends with

    def step(self, state, symbol):
        row = self.arcs[state]
        if symbol in row:
            return row[symbol]
        nxt, out = row["*"]
        return nxt, (symbol if out is None else out)


def compose(a: Transducer, b: Transducer, alphabet) -> Transducer:
    """The transducer that feeds ``a``'s output to ``b``, over the states reachable with ``alphabet``."""
    out = Transducer((a.start, b.start))
    todo = [out.start]
    while todo:
        s = todo.pop()
        if s in out.arcs:
            continue
        out.arcs[s] = {}
        for symbol in alphabet:
            na, mid = a.step(s[0], symbol)
            nb, end = b.step(s[1], mid)
            out.arcs[s][symbol] = ((na, nb), end)
            todo.append((na, nb))
        out.final[s] = (a.final.get(s[0]), b.final.get(s[1]))
    return out


# Symbols: I insult, H threat, Y target, N negation, R reporting verb, Q quote, x other word.
SYMBOLS = ("I", "H", "Y", "N", "R", "Q", "x")


def negation() -> Transducer:
    t = Transducer(0)
    for k in range(NEGATION_REACH + 1):
        after = max(0, k - 1)
        t.arcs[k] = {"N": (NEGATION_REACH, "N"), "Q": (k, "Q"), "*": (after, None)}
        if k:
            t.arcs[k] |= {"I": (after, "I-"), "H": (after, "H-")}
    return t


def reported() -> Transducer:
    """States: (a reporting verb was read, a quote is open)."""
    t = Transducer((False, False))
    for said in (False, True):
        for quote in (False, True):
            row = {"R": ((True, quote), "x"), "Q": ((said, not quote), "x"), "*": ((said, quote), None)}
            if said or quote:
                row |= {s: ((said, quote), s[0] + "r") for s in ("I", "I-", "H", "H-")}
            t.arcs[(said, quote)] = row
    return t


def target() -> Transducer:
    t = Transducer(False, final={False: "", True: "targeted"})
    t.arcs = {False: {"Y": (True, "x"), "*": (False, None)}, True: {"Y": (True, "x"), "*": (True, None)}}
    return t


def outcome() -> Transducer:
    t = Transducer(0)
    t.arcs = {0: {"I": (0, "insult"), "H": (0, "threat"), "I-": (0, "insult_negated"), "Ir": (0, "insult_reported"),
                  "H-": (0, ""), "Hr": (0, ""), "*": (0, "")}}
    return t


@lru_cache(maxsize=1)
def clause_grammar() -> Transducer:
    first = compose(negation(), reported(), SYMBOLS)
    return compose(compose(first, target(), SYMBOLS), outcome(), SYMBOLS)


def read_clause(symbols: list[tuple[str, float]]) -> dict[str, float]:
    """Summed weights of the clause's outcomes."""
    g = clause_grammar()
    state, got = g.start, []
    for s, w in symbols:
        state, out = g.step(state, s)
        if out:
            got.append((out, w))
    (_, aimed), _ = g.final[state]
    total: dict[str, float] = {}
    for out, w in got:
        name = f"{out}_targeted" if aimed and out in ("insult", "threat") else out
        total[name] = total.get(name, 0.0) + w
    return total


# ---------------------------------------------------------------- reading texts

@dataclass
class Model:
    """Lexicon entry -> weight (a trailing "*" marks a stem), and the logistic weights."""

    insults: dict[str, float]
    weights: np.ndarray

    def lexicon(self) -> dict[str, tuple[str, float]]:
        return {w: ("H", SEED_WEIGHT) for w in THREATS} | {w: ("I", x) for w, x in self.insults.items()}


# English contractions count as one word without the apostrophe ("aren't", "you're"); an elided article does not.
_CONTRACTED = re.compile(r"(?<=n)['’](?=t\b)|(?<=[^\W\d_])['’](?=(?:re|ve|ll)\b)")
_WORD = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_EDGE = re.compile(r"[.!?;\n]")
_KIND = {w: s for s, words in (("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}


class Reader:
    """The lexicon automaton and the clause grammar, built once per Python worker."""

    def __init__(self, model: Model):
        import ahocorasick

        self.lexicon, self.weights = model.lexicon(), model.weights
        self.automaton = ahocorasick.Automaton()
        for w in self.lexicon:
            key = w.rstrip("*")
            self.automaton.add_word(key, len(key))
        self.automaton.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        keys = [word, *(f"{word[:n]}*" for n in range(STEM[0], min(STEM[1], len(word)) + 1))]
        found = [self.lexicon[k] for k in keys if k in self.lexicon]
        if found:  # a word may hold several stems; their evidence adds up
            return found[0][0], sum(w for s, w in found if s == found[0][0])
        if word in '"“”«»„':
            return "Q", 0.0
        return _KIND.get(word, "x"), 0.0

    def features(self, text: str) -> np.ndarray:
        low, done = _CONTRACTED.sub("", text.lower()), -1
        total = np.zeros(1 + len(OUTCOMES))
        total[0] = len(text) / 100
        for end, n in self.automaton.iter(low):
            start = end - n + 1
            if start < done or (start and low[start - 1].isalpha()):
                continue
            a = max(done, 0, *(1 + low.rfind(c, max(done, 0), start) for c in ".!?;\n"))
            m = _EDGE.search(low, end + 1)
            done = m.end() if m else len(low)
            for name, w in read_clause([self.symbol(x) for x in _WORD.findall(low, a, done)]).items():
                total[1 + OUTCOMES.index(name)] += w
        return total

    def score(self, text: str) -> float:
        return probability(self.features(text)[None, :], self.weights)[0]


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0] + np.log2(1 + np.maximum(features, 0)) @ weights[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_readers: dict[int, Reader] = {}


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column (null as empty)."""
    key = hash((tuple(sorted(model.insults.items())), model.weights.tobytes()))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if key not in _readers:
            _readers[key] = Reader(model)
        reader = _readers[key]
        return pd.Series([float(reader.score(t)) for t in texts])

    return score(F.coalesce(text.cast("string"), F.lit("")))


# ---------------------------------------------------------------- learning

def remainder(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(n, toxic, text): at most ``rows`` labelled rows that are not held out, equal texts once.

    Only ids are sorted (by hash); the documents meet at most ``rows`` broadcast ids.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = known.where(remainder(F.col("doc_id")) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = text_or_empty(text_col)
    met = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).join(
        F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
    return met.groupBy(F.xxhash64("text").alias("n")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))


def _words(sample: DataFrame) -> DataFrame:
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    return sample.select("n", "toxic", F.explode(words).alias("word")).where(F.length("word") >= 3)


def _entries(word: str) -> Column:
    """The word itself and its beginnings, marked as stems."""
    stems = F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[1])), lambda k: F.when(
        k <= F.length(word), F.concat(F.substr(F.col(word), F.lit(1), k), F.lit("*"))))
    return F.array_compact(F.concat(F.array(F.col(word)), stems))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and stems that mark toxic documents, with their weights (log odds for each time they occur).

    Candidates are entries held by clearly more toxic documents than clean ones; the ``CANDIDATES`` of most
    evidence meet the sample's documents. Entries are then added one at a time, each the one that most improves
    a logistic model of the entries so far, as long as the gain exceeds what the best of so many candidates
    gains by chance. Words that merely accompany chosen ones (as in copied documents) gain nothing more.
    """
    totals = dict(sample.groupBy("toxic").count().collect())
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    words = _words(sample)
    by_word = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    by_entry = by_word.select(F.explode(_entries("word")).alias("entry"), "t", "n").groupBy("entry").agg(
        F.sum("t").alias("t"), F.sum("n").alias("n"))
    log_ratio = F.log(((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("n") - F.col("t") + 0.5) / (n_clean + 1)))
    good = by_entry.withColumn("r", log_ratio).where((F.col("t") >= LEAST_DOCS) & (F.col("r") >= math.log(RATIO))).orderBy(
        F.desc(F.col("t") * F.col("r")), F.desc(F.length("entry")), "entry").limit(CANDIDATES).select("entry")
    names = [r["entry"] for r in good.collect()]
    if not names:
        return {}
    number = {e: k for k, e in enumerate(names)}
    met = words.select("n", "toxic", F.explode(_entries("word")).alias("entry")).join(F.broadcast(good), "entry")
    held = met.groupBy("entry", "n", "toxic").count().collect()
    docs: dict[int, int] = {}
    rows = [(number[r["entry"]], docs.setdefault(r["n"], len(docs)), min(r["count"], MOST), r["toxic"]) for r in held]
    entry, doc, x = (np.array(c) for c in list(zip(*rows))[:3])
    y = np.zeros(len(docs))
    for _, d, _, t in rows:
        y[d] = t
    # Documents without any candidate enter only through the bias.
    logit = np.full(len(docs), math.log(n_toxic / n_clean) - 1.0)
    least, chosen = 2 * math.log(len(names)), {}
    for _ in range(ENTRIES):
        p = 1 / (1 + np.exp(-logit))
        grad = np.bincount(entry, ((y - p)[doc] * x), len(names))
        hess = np.bincount(entry, ((p * (1 - p))[doc] * x * x), len(names)) + 1.0
        gain = np.where(grad > 0, grad * grad / hess, 0.0)
        k = int(np.argmax(gain))
        if gain[k] < least:
            break
        step = min(grad[k] / hess[k], 2.0)
        chosen[names[k]] = chosen.get(names[k], 0.0) + float(step)
        mine = entry == k
        np.add.at(logit, doc[mine], step * x[mine])
    return chosen


def fit_weights(features: np.ndarray, toxic: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Logistic weights by Newton's method, drawn to the prior by ``ridge``."""
    x = np.hstack([np.ones((len(features), 1)), np.log2(1 + np.maximum(features, 0))])
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - toxic) + ridge * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w - np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """A model from at most ``rows`` labelled rows that are not held out; without labels, the fixed grammar."""
    sample = stored(labelled_sample(docs, labels, rows, id_col, text_col), "toxic-sample")
    model = Model(dict.fromkeys(INSULTS, SEED_WEIGHT) | learn_lexicon(sample), PRIOR.copy())

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        reader = Reader(model)
        return pd.Series([reader.features(t).tolist() for t in texts])

    seen = sample.select("toxic", features("text").alias("x")).collect()
    if seen:
        model.weights = fit_weights(np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen], float))
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null and empty texts have no clause and get the score of a clean text; null ids hash like the empty string
    (not held out); repeated rows are scored each; an empty table gives no rows; other columns are not read.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col)) == HELD_OUT).alias("held_out"),
                      score_column(model, F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns."""
    return docs.where(score_column(model, F.col(text_col)) < THRESHOLD)
