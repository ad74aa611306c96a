"""Secret scans: fixed patterns, and sliding-window Shannon entropy with an allow list.

Everything is column expressions on the row of the document: no shuffle, no Python in tasks.

Positions come from the text between the matches (`split` by the pattern) and the matches themselves
(`regexp_extract_all` of it), summed in code points. Patterns repeat groups possessively only, as others are matched
by recursion, which a long text would exhaust.

Entropy: candidate strings are runs of at least ``WINDOW`` base64-like characters that no allow-list
pattern matches. A window of that many characters slides over a candidate with a count per character;
entering and leaving characters update the counts, the sum of c*log2(c) and the class counts, so a step
never recounts the window. The class of a window (hex, one-case, mixed) sets its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.expr import let as _let
from trawl.llm.common import fresh, text_or_empty

# The base patterns; a match failing its length is dropped after matching.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
# Runs are maximal, so a bound on the length inside the pattern drops exactly the failing matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
THRESHOLDS = {"hex": 3.0, "one_case": 3.6, "mixed": 3.8}
MIN_DIGITS = 2
ALLOW = (
    r"^[^0-9]*$",                                                                  # words, rules, identifiers
    r"^[0-9+/_=-]*$",                                                              # numbers, dates, phone numbers
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
    r"^(?:[A-Za-z]++[0-9]{0,4}[/_=-]++)++[A-Za-z]*+[0-9]{0,4}$",                   # paths and slugs
)
ALLOW_WORDS = r"(?i)example|sample|dummy|placeholder|changeme"

_SPAN = "struct<start:int,kind:int,end:int>"


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


BLOCK = 128  # elements that `prefixes` goes through at a time


def prefixes(values: Column, combine) -> Column:
    """At each place of an array of numbers, ``combine`` (associative, 0 neutral) of all up to it.

    Blocks are combined first, then gone through one by one, so no array grows by one element at a time
    over the whole length.
    """
    zero = F.lit(0).cast("long")
    steps = lambda v: F.aggregate(v, F.array(zero), lambda acc, x: F.concat(
        acc, F.array(combine(F.element_at(acc, -1), x.cast("long")))))

    def placed(v):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                             lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        return _let(blocks, lambda parts: _let(
            steps(F.transform(parts, lambda p: F.aggregate(p, zero, lambda acc, x: combine(acc, x.cast("long"))))),
            lambda before: F.flatten(F.transform(parts, lambda p, i: F.transform(
                F.slice(steps(p), 2, BLOCK), lambda x: combine(F.get(before, i), x))))))

    return _let(values, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(F.array().cast("array<long>")))


def _located(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """(start, kind, end) of the matches of ``pattern``, in order; with ``least``, of those whose second group is as long."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else found
    sizes = lambda texts: F.transform(texts, lambda x: F.char_length(x))

    def spans(between, own, said):
        ends = prefixes(F.zip_with(F.slice(between, 1, F.size(own)), own, lambda x, y: x + y), lambda x, y: x + y)
        every = F.zip_with(ends, F.zip_with(own, said, lambda x, y: F.struct(x.alias("own"), y.alias("said"))),
                           lambda e, z: F.struct((e.cast("int") - z["own"]).alias("start"), F.lit(kind).alias("kind"),
                                                 e.cast("int").alias("end"), z["said"].alias("said")))
        kept = F.filter(every, lambda x: x["said"] >= least) if least else every
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    located = _let(sizes(F.split(text, pattern, -1)), lambda between: _let(
        sizes(found), lambda own: spans(between, own, sizes(counted))))
    return F.when(text.rlike(pattern), located).otherwise(_none())


# A text as four bytes a code point: a stretch of it is cut out without walking from its beginning.
_MARK = "0000FEFF"  # byte order mark, which decoding takes off again


def wide(text: Column) -> Column:
    return F.encode(text, "UTF-32")


def cut(points: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to before ``end`` of a `wide` text."""
    return F.decode(F.concat(F.unhex(F.lit(_MARK)), F.substring(points, start * 4 + 1, (end - start) * 4)), "UTF-32")


def base_spans(text: Column) -> list[Column]:
    """Spans of the three base kinds, each an array in order of start."""
    return [_located(text, ASSIGN, 0, ASSIGN_MIN),
            F.when(F.contains(text, F.lit("AKIA")), _located(text, ACCESS, 1)).otherwise(_none()),
            _located(text, HEX, 2)]


def entropy_span(word: Column) -> Column:
    """(start, end) in ``word`` from the first to past the last window over its class's threshold, or null."""
    return _let(F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1),
                lambda symbol: _window_span(symbol, F.char_length(word)))


def _window_span(symbol: Column, length: Column) -> Column:
    # The symbols stay out of the state, which is copied at every step.
    n = len(ALPHABET)
    size = float(WINDOW)

    def weight(c):  # c * log2(c), 0 at 0
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def step(acc, i):
        code = F.get(symbol, i)
        out = F.when(i >= WINDOW, F.get(symbol, i - WINDOW)).otherwise(F.lit(-1))
        into, left = F.get(acc["counts"], code), F.coalesce(F.get(acc["counts"], out), F.lit(0))
        same = code == out
        total = F.when(same, acc["total"]).otherwise(
            acc["total"] + weight(into + 1) - weight(into)
            + F.when(out >= 0, weight(left - 1) - weight(left)).otherwise(F.lit(0.0)))
        counts = F.when(same, acc["counts"]).otherwise(F.transform(
            acc["counts"], lambda c, k: c + (k == code).cast("int") - (k == out).cast("int")))

        def among(name, lo, hi):
            inside = lambda x: ((x >= lo) & (x < hi)).cast("int")
            return (acc[name] + inside(code) - inside(out)).alias(name)

        return F.struct(counts.alias("counts"), total.alias("total"),
                        among("digit", 0, 10), among("hex", 0, 16), among("lower", 10, 36), among("upper", 36, 62),
                        acc["first"].alias("first"), acc["last"].alias("last"), i.alias("i"))

    def judge(acc):
        entropy = F.log2(F.lit(size)) - acc["total"] / size
        limit = (F.when(acc["hex"] == WINDOW, THRESHOLDS["hex"])
                 .when((acc["lower"] == 0) | (acc["upper"] == 0), THRESHOLDS["one_case"])
                 .otherwise(THRESHOLDS["mixed"]))
        hit = (acc["i"] >= WINDOW - 1) & (acc["digit"] >= MIN_DIGITS) & (entropy >= limit)
        begin, end = acc["i"] - (WINDOW - 1), acc["i"] + 1
        return F.struct(acc["counts"].alias("counts"), acc["total"].alias("total"),
                        *[acc[c].alias(c) for c in ("digit", "hex", "lower", "upper")],
                        F.when(hit & (acc["first"] < 0), begin).otherwise(acc["first"]).alias("first"),
                        F.when(hit, end).otherwise(acc["last"]).alias("last"), acc["i"].alias("i"))

    def both(acc, i):  # bind the stepped state once, then judge it
        return F.get(F.transform(F.array(step(acc, i)), judge), 0)

    zero = F.lit(0)
    init = F.struct(F.array_repeat(zero, n).alias("counts"), F.lit(0.0).alias("total"),
                    *[zero.alias(c) for c in ("digit", "hex", "lower", "upper")], F.lit(-1).alias("first"),
                    F.lit(-1).alias("last"), F.lit(-1).alias("i"))
    return F.aggregate(F.sequence(zero, length - 1), init, both,
                       lambda a: F.when(a["first"] >= 0, F.struct(a["first"].alias("start"), a["last"].alias("end"))))


def entropy_spans(text: Column, located: Column, base: Column) -> Column:
    """Entropy spans of the located candidates, without those that lie in a base span.

    The allow-listed words count only in the part of a candidate, between ``/`` and ``=``, that its windows touch.
    """
    def judged(points, c):
        def span(word, at):
            around = F.concat(F.regexp_extract(F.left(word, at["start"]), "[^/=]*$", 0),
                              F.substring(word, at["start"] + 1, at["end"] - at["start"]),
                              F.regexp_extract(F.substring(word, at["end"] + 1, F.char_length(word)), "^[^/=]*", 0))
            return F.when(~around.rlike(ALLOW_WORDS), F.struct(
                (c["start"] + at["start"]).alias("start"), F.lit(3).alias("kind"), (c["start"] + at["end"]).alias("end")))

        return _let(cut(points, c["start"], c["end"]), lambda word: _let(
            F.when(~_any([word.rlike(p) for p in ALLOW]), entropy_span(word)), lambda at: F.when(
                at.isNotNull(), span(word, at))))

    spans = _let(wide(text), lambda points: F.filter(F.transform(located, lambda c: judged(points, c)), lambda s: s.isNotNull()))

    def outside(every):
        """A span lies in a base span if one that begins no later ends no earlier: base spans stand first on ties."""
        reach = prefixes(F.transform(every, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), F.greatest)
        free = F.zip_with(every, reach, lambda s, r: F.when((s["kind"] == 3) & (r < s["end"]), s))
        return F.filter(free, lambda s: s.isNotNull())

    return _let(F.array_sort(F.concat(base, spans)), outside)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def scan(docs: DataFrame, text_col: str = "text", prefix: str = "secret_") -> DataFrame:
    """``docs`` with two more columns, each an array of (start, kind, end) by start, then kind.

    ``<prefix>base`` holds the spans of the base patterns, ``<prefix>spans`` those and the entropy spans; kind
    numbers ``KINDS``. Null and empty texts have no spans; repeated rows are scanned each; an empty table gives
    no rows; other columns are kept (a column already named so is replaced).
    """
    text = text_or_empty(text_col)
    assign, access, hexes = base_spans(text)
    found = docs.withColumns({f"{prefix}base": F.array_sort(F.concat(assign, access, hexes)),
                              f"{prefix}spans": _located(text, CANDIDATE, 3)})
    base, located = F.col(f"{prefix}base"), F.col(f"{prefix}spans")
    return found.withColumn(f"{prefix}spans", F.when(
        F.size(located) == 0, base).otherwise(F.array_sort(F.concat(base, entropy_spans(text, located, base)))))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span (overlapping ones together) replaced by ``mask``."""
    def done(points, found, reach):
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1).cast("int"))
        gaps = F.transform(found, lambda s, i: F.when(s["start"] >= before(i), F.concat(
            cut(points, before(i), s["start"]), F.lit(mask))))
        rest = cut(points, F.element_at(reach, -1).cast("int"), F.char_length(text))
        return F.concat(F.array_join(gaps, ""), rest)

    return F.when(F.size(spans) > 0, _let(wide(text), lambda points: _let(spans, lambda found: _let(
        prefixes(F.transform(found, lambda s: s["end"]), F.greatest), lambda reach: done(points, found, reach))))).otherwise(text)


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets in its texts masked; null texts stay null, all columns are kept."""
    (prefix,) = {n[:-len("base")] for n in fresh([c.replace("spans", "base") for c in docs.columns], "secret_base")}
    found = scan(docs, text_col, prefix)
    return found.withColumn(text_col, masked(F.col(text_col), F.col(f"{prefix}spans"), mask)).select(*docs.columns)
