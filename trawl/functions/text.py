"""Term analysis as native column expressions (higher-order array functions, no UDFs).

Index side: lower-case -> split on Unicode white space -> trim punctuation -> drop
empty words and stop words -> stem. Stop words are checked after the trim and before
stemming, and nothing is re-checked after stemming, so a stem may be empty or be a
stop word; such terms are real index terms.

Query side of ranked search and suggestions: lower-case + split only (`query_words`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.expr import let

# ---------------------------------------------------------------------------
# These must equal the reference's behaviour.
# ---------------------------------------------------------------------------
# Unicode white space (the field splitter's class). Works in Java regex and RE2.
WS = (
    "[\\t\\n\\x0B\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)
# Its part in ASCII: a pattern of one small set of characters, which is matched several times faster.
ASCII_WS = "[\\t\\n\\x0B\\f\\r ]+"
# Characters trimmed from both ends of each word.
PUNCT_CUTSET = ".,!?()[]{}:;\"'"
# English stop words, 65 of them.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at",
    "be", "by", "for", "from", "has", "he",
    "in", "is", "it", "its", "of", "on",
    "that", "the", "to", "was", "were", "will",
    "with", "this", "but", "they", "have",
    "had", "what", "when", "where", "who", "which",
    "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such",
    "no", "nor", "not", "only", "own", "same",
    "so", "than", "too", "very", "can", "did",
    "do", "does", "doing", "done", "down", "up",
)
# Words shorter than this many bytes are not stemmed.
STEM_MIN_BYTES = 3
# ---------------------------------------------------------------------------

def _empty() -> Column:
    return F.array().cast("array<string>")


def go_lower(c: Column) -> Column:
    """Unicode lower-case, rune by rune (no final-sigma or dotted-I expansion)."""
    return F.lower(F.translate(c, "İΣ", "iσ"))


def collapse_ws(c: Column) -> Column:
    """Join the white-space separated fields with single spaces (TrimSpace + Fields)."""
    return F.trim(F.regexp_replace(c, WS, " "))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def lower_text(c: Column) -> Column:
    """The text as `_split_lower` splits it, for `words.python_words`: valid UTF-8, lower-cased."""
    return F.make_valid_utf8(F.when(_is_ascii(c), F.lower(c)).otherwise(go_lower(c)))


def _split_ws(c: Column) -> Column:
    """Split on runs of Unicode white space; an end of white space gives an empty field."""
    return let(c, lambda t: F.when(_is_ascii(t), F.split(t, ASCII_WS)).otherwise(F.split(t, WS)))


def _split_lower(c: Column) -> Column:
    """`_split_ws` of the lower-cased text (ASCII needs no rune-by-rune treatment)."""
    return let(c, lambda t: F.when(_is_ascii(t), F.split(F.lower(t), ASCII_WS)).otherwise(F.split(go_lower(t), WS)))


def split_fields(c: Column) -> Column:
    """Split on runs of Unicode white space; no empty fields."""
    return F.filter(_split_ws(c), lambda w: w != "")


def query_words(query: Column) -> Column:
    """Query terms of ranked search / suggestions: lower-case + white-space split only."""
    return F.coalesce(split_fields(go_lower(query)), _empty())


def trimmed_words(text: Column) -> Column:
    """Lower-cased words with punctuation trimmed at both ends (may contain '')."""
    return F.transform(F.filter(_split_lower(text), lambda w: w != ""), _trim)


def _trim(w: Column) -> Column:
    return F.btrim(w, F.lit(PUNCT_CUTSET))


def _drop(w: Column, n: int) -> Column:
    return F.left(w, F.length(w) - n)


def _step1a(w: Column) -> Column:
    return (F.when(w.endswith("sses"), _drop(w, 2))
            .when(w.endswith("ies"), _drop(w, 2))
            .when(w.endswith("ss"), w)
            .when(w.endswith("s"), _drop(w, 1))
            .otherwise(w))


def _step1b(w: Column) -> Column:
    return (F.when(w.endswith("eed"), _drop(w, 1))
            .when(w.endswith("ed"), _drop(w, 2))
            .when(w.endswith("ing"), _drop(w, 3))
            .otherwise(w))


def _step2(w: Column) -> Column:
    return (F.when(w.endswith("ization"), F.concat(_drop(w, 5), F.lit("ize")))
            .when(w.endswith("ational"), F.concat(_drop(w, 5), F.lit("ate")))
            .when(w.endswith("fulness") | w.endswith("ousness") | w.endswith("iveness"), _drop(w, 4))
            .otherwise(w))


def _step3(w: Column) -> Column:
    return (F.when(w.endswith("ize"), _drop(w, 3))
            .when(w.endswith("ate"), _drop(w, 3))
            .when(w.endswith("al"), _drop(w, 2))
            .otherwise(w))


# A word with none of these endings is its own stem: the first two steps take "s", "ed" and "ing", the third one
# what ends in "s" too or in these two, the last one the rest.
STEM_ENDINGS = ("s", "ed", "ing", "ization", "ational", "ize", "ate", "al")


def _has_stem_ending(w: Column) -> Column:
    found = w.endswith(STEM_ENDINGS[0])
    for e in STEM_ENDINGS[1:]:
        found = found | w.endswith(e)
    return found & (F.octet_length(w) >= STEM_MIN_BYTES)


def _stemmed(w: Column) -> Column:
    for step in (_step1a, _step1b, _step2, _step3):
        w = let(w, step)
    return w


def stem_words(words: Column) -> Column:
    """Stem every word of an array with the four-step suffix stripper.

    Most words have no ending that a step takes and stay as they are; each step's word is bound by `let`, so the
    expression stays linear in size.
    """
    return F.transform(words, lambda w: F.when(_has_stem_ending(w), _stemmed(w)).otherwise(w))


def with_stem(df: DataFrame, word: str, out: str) -> DataFrame:
    """Add column ``out`` = stem of string column ``word`` as scalar projections.

    One projection per step, so each step reads the previous one as a column and whole-
    stage codegen compiles the chain (used on exploded tokens at index build)."""
    keep = F.octet_length(F.col(word)) < STEM_MIN_BYTES
    cur = word
    for i, step in enumerate((_step1a, _step1b, _step2, _step3)):
        nxt = out if i == 3 else f"_{out}_s{i}"
        df = df.withColumn(nxt, F.when(keep, F.col(word)).otherwise(step(F.col(cur))))
        if cur != word:
            df = df.drop(cur)
        cur = nxt
    return df


def stem(word: Column) -> Column:
    """Stem a single word (scalar form of `stem_words`)."""
    return F.element_at(stem_words(F.array(word)), 1)


def is_stop_word(w: Column) -> Column:
    return w.isin(*STOP_WORDS)


def kept_words(text: Column) -> Column:
    """Trimmed words that are neither empty nor stop words (before stemming)."""
    return F.filter(F.transform(_split_lower(text), _trim), lambda w: ~w.isin("", *STOP_WORDS))


def analyze(text: Column) -> Column:
    """Index terms of a text, in order: array<string>. Null text gives []."""
    return F.coalesce(stem_words(kept_words(text)), _empty())


def term_count(text: Column) -> Column:
    """Number of index terms of a text; stemming never changes it, so it is skipped."""
    return F.coalesce(F.size(kept_words(text)), F.lit(0)).cast("int")
