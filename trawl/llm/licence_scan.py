"""License scans by canonical digest lookup.

A text is brought to a canonical form - copyright statements out, lower case, equivalent spellings made one,
punctuation and white space as single blanks, however the running text is wrapped - and its SHA-256 is joined to the digests of known licence
texts in the same form. Beside whole texts, each single line is looked up among known one-line notices.

The known digests are one row per listed text, so they are broadcast; lines whose canonical length is that
of no notice cannot match and are not hashed. Documents are aggregated where they were read before the
shuffle, which then carries one short row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import text_or_empty
from trawl.llm.licence_texts import NOTICES, TEXTS, published

# Words that follow "copyright" in running text, so that a line wrapped before it is no statement.
PROSE = ("notices?|holders?|owners?|ownership|licen[cs]es?|laws?|acts?|statements?|disclaimers?|permissions?|interests?|"
         "protections?|rights?|treaty|treaties|infringements?|assignments?|claims?|materials?|works?|status|information|"
         "and|or|in|on|is|of|to|for|as|if|from|may|with|that|which|are|was|has|have|by\\s+(?:the|a|an)|under|over|"
         "does|do|shall|will|can|other|its|such|any|this|these|not|when|where|who|at|be|been|than|then|but|so")
# A copyright statement, in the case it was written: the word, the sign or (c) before a year, a sign or a holder's
# name. A bare (c) may number a list item: before names it counts only when two or more of them fill its line. Groups
# repeat possessively, as others are matched by recursion, which a long line would exhaust.
_YEAR = r"(?:\d{4}|(?i:19yy|year)\b|[<\[{](?i:y))"
_NAME = r"(?!(?:The|You|Your|Any|All|If|In|No)\b)\p{Lu}\p{Ll}[\p{L}'-]*(?:(?<=Inc|Ltd|Corp|Co)\.)?,?"
COPYRIGHT_LINE = (
    r"(?m)^[ \t\r\f#*/;-]*+(?:©|(?i:copyright)[: \t]*(?:(?i:\(c\)|©)|[<\[{]|" + _YEAR + ")"
    r"|C(?i:opyright):?[ \t]+(?!(?i:" + PROSE + r")\b)(?:(?:by|the)[ \t]+)*+\p{Lu}"
    r"|(?i:\(c\))[ \t,]*(?i:copyright[ \t]+)?(?:" + _YEAR + "|(?i:©)|(?:(?i:by|the)[ \\t]+)?" + _NAME
    + r"(?:(?:[ \t]+(?:and|of|&|the))*+[ \t]+" + _NAME + r")++\.?[ \t]*$))[^\n]*$")
# Spellings that licence matching treats as one.
SPELLINGS = (("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
             ("non-commercial", "noncommercial"), ("organisation", "organization"), ("favour", "favor"),
             ("authoris", "authoriz"), ("recognis", "recogniz"), ("whilst", "while"), ("wilful", "willful"),
             ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"), ("per cent", "percent"))


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line feeds (and blanks around them)."""
    low = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, ""))
    one = low
    for old, new in SPELLINGS:
        one = F.replace(one, F.lit(old), F.lit(new))
    return F.regexp_replace(one, r"[^\p{L}\p{N}\n]+", " ")


def canonical(lines: Column) -> Column:
    """The canonical form as one line, with the spellings of two words that a line feed kept apart."""
    one = F.regexp_replace(lines, r"[ \n]+", " ")
    for old, new in SPELLINGS:
        if " " in old:
            one = F.replace(one, F.lit(old), F.lit(new))
    return F.trim(one)


def known_digests(spark: SparkSession, entries=None) -> DataFrame:
    """(kind, digest, licence, size) of the known texts (all, if none are given), in canonical form; one row each."""
    if entries is None:
        entries = [*((n, t, "text") for n, t in (*TEXTS, *published())), *((n, t, "notice") for n, t in NOTICES)]
    rows = spark.createDataFrame(list(entries), "licence string, text string, kind string")
    form = canonical(canonical_lines(F.col("text")))
    return rows.select("kind", F.sha2(form, 256).alias("digest"), "licence", F.char_length(form).alias("size")).groupBy(
        "kind", "digest").agg(F.min("licence").alias("licence"), F.min("size").alias("size"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, licence, notices, n_notice_lines) of every row.

    ``licence`` names the known text that the whole document is, else null; ``notices`` lists, in order of name,
    the licences whose notice is a line of it. Null and empty texts have the digest of the empty text and no
    licence; null ids are kept; repeated rows give repeated rows; an empty table gives no rows; other columns are
    not read.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    sizes = [r["size"] for r in known.where("kind = 'notice'").select("size").distinct().collect()]
    text = text_or_empty(text_col)
    formed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                         canonical_lines(text).alias("lines"))
    line = lambda x: F.struct(F.lit("notice").alias("kind"), F.trim(x).alias("form"))
    fits = lambda u: F.char_length(u["form"]).isin(sizes) if sizes else F.lit(False)
    units = F.concat(F.array(F.struct(F.lit("text").alias("kind"), canonical(F.col("lines")).alias("form"))),
                     F.filter(F.transform(F.split("lines", "\n"), line), fits))
    each = formed.select("doc_id", "text_hash", F.explode(units).alias("u")).select(
        "doc_id", "text_hash", F.col("u.kind").alias("kind"), F.sha2("u.form", 256).alias("digest"))
    met = each.join(F.broadcast(known.select("kind", "digest", "licence")), ["kind", "digest"], "left")
    whole, notice = F.col("kind") == "text", (F.col("kind") == "notice") & F.col("licence").isNotNull()
    found = met.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(whole, 1)).alias("copies"), F.max(F.when(whole, F.col("digest"))).alias("digest"),
        F.max(F.when(whole, F.col("licence"))).alias("licence"),
        F.array_sort(F.collect_set(F.when(notice, F.col("licence")))).alias("notices"), F.count(F.when(notice, 1)).alias("n"))
    # Rows equal in id and text were summed together.
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"),
        F.expr("n div copies").alias("n_notice_lines"))
