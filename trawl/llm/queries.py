"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.llm import (chat_format, collocations, decontamination, licence_scan, order_minhash, packing, prefix_trie,
                       secrets, sharding, simhash, token_counts, toxicity, warc)
from trawl.llm.common import stored, table
from trawl.llm.licence_texts import NOTICES, TEXTS
from trawl.llm.tokenizers_io import public_path
from trawl.session import scratch_path

N_SHARDS = 40
TOKEN_LIMIT = 2048
SIMHASH_BITS, SIMHASH_SHINGLE = 3, 3


def op1_token_counts(spark, sf):
    """Tokens of every whole text, summed from piece counts of distinct pre-tokens."""
    counts = token_counts.count_tokens(table(spark, sf, "documents"), public_path("word_bpe_49k.json"))
    return token_counts.with_limit(counts, TOKEN_LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit",
                                                               "n_pretokens")


def op2_toxicity(spark, sf):
    """Toxicity of every whole text; learnt from labelled rows that are not held out."""
    docs = table(spark, sf, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op3_decontamination(spark, sf):
    """Pairs of a document and a benchmark item that it holds whole, in part, or with replaced words."""
    found = decontamination.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "aligned", "doc_start",
                        (F.col("matched") / F.col("aligned")).alias("share"))


def _op3_keys(words: str, rows: str, at: str) -> str:
    """SQL: the exact masked words of every window, one row per window and mask."""
    parts = []
    for k, mask in enumerate([*decontamination.MASKS, *(tuple(range(n)) for n in range(
            decontamination.SHORTEST, decontamination.SPAN))]):
        key = " || ' ' || ".join(f"{words}[i + {o + 1}]" for o in mask)
        parts.append(f"SELECT *, {k} AS m, i AS {at}, {key} AS k FROM {rows} WHERE i + {mask[-1]} < len({words})")
    return " UNION ALL ".join(parts)


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'),
                                      lambda x: x <> '') AS dw FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'),
                                  lambda x: x <> '') AS bw FROM benchmark),
dp AS (SELECT doc_id, dw, unnest(range(len(dw))) AS i FROM d),
bp AS (SELECT item_id, bw, unnest(range(len(bw))) AS i FROM b WHERE len(bw) >= {decontamination.SHORTEST}),
dk AS ({_op3_keys("dw", "dp", "di")}),
bk AS (SELECT * FROM ({_op3_keys("bw", "bp", "bi")}) x
       WHERE CASE WHEN len(bw) >= {decontamination.SPAN} THEN m < {len(decontamination.MASKS)}
                  ELSE m = {len(decontamination.MASKS)} + len(bw) - {decontamination.SHORTEST} END),
hits AS (SELECT DISTINCT dk.doc_id, bk.item_id, di - bi AS shift FROM dk JOIN bk USING (m, k)),
cells AS (
  SELECT doc_id, item_id, shift, len(bw) AS n, dw, bw,
         unnest(range(greatest(0, -shift), least(len(bw), len(dw) - shift))) AS p
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
sums AS (
  SELECT doc_id, item_id, shift, n, p, sum(CASE WHEN dw[p + shift + 1] = bw[p + 1] THEN 1 ELSE -{decontamination.MISS} END) OVER w AS s,
         min(p) OVER w AS p0
  FROM cells WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY p)),
lows AS (
  SELECT *, least(0, coalesce(min(s) OVER w, 0)) AS low FROM sums
  WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
runs AS (
  SELECT *, s - low AS run,
         coalesce(max(CASE WHEN s < low THEN p END) OVER w + 1, p0) AS since
  FROM lows
  WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (
  SELECT doc_id, item_id, p - since + 1 AS aligned, shift + since AS doc_start,
         (run + {decontamination.MISS} * (p - since + 1)) / ({decontamination.MISS} + 1) AS matched
  FROM runs WHERE run >= 0 AND p - since + 1 >= least({decontamination.OVERLAP}, n)
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY run DESC, aligned DESC, p) = 1)
SELECT doc_id, item_id, CAST(matched AS INTEGER) AS matched, CAST(aligned AS INTEGER) AS aligned,
       CAST(doc_start AS INTEGER) AS doc_start, matched / aligned AS share
FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, aligned, doc_start) = 1
"""


def op4_simhash_groups(spark, sf):
    """Components of 64-bit SimHash fingerprints within 3 bits."""
    return simhash.groups(table(spark, sf, "documents"), SIMHASH_BITS, SIMHASH_SHINGLE).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op5_chat_format(spark, sf):
    """Prefix-target examples of all conversations, read back from the formatted texts."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    back = chat_format.read_back(chat_format.examples(turns.union(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(role, '([<\[\]\\])', '\1x', 'g')) + length(regexp_replace(text, '([<\[\]\\])', '\1x', 'g')) + 12 AS n,
         row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS total
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), summed AS (
  SELECT *, 3 + sum(n) OVER (PARTITION BY conv_id ORDER BY nth) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR nth = total))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


def op6_order_minhash(spark, sf):
    """Order min-hash fingerprints of every text and its edited text."""
    return order_minhash.fingerprints(table(spark, sf, "documents"))


def op7_licence_scan(spark, sf):
    """Known licence texts and notices in all documents, by canonical digest."""
    return licence_scan.scan(table(spark, sf, "documents"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_known_sql = ", ".join(f"('{kind}', {_sql_text(name)}, {_sql_text(text)})"
                       for kind, entries in (("text", TEXTS), ("notice", NOTICES)) for name, text in entries)
_OP7_FORM = r"regexp_replace({0}, '(^|\n)[\s#*/;-]*(copyright|©|\(c\))[^\n]*', '\1', 'g')"
for _old, _new in licence_scan.SPELLINGS:
    _OP7_FORM = f"replace({_OP7_FORM}, '{_old}', '{_new}')"
_OP7_FORM = r"regexp_replace(" + _OP7_FORM + r", '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
OP7_SQL = f"""
WITH known AS (SELECT DISTINCT kind, licence,
    trim(regexp_replace({_OP7_FORM.format("lower(text)")}, '[ \\n]+', ' ', 'g')) AS form
  FROM (VALUES {_known_sql}) k(kind, licence, text)
), docs AS (SELECT doc_id, {_OP7_FORM.format("lower(coalesce(text, ''))")} AS lines FROM documents
), wholes AS (SELECT doc_id, trim(regexp_replace(lines, '[ \\n]+', ' ', 'g')) AS form FROM docs
), found AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices, count(*) AS n
  FROM (SELECT doc_id, trim(unnest(string_split(lines, chr(10)))) AS form FROM docs) x
  JOIN known USING (form) WHERE kind = 'notice' GROUP BY doc_id)
SELECT w.doc_id, sha256(w.form) AS digest, k.licence, coalesce(f.notices, '') AS notices, coalesce(f.n, 0) AS n_notice_lines
FROM wholes w LEFT JOIN found f USING (doc_id) LEFT JOIN known k ON k.kind = 'text' AND k.form = w.form
"""


def op8_packing(spark, sf):
    """Sequences of at most 1024 tokens, filled by BM25 neighbours."""
    return packing_digest(packing.pack(table(spark, sf, "documents"), public_path("byte_bpe_50k.json"),
                                       public_path("byte_bpe_50k.tiktoken")))


def packing_digest(pieces):
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "padded")


def op9_secret_scan(spark, sf):
    """Secrets in every text: base patterns and high-entropy strings."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    base, spans = F.col("secret_base"), F.col("secret_spans")
    kinds = [secrets.count_kind(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return secrets.scan(docs).select(
        "doc_id", *kinds, F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(spans).alias("spans"), secrets.count_kind(spans, "entropy").alias("n_entropy"))


def op10_sharding(spark, sf):
    """Shards 0 to 39 of near-equal bytes (law `bytes`) by fixed virtual slots."""
    placed = sharding.shard(table(spark, sf, "documents"), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("position").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         "vslot", F.col("version").alias("map_version"))


LENT, FAMILY = 9, 5


def rebuilt(turns):
    """Every conversation c anew: the first crc32(c) % 9 turns of the conversation c - c % 5, then c's own after as many.

    ``turns`` are those of `prefix_trie.turns`; a row with a null key marks each conversation, also one without turns.
    """
    lent = lambda c: F.crc32(c.cast("string").cast("binary")) % LENT
    ids = turns.select("conv_id").distinct()
    own = turns.where(F.col("pos") > lent(F.col("conv_id")))
    first = turns.where((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("pos") < LENT)).withColumn(
        "conv_id", F.explode(F.sequence("conv_id", F.col("conv_id") + FAMILY - 1))).where(
            F.col("pos") <= lent(F.col("conv_id"))).join(ids, "conv_id", "left_semi")
    marks = ids.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("key"),
                       F.lit(0).cast("long").alias("size"))
    return own.unionByName(first).unionByName(marks)


def op11_prefix_trie(spark, sf):
    """The trie of all rebuilt conversations."""
    turns = stored(prefix_trie.turns(table(spark, sf, "conversations")), "turns")
    return prefix_trie.prefix_trie(rebuilt(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda e, z: CASE WHEN e % 2 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END)), 4294967295)"""
OP11_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT *, {_CRC32} % {LENT} AS h FROM (
  SELECT conv_id, list(struct_pack(role := role, said := said) ORDER BY pos) AS own FROM t GROUP BY conv_id)),
r AS (SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
p AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM r),
n AS (SELECT depth, seq[1:depth] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(seq[depth].said)) END) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, seq[1:depth]),
kids AS (SELECT depth - 1 AS depth, k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, k)),
over AS (SELECT *, unnest(range(0, depth + 1)) AS above FROM full_n),
sums AS (SELECT above AS depth, k[1:above] AS k, count(*) FILTER (n_children = 0) AS n_leaves,
    sum((n_convs - 1) * size)::BIGINT AS saved_tokens FROM over GROUP BY above, k[1:above])
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_n f JOIN sums USING (depth, k) LEFT JOIN full_n u ON u.depth = f.depth - 1 AND u.k = f.k[1:f.depth - 1]
"""


def op12_warc(spark, sf):
    """All pages written as WARC records and read back from the archives."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf, "pages"), path)
    return warc.page_rows(warc.read_archive(spark, path))


OP12_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT *, CASE WHEN size >= {warc.LEAST_SHARED} THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS keep
      FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to FROM k
"""

LONGEST_PHRASE, LEAST_COUNT, COVERED_PERCENT, PHRASES_PER_LANG = 3, 10, 50, 2000


def op13_collocations(spark, sf):
    """Each language's first 2000 phrases of 2 or 3 words, mined over all documents."""
    return collocations.collocations(table(spark, sf, "documents"), LONGEST_PHRASE, LEAST_COUNT, COVERED_PERCENT,
                                     PHRASES_PER_LANG)


OP13_SQL = rf"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?
-
]')) AS piece FROM docs),
spoken AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM spoken GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)),
                                                lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM spoken, (VALUES (1), (2), (3)) sizes(k)),
counts AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL),
candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= {LEAST_COUNT}),
cuts AS (SELECT c.lang, c.phrase, c.f, i, x.f AS l, y.f AS r,
                (c.f::HUGEINT * c.f * 1000000) // (x.f::HUGEINT * y.f) AS score
         FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates) c
         JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i], ' ')
         JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
covered AS (SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN counts x ON x.lang = s.lang AND x.k = s.k + 1
            AND (array_to_string(x.w[1:s.k], ' ') = s.phrase OR array_to_string(x.w[2:], ' ') = s.phrase)
            WHERE 100 * x.f >= {COVERED_PERCENT} * s.f AND x.f >= {LEAST_COUNT}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank
           FROM weakest ANTI JOIN covered USING (lang, phrase))
SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang)
WHERE rank <= {PHRASES_PER_LANG}
"""


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_toxicity, op3_decontamination, op4_simhash_groups, op5_chat_format, op6_order_minhash,
    op7_licence_scan, op8_packing, op9_secret_scan, op10_sharding, op11_prefix_trie, op12_warc,
    op13_collocations)}
ORACLE_SQL: dict[str, str] = {"op3_decontamination": OP3_SQL, "op5_chat_format": OP5_SQL, "op7_licence_scan": OP7_SQL,
                              "op11_prefix_trie": OP11_SQL, "op12_warc": OP12_SQL, "op13_collocations": OP13_SQL}
