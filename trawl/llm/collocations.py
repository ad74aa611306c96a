"""Phrase collocations by relational (SETM) mining.

The occurrence relation - chunk, position, word, in the order of the text, with a gap between pieces - is
written once. A level then joins the occurrences of frequent phrases of one length with those at the next
position of the same piece (a merge of two sorted columns), counts the groups, keeps the frequent ones, and
only their occurrences are extended by the following level.

A chunk is a run of about ``CHUNK`` words of the texts that one task read. Inside a chunk, words and phrases
have local numbers, and a chunk tells the rest only (phrase, local number, count), one row per distinct phrase.
These rows are dealt out by phrase, so a phrase that is everywhere has one row per chunk; the frequent ones go
back to their chunks as (local number, phrase id). Rows of numbers cross the network packed, those of a chunk for a
task (or of a task for a chunk) in one compressed row. No text is shuffled and no phrase is hashed: the id of a
phrase is the least (chunk, local number) that holds it, and a longer phrase is the pair of ids of its
first and its last words.

A run cut inside a piece keeps the following ``longest - 1`` words as a tail, in which nothing starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored

CHUNK = 1_000_000          # words of a chunk
BUFFER_BYTES = 7 << 20     # text that a task cuts into words at a time (and one document more)
BLOCK = 1 << 18            # words of a stored row
PART = 1_000_000           # rows that a task counts at a time, about
LOCAL = 24                 # bits of a local number
GAP = -1                   # between pieces; a tail word w is stored as -2 - w
SCALE = 1_000_000

RELATION = "chunk long, at int, run binary, local int, lang string, word string, n long"
GROUPS = "part int, rows int, packed binary"


# ---------------------------------------------------------------- the occurrence relation

def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word numbers with ``GAP`` between pieces, the words, words and gaps of each text)."""
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), r"[.,;:!?\x0A-\x0D]+", " \n ")
    marked = pc.binary_join_element_wise(pc.replace_substring(marked, "\t", " "), "\n", " ")
    lists = pc.split_pattern(marked, " ")
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    keep = codes != pc.index(words, "").as_py()
    codes, owner = codes[keep], owner[keep]
    codes[codes == pc.index(words, "\n").as_py()] = GAP
    return codes, words, np.bincount(owner, minlength=len(lists))


def _chunk_batches(number: int, word: np.ndarray, tail: int, names: pa.Array, langs: list[str],
                   width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: its run of local numbers in blocks, and its words. The last ``tail`` are tail words."""
    real = word != GAP
    distinct, local = np.unique(word[real], return_inverse=True)
    starts = np.ones(len(word), bool)
    starts[len(word) - tail:] = False
    counts = np.bincount(local[starts[real]], minlength=len(distinct))
    run = np.full(len(word), GAP, np.int32)
    run[real] = np.where(starts[real], local, -2 - local)
    blocks = [run[i:i + BLOCK].astype("<i4").tobytes() for i in range(0, len(run), BLOCK)]
    packed = [pa.compress(b, codec="zstd", asbytes=True) for b in blocks]
    n, k = len(blocks), len(distinct)
    sized = [len(b).to_bytes(8, "little") + z for b, z in zip(blocks, packed)]
    schema = pa.schema([("chunk", pa.int64()), ("at", pa.int32()), ("run", pa.binary()), ("local", pa.int32()),
                        ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    yield pa.record_batch([pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(sized, pa.binary()),
                           pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()),
                           pa.nulls(n, pa.int64())], schema=schema)
    yield pa.record_batch([pa.array(np.full(k, number, np.int64)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()),
                           pa.array(np.arange(k, dtype=np.int32)), pa.array(langs, pa.string()).take(
                               pa.array(distinct // width)), names.take(pa.array(distinct % width)),
                           pa.array(counts.astype(np.int64))], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch], longest: int, size_of_chunk: int) -> Iterator[pa.RecordBatch]:
    """The occurrence relation of the texts of a task."""
    from pyspark import TaskContext

    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 19
    held, size = [], 0

    def relation(parts):
        nonlocal number
        table = pa.Table.from_batches(parts).combine_chunks()
        codes, names, sizes = _words(pa.array(table["text"].combine_chunks(), pa.string()))
        coded = table["lang"].combine_chunks().dictionary_encode()
        lang = np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
        width = max(1, len(names))
        word = np.where(codes == GAP, GAP, lang * width + codes)
        for i in range(0, len(word), size_of_chunk):
            upto = i + size_of_chunk
            after = word[upto:upto + longest - 1]
            gaps = np.flatnonzero(after == GAP)
            tail = int(gaps[0]) if len(gaps) else len(after)
            yield from _chunk_batches(number, word[i:upto + tail], tail, names, coded.dictionary.to_pylist(), width)
            number += 1

    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        lo = 0
        while lo < batch.num_rows:
            upto = (ends[lo - 1] if lo else 0) + BUFFER_BYTES - size
            hi = max(lo + 1, int(np.searchsorted(ends, upto, "right")))
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1] - (ends[lo - 1] if lo else 0))
            lo = hi
            if size >= BUFFER_BYTES or lo < batch.num_rows:
                yield from relation(held)
                held, size = [], 0
    if held:
        yield from relation(held)


def occurrences(docs: DataFrame, longest: int, text_col: str = "text", lang_col: str = "lang",
                chunk: int = CHUNK) -> DataFrame:
    """The relation, stored: per chunk its ``run`` in blocks (``at``), and its words (``local``, lang, word, n)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(partial(_cut, longest=longest, size_of_chunk=chunk), RELATION), "occurrences")


# ---------------------------------------------------------------- levels

def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers as compressed bytes: the first bytes of all values, then the second ones, and so on."""
    planes = [np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(packed: bytes, rows: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=8 * rows * columns, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(c.T).view("<i8").ravel().astype(np.int64) for c in raw.reshape(columns, 8, rows)]


def _runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal values of a sorted column."""
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(values)])) if len(values) else []


def _packed_groups(groups: pa.Table, parts: int) -> pa.Table:
    """A chunk's groups (a, b, own, n) by the part that counts the phrase (a, b): part, rows, packed."""
    a, b, own, n = (groups[c].to_numpy() for c in ("a", "b", "own", "n"))
    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    part = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    a, b, own, n, part = a[order], b[order], own[order], n[order], part[order]
    spans = _runs_of(part)
    return pa.table([pa.array([part[i] for i, _ in spans], pa.int32()), pa.array([j - i for i, j in spans], pa.int32()),
                     pa.array([_pack([a[i:j], b[i:j], np.diff(own[i:j], prepend=0), n[i:j]]) for i, j in spans], pa.binary())],
                    names=["part", "rows", "packed"])


def _unpacked_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, packed in zip(batch["rows"].to_pylist(), batch["packed"].to_pylist()):
            a, b, own, n = _unpack(packed, rows, 4)
            yield pa.record_batch([pa.array(a), pa.array(b), pa.array(np.cumsum(own)), pa.array(n)], names=["a", "b", "own", "n"])


def _counted(batches: Iterator[pa.RecordBatch], least: int, ids_only: bool, packed: bool) -> Iterator[pa.RecordBatch]:
    """Group count of the phrases of a partition: a row (keys, id, f) per frequent phrase, and, packed per chunk, the
    (local, id) of its occurrences there."""
    parts = [b for b in (_unpacked_groups(batches) if packed else batches) if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    keys = table.column_names[:2]
    sides = [table[k].combine_chunks().dictionary_encode() for k in keys]
    codes = [s.indices.to_numpy(zero_copy_only=False).astype(np.int64) for s in sides]
    order = np.lexsort((table["own"].to_numpy(), codes[0] * len(sides[1].dictionary) + codes[1]))
    pair = (codes[0] * len(sides[1].dictionary) + codes[1])[order]
    own, n = table["own"].to_numpy()[order], table["n"].to_numpy()[order]
    begins = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    sizes = np.diff(np.append(begins, len(pair)))
    total, id_ = np.add.reduceat(n, begins), own[begins]
    kept = np.repeat(total >= least, sizes)
    total, id_ = np.repeat(total, sizes)[kept], np.repeat(id_, sizes)[kept]
    own, taken = own[kept], order[kept]
    first = own == id_
    named = [table[k].combine_chunks().take(pa.array(taken[first])) for k in keys]
    rows = int(first.sum())
    schema = pa.schema([*((k, table.schema.field(k).type) for k in keys), ("id", pa.int64()), ("f", pa.int64()),
                        ("chunk", pa.int64()), ("rows", pa.int32()), ("packed", pa.binary())])
    yield from pa.table([*named, id_[first], total[first], pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()),
                         pa.nulls(rows, pa.binary())], schema=schema).to_batches(1 << 18)
    if ids_only:
        return
    order = np.argsort(own)
    own, id_ = own[order], id_[order]
    chunk, local = own >> LOCAL, own & ((1 << LOCAL) - 1)
    spans = _runs_of(chunk)
    for at in range(0, len(spans), 64):
        some = spans[at:at + 64]
        k = len(some)
        yield pa.record_batch([*(pa.nulls(k, schema.field(c).type) for c in keys), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                               pa.array([int(chunk[i]) for i, _ in some], pa.int64()),
                               pa.array([j - i for i, j in some], pa.int32()),
                               pa.array([_pack([np.diff(local[i:j], prepend=0), id_[i:j]]) for i, j in some], pa.binary())],
                              schema=schema)


def _frequent(dealt: DataFrame, keys: str, least: int, ids_only: bool = False, packed: bool = True) -> DataFrame:
    """Of groups dealt out by phrase, the phrases of at least ``least`` occurrences; stored.

    Rows (keys, id, f) name the phrases; rows (chunk, rows, packed) say where they are. A task counts a part of about
    ``PART`` rows at a time.
    """
    return stored(dealt.mapInArrow(partial(_counted, least=least, ids_only=ids_only, packed=packed),
                                   f"{keys}, id long, f long, chunk long, rows int, packed binary"), "frequent", True)


def _extended(key, runs: pa.Table, kept: pa.Table, level: int, parts: int) -> pa.Table:
    """`_extend` of a chunk whose frequent phrases come packed; its groups packed by part."""
    some = [(lv, *_unpack(p, n, 2)) for lv, n, p in zip(*(kept[c].to_pylist() for c in ("level", "rows", "packed")))]
    column = lambda arrays: np.concatenate([np.zeros(0, np.int64), *arrays])
    plain = pa.table([column([np.full(len(i), lv) for lv, _, i in some]), column([np.cumsum(d) for _, d, _ in some]),
                      column([i for _, _, i in some])], names=["level", "local", "id"])
    return _packed_groups(_extend(key, runs, plain, level), parts)


def _run(table: pa.Table) -> np.ndarray:
    rows = sorted(zip(table["at"].to_pylist(), table["run"].to_pylist()))
    parts = [np.frombuffer(pa.decompress(z[8:], decompressed_size=int.from_bytes(z[:8], "little"), codec="zstd",
                                         asbytes=True), "<i4") for _, z in rows]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _extend(key, runs: pa.Table, kept: pa.Table, level: int) -> pa.Table:
    """(a, b, own, n): the chunk's phrases of ``level`` + 1 words whose first and last ``level`` words are frequent."""
    names = ["a", "b", "own", "n"]
    if not runs.num_rows or not kept.num_rows:
        return pa.table([pa.array([], pa.int64())] * 4, names=names)
    run = _run(runs)
    starts, local = run >= 0, np.where(run <= -2, -2 - run, run)
    n_local = int(local.max(initial=-1)) + 1
    for step in range(1, level + 1):
        # Semi-join: occurrences of frequent phrases only, as their place among the chunk's frequent ones.
        # Each level numbers the phrases of the levels below anew: in an order of their own, not of arrival.
        held = kept.filter(pc.equal(kept["level"], step)).sort_by("local")
        ids = held["id"].to_numpy()
        place = np.full(n_local + 1, -1, np.int64)
        place[held["local"].to_numpy()] = np.arange(len(ids))
        at = np.where(local >= 0, place[local], -1)
        # Merge of the relation with itself at the next position: both sides are sorted by position.
        both = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
        distinct, inverse = np.unique(at[both] * max(1, len(ids)) + at[both + 1], return_inverse=True)
        n_local = len(distinct)
        if n_local >= 1 << LOCAL:
            raise ValueError("a chunk has too many distinct phrases for its local numbers")
        local = np.full(len(run), -1, np.int64)
        local[both] = inverse
    n = np.bincount(inverse[starts[both]], minlength=n_local)
    own = (runs["chunk"][0].as_py() << LOCAL) + np.arange(n_local)
    width = max(1, len(ids))
    return pa.table([ids[distinct // width], ids[distinct % width], own, n.astype(np.int64)], names=names)


def _named(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """(id, f, lang, words, firsts, lasts) of phrases (id, f, a, b) from those of their first and last words."""
    first = shorter.select(F.col("id").alias("a"), "lang", "words", "firsts", F.col("f").alias("first"))
    last = shorter.select(F.col("id").alias("b"), F.element_at("words", -1).alias("word"), "lasts", F.col("f").alias("last"))
    return found.join(first, "a").join(last, "b").select(
        "id", "f", "lang", F.array_append("words", F.col("word")).alias("words"),
        F.array_append("firsts", F.col("first")).alias("firsts"), F.array_append("lasts", F.col("last")).alias("lasts"))


def phrases(relation: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """(lang, words, f, firsts, lasts) of every phrase of 2 to ``longest`` words with f >= ``least``.

    ``firsts[i]`` and ``lasts[i]`` are the counts of its first and last i + 1 words.
    """
    runs = relation.where("run IS NOT NULL").select("chunk", "at", "run")
    words = relation.where("word IS NOT NULL")
    rows, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    own = F.shiftleft(F.col("chunk"), LOCAL) + F.col("local")
    found = _frequent(words.select("lang", "word", own.alias("own"), "n").repartition(1 + rows // PART, "lang", "word"),
                      "lang string, word string", least, packed=False)
    none = F.array().cast("array<long>")
    named = found.where("id IS NOT NULL").select("id", "f", "lang", F.array("word").alias("words"), none.alias("firsts"),
                                                 none.alias("lasts"))
    kept, out = None, None
    parts = 1 + total // PART
    for level in range(1, longest):
        held = found.where("packed IS NOT NULL").select(F.lit(level).alias("level"), "chunk", "rows", "packed")
        kept = held if kept is None else kept.unionByName(held)
        groups = runs.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(
            partial(_extended, level=level, parts=parts), GROUPS)
        found = _frequent(groups.repartitionById(parts, F.col("part")), "a long, b long", least,
                          ids_only=level + 1 == longest)
        named = _named(found.where("id IS NOT NULL").select("id", "f", "a", "b"), named)
        longer = named.select("lang", "words", "f", "firsts", "lasts")
        out = longer if out is None else out.unionByName(longer)
    return out


# ---------------------------------------------------------------- scores

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (l * r)), exact: 38 digits hold a * a * SCALE for a below 10^16."""
    exact = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.call_function("div", exact(a, 16) * exact(a, 16) * exact(F.lit(SCALE), 7),
                           exact(left, 19) * exact(right, 19))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered_percent: int = 50,
                 per_lang: int = 2000, text_col: str = "text", lang_col: str = "lang", chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``per_lang`` phrases by score.

    Words are runs without blanks and tabs inside pieces (cut at ``.,;:!?`` and line breaks), A-Z lower-cased.
    A phrase of 2 to ``longest`` words occurs a >= ``least`` times; its score is that of its weakest cut into l and
    r occurrences (on a tie the first), floor(10^6 a^2 / (l r)). A phrase is left out when a longer one that
    holds it occurs at least ``covered_percent`` in a hundred times as often. Ties of score go to the larger a,
    then to the smaller phrase in byte order.

    Null texts count as empty and have no words; a null language is ``und``; repeated rows count each time; texts of
    any length are whole; an empty table gives no rows; other columns are not read.
    """
    relation = occurrences(docs, longest, text_col, lang_col, chunk)
    totals = relation.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    found = stored(phrases(relation, longest, least), "phrases")
    size = F.size("words")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        _score(F.col("f"), F.get("firsts", k - 1), F.get("lasts", size - k - 1)).alias("score"), k.alias("k"),
        F.get("firsts", k - 1).alias("l"), F.get("lasts", size - k - 1).alias("r")))
    scored = found.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"),
                          F.array_min(cuts).alias("cut"))
    # Each phrase tells the shorter ones inside it how often it occurs.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda s: F.array_join(F.slice("words", s, m), " "))))
    covers = (found.where(size > 2).select("lang", F.explode(spans).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("cover")))
    free = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * covered_percent))
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    top = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(w)).where(F.col("rank") <= per_lang)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                           "score")
