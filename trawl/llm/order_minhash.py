"""Document fingerprints by order min-hash.

A text's k-mers are numbered by occurrence (the second copy of a k-mer is another element), and each
element is hashed under ``SIZE`` seeds. Under each seed the ``TUPLE`` least elements are taken, put back into text
order, and their k-mers are hashed as a tuple. Two texts share a component when the same elements are minimal
under its seed and stand in the same order, so the share of equal components falls with edit distance, also when
pieces only change places.

`with_next` pairs every document with the one of the next id: documents are dealt into id ranges, each
range also receives the first document of the following range, and a task walks its ranges in order.
Texts cross the network once; the driver holds one id per range.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import text_or_empty

K = 8          # code points of a k-mer (a power of two)
SIZE = 32      # components of a fingerprint
TUPLE = 3      # elements of a component
RANGES_PER_TASK = 4

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LIKELY = 16           # elements of a long text that are looked at per seed
BLOCK = 1 << 13       # elements hashed at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place)."""
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def kmer_hashes(points: np.ndarray) -> np.ndarray:
    """Hash of the k-mer at each position; a shorter text is one k-mer, an empty one has none."""
    if not len(points):
        return np.zeros(0, np.uint64)
    h = points.astype(np.uint64) + np.uint64(1)
    if len(h) < K:
        h = np.concatenate([h, np.zeros(K - len(h), np.uint64)])
    width, power = 1, int(_M1)
    while width < K:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    return _mix(h)


def occurrence(h: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate(([True], s[1:] != s[:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - start
    return out


# An odd factor per seed: multiplying by it is a bijection of 32 bits.
_FACTORS = (_mix(np.arange(1, SIZE + 1, dtype=np.uint64) * _M1) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def _least(elements: np.ndarray, take: int) -> np.ndarray:
    """Positions of the ``take`` least elements (32 bits) under each seed, (SIZE, take); of equal ones the first."""
    n = len(elements)
    for limit in ((int((LIKELY << 32) / n),) if n > 4 * LIKELY else ()) + ((1 << 32) - 1,):
        # Of a long text only elements under a limit that leaves about LIKELY of them; all, if a seed has too few.
        seeds, places, ranks = [], [], []
        for i in range(0, n, BLOCK):
            block = elements[i:i + BLOCK] * _FACTORS
            found = np.flatnonzero(block <= np.uint32(limit))
            seeds.append(found // block.shape[1])
            places.append(found % block.shape[1] + i)
            ranks.append(block.ravel()[found])
        seed, place, rank = np.concatenate(seeds), np.concatenate(places), np.concatenate(ranks)
        if (np.bincount(seed, minlength=SIZE) >= take).all():
            break
    order = np.lexsort((place, rank, seed))
    first = np.searchsorted(seed[order], np.arange(SIZE))
    return place[order][first[:, None] + np.arange(take)]


def fingerprint(points: np.ndarray) -> np.ndarray:
    """``SIZE`` components (unsigned 32-bit); all zero for an empty text."""
    h = kmer_hashes(points)
    if not len(h):
        return np.zeros(SIZE, np.uint32)
    elements = h.copy()
    distinct = np.sort(h)
    if (distinct[1:] == distinct[:-1]).any():
        elements ^= occurrence(h).astype(np.uint64) * _M1
    take = min(TUPLE, len(h))
    chosen = np.sort(_least((_mix(elements) >> np.uint64(32)).astype(np.uint32), take), axis=1)  # text order
    out = np.full(SIZE, take, np.uint64)
    for j in range(take):
        out = _mix(out * _M1 + h[chosen[:, j]])
    return (out >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components."""
    return float((a == b).mean())


def text_of(fp: np.ndarray) -> str:
    return fp.astype(">u4").tobytes().hex()


# ---------------------------------------------------------------- neighbours by id

def id_ranges(docs: DataFrame, n: int):
    """``docs`` with the number of its id's range (null ids last, spread by text hash); about n ranges."""
    from pyspark.ml.feature import Bucketizer

    ids = docs.select(F.col("doc_id").cast("double").alias("x")).where("x IS NOT NULL")
    cuts = ids.approxQuantile("x", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    splits = [-math.inf, *sorted(set(cuts) or {0.0}), math.inf]
    known = Bucketizer(splits=splits, inputCol="x", outputCol="range", handleInvalid="keep").transform(
        docs.withColumn("x", F.col("doc_id").cast("double"))).drop("x")
    spread = F.floor((F.col("text_hash") / float(1 << 63) + 1) / 2 * (n - 1e-6))
    return known.withColumn("range", F.when(F.col("doc_id").isNull(), len(splits) - 1 + spread).otherwise(
        F.col("range")).cast("int"))


def with_next(docs: DataFrame, n_ranges: int) -> DataFrame:
    """(range, ahead, doc_id, text), each task sorted so that a range's documents come in order of id (then text
    hash; null ids last) and, after them with ``ahead`` set, the document that follows the range (after the last
    range: the very first document)."""
    placed = id_ranges(docs, n_ranges)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    firsts = sorted((r["range"], r["first"]) for r in placed.groupBy("range").agg(F.min(key).alias("first")).collect())
    rows = [(r, f["doc_id"], f["text_hash"], firsts[k - 1][0]) for k, (r, f) in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(rows, "range int, head_id long, head_hash long, before int")
    met = placed.join(F.broadcast(heads), "range")  # one row per range
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("text_hash") == F.col("head_hash"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("ahead"))
    extra = F.struct(F.col("before").alias("range"), F.lit(True).alias("ahead"))
    sent = met.select(F.explode(F.when(is_head, F.array(own, extra)).otherwise(F.array(own))).alias("to"), "doc_id",
                      "text", "text_hash").select("to.range", "to.ahead", "doc_id", "text", "text_hash")
    return sent.repartition(max(1, n_ranges // RANGES_PER_TASK), "range").sortWithinPartitions(
        "range", "ahead", F.col("doc_id").isNull(), "doc_id", "text_hash")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) of the following text's first ones."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    Null texts count as empty (fingerprint of zeros, like other empty texts only); null ids come after all
    others; rows of one id follow each other by text hash; repeated rows are all kept; the next document of
    the last is the first; an empty table gives no rows; other columns are not read.
    """
    text = text_or_empty(text_col)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    n_ranges = n_ranges or RANGES_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        rows: list[tuple] = []
        held = None  # (range, doc_id, text, fingerprint) of a document that waits for the next one

        def close(doc, following, next_fp):
            _, doc_id, own, fp = doc
            new = edited(own, following)
            new_fp = fingerprint(code_points(new)) if new != own else fp
            rows.append((doc_id, len(own), hashlib.sha256(new.encode()).hexdigest(), text_of(fp), text_of(new_fp),
                         likeness(fp, new_fp), likeness(fp, next_fp)))

        for b in batches:
            numbers, ahead, ids = (b.column(i).to_pylist() for i in range(3))
            for number, late, doc_id, value in zip(numbers, ahead, ids, b.column(3)):
                if late and (held is None or held[0] != number):
                    continue  # a second candidate for the same place
                own = value.as_py()
                fp = fingerprint(code_points(own))
                if held is not None and held[0] == number:
                    close(held, own, fp)
                held = None if late else (number, doc_id, own, fp)
            if rows:
                yield _batch(rows)
                rows = []

    return with_next(read, n_ranges).select("range", "ahead", "doc_id", "text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
