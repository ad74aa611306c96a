"""SimHash near-duplicate groups by the generalised pigeonhole principle.

The 64 bits are dealt into m parts, correlated bits together, and part i gets its own threshold t_i
with sum(t_i) = d - m + 1, where -1 means that the part is not probed. Two fingerprints within d bits
then agree within t_i bits in some part i, so probing every part's values within t_i flips finds every
pair. Dynamic programming picks m and the thresholds of least estimated cost from statistics of all
fingerprints. Candidates that share a probed value are verified by their bit distance.

Equal fingerprints are collapsed first (with map-side combination), so a group of exact copies, however
large, is one node. Candidates of one value are verified in blocks of bounded size, and each block
gives a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import fresh, stored, text_or_empty
from trawl.llm.components import components

BITS = 64
CHUNK = 2048        # members of one value verified together; larger values go in pairs of chunks
PROBE_COST = 4.0    # cost of writing one probe row against verifying one candidate
PARTS = (2, 3, 4)   # numbers of parts considered

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str, shingle: int = 3) -> int:
    """Majority bits of the XXH64 of every run of ``shingle`` words (A-Z lower-cased, repeats count).

    Fewer words give one run of them all; no word gives 0.
    """
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(_hash, runs), np.uint64, max(1, len(words) - shingle + 1))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), fp(text).alias("fp"))


# ---------------------------------------------------------------- parts and thresholds

def bit_statistics(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Share of ones per bit, bit correlations, and the number of fingerprints (all of them)."""

    def run(batches):
        ones, both, n = np.zeros(BITS), np.zeros((BITS, BITS)), 0
        for b in batches:
            x = np.unpackbits(b.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").astype(np.float32)
            ones += x.sum(axis=0)
            both += x.T @ x
            n += len(x)
        values = np.concatenate([[n], ones, both.ravel()]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                         names=["k", "v"])

    sums = np.zeros(1 + BITS + BITS * BITS)
    for k, v in nodes.select("fp").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v")).collect():
        sums[k] = v
    n = int(sums[0])
    if not n:
        return np.full(BITS, 0.5), np.eye(BITS), 0
    p = sums[1:1 + BITS] / n
    cov = sums[1 + BITS:].reshape(BITS, BITS) / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return p, cov / np.outer(sd, sd), n


def correlated_parts(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near-equal size; each is grown by the free bit most correlated with its members."""
    free, parts = set(range(BITS)), []
    for k in range(m):
        size = len(free) // (m - k)
        strength = np.abs(corr).copy()
        np.fill_diagonal(strength, 0)
        seed = max(sorted(free), key=lambda b: strength[b, sorted(free)].sum())
        part = [seed]
        free.remove(seed)
        while len(part) < size:
            nxt = max(sorted(free), key=lambda b: strength[b, part].sum())
            part.append(nxt)
            free.remove(nxt)
        parts.append(sorted(part))
    return parts


def part_value(fp, part: list[int]):
    """A column: the bits of ``part`` of ``fp``, as a long (runs of adjacent bits move together)."""
    runs, out = [], F.lit(0).cast("long")
    for j, b in enumerate(part):
        if runs and runs[-1][0] + runs[-1][2] == b:
            runs[-1][2] += 1
        else:
            runs.append([b, j, 1])
    for b, j, width in runs:
        piece = F.shiftrightunsigned(fp, b).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(piece, j))
    return out


def within(p: np.ndarray, part: list[int], t: int) -> np.ndarray:
    """P(two independent fingerprints differ in exactly k bits of the part), k = 0..t."""
    dist = np.zeros(t + 1)
    dist[0] = 1.0
    for b in part:
        d = 2 * p[b] * (1 - p[b])
        dist = dist * (1 - d) + np.concatenate(([0.0], dist[:-1])) * d
    return dist


def n_probes(width: int, t: int) -> int:
    """Values within t flips of one value."""
    total, c = 0, 1
    for k in range(t + 1):
        total += c
        c = c * (width - k) // (k + 1)
    return total


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum ``total`` and least sum of costs[i][t_i + 1] (dynamic programming)."""
    best = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for k, add in enumerate(row):
                key = s + k - 1
                if key not in nxt or c + add < nxt[key][0]:
                    nxt[key] = (c + add, [*ts, k - 1])
        best = nxt
    return best[total]


def plan(nodes: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """The probed parts, each with its threshold, of least estimated cost over all fingerprints.

    The candidates of a part at threshold 0 are counted (pairs with an equal value); at t > 0 that count
    is scaled by the model of independent bits.
    """
    p, corr, n = bit_statistics(nodes)
    layouts = {m: correlated_parts(corr, m) for m in PARTS if m <= distance + 1} or {1: [list(range(BITS))]}
    tagged = [(m, i, part) for m, parts in layouts.items() for i, part in enumerate(parts)]
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), part_value(F.col("fp"), part).alias("v"))
                                 for k, (_, _, part) in enumerate(tagged)]))
    pairs = dict(nodes.select(values.alias("x")).groupBy("x.k", "x.v").count()
                 .groupBy("k").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect())
    best = None
    for m, parts in layouts.items():
        costs = []
        for i, part in enumerate(parts):
            equal = pairs.get(tagged.index((m, i, part)), 0.0)
            row = [0.0]
            for t in range(distance - m + 2):
                dist = within(p, part, t)
                row.append(PROBE_COST * n * n_probes(len(part), t) + 2 * equal * dist.sum() / max(dist[0], 1e-300))
            costs.append(row)
        cost, ts = allocate(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(part, t) for part, t in zip(parts, ts) if t >= 0])
    return best[1]


# ---------------------------------------------------------------- probing and verification

def probes(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(k, v, fp, own): every value within the part's threshold of the fingerprint's own value."""
    rows = []
    for k, (part, t) in enumerate(parts):
        flips = [sum(1 << j for j in c) for r in range(t + 1) for c in combinations(range(len(part)), r)]
        masks = F.array(*[F.lit(x - (1 << 64) if x >> 63 else x).cast("long") for x in flips])
        rows.append(F.struct(F.lit(k).alias("k"), part_value(F.col("fp"), part).alias("v"), masks.alias("masks")))
    own = nodes.select("fp", F.explode(F.array(*rows)).alias("x")).select("fp", "x.k", "x.v", "x.masks")
    flipped = own.select("fp", "k", "v", F.explode("masks").alias("mask"))
    return flipped.select("k", F.col("v").bitwiseXOR(F.col("mask")).alias("v"), "fp", (F.col("mask") == 0).alias("own"))


def blocked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows with the block (a, b) they are verified in.

    A value of at most ``chunk`` rows is one block. A larger one is cut into n hashed chunks, and each row
    joins the n blocks of its chunk with every chunk, so each pair meets in one block and no block exceeds
    about two chunks.
    """
    counts = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"), F.max("own").alias("any_own"))
    sized = counts.where("c > 1 AND any_own").select("k", "v", F.ceil(F.col("c") / chunk).cast("int").alias("n"))
    cut = rows.join(sized, ["k", "v"]).withColumn("me", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    return cut.select("k", "v", "fp", "own", "me", other.alias("other")).select(
        "k", "v", F.least("me", "other").alias("a"), F.greatest("me", "other").alias("b"), "own", "me", "fp")


def _forest(batches, distance: int):
    """Edges of a spanning forest of the links inside each block (rows arrive sorted by block, own first)."""
    names = ["k", "v", "a", "b", "own", "me", "fp"]
    held = None

    def solve(block: dict[str, np.ndarray]):
        n = len(block["fp"])
        fp = block["fp"].view(np.uint64)
        new = np.zeros(n, bool)
        new[0] = True
        for c in names[:4]:
            new[1:] |= block[c][1:] != block[c][:-1]
        end = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
        mixed = block["a"] != block["b"]
        root = np.arange(n)
        us, vs = [], []
        i, d = np.flatnonzero(block["own"]), 0
        while True:
            d += 1
            i = i[i + d < end[i]]
            if not len(i):
                break
            j = i + d
            near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
            near &= (fp[i] != fp[j]) & ~(mixed[i] & (block["me"][i] == block["me"][j]))
            near &= root[i] != root[j]
            if near.any():
                for x, y in zip(i[near], j[near]):
                    while root[x] != x:
                        x = root[x]
                    while root[y] != y:
                        y = root[y]
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        us.append(max(x, y))
                        vs.append(min(x, y))
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
        return pa.RecordBatch.from_arrays([pa.array(block["fp"][np.array(x, np.int64)], pa.int64()) for x in (us, vs)],
                                          names=["u", "v"])

    for b in batches:
        now = {c: b.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            now = {c: np.concatenate([held[c], now[c]]) for c in names}
        last = np.ones(len(now["fp"]), bool)
        for c in names[:4]:
            last &= now[c] == now[c][-1]
        cut = int(np.argmax(last))
        if cut:
            yield solve({c: x[:cut] for c, x in now.items()})
        held = {c: x[cut:] for c, x in now.items()}
    if held is not None and len(held["fp"]):
        yield solve(held)


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """(u, v): edges whose components are those of all pairs of ``nodes`` within ``distance`` bits."""
    rows = blocked(probes(nodes, plan(nodes, distance)))
    block = ["k", "v", "a", "b"]
    ordered = rows.repartition(*block).sortWithinPartitions(*block, F.desc("own"), "fp")
    return ordered.mapInArrow(partial(_forest, distance=distance), "u long, v long")


def groups(docs: DataFrame, distance: int = 3, shingle: int = 3, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, component_id, keep_id, keep_hash) of every row.

    component_id is the least doc_id reachable by links of at most ``distance`` bits (null if no row of the
    group has an id); (keep_id, keep_hash) names the row that represents the group. Null and empty texts
    have fingerprint 0 and link like any other; repeated rows are kept; an empty table gives no rows; other
    columns are not read.
    """
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = stored(fps.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), distance))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(least, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.doc_id").alias("keep_id"),
        F.col("first.text_hash").alias("keep_hash"))
    return fps.join(named, "fp")


def drop_near_copies(docs: DataFrame, distance: int = 3, shingle: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their group: one per group (its least doc_id), all columns."""
    key, text_hash, nth = fresh(docs.columns, "keep_key", "keep_hash", "keep_nth")
    as_key = lambda c: F.to_json(F.struct(F.col(c).alias("k")))  # noqa: E731  a null id has a key, too
    kept = groups(docs, distance, shingle, id_col, text_col).select(
        as_key("keep_id").alias(key), F.col("keep_hash").alias(text_hash)).distinct()
    named = docs.withColumns({key: as_key(id_col), text_hash: F.xxhash64(text_or_empty(text_col))})
    # The join and the choice among repeated rows use the same keys, so texts are shuffled once.
    once = Window.partitionBy(key, text_hash).orderBy(text_hash)
    met = named.join(kept, [key, text_hash]).withColumn(nth, F.row_number().over(once))
    return met.where(F.col(nth) == 1).select(*docs.columns)
