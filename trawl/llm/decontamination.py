"""Benchmark decontamination by spaced-seed hashing, in column expressions and joins.

A mask names the token positions of a window that count; the others may differ. Every window of every
document and of every benchmark item is hashed under each mask and the hashes are joined. A hit fixes an
alignment of item and document; the tokens along it are compared one by one, and the best stretch counts
when it is long enough and at least ``SHARE`` of its tokens agree. So passages are found whole, cut, or
with replaced tokens. The four masks hit any 13 tokens of which at most two were replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import fresh, text_or_empty

MASKS = ((0, 1, 3, 5, 6, 7), (0, 3, 4, 5, 7, 8), (0, 1, 2, 3, 4, 7), (0, 1, 2, 6, 9, 10))
SPAN = 1 + max(m[-1] for m in MASKS)
OVERLAP = 13      # aligned tokens a stretch needs (or the whole item, if that is shorter)
MISS = 4          # equal tokens that one replaced token outweighs
SHARE = MISS / (MISS + 1)  # 0.8: the share of equal tokens that a stretch needs
SHORTEST = 5      # items of fewer tokens are no evidence and are not searched
SEED_LIMIT = 500_000  # seeds broadcast at once (16 bytes each in the hash table); more go in several passes


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(tokens: Column, start: Column, mask: tuple[int, ...], number: int) -> Column:
    """Hash of the masked tokens from ``start``; null where the window passes the end."""
    picked = [F.get(tokens, start + o) for o in mask]
    return F.when(start + mask[-1] < F.size(tokens), F.xxhash64(F.lit(number), *picked))


def _windows(rows: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """``rows`` with ``at`` and ``seed`` of every window under every mask."""
    last = F.greatest(F.size("tokens") - 1, F.lit(0))  # an empty array has one position and no seed
    placed = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    seeds = F.array(*[_seed(F.col("tokens"), F.col("at"), m, len(m) * 100 + m[-1] + 1000 * k)
                      for k, m in enumerate(masks)])
    return placed.select("*", F.explode(seeds).alias("seed")).where("seed IS NOT NULL")


def best_stretch(doc: Column, item: Column, need: Column) -> Column:
    """(length, same, start) of the best stretch of two aligned arrays; length 0 if none qualifies.

    An equal token scores 1, another -MISS, so a stretch that scores 0 or more has a share of at least SHARE. At
    every token the stretch of highest score that ends there counts (the longer one, if two score the same), if
    it has ``need`` tokens. The best has the highest score, then the greatest length, and comes first.
    """
    names = ("run", "since", "eq", "best", "length", "same", "start")
    init = F.struct(*[F.lit(0).alias(n) for n in names])

    def step(acc, i):
        equal = F.get(doc, i) == F.get(item, i)
        fresh = acc["run"] < 0
        run = F.when(fresh, F.lit(0)).otherwise(acc["run"]) + F.when(equal, F.lit(1)).otherwise(F.lit(-MISS))
        since = F.when(fresh, i).otherwise(acc["since"])
        same = F.when(fresh, F.lit(0)).otherwise(acc["eq"]) + equal.cast("int")
        return F.get(F.transform(F.array(F.struct(run.alias("run"), since.alias("since"), same.alias("eq"),
                                                  (i - since + 1).alias("n"))), lambda x: pick(acc, x)), 0)

    def pick(acc, x):
        better = (x["n"] >= need) & (x["run"] >= 0) & (
            (x["run"] > acc["best"]) | ((x["run"] == acc["best"]) & (x["n"] > acc["length"])))
        now = {"best": x["run"], "length": x["n"], "same": x["eq"], "start": x["since"]}
        return F.struct(x["run"].alias("run"), x["since"].alias("since"), x["eq"].alias("eq"),
                        *[F.when(better, v).otherwise(acc[k]).alias(k) for k, v in now.items()])

    steps = F.sequence(F.lit(0), F.least(F.size(doc), F.size(item)) - 1)
    return F.aggregate(steps, init, step, lambda a: F.struct(*[a[n].alias(n) for n in ("length", "same", "start")]))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(id_col).alias("item_id"), token_hashes(text_or_empty(text_col)).alias("item")).where(
        F.size("item") >= SHORTEST)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", seed_limit: int = SEED_LIMIT) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, aligned, doc_start) of the best verified overlap of every such pair.

    ``aligned`` tokens from the document's token ``doc_start`` agree with the item in ``matched`` places.
    Items shorter than the masks are sought as a whole; those under ``SHORTEST`` tokens are not sought. Null
    and empty texts overlap with nothing; null ids are kept; repeated rows count as one; empty tables give no
    rows; other columns are not read. The benchmark's seeds are broadcast ``seed_limit`` at a time, measured
    first; a larger benchmark takes more passes over the documents.
    """
    items = _items(benchmark, item_col, item_text)
    sizes = items.agg(F.sum(F.size("item") * len(MASKS)).alias("seeds"),
                      F.array_sort(F.collect_set(F.when(F.size("item") < SPAN, F.size("item")))).alias("short")).first()
    masks = [*MASKS, *(tuple(range(n)) for n in sizes["short"])]
    passes = max(1, -(-(sizes["seeds"] or 0) // seed_limit))
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       token_hashes(text).alias("tokens"))
    windows = _windows(rows, masks)
    hits = None
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", F.lit(9)), F.lit(passes)) == k)
        seeds = _windows(part.select("item_id", "item", F.col("item").alias("tokens")), masks).where(
            # a short item only as a whole, a longer one only under the spaced masks
            (F.size("item") >= SPAN) | (F.col("seed") == _whole(masks)))
        met = windows.join(F.broadcast(seeds.select("seed", "item_id", F.col("at").alias("item_at"))), "seed").select(
            "doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "tokens")
        full = met.join(F.broadcast(part), "item_id")
        begin = F.greatest(F.lit(0), -F.col("shift"))
        doc = F.slice("tokens", F.col("shift") + begin + 1, F.size("item") - begin)
        own = F.slice("item", begin + 1, F.size("item") - begin)
        aligned = full.select("doc_id", "text_hash", "item_id", F.size("item").alias("n"), "shift",
                              (F.col("shift") + begin).alias("from"), doc.alias("doc"), own.alias("own"))
        hits = aligned if hits is None else hits.unionByName(aligned)
    # Every seed of an overlap gives the same alignment: each is judged once (collapsed before the shuffle). The
    # shift names it; ``from`` is 0 for every item that starts before the document.
    once = hits.groupBy("doc_id", "text_hash", "item_id", "shift", "from", "n").agg(
        F.first("doc").alias("doc"), F.first("own").alias("own"))
    judged = once.select("doc_id", "text_hash", "item_id", "n", "from",
                         F.explode(F.array(best_stretch(F.col("doc"), F.col("own"), F.least(F.lit(OVERLAP), F.col("n"))))
                                   ).alias("b"))
    kept = judged.where("b.length > 0")
    best = F.max(F.struct(F.col("b.same").alias("same"), (-F.col("b.length")).alias("length"),
                          (-(F.col("from") + F.col("b.start"))).alias("start"))).alias("best")
    return kept.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", F.col("best.same").alias("matched"), (-F.col("best.length")).alias("aligned"),
        (-F.col("best.start")).alias("doc_start"))


def _whole(masks: list[tuple[int, ...]]) -> Column:
    """The seed of a short item as a whole."""
    out = F.lit(None).cast("long")
    for k, m in enumerate(masks):
        if k >= len(MASKS):
            out = F.when(F.size("item") == len(m), _seed(F.col("item"), F.lit(0), m, len(m) * 100 + m[-1] + 1000 * k)
                         ).otherwise(out)
    return F.coalesce(out, F.lit(0).cast("long"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified overlap, all columns; null ids and texts stay."""
    bad_id, bad_hash = fresh(docs.columns, "bad_id", "bad_hash")
    bad = overlaps(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    same = docs[id_col].eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_or_empty(text_col)) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")
