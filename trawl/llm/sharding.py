"""Sharding by fixed virtual slots.

A record's slot is a hash of the record; the number of slots is fixed for the life of a data set.
Bytes and rows are summed per slot, and a small versioned table says which shard owns each slot.
Rebalancing edits that table only: slots keep their records, and a new version lists which slots
moved. The table has one row per slot (a fixed number, 8192 by default), whatever the data size, so
it may be held by the driver and broadcast.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored, text_or_empty
from trawl.session import scratch_path

SLOTS = 8192
RECORD_OVERHEAD = 16  # bytes counted per record beside its text
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, n_rows long, base long, moved boolean"


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot, record) of every row; record is the hash that decides the slot.

    Null text: no bytes. The slot hashes the id and the text, so rows with a null or repeated id are
    spread as long as their texts differ; rows equal in both share a slot (see `spread`).
    """
    text = text_or_empty(text_col)
    record = F.xxhash64(F.col(id_col), F.xxhash64(text))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + RECORD_OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(record, F.lit(slots)).cast("int").alias("vslot"),
        record.alias("record"),
    )


def spread(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``recs`` with the rows of one record that repeats more often than a slot has rows dealt out over all slots.

    There are fewer such records than slots, so they are broadcast. Which slot a repeated row gets depends on its
    place in the input, so the rows are stored before they are counted. All others keep their slot.
    """
    total = recs.select(F.count(F.lit(1))).scalar()
    often = recs.groupBy("record").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & (F.col("n") * slots > total))
    met = recs.join(F.broadcast(often.select("record", F.lit(True).alias("often"))), "record", "left")
    dealt = F.pmod(F.xxhash64("record", F.monotonically_increasing_id()), F.lit(slots)).cast("int")
    return stored(met.withColumn("vslot", F.when(F.col("often"), dealt).otherwise(F.col("vslot"))).select(
        "doc_id", "size", "text_crc32", "vslot"), "records")


def slot_sizes(recs: DataFrame) -> DataFrame:
    """(vslot, bytes, n_rows): at most one row per slot, pre-aggregated on the map side."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def assign_slots(sizes: dict[int, tuple[int, int]], n_shards: int, slots: int = SLOTS,
                 old: dict[int, int] | None = None, tolerance: float = 0.01) -> dict[int, int]:
    """slot -> shard with near-equal bytes: largest slots first, each to the lightest shard.

    With an ``old`` map, a slot stays where it is unless its shard no longer exists or is more than
    ``tolerance`` above the mean; only the slots taken from such shards move.
    """
    load = [0] * n_shards
    owner: dict[int, int] = {}
    mean = sum(b for b, _ in sizes.values()) / n_shards
    loose: list[int] = []
    by_size = sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s))
    for s in by_size:
        b = sizes.get(s, (0, 0))[0]
        home = old.get(s) if old else None
        if home is not None and home < n_shards and load[home] + b <= mean * (1 + tolerance):
            owner[s] = home
            load[home] += b
        else:
            loose.append(s)
    held = [0] * n_shards
    for shard in owner.values():
        held[shard] += 1
    heap = [(load[k], held[k], k) for k in range(n_shards)]
    heapq.heapify(heap)
    for s in loose:
        b, n, k = heapq.heappop(heap)
        owner[s] = k
        heapq.heappush(heap, (b + sizes.get(s, (0, 0))[0], n + 1, k))
    return owner


def write_slot_map(spark, sizes: DataFrame, n_shards: int, root: str, version: int = 1,
                   slots: int = SLOTS) -> DataFrame:
    """Write version ``version`` of the slot map under ``root``, edited from the version before it.

    ``base`` is the number of rows in lower slots of the same shard. One row per slot reaches the
    driver (the slot count is fixed).
    """
    measured = {r["vslot"]: (r["bytes"], r["n_rows"]) for r in sizes.collect()}
    old = None
    if version > 1:
        old = {r["vslot"]: r["shard"] for r in read_slot_map(spark, root, version - 1).collect()}
    owner = assign_slots(measured, n_shards, slots, old)
    base, rows = [0] * n_shards, []
    for s in range(slots):
        b, n = measured.get(s, (0, 0))
        k = owner[s]
        rows.append((version, s, k, b, n, base[k], bool(old) and old.get(s) != k))
        base[k] += n
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{root}/version={version:06d}")
    return read_slot_map(spark, root, version)


def read_slot_map(spark, root: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{root}/version={version:06d}")


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard and its position there (from 0, without gaps).

    Records are numbered inside their virtual slot, and the map's ``base`` lifts that number to the
    shard, so no task holds a shard; only ids and sizes are shuffled, never texts.
    """
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = recs.withColumn("nth", F.row_number().over(order) - 1)
    return (numbered.join(F.broadcast(slot_map.select("vslot", "shard", "base", "version")), "vslot")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("nth")).alias("position"),
                    "vslot", "version"))


def shard(docs: DataFrame, n_shards: int, slots: int = SLOTS, root: str | None = None) -> DataFrame:
    """Put every row of ``docs`` into shards 0..n_shards-1 of near-equal bytes.

    Null and empty texts count ``RECORD_OVERHEAD`` bytes; null ids are kept; repeated rows are all
    placed, and those of a very frequent one spread over the shards; an empty table gives no rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    recs = spread(records(docs, slots), slots)
    root = root or scratch_path(spark, "slot-map")
    slot_map = write_slot_map(spark, slot_sizes(recs), n_shards, root, 1, slots)
    return place(recs, slot_map)
