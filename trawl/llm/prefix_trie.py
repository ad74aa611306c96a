"""The trie of conversation prefixes, as node tables in flat arrays under minimal perfect hashes.

A node is a distinct sequence of first turns and is named by a chained 128-bit digest of it. Sequences are walked turn
by turn in tasks that hold one digest at a time, and only digests, lengths and ids cross the network.

A shard holds whole subtrees: its distinct digests get the slots of a minimal perfect hash (every look-up compares
the digest in the slot, so a foreign digest is never taken for a member), counts are scattered into arrays by slot, and
leaves and saved bytes are accumulated through the array of parent slots, deepest nodes first.

Nodes that more than one in ``HOT_NODES`` of all rows belongs to (and more than ``LEAST_HOT``) are the trie's top.
A row belongs to one node, so there are fewer than ``HOT_NODES`` of them at any size. They are counted with map-side
combination, get the sums of the shards below them, and are accumulated as one more shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored

HOT_NODES = 50_000
LEAST_HOT = 64
SHARD_ROWS = 500_000       # rows of a shard, about
IDS_PER_TEXT = 1 << 16     # ids joined into one text before they are hashed
ROOT = bytes(16)
BATCH = 1 << 16

NODES = ("node binary, parent binary, below_top boolean, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- sequences

def turns(conversations: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, key, size): the turns of each conversation in order, as a digest of role and text and the
    text's UTF-8 bytes. Null turns come first, turns of equal number by digest; null roles and texts are empty; rows
    without conv_id belong to no conversation and are left out."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    said = F.concat(F.octet_length(empty(role_col)), F.lit(":"), empty(role_col), empty(text_col))
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(order_col).alias("turn"),
                                F.unhex(F.left(F.sha2(said, 256), F.lit(32))).alias("key"),
                                F.octet_length(empty(text_col)).cast("long").alias("size")).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return rows.withColumn("pos", F.row_number().over(order)).select("conv_id", "pos", "key", "size")


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, bytes, int, bool]]:
    """(conv_id, depth, node, parent, size, last) along sequences sorted by (conv_id, pos); a null key is no turn."""
    held, now, depth, conv = None, ROOT, 0, None
    for batch in batches:
        for c, key, size in zip(*[batch[n].to_pylist() for n in ("conv_id", "key", "size")]):
            if c != conv:
                if held:
                    yield *held, True
                held, conv, now, depth = (c, 0, ROOT, b"", 0), c, ROOT, 0
            if key is not None:
                yield *held, False
                parent, now, depth = now, hashlib.blake2b(now + key, digest_size=16).digest(), depth + 1
                held = (c, depth, now, parent, size)
    if held:
        yield *held, True


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == BATCH:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_ROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                  ("size", pa.int64()), ("ends", pa.bool_())])
_ROW_SQL = "conv_id long, depth long, node binary, parent binary, size long, ends boolean"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation and depth."""
    return _batched(_walked(batches), _ROW)


def _below(batches: Iterator[pa.RecordBatch], top: frozenset) -> Iterator[pa.RecordBatch]:
    """The rows below the top, with the first node of their path that is not in it (``shard``)."""
    def rows():
        shard = None
        for row in _walked(batches):
            if row[2] in top:
                shard = None
                continue
            if shard is None or row[3] in top:
                shard = row[2]
            yield *row, shard

    return _batched(rows(), _ROW.append(pa.field("shard", pa.binary())))


def _ends_in(batches: Iterator[pa.RecordBatch], top: frozenset) -> Iterator[pa.RecordBatch]:
    """(node, conv_id) of the conversations that end in a node of the top."""
    schema = pa.schema([("node", pa.binary()), ("conv_id", pa.int64())])
    return _batched(((r[2], r[0]) for r in _walked(batches) if r[5] and r[2] in top), schema)


# ---------------------------------------------------------------- node tables

class SlotTable:
    """A minimal perfect hash over distinct 128-bit keys.

    Level by level, the keys without a slot are hashed into an array of twice their number; a key that is alone in its
    cell takes it, the others go on with another seed. Slots are the ranks of taken cells. `find` compares the key
    in the slot.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.keys = [], np.zeros_like(keys)
        left, used = keys, 0
        while len(left):
            cell = self._cell(left, len(self.levels), 2 * len(left))
            taken = np.bincount(cell, minlength=2 * len(left)) == 1
            rank = used + np.cumsum(taken) - 1
            alone = taken[cell]
            self.keys[rank[cell[alone]]] = left[alone]
            self.levels.append((taken, rank))
            used += int(alone.sum())
            left = left[~alone]

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = (keys[:, 0] ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for one that is not a member."""
        slots = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (taken, rank) in enumerate(self.levels):
            cell = self._cell(keys[left], level, len(taken))
            here = taken[cell]
            slots[left[here]] = rank[cell[here]]
            left = left[~here]
        met = slots >= 0
        met[met] = (self.keys[slots[met]] == keys[met]).all(axis=1)
        return np.where(met, slots, -1)


def as_keys(column: pa.Array) -> np.ndarray:
    """16-byte values as (n, 2) integers; shorter ones (no parent) become the greatest key."""
    data = b"".join(v if len(v) == 16 else b"\xff" * 16 for v in column.to_pylist())
    return np.frombuffer(data, "<u8").reshape(-1, 2)


def accumulate(parent: np.ndarray, depth: np.ndarray, *sums: np.ndarray) -> None:
    """Add each node's sums to its parent's (slot; -1: none), deepest nodes first, in place."""
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        for s in sums:
            np.add.at(s, parent[level], s[level])


def _ends_text(convs: np.ndarray) -> str:
    return ",".join(map(str, np.sort(convs).tolist()))


_NODE = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("below_top", pa.bool_()), ("conv_id", pa.int64()),
                   ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                   ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node table of a shard (all rows of a partition)."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    keys = as_keys(rows["node"])
    slots_of = SlotTable(np.unique(keys, axis=0))
    slot, n = slots_of.find(keys), len(slots_of.keys)
    conv, ends = rows["conv_id"].to_numpy(), rows["ends"].to_numpy()
    some = np.zeros(n, np.int64)
    some[slot] = np.arange(len(slot))  # a row of each node
    depth, size = rows["depth"].to_numpy()[some], rows["size"].to_numpy()[some]
    n_convs = np.bincount(slot, minlength=n)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    parents = rows["parent"].take(pa.array(some))
    parent = slots_of.find(as_keys(parents))
    inside = parent >= 0
    children = np.bincount(parent[inside], minlength=n)
    leaves, saved = (children == 0).astype(np.int64), (n_convs - 1) * size
    accumulate(parent, depth, leaves, saved)
    order = np.lexsort((conv[ends], slot[ends]))
    end_slot, end_conv = slot[ends][order], conv[ends][order]
    at, upto = np.searchsorted(end_slot, np.arange(n)), np.searchsorted(end_slot, np.arange(n), "right")
    hashes = [hashlib.sha256(_ends_text(end_conv[i:j]).encode()).hexdigest() for i, j in zip(at, upto)]
    yield from pa.table([rows["node"].take(pa.array(some)), parents, ~inside, least, depth,
                         pa.array(least[parent], pa.int64(), mask=~inside), n_convs, children, leaves, saved, hashes],
                        schema=_NODE).to_batches(BATCH)


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top's node table: its rows hold counts, and the sums of the subtrees below the top."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    slots_of = SlotTable(as_keys(rows["node"]))
    slot = slots_of.find(as_keys(rows["node"]))
    n = len(slot)
    spread = {}
    for name in ("conv_id", "depth", "size", "n_convs", "below_children", "below_leaves", "below_saved"):
        spread[name] = np.zeros(n, np.int64)
        spread[name][slot] = rows[name].to_numpy()
    parent = np.empty(n, np.int64)
    parent[slot] = slots_of.find(as_keys(rows["parent"]))
    inside = parent >= 0
    children = spread["below_children"] + np.bincount(parent[inside], minlength=n)
    leaves = spread["below_leaves"] + (children == 0)
    saved = spread["below_saved"] + (spread["n_convs"] - 1) * spread["size"]
    accumulate(parent, spread["depth"], leaves, saved)
    back = pa.array(np.argsort(slot))
    yield from pa.table([rows["node"].take(back), rows["parent"].take(back), np.zeros(n, bool), spread["conv_id"],
                         spread["depth"], pa.array(spread["conv_id"][parent], pa.int64(), mask=~inside), spread["n_convs"],
                         children, leaves, saved, rows["ends_sha256"].take(back)], schema=_NODE).to_batches(BATCH)


# ---------------------------------------------------------------- ids that end in one node

def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by (node, conv_id) -> (node, first id, their joined text) of at most ``IDS_PER_TEXT`` ids."""
    def rows():
        node, ids = None, []
        for batch in batches:
            for k, c in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (k != node or len(ids) == IDS_PER_TEXT):
                    yield node, ids[0], ",".join(map(str, ids))
                    ids = []
                node = k
                ids.append(c)
        if ids:
            yield node, ids[0], ",".join(map(str, ids))

    return _batched(rows(), pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, SHA-256 of its texts, which come in order)."""
    def rows():
        node, digest = None, None
        for batch in batches:
            for k, text in zip(batch["node"].to_pylist(), batch["ids"].to_pylist()):
                if k == node:
                    digest.update(b",")
                elif node is not None:
                    yield node, digest.hexdigest()
                if k != node:
                    node, digest = k, hashlib.sha256()
                digest.update(text.encode())
        if node is not None:
            yield node, digest.hexdigest()

    return _batched(rows(), pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): ids are dealt by ranges of them and joined there, so a node of many ids sends few rows."""
    texts = ends.repartitionByRange("conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _texts, "node binary, first long, ids string")
    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _hashed, "node binary, ends_sha256 string")


# ---------------------------------------------------------------- the trie

def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes (rows of ``NODES``) of the trie of ``sequences`` (conv_id, pos, key, size), as `turns` gives them.

    A conversation without turns is one row with a null key; it belongs to the root. Per node: its least member
    (conv_id), that of its parent (null for the root), how many conversations have it, its children, the childless
    nodes under it (itself included), the bytes that storing each node's last turn once saves in its subtree, and the
    SHA-256 of the comma-joined ids of the conversations that end there. An empty table has no nodes. The ids of a
    node are hashed in order by one task, which gets them in texts of 65,536 ids; a task holds a shard.
    """
    rows = stored(sequences.select("conv_id", "pos", "key", "size"), "sequences")
    walk = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "key", "size")
    total = rows.count()
    hot = max(LEAST_HOT, total // HOT_NODES)
    top = stored(walk.mapInArrow(_chain, _ROW_SQL).groupBy("node").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("size").alias("size")).where((F.col("n_convs") > hot) | (F.col("depth") == 0)),
        "trie-top")
    # At most HOT_NODES digests, the same at every size of the input.
    names = frozenset(bytes(r["node"]) for r in top.select("node").collect())
    below = walk.mapInArrow(partial(_below, top=names), f"{_ROW_SQL}, shard binary")
    shards = below.repartition(1 + total // SHARD_ROWS, "shard").select("node", "parent", "depth", "size", "conv_id", "ends")
    nodes = stored(shards.mapInArrow(_shard, NODES), "trie-nodes")
    under = nodes.where("below_top").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("below_children"), F.sum("n_leaves").alias("below_leaves"),
        F.sum("saved_tokens").alias("below_saved"))
    hashes = _ends_hashes(walk.mapInArrow(partial(_ends_in, top=names), "node binary, conv_id long"))
    none = hashlib.sha256().hexdigest()
    summed = top.join(under, "node", "left").join(hashes, "node", "left").na.fill(
        0, ["below_children", "below_leaves", "below_saved"]).na.fill(none, ["ends_sha256"])
    peak = stored(summed.repartition(1).mapInArrow(_top, NODES), "trie-peak")
    of_top = peak.select(F.col("node").alias("parent"), F.col("conv_id").alias("from_top"))
    linked = nodes.join(F.broadcast(of_top), "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "from_top"))
    return linked.select(*nodes.columns).unionByName(peak)
