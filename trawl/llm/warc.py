"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing. A record is its header lines, a blank line, its block and two line breaks, so the text writer with that
end as its line separator writes an archive per task, under Spark's own commit protocol. Records of equal
payloads of at least ``LEAST_SHARED`` bytes are one response (that of the largest id) and revisits of it.

Reading. Archives are cut into byte ranges as any text, and a range is read as the stretches between magics. Each
stretch may be a record, whose header names where its successor begins. A task emits these (record, successor)
offsets, and follows them by pointer jumping to where they leave its range. Ranges are placed by sums of their
lengths, and pointer jumping over ranges, from the start of each file, tells at which offset the true chain enters
each one. Only records on this chain are read; a magic inside a payload is on no chain. A record that ends in
another range is read by the task of the range in which it begins: what stands before the entry of a range belongs
to the range that the chain came from. Offsets of records are those of the byte after their magic. (Blank lines would
not do as separators: runs of line breaks are cut differently from different starts.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored, text_or_empty

LEAST_SHARED = 1000                    # bytes of a payload that may be revisited
DATE = "1970-01-01T00:00:00Z"          # pages carry no fetch time
FREQUENT = 1000                        # a payload with more than this part (1/n) of all records is frequent
BATCH_BYTES = 8 << 20
PACK_BYTES = 128 << 10                 # bytes of an archive that are moved as one row, about
HEADER_BYTES = 1 << 20

# Fixed values of the format.
MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ID = "urn:page:"

_LENGTH = re.compile(rb"(?:^|\r\n)(?i:content-length):[ \t]*(\d{1,18})[ \t]*(?=\r\n|\Z)")
_AFTER = len(END) + len(MAGIC)         # bytes from the end of a block to the successor's offset


# ---------------------------------------------------------------- writing

def revisits(rows: DataFrame) -> DataFrame:
    """(page_id, digest, keep): the pages (of page_id, digest, size) that repeat the payload of the page ``keep``.

    The join to the payloads that several pages share goes by digest; a payload of more than one
    ``FREQUENT``-th of the rows (so fewer than that many payloads) is looked up by broadcast instead.
    """
    rows = rows.where(F.col("size") >= LEAST_SHARED).select("page_id", "digest")
    total = rows.select(F.count(F.lit(1))).scalar()
    groups = stored(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keep"))
                    .where("n > 1 AND keep IS NOT NULL").select("digest", "keep", (F.col("n") * FREQUENT > total).alias("hot")),
                    "payloads")
    met = rows.join(F.broadcast(groups.where("hot").select("digest", F.col("keep").alias("often"))), "digest", "left")
    rest = met.where("often IS NULL").drop("often").join(groups.where("NOT hot").select("digest", "keep"), "digest")
    found = met.where("often IS NOT NULL").select("digest", "page_id", F.col("often").alias("keep")).unionByName(rest)
    return found.where(F.col("page_id").isNull() | (F.col("page_id") < F.col("keep"))).distinct()


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> None:
    """A record per row, in archives under ``path`` (one file per task).

    A null payload is empty; a row without id, or without URL, lacks that header (the id stays empty); line
    breaks in a URL are percent-encoded; of repeated rows with the largest id all are responses; rows without id
    are revisits of a row with one; an empty table gives no record; other columns are not read.
    """
    payload = text_or_empty(payload_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumns({
                            "size": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary"))})
    again = stored(revisits(rows), "revisits").withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    met = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    revisit = F.col("keep").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit(END))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.when(revisit, F.col("http")).otherwise(F.concat("http", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda c: F.coalesce(c, F.lit(""))
    record = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), optional(F.col("page_id").cast("string")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)), optional(line("WARC-Target-URI", url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        optional(F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("keep"), F.lit(">"))),
                                          line("WARC-Profile", F.lit(PROFILE))))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END), "block")
    met.withColumn("http", http).withColumn("block", block).select(record.alias("value")).write.option(
        "lineSep", END).text(path)


# ---------------------------------------------------------------- boundaries

def _stretches(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, in the order of the file within each (file, block)."""
    return spark.read.option("lineSep", MAGIC.decode()).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))


def _by_range(batches: Iterator[pa.RecordBatch]):
    """Batches cut where the (file, block) changes: (file, block, batch, whether a range begins)."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch["file"].dictionary_encode().indices.to_numpy(zero_copy_only=False)
        blocks = batch["block"].to_numpy()
        edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            key = (batch["file"][lo].as_py(), int(blocks[lo]))
            yield *key, batch.slice(lo, hi - lo), key != last
            last = key


def _offsets(values: pa.Array, begin: int) -> np.ndarray:
    """Where each stretch begins, and last where the next one does."""
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + len(MAGIC)
    return begin + np.concatenate([[0], np.cumsum(sizes)])


def header_of(value: bytes) -> tuple[int, int] | None:
    """(where the block begins, its length) of the record that ``value`` is after its magic; null if it is none."""
    upto = value.find(END.encode())
    length = _LENGTH.search(value, 0, upto) if upto >= 0 else None
    return (upto + len(END), int(length[1])) if length else None


def chain_exits(starts: np.ndarray, after: np.ndarray, end: int) -> np.ndarray:
    """Where the chain from each record leaves a range that ends at ``end``; -1 if it meets no record inside."""
    if not len(starts):
        return after
    to = np.minimum(np.searchsorted(starts, after), len(starts) - 1)
    hit = starts[to] == after
    jump = np.where(hit, to, np.arange(len(starts)))
    for _ in range(len(starts).bit_length()):
        jump = jump[jump]
    return np.where(after[jump] >= end, after[jump], -1)


_CANDIDATES = "file string, block long, start long, exit long, size long"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range a row with its size (start null), and a row per possible record; offsets within the range."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("exit", pa.int64()),
                        ("size", pa.int64())])
    file = block = None
    size, found = 0, []

    def done():
        pairs = np.array(found, np.int64).reshape(-1, 2)
        n = len(pairs)
        starts = pa.array([None, *pairs[:, 0].tolist()], pa.int64())
        exits = pa.array([None, *chain_exits(pairs[:, 0], pairs[:, 1], size).tolist()], pa.int64())
        sizes = pa.array([size, *[None] * n], pa.int64())
        return pa.record_batch([pa.array([file] * (n + 1), pa.string()), pa.array([block] * (n + 1), pa.int64()), starts,
                                exits, sizes], schema=schema)

    for f, b, part, begins in _by_range(batches):
        if begins:
            if file is not None:
                yield done()
            file, block, size, found = f, b, 0, []
        at = _offsets(part["value"], size)
        for a, value in zip(at.tolist(), part["value"].to_pylist()):
            if head := header_of(value):
                found.append((a, a + sum(head) + _AFTER))
        size = int(at[-1])
    if file is not None:
        yield done()


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, base, entry, before) per range: its offset, that of the first true record in it (null: none),
    and the block from which the chain came."""
    found = stored(_stretches(spark, path).mapInArrow(_candidates, _CANDIDATES), "warc-candidates")
    order = Window.partitionBy("file").orderBy("block")
    ranges = stored(found.where("start IS NULL").select("file", "block", F.coalesce(F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")), "warc-ranges")
    placed = found.where("start IS NOT NULL").join(ranges, ["file", "block"]).select(
        "file", "block", (F.col("base") + F.col("start")).alias("at"),
        F.when(F.col("exit") >= 0, F.col("base") + F.col("exit")).alias("to"))
    begins = ranges.select("file", F.lit(len(MAGIC)).cast("long").alias("at")).distinct()
    entered = placed.where("to IS NOT NULL").select("file", F.col("to").alias("at")).union(begins).distinct()
    doors = stored(placed.join(entered, ["file", "at"], "left_semi"), "warc-doors")
    # After k rounds ``reached`` holds the chain's first 2^k doors, and ``jump`` leads 2^k doors on.
    reached, jump = stored(begins, "warc-reached"), doors.where("to IS NOT NULL").select("file", "at", "to")
    n = reached.count()
    while n:
        grown = stored(reached.union(reached.join(jump, ["file", "at"]).select("file", "to")).distinct(), "warc-reached")
        now = grown.count()
        if now == n:
            break
        on = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = stored(jump.join(on, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "warc-jumps")
        reached, n = grown, now
    true = doors.join(reached, ["file", "at"], "left_semi").groupBy("file", "block").agg(F.min("at").alias("entry"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return stored(ranges.join(true, ["file", "block"], "left").select(
        "file", "block", "base", "entry",
        F.last(F.when(F.col("entry").isNotNull(), F.col("block")), ignorenulls=True).over(earlier).alias("before")),
        "warc-entries")


# ---------------------------------------------------------------- records

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each range in compressed rows of about ``PACK_BYTES``: (file, block, size, at, upto, packed)."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("at", pa.int64()),
                        ("upto", pa.int64()), ("packed", pa.binary())])
    size = 0
    for file, block, part, begins in _by_range(batches):
        at = _offsets(part["value"], 0 if begins else size)
        size, rows, lo = int(at[-1]), [], 0
        while lo < part.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PACK_BYTES)))
            raw = MAGIC.join([*part["value"][lo:hi].to_pylist(), b""])
            rows.append((file, block, part["size"][lo].as_py(), int(at[lo]), int(at[min(hi, part.num_rows)]),
                         len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)))
            lo = hi
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def parsed_headers(value: bytes) -> dict[str, str]:
    """Header names (lower case) and values; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for line in value.decode("utf-8", "replace").split("\r\n"):
        name, colon, said = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), said.strip())
    return out


RECORDS = ("file string, offset long, type string, record_id string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary")
_RECORD_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.binary())


def _record(file: str, offset: int, head: bytes, block: bytes) -> tuple:
    """A row of ``RECORDS``; the payload of a revisit is null, its size is the one its HTTP header names."""
    warc = parsed_headers(head)
    http, gap, payload = block.partition(END.encode())
    if not gap or not warc.get("content-type", "").startswith("application/http"):
        http, payload = b"", block
    size = parsed_headers(http).get("content-length", "")
    kind = warc.get("warc-type")
    own = (None, int(size) if size.isdigit() else None) if kind == "revisit" else (payload, len(payload))
    return (file, offset, kind, warc.get("warc-record-id"), warc.get("warc-target-uri"), warc.get("warc-refers-to"),
            warc.get("warc-payload-digest"), own[1], own[0])


def _next_record(data: bytearray, at: int, begin: int, size: int):
    """The record after the magic that ends at ``at``: (end of header, end), "more" if ``data`` ends before it, or
    None where no record is. ``data`` begins at ``begin`` in a file of ``size`` bytes."""
    if at >= len(MAGIC) and data[at - len(MAGIC):at] != MAGIC:
        return None
    upto = data.find(END.encode(), at)
    if upto < 0:
        return "more" if len(data) - at < HEADER_BYTES else None
    length = _LENGTH.search(data, at, upto)
    if not length or data.find(MAGIC, at, upto) >= 0:
        return None
    end = upto + len(END) + int(length[1])
    if begin + end > size:
        return None
    return (upto, end) if end <= len(data) else "more"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the packed rows, which come in order for each (file, owner); one record is held at a time."""
    rows, held, key, want, begin = [], 0, None, 0, 0
    data = bytearray()
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_TYPES)], names)

    for batch in batches:
        for file, owner, a, packed, first, stop, size in zip(*[batch[c].to_pylist() for c in (
                "file", "owner", "offset", "packed", "first", "stop", "size")]):
            if (file, owner) != key:
                key, want, begin, data = (file, owner), first, a, bytearray()
            if want is None:
                continue
            data += pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
            while True:
                if stop is not None and want >= stop:
                    want = None  # the next range reads on
                    break
                if want - begin > len(data):
                    break
                found = _next_record(data, want - begin, begin, size)
                if found == "more":
                    break
                if found is None:
                    want = None  # the chain ends
                    break
                upto, end = found
                rows.append(_record(file, want, bytes(data[want - begin:upto]), bytes(data[upto + len(END):end])))
                held += end + len(END) - (want - begin)
                want = begin + end + _AFTER
                if held >= BATCH_BYTES:
                    yield flush()
                    rows, held = [], 0
            if want is not None:  # keep what the next record begins with, and the magic before it
                drop = min(len(data), max(0, want - len(MAGIC) - begin))
                del data[:drop]
                begin += drop
    if rows:
        yield flush()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records on the chain from the start of each file under ``path`` (rows of ``RECORDS``).

    A file whose chain breaks (a cut-off record, bytes that are no record, a header over ``HEADER_BYTES``) gives the
    records before the break. A task holds the possible records of a byte range, and one record whole. The bytes
    are moved once, compressed, to the task of their range; a row that holds the entry of its range goes also to
    the task of the range before it.
    """
    packed = _stretches(spark, path).mapInArrow(
        _packed, "file string, block long, size long, at long, upto long, packed binary")
    met = packed.join(entries(spark, path), ["file", "block"])
    begins, ends = F.col("base") + F.col("at"), F.col("base") + F.col("upto")
    none = F.lit(None).cast("long")
    to_own = F.when(ends > F.col("entry"), F.struct(F.col("block").alias("owner"), F.col("entry").alias("first"), none.alias("stop")))
    to_before = F.when(F.col("before").isNotNull() & (F.col("entry").isNull() | (begins < F.col("entry"))), F.struct(
        F.col("before").alias("owner"), none.alias("first"), F.col("entry").alias("stop")))
    owned = met.select("file", "size", begins.alias("offset"), "packed", F.explode(F.array_compact(F.array(
        to_own, to_before))).alias("to")).select("file", "to.*", "offset", "packed", "size")
    return owned.repartition("file", "owner").sortWithinPartitions("file", "owner", "offset").mapInArrow(_read, RECORDS)


def page_rows(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that `write_archive` wrote; the
    digest of a response is that of the payload as read."""
    number = lambda c: F.regexp_extract(c, f"^<{ID}(-?[0-9]+)>$", 1).try_cast("long")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes",
        F.when(F.col("type") == "revisit", F.regexp_replace("payload_digest", "^sha1:", "")).otherwise(
            F.sha1("payload")).alias("payload_digest"),
        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))
