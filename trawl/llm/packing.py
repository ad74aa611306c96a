"""Packing of documents into fixed windows by lexical retrieval.

Each input partition is read in shards of bounded text. A shard is tokenised and indexed (an inverted
index from token id to documents, BM25 weights of the shard), and its windows are filled greedily: a
seed document opens a window, its best-scoring unused neighbours follow, and the last one is cut where
the window ends; what is left of it stays available. Documents are never sent over the network:
sharding follows the input splits, so packing is one pass without a shuffle, and a lost task repeats
exactly its own shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trawl.llm.tokenizers_io import load_ranks, load_tokenizer, special_strings

WINDOW = 1024
SHARD_CHARS = 8 << 20   # a shard closes once its texts reach this many characters
QUERY_TERMS = 12        # a seed's terms with the highest BM25 weight form its query
K1, B = 1.2, 0.75       # BM25
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, padded long")


def encode(text: str, json_path: str, ranks_path: str | None) -> np.ndarray:
    """Token ids of one text, then id 0.

    With a rank file of the same vocabulary, texts without special strings take the faster library;
    ids are the same (tests/llm compares both over every code point).
    """
    if ranks_path and not any(s in text for s in special_strings(json_path)):
        ids = load_ranks(ranks_path).encode_ordinary(text)
    else:
        ids = load_tokenizer(json_path).encode(text, add_special_tokens=False).ids
    return np.array([*ids, 0], dtype="<u4")


class ShardIndex:
    """Inverted BM25 index over the token ids of one shard's documents."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        owner = np.repeat(np.arange(n, dtype=np.uint64), lengths)
        keys = np.sort((owner << np.uint64(32)) | np.concatenate(docs).astype(np.uint64))
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        tf = np.diff(np.append(first, len(keys))).astype(np.float32)
        doc = (keys[first] >> np.uint64(32)).astype(np.int64)
        term = (keys[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.doc_start = np.searchsorted(doc, np.arange(n + 1))
        by_term = np.argsort(term, kind="stable")
        vocab, starts = np.unique(term[by_term], return_index=True)
        df = np.diff(np.append(starts, len(term)))
        idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        slot = np.searchsorted(vocab, term)
        weight = idf[slot] * tf * (K1 + 1) / (tf + norm[doc].astype(np.float32))
        self.slots, self.own_weight = slot, weight
        self.starts = np.append(starts, len(term))
        self.docs, self.weights = doc[by_term], weight[by_term]
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document of the shard for the seed's strongest terms."""
        a, b = self.doc_start[seed], self.doc_start[seed + 1]
        slots = self.slots[a:b]
        if len(slots) > QUERY_TERMS:
            slots = slots[np.argsort(-self.own_weight[a:b], kind="stable")[:QUERY_TERMS]]
        out = np.zeros(self.n, dtype=np.float32)
        for t in slots:
            s, e = self.starts[t], self.starts[t + 1]
            out[self.docs[s:e]] += self.weights[s:e]
        return out


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) that cover every id of every document once.

    A document longer than the window first fills whole windows alone. The rest of each document, in
    order, seeds a window unless it was used as a neighbour before; ties in score go to the earlier
    document, and documents without a common term follow in their order.
    """
    start = np.zeros(len(docs), dtype=np.int64)
    for d, ids in enumerate(docs):
        while len(ids) - start[d] >= window:
            yield [(d, int(start[d]), window)]
            start[d] += window
    left = np.array([len(ids) for ids in docs]) - start
    index = ShardIndex(docs) if np.count_nonzero(left) > 1 else None
    free = left > 0
    for seed in range(len(docs)):
        if free[seed]:
            take = [(seed, int(start[seed]), int(left[seed]))]
            room, free[seed] = window - left[seed], False
            scores = None
            while room and free.any():
                if scores is None:
                    scores = np.where(free, index.scores(seed), np.float32(-1))
                d = int(np.argmax(scores))
                n = int(min(room, left[d]))
                take.append((d, int(start[d]), n))
                start[d], left[d], room, scores[d] = start[d] + n, left[d] - n, room - n, -1
                free[d] = left[d] > 0
            yield take


def padded_length(n: int, window: int = WINDOW) -> int:
    """The last window of a shard is padded to a power of two only (at most the window)."""
    return min(window, 1 << max(0, n - 1).bit_length())


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, window: int = WINDOW,
         shard_chars: int = SHARD_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers. Null and empty
    texts have the single id 0; null ids stay null; repeated rows are packed like any other; an empty
    table gives no rows; other columns are not read. A text longer than a shard forms its own.
    """

    def run(batches):
        part, sequence = TaskContext.get().partitionId(), 0

        def shards():
            names, texts, size = [], [], 0
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = text.as_py() or ""
                    names.append(name)
                    texts.append(encode(text, json_path, ranks_path))
                    size += len(text)
                    if size >= shard_chars:
                        yield names, texts
                        names, texts, size = [], [], 0
            if names:
                yield names, texts

        for names, ids in shards():
            rows: list[tuple] = []
            for pieces in pack_shard(ids, window):
                offset, total = 0, padded_length(sum(n for _, _, n in pieces), window)
                for d, s, n in pieces:
                    rows.append((names[d], s, n, ids[d][s:s + n].tobytes(), len(ids[d]),
                                 (part << 32) | sequence, offset, total))
                    offset += n
                sequence += 1
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
        run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
