"""Token counts without materialising ids.

1. A pass over the documents splits each text into pre-tokens. A block of documents (bounded text) is
   written as its vocabulary rows (pre-token, block, number of the word in the block) and one row of
   per-document frequencies (word numbers and counts, packed).
2. The vocabularies are shuffled by pre-token and sorted; each distinct pre-token is run through the
   BPE model once, however many blocks hold it, and only its number of pieces is kept.
3. The piece counts return to their blocks (packed per task and block), where they are joined to the
   per-document frequencies and summed.

Neither texts nor token ids are shuffled. A frequent pre-token costs one row per block, so no key
gathers more rows than there are blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored
from trawl.llm.tokenizers_io import load_tokenizer, special_strings

BLOCK_CHARS = 24 << 20  # a block closes once its texts reach this many characters
FLAT = 1_000_000        # words held unpacked at a time
BLOCK_SCHEMA = ("block long, pretoken string, word int, doc_id array<long>, n_bytes array<long>, n_words binary, "
                "words binary, freqs binary")

# Fixed value: the published pre-token pattern of this vocabulary.
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Texts with other characters go through the tokenizer's own normaliser and splitter, because letter
# classes and lower case there may follow another Unicode version.
PLAIN = regex.compile(r"[^\x00-ɏ‐-⁞]")


class _Words(dict):
    """Word -> its number in order of first use."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


@lru_cache(maxsize=1)
def _byte_letters() -> tuple[dict[int, str], dict[str, int]]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 up."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in kept}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(kept)))
    return letters, {c: b for b, c in letters.items()}


def pretokens(text: str, path: str) -> list[str]:
    """Pre-tokens of one text, special strings included as themselves."""
    out: list[str] = []
    special = special_strings(path)
    parts = regex.split("(" + "|".join(map(regex.escape, special)) + ")", text) if "<|" in text else [text]
    for part in parts:
        if part in special:
            out.append(part)
        elif not PLAIN.search(part):
            out += WORD_PATTERN.findall(part.lower())
        else:
            t, back = load_tokenizer(path), _byte_letters()[1]
            for word, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(part)):
                out.append(bytes(back[c] for c in word).decode())
    return out


def n_pieces(pretoken: str, path: str) -> int:
    """Pieces of one pre-token."""
    if pretoken in special_strings(path):
        return 1
    letters = _byte_letters()[0]
    return len(load_tokenizer(path).model.tokenize("".join(letters[b] for b in pretoken.encode())))


def packed(a: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as byte planes, compressed (small numbers cost little)."""
    planes = np.ascontiguousarray(a, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, "<u4")
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Block:
    def __init__(self, path: str):
        self.path, self.words = path, _Words()
        self.doc_id, self.n_bytes, self.n_words = [], [], []
        self.parts: list[np.ndarray] = []
        self.freqs: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id, text: str) -> None:
        found = pretokens(text, self.path)
        numbers = np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found))
        words, freqs = np.unique(numbers, return_counts=True)
        self.doc_id.append(doc_id)
        self.n_bytes.append(len(text.encode("utf-8")))
        self.n_words.append(len(words))
        self.parts.append(np.diff(words, prepend=np.uint32(0)).astype("<u4"))
        self.freqs.append(freqs.astype("<u4"))
        self.chars += len(text)

    def batches(self, block: int):
        schema = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                  pa.binary(), pa.binary()]
        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]

        def batch(n, cols):
            full = [cols.get(k, pa.nulls(n, t)) for k, t in zip(names, schema)]
            return pa.RecordBatch.from_arrays(full, names=names)

        words = list(self.words)
        for i in range(0, len(words), 100_000):
            part = words[i:i + 100_000]
            yield batch(len(part), {"block": pa.array([block] * len(part), pa.int64()), "pretoken": pa.array(part),
                                    "word": pa.array(range(i, i + len(part)), pa.int32())})
        flat = {"n_words": np.array(self.n_words), "words": np.concatenate(self.parts),
                "freqs": np.concatenate(self.freqs)}
        yield batch(1, {"block": pa.array([block], pa.int64())}
                    | {k: pa.array([v], pa.list_(pa.int64())) for k, v in (("doc_id", self.doc_id),
                                                                          ("n_bytes", self.n_bytes))}
                    | {k: pa.array([packed(v)], pa.binary()) for k, v in flat.items()})


def blocks(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Vocabulary rows and one frequency row of every block of documents."""

    def run(batches):
        part, number, block = TaskContext.get().partitionId(), 0, _Block(path)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                block.add(doc_id, text.as_py() or "")
                if block.chars >= block_chars:
                    yield from block.batches((part << 32) | number)
                    number, block = number + 1, _Block(path)
        if block.doc_id:
            yield from block.batches((part << 32) | number)

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def piece_counts(vocabulary: DataFrame, path: str) -> DataFrame:
    """(block, n, words, pieces): pieces of each word of a block, every distinct pre-token encoded once."""

    def run(batches):
        last, count = None, 0
        got: dict[int, tuple[list[int], list[int]]] = {}
        held = 0

        def flush():
            rows = [(b, len(w), packed(np.array(w)), packed(np.array(p))) for b, (w, p) in got.items()]
            got.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["block", "n", "words", "pieces"])

        for b in batches:
            for word, block, number in zip(*(b.column(i).to_pylist() for i in range(3))):
                if word != last:
                    last, count = word, n_pieces(word, path)
                words, pieces = got.setdefault(block, ([], []))
                words.append(number)
                pieces.append(count)
                held += 1
            if held >= FLAT:
                yield flush()
                held = 0
        if got:
            yield flush()

    rows = vocabulary.select("pretoken", "block", "word").repartition("pretoken").sortWithinPartitions("pretoken")
    return rows.mapInArrow(run, "block long, n int, words binary, pieces binary")


def _sum_block(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    known = [r for r in rows if r["doc_id"] is None]
    (own,) = [r for r in rows if r["doc_id"] is not None]
    pieces = np.zeros(1 + max((int(unpacked(r["words"], r["n"]).max()) for r in known), default=0), np.int64)
    for r in known:
        pieces[unpacked(r["words"], r["n"])] = unpacked(r["pieces"], r["n"])
    n_docs = len(own["doc_id"])
    n_words = unpacked(own["n_words"], n_docs).astype(np.int64)
    ends = np.cumsum(n_words)
    total = int(ends[-1])
    steps, freqs = unpacked(own["words"], total).astype(np.int64), unpacked(own["freqs"], total).astype(np.int64)
    run = np.cumsum(steps)
    before = np.concatenate(([0], run))[ends - n_words]  # the running sum where a document starts
    words = run - np.repeat(before, n_words)
    sums = np.concatenate(([0], np.cumsum(pieces[words] * freqs)))
    tokens = sums[ends] - sums[ends - n_words]
    return pa.table({"doc_id": pa.array(own["doc_id"], pa.int64()), "n_bytes": pa.array(own["n_bytes"], pa.int64()),
                     "n_tokens": pa.array(tokens, pa.int64()), "n_pretokens": pa.array(n_words, pa.int64())})


def count_tokens(docs: DataFrame, path: str, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_pretokens) of every row; n_pretokens counts distinct ones.

    Null texts count as empty (0 tokens); null ids are kept; repeated rows are counted each; an empty
    table gives no rows; other columns are not read; a very long text forms a block of its own.
    """
    read = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    written = stored(blocks(read, path, block_chars), "token-blocks")
    counts = piece_counts(written.where("pretoken IS NOT NULL"), path)
    own = written.where("pretoken IS NULL").select("block", "doc_id", "n_bytes", "n_words", "words", "freqs")
    return own.unionByName(counts, allowMissingColumns=True).groupBy("block").applyInArrow(
        _sum_block, "doc_id long, n_bytes long, n_tokens long, n_pretokens long")


def with_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
