"""Term analysis of a lower-cased text inside an Arrow task, where many words are looked up in a dict.

The rules and constants are those of `trawl.functions.text`. Tasks get these functions by value: workers need pyarrow
and xxhash, but not this package.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import pyarrow as pa
import xxhash
from pyspark import cloudpickle

from trawl.functions.text import PUNCT_CUTSET, STEM_ENDINGS, STEM_MIN_BYTES, STOP_WORDS, WS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# str.split() knows four separators more than WS.
_MORE_SEPARATORS = re.compile("[\x1c-\x1f]")
_FIELD = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m[1]:0>4}", WS).replace("[", "[^", 1))
_STOP_SET = frozenset(STOP_WORDS)


def python_words(lowered: str) -> list[str]:
    """Words of a text of `lower_text`, not yet trimmed."""
    return _FIELD.findall(lowered) if _MORE_SEPARATORS.search(lowered) else lowered.split()


def python_term(word: str) -> str | None:
    """The index term of a lower-cased word; None where the word is not kept."""
    w = word.strip(PUNCT_CUTSET)
    if not w or w in _STOP_SET:
        return None
    if not w.endswith(STEM_ENDINGS) or len(w.encode()) < STEM_MIN_BYTES:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1]
    elif w.endswith("ed"):
        w = w[:-2]
    elif w.endswith("ing"):
        w = w[:-3]
    if w.endswith("ization"):
        w = w[:-5] + "ize"
    elif w.endswith("ational"):
        w = w[:-5] + "ate"
    elif w.endswith(("fulness", "ousness", "iveness")):
        w = w[:-4]
    if w.endswith(("ize", "ate")):
        return w[:-3]
    return w[:-2] if w.endswith("al") else w


# Words whose terms a task remembers, characters of text in a batch of its rows, positions whose texts it keeps.
KNOWN_WORDS = 500_000
BATCH_CHARS = 4 << 20
SMALL_NUMBERS = 1 << 16


class _Terms(dict):
    """Word -> (bucket, term), or None where the word is not kept."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: str) -> tuple[int, str] | None:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        term = python_term(word)
        if term is not None:
            n = xxhash.xxh64_intdigest(term.encode(), seed=42)
            term = ((n - (1 << 64) if n >> 63 else n) % self.buckets, term)
        self[word] = term
        return term


def _bucket_lines(text: str, title: str | None, known: _Terms, small: list[str]) -> dict[int, list[str]]:
    """Bucket -> lines of a text's terms (see `operators.index.bucket_postings`)."""
    positions: dict[tuple[int, str], list[str]] = defaultdict(list)
    kept = [key for key in map(known.__getitem__, python_words(text)) if key is not None]
    for key, at in zip(kept, chain(small, map(str, count(len(small))))):
        positions[key].append(at)
    lines: dict[int, list[str]] = defaultdict(list)
    for (bucket, term), numbers in positions.items():
        line = f"{term} {' '.join(numbers)}"
        lines[bucket].append(f"{line}?" if title is None else f"{line}+" if term in title else line)
    return lines


def packed_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, lower-cased text, lower-cased title) as (doc_id, array of bucket and packed lines)."""
    known, small = _Terms(buckets), [str(i) for i in range(SMALL_NUMBERS)]
    for batch in batches:
        begun, chars, ends, numbers, packed = 0, 0, [0], [], []
        last = batch.num_rows - 1
        for row, (text, title) in enumerate(zip(batch.column(1), batch.column(2))):
            text = text.as_py() or ""
            for bucket, lines in _bucket_lines(text, title.as_py(), known, small).items():
                numbers.append(bucket)
                packed.append("\n".join(lines))
            ends.append(len(numbers))
            chars += len(text)
            if chars >= BATCH_CHARS or row == last:
                rows = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.string())],
                                                  names=["term_bucket", "packed"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, row + 1 - begun),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], names=["doc_id", "rows"])
                begun, chars, ends, numbers, packed = row + 1, 0, [0], [], []
