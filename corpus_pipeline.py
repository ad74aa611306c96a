"""The training-data pipeline over `documents`: each stage applies one operator to what the one before it kept.

Toxic documents go; of each SimHash group one document stays; documents that overlap the benchmark go; secrets
are masked in the texts; what remains is packed into windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trawl.llm import decontamination, packing, secrets, simhash, toxicity
from trawl.llm.common import stored, table
from trawl.llm.queries import SIMHASH_BITS, SIMHASH_SHINGLE, packing_digest
from trawl.llm.tokenizers_io import public_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, learnt from labelled rows of ``docs``, scores below its threshold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within the bit distance: the one of least id."""
    return simhash.drop_near_copies(docs, SIMHASH_BITS, SIMHASH_SHINGLE)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.mask_secrets(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of at most 1024 tokens."""
    return packing_digest(packing.pack(docs, public_path("byte_bpe_50k.json"), public_path("byte_bpe_50k.tiktoken")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

# Token ids, and a grammar learnt from labels, have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage but the last is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
