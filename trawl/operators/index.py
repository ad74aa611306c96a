"""Inverted index build: corpus -> texts, docs, postings, term statistics, document terms.

postings is long format, one row per (term, doc_id), never a nested map: a hot term
is many rows spread over many tasks, not one giant row.

`postings_table` groups tokens by (term, doc_id); the tokens of a document sit in one
input row, so the map-side partial aggregation already collapses them to one row per
posting before its one exchange. The stored build (`sources.index_store`) groups the tokens
inside their row, ships them as one text per document and bucket (`bucket_postings`), deals these out by
(term_bucket, slice of doc_id) and passes that as `deal`: the same single exchange and one
sort then serve the merge of repeated documents and the bucketed write, and a term that is in
a third of all documents is spread over all slices.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.expr import let
from trawl.functions.text import analyze, go_lower, kept_words, lower_text, term_count, with_stem
from trawl.functions.words import packed_rows


def docs_table(corpus: DataFrame) -> DataFrame:
    """Document metadata: doc_id, url, title, length (index-term count), clean_text."""
    return corpus.select("doc_id", "url", "title", term_count(F.col("clean_text")).alias("length"), "clean_text")


def postings_table(corpus: DataFrame, deal=None, unique: bool = False) -> DataFrame:
    """term, doc_id, frequency, first_pos, positions (ascending, 0-based), in_title.

    Positions are offsets in the kept-token list. in_title says whether the term is a
    substring of the lower-cased title; it is computed here, where title and tokens
    share a row, so ranked search needs no docs join before its top-k.
    ``deal``: partitions rows of (doc_id, term_bucket) for its ``buckets`` and adds the columns it
    partitioned by (kept as leading columns); rows of one posting must stay together. ``unique``: no doc_id (null is one)
    is in two rows, as the caller has found out, so no rows need to be merged.
    """
    if deal is not None:
        rows, added = _dealt(bucket_postings(corpus, deal.buckets), deal)
        return (_parsed if unique else _merged)(_unpacked(rows, [BUCKET, *added]), [BUCKET, *added])
    # Stemming never changes how many tokens are kept, so positions are taken from the
    # kept (unstemmed) words; each token is then stemmed by codegen'd scalar projections.
    tok = corpus.select("doc_id", go_lower(F.col("title")).alias("title_lc"),
                        F.posexplode(kept_words(F.col("clean_text"))).alias("pos", "word"))
    tok = with_stem(tok, "word", "term")
    tok = tok.select("doc_id", "pos", "term", (F.instr(F.col("title_lc"), F.col("term")) > 0).alias("in_title"))
    return (tok.groupBy("term", "doc_id")
            .agg(F.count(F.lit(1)).cast("int").alias("frequency"),
                 F.min("pos").alias("first_pos"),
                 F.array_sort(F.collect_list("pos")).alias("positions"),
                 F.bool_or("in_title").alias("in_title")))


def _runs(a, key: str, out):
    """Array ``a`` of structs, sorted by field ``key``: ``out(first, run)`` of each run of equal keys."""
    starts = F.filter(F.transform(a, lambda x, i: i),
                      lambda i: (i == 0) | (F.get(a, i)[key] != F.get(a, i - 1)[key]))
    return let(starts, lambda s: F.transform(s, lambda b, k: out(
        F.get(a, b), F.slice(a, b + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - b))))


def _term_runs(tokens):
    """Tokens (structs of term and pos, and fields that follow from the term) sorted by term: structs of term,
    positions (joined by blanks) and these fields."""
    return let(tokens, lambda a: _runs(a, "term", lambda first, run: first.dropFields("pos").withField(
        "positions", F.array_join(F.transform(run, lambda x: x["pos"].cast("string")), " "))))


def document_postings(corpus: DataFrame) -> DataFrame:
    """doc_id, term, positions (joined by blanks), in_title: a row per input row and term; nothing is shuffled.

    The tokens of a text are sorted by (term, position); each run of a term is a slice of them.
    """
    tokens = F.array_sort(F.transform(analyze(F.col("clean_text")), lambda t, i: F.struct(t.alias("term"), i.alias("pos"))))
    rows = corpus.select("doc_id", go_lower(F.col("title")).alias("title_lc"), F.inline(_term_runs(tokens)))
    return rows.select("doc_id", "term", "positions", (F.instr("title_lc", F.col("term")) > 0).alias("in_title"))


def bucket_postings(corpus: DataFrame, buckets: int) -> DataFrame:
    """doc_id, term_bucket, packed: the rows of `document_postings` as one short text per input row and bucket.

    A line is a term, a blank and its positions, then "+" where the term is in the title and "?" where there is no title;
    a term holds no white space. Words are analysed in Arrow tasks, as arrays of structs cost six times as much; Spark
    lower-cases the texts."""
    read = corpus.select("doc_id", lower_text(F.col("clean_text")).alias("lowered"), F.make_valid_utf8(
        go_lower(F.col("title"))).alias("title_lc"))
    schema = f"doc_id {corpus.schema['doc_id'].dataType.simpleString()}, rows array<struct<{BUCKET}: int, packed: string>>"
    return read.mapInArrow(partial(packed_rows, buckets=buckets), schema).select("doc_id", F.inline("rows"))


def _unpacked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `document_postings` (and ``keys``) from those of `bucket_postings`."""
    lines = rows.select(*keys, "doc_id", F.explode(F.split("packed", "\n")).alias("line"))
    term = F.substring_index("line", " ", 1)
    return lines.select(*keys, "doc_id", term.alias("term"),
                        F.rtrim(F.substr("line", F.length(term) + 2), F.lit("+?")).alias("positions"),
                        F.when(~F.endswith("line", F.lit("?")), F.endswith("line", F.lit("+"))).alias("in_title"))


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Postings of rows of `document_postings`: the rows of a repeated document become one, whatever their number.

    The window needs the rows sorted by bucket, term, the other keys and document, as the bucketed write and
    `with_block_stats` do: one sort serves all.
    """
    same = Window.partitionBy(*keys[:1], "term", *keys[1:], "doc_id").orderBy("positions")
    all_rows = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = rows.select(
        *keys, "term", "doc_id", "positions", F.row_number().over(same).alias("nth"),
        F.collect_list("positions").over(all_rows).alias("rows"),
        F.max("in_title").over(all_rows).alias("in_title")).where("nth = 1")
    positions = F.when(F.size("rows") == 1, _numbers("positions")).otherwise(
        F.array_sort(_numbers(F.array_join("rows", " "))))
    return _with_frequency(merged.select(*keys, "term", "doc_id", positions.alias("positions"), "in_title"), keys)


def _parsed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Postings of rows of `document_postings` where no document is repeated."""
    return _with_frequency(rows.withColumn("positions", _numbers("positions")), keys)


def _numbers(text) -> Column:
    return F.split(text, " ").cast("array<int>")


def _with_frequency(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys, "term", "doc_id", F.size("positions").alias("frequency"),
                       F.get("positions", F.lit(0)).alias("first_pos"), "positions", "in_title")


def term_stats(postings: DataFrame) -> DataFrame:
    """Document frequency per term: term, doc_count (postings hold one row per doc)."""
    keys = ["term", BUCKET] if BUCKET in postings.columns else ["term"]
    return postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("doc_count"))


# Stored indexes split postings and term_stats into hash buckets of the term (a Parquet
# partition column), so joins on the term can prune whole buckets; docs and document terms
# are split the same way by document. A stored index records the counts it was written with.
BUCKET = "term_bucket"
DOC_BUCKET = "doc_bucket"
TEXT_PART = "text_part"
# Documents are dealt into blocks by hash; a stored index holds, per term and block, the greatest weight of a
# posting (its contribution to a score but for idf), so ranked search can leave out blocks that cannot matter.
DOC_BLOCK = "doc_block"
SLICE = "term_slice"


def term_bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def doc_bucket(doc_id, buckets: int):
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def doc_block(doc_id, blocks: int):
    return F.pmod(F.xxhash64(doc_id, F.lit(5)), F.lit(blocks)).cast("int")


# Boosts of the ranking formula (fixed values).
POSITION_BOOST = 1.2      # first occurrence before this position ...
POSITION_LIMIT = 100      # ... gets the boost
TITLE_BOOST = 1.5         # term is a substring of the lower-cased title


def posting_weight():
    """What a posting adds to the score of its document per unit of idf."""
    return (F.col("frequency") * F.when(F.col("first_pos") < POSITION_LIMIT, POSITION_BOOST).otherwise(1.0)
            * F.when(F.col("in_title"), TITLE_BOOST).otherwise(1.0))


def _dealt(rows: DataFrame, deal) -> tuple[DataFrame, list[str]]:
    """(rows as ``deal`` partitions them, the columns it adds); without one the rows as they are."""
    if deal is None:
        return rows, []
    dealt = deal(rows)
    return dealt, [c for c in dealt.columns if c not in rows.columns]


def block_stats(postings: DataFrame, blocks: int, deal=None) -> DataFrame:
    """Per term and document block: term, doc_block, doc_count, best (greatest `posting_weight`).

    ``deal``: as for `postings_table`; rows of one block must stay together."""
    keys = ["term", BUCKET] if BUCKET in postings.columns else ["term"]
    rows, added = _dealt(postings.select(*keys, doc_block(F.col("doc_id"), blocks).alias(DOC_BLOCK),
                                         posting_weight().alias("weight")), deal)
    return rows.groupBy(*added, *keys, DOC_BLOCK).agg(F.count(F.lit(1)).alias("doc_count"), F.max("weight").alias("best"))


# Columns of stored postings: on the first posting of a term in a document block its block_stats, else null.
BLOCK_DOCS, BLOCK_BEST = "block_doc_count", "block_best"


def with_block_stats(postings: DataFrame) -> DataFrame:
    """Dealt postings with the columns of block_stats on the first posting of each term and block.

    A deal by document blocks has all postings of a term in a block in one task, sorted by term and block."""
    block = Window.partitionBy(BUCKET, "term", SLICE, DOC_BLOCK).orderBy("doc_id")
    rows = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.col("nth") == 1
    return (postings.withColumn("weight", posting_weight())
            .select("*", F.row_number().over(block).alias("nth"), F.count(F.lit(1)).over(rows).alias("n"),
                    F.max("weight").over(rows).alias("best"))
            .withColumns({BLOCK_DOCS: F.when(first, F.col("n")), BLOCK_BEST: F.when(first, F.col("best"))})
            .drop("weight", "nth", "n", "best"))


def stored_block_stats(postings: DataFrame, blocks: int) -> DataFrame:
    """`block_stats` of postings that `with_block_stats` wrote: a filter, nothing is shuffled."""
    return postings.where(F.col(BLOCK_DOCS).isNotNull()).select(
        "term", BUCKET, doc_block(F.col("doc_id"), blocks).alias(DOC_BLOCK), F.col(BLOCK_DOCS).alias("doc_count"),
        F.col(BLOCK_BEST).alias("best"))


@dataclass
class Index:
    """An inverted index: document table + postings (+ derived tables of a stored index).

    `complete` says that every posting's document has a docs row (a build of this package
    guarantees it); otherwise ranked search checks it before ranking.
    """

    docs: DataFrame
    postings: DataFrame
    _term_stats: DataFrame | None = None
    term_buckets: int = 0
    doc_buckets: int = 0
    _texts: DataFrame | None = None
    _doc_terms: DataFrame | None = None
    complete: bool = False
    doc_blocks: int = 0
    _block_stats: DataFrame | None = None

    @property
    def block_stats(self) -> DataFrame:
        return self._block_stats if self._block_stats is not None else block_stats(self.postings, self.doc_blocks)

    @property
    def term_stats(self) -> DataFrame:
        return self._term_stats if self._term_stats is not None else term_stats(self.postings)

    @property
    def bucketed(self) -> bool:
        return BUCKET in self.postings.columns

    @property
    def term_keys(self) -> list[str]:
        return ["term", BUCKET] if self.bucketed else ["term"]

    def keyed(self, small: DataFrame) -> DataFrame:
        """Add the bucket column to a small term-keyed frame when the index is bucketed."""
        return small.withColumn(BUCKET, term_bucket(F.col("term"), self.term_buckets)) if self.bucketed else small

    def by_doc(self, table: DataFrame, small: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        """(table, small frame, join keys) for a join on doc_id; where the table is split
        by document, the join also matches the bucket."""
        if DOC_BUCKET in table.columns:
            return table, small.withColumn(DOC_BUCKET, doc_bucket(F.col("doc_id"), self.doc_buckets)), [
                "doc_id", DOC_BUCKET]
        return table, small, ["doc_id"]

    @property
    def doc_terms(self) -> DataFrame:
        """doc_id, terms (array of term and df), one row per document, for suggestions."""
        if self._doc_terms is not None:
            return self._doc_terms
        return document_terms(self.postings.select("doc_id", "term"), self.term_stats.select("term", "doc_count"))

    def with_text(self, ranked: DataFrame) -> DataFrame:
        """Add clean_text to rows that hold doc columns; stored texts are joined on the
        part they were written in, so only the parts of these documents are read."""
        if self._texts is None:
            return ranked.join(self.docs.select("doc_id", "clean_text"), "doc_id")
        return ranked.join(self._texts.select("doc_id", TEXT_PART, "clean_text"), ["doc_id", TEXT_PART])

    @property
    def doc_columns(self) -> list[str]:
        return ["url", "title", *([TEXT_PART] if self._texts is not None else [])]

    def doc_count(self):
        """N as a scalar subquery column (no driver round trip, no cross join)."""
        return self.docs.select(F.count(F.lit(1))).scalar()


def document_terms(pairs: DataFrame, stats: DataFrame, keys: tuple[str, ...] = ("term",), deal=None) -> DataFrame:
    """(doc_id, term) pairs -> one row per document with its distinct terms and their df.

    ``deal``: as for `postings_table`; rows of one document must stay together."""
    rows, added = _dealt(pairs.join(stats, list(keys)).select("doc_id", "term", "doc_count"), deal)
    return rows.groupBy(*added, "doc_id").agg(F.collect_list(F.struct("term", F.col("doc_count").alias("df"))).alias("terms"))


def build_index(corpus: DataFrame) -> Index:
    """Lazy index over a corpus; `build_and_write_index` + `read_index` materialise one."""
    return Index(docs=docs_table(corpus), postings=postings_table(corpus), complete=True)


def doc_lengths(index: Index) -> DataFrame:
    return index.docs.select("doc_id", "length")


def index_stats(index: Index) -> DataFrame:
    """total_terms (distinct terms), total_documents: one row."""
    spark = index.docs.sparkSession
    return spark.range(1).select(
        index.term_stats.select(F.count(F.lit(1))).scalar().alias("total_terms"),
        index.docs.select(F.count(F.lit(1))).scalar().alias("total_documents"),
    )


def index_stats_ext(index: Index) -> DataFrame:
    """index_stats plus total_postings and total_positions (instead of a size string)."""
    spark = index.docs.sparkSession
    p = index.postings.agg(F.count(F.lit(1)).alias("n"), F.sum("frequency").alias("f"))
    return spark.range(1).select(
        index.term_stats.select(F.count(F.lit(1))).scalar().alias("total_terms"),
        index.docs.select(F.count(F.lit(1))).scalar().alias("total_documents"),
        p.select("n").scalar().alias("total_postings"),
        p.select(F.col("f").cast("bigint")).scalar().alias("total_positions"),
    )


def stopword_share(corpus: DataFrame) -> DataFrame:
    """Per document: words after the punctuation trim, how many were empty, stop words, kept."""
    from trawl.functions.text import is_stop_word, trimmed_words

    w = trimmed_words(F.col("clean_text"))
    return corpus.select(
        "doc_id",
        F.size(w).alias("n_words"),
        F.size(F.filter(w, lambda x: x == "")).alias("n_empty"),
        F.size(F.filter(w, lambda x: is_stop_word(x))).alias("n_stop"),
        F.size(F.filter(w, lambda x: (x != "") & ~is_stop_word(x))).alias("n_kept"),
    )
