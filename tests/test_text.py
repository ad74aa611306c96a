"""Term analysis: stemmer golden rows, stop words, punctuation, query splitting."""

from pyspark.sql import functions as F

from trawl.functions.text import analyze, query_words, stem

# (input word, stem) derived by hand from the four suffix steps.
GOLDEN = [
    ("ponies", "poni"), ("caresses", "caress"), ("running", "runn"),
    ("king", "k"), ("ing", ""), ("ate", ""),
    ("als", ""), ("agreed", "agree"), ("feeds", "fee"),
    ("red", "r"), ("sized", "siz"), ("gas", "ga"),
    ("organization", "organiz"), ("rationalizations", "rationaliz"), ("ization", "iz"),
    ("relational", "relat"), ("nationals", "nat"), ("ational", "at"),
    ("hopefulness", "hopeful"), ("hopefulnes", "hopefulne"), ("callousness", "callous"),
    ("activeness", "active"), ("thes", "the"), ("ss", "ss"),
    ("é", "é"), ("éd", "éd"),
]


def test_stemmer_golden_rows(spark):
    df = spark.createDataFrame(GOLDEN, "w string, want string")
    got = df.select("w", "want", stem(F.col("w")).alias("got")).collect()
    assert [(r.w, r.got) for r in got] == [(r.w, r.want) for r in got]


def test_analyze_pipeline(spark):
    df = spark.createDataFrame([("The (Running) dogs, that's all!\tOrganizations ing",)], "t string")
    (terms,) = df.select(analyze(F.col("t"))).first()
    # "the", "all" are stop words; "that's" trims to "that's" (not a stop word) -> "that'";
    # "ing" stems to the empty term, which is kept.
    assert terms == ["runn", "dog", "that'", "organiz", ""]


def test_analyze_null_and_blank(spark):
    df = spark.createDataFrame([(None,), ("   ",), ("a an the",)], "t string")
    assert [r[0] for r in df.select(analyze(F.col("t"))).collect()] == [[], [], []]


def test_query_words_keep_stop_words_and_case_folds(spark):
    df = spark.createDataFrame([("That HAT  de de",), ("",)], "q string")
    assert [r[0] for r in df.select(query_words(F.col("q"))).collect()] == [["that", "hat", "de", "de"], []]


def test_lower_is_rune_wise(spark):
    df = spark.createDataFrame([("İSTANBUL ΟΔΟΣ",)], "t string")
    assert df.select(query_words(F.col("t"))).first()[0] == ["istanbul", "οδοσ"]
