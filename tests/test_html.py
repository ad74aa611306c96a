"""HTML cleaning and titles on the edge rows of the fixtures."""

from pyspark.sql import functions as F

from trawl.functions.html import clean_text, first_title, page_title

ROWS = [
    ("<title>A</title><b>foo</b>bar", "A", "A foo bar"),
    ("<title> </title>x", "No Title", "x"),
    ('<script>var t="</p>";</script>a<!-- b -->c', "No Title", "a c"),
    ("a&amp;nbsp;b &amp;lt; &copy;", "No Title", "a b ©"),
    ("<noscript>n</noscript>a&nbsp;b", "No Title", "a b"),
    ("", "No Title", ""),
    ("<title>One</title><title> </title>z", "No Title", "One z"),
    ("<title>One</title><svg><title>Two &amp; 2</title></svg>", "Two & 2", "One Two & 2"),
    ("<p>&#233;t&#xE9; &#0; &lt;b&gt;</p>", "No Title", "été � <b>"),
    ("<STYLE type=x>p{}</STYLE ><p>k</p>", "No Title", "k"),
]


def test_clean_text_and_title(spark):
    df = spark.createDataFrame([(h,) for h, _, _ in ROWS], "html string")
    got = df.select(page_title(F.col("html")).alias("t"), clean_text(F.col("html")).alias("c")).collect()
    assert [(r.t, r.c) for r in got] == [(t, c) for _, t, c in ROWS]


def test_first_title_skips_blank(spark):
    df = spark.createDataFrame([("<title> </title><title>B</title><title>C</title>",), ("x",)], "html string")
    assert [r[0] for r in df.select(first_title(F.col("html"))).collect()] == ["B", "No Title"]


def test_null_html(spark):
    df = spark.createDataFrame([(None,)], "html string")
    r = df.select(page_title(F.col("html")), clean_text(F.col("html"))).first()
    assert tuple(r) == ("No Title", "")


# Elements that hold text only: (html, index title, clean text).
TEXT_ONLY = [
    ("<title>a<b>c</b></title>d", "a<b>c</b>", "a<b>c</b> d"),
    ("x<textarea rows=2><b>t</b> &lt;i&gt; &amp;amp;</textarea>y", "No Title", "x <b>t</b> <i> y"),
    ("x<iframe src='a>b'><p>k &eacute; &amp; m</p></iframe>y", "No Title", "x <p>k m</p> y"),
    ("<!-- <textarea> --><b>u</b><textarea>open <b>", "No Title", "u open <b>"),
    ("<script><textarea><b>s</b></textarea></script><p>v</p>", "No Title", "v"),
    ("<TITLE>T</title ><TextArea></textarea><i>w</i> a < b", "T", "T w a < b"),
    ("<xmp></xm></xmp>z<noembed><a href=q></noembed>", "No Title", "</xm> z <a href=q>"),
    ("<title>plain</title><textarea>none</textarea>", "plain", "plain none"),
]


def test_text_only_elements(spark):
    df = spark.createDataFrame([(h,) for h, _, _ in TEXT_ONLY], "html string")
    got = df.select(page_title(F.col("html")).alias("t"), clean_text(F.col("html")).alias("c")).collect()
    assert [(r.t, r.c) for r in got] == [(t, c) for _, t, c in TEXT_ONLY]


# Rows derived by hand from the HTML rules: (html, clean text, resolved links against http://h/p).
PROBES = [
    ("Canci&oacute;n &Uuml;ber", "Canción Über", []),
    ("a&ampb &notit; &copy", "a&b ¬it; ©", []),
    ('<p title="a > b">x</p>', "x", []),
    ('<a title="a > b" href="/z">k</a>', "k", ["http://h/z"]),
    ('<a title="see href=/x" href="/y">', "", ["http://h/y"]),
    ('<a href="/one" href="/two">', "", ["http://h/one"]),
    ('a <a href="/cut', "a", []),
    ('x<script>var a = "<!--";</script>y', "x y", []),
    ("x<!-- open", "x", []),
    ("x<script>open", "x", []),
    ("x<!-->y", "x y", []),
    ("&#0000000000065;&#x1F600 &#99999999999;", "A😀 \ufffd", []),
    ("<a href=/u?a=1&copy=2>q</a>", "q", ["http://h/u?a=1&copy=2"]),
    ("<a HREF = '/s t' >", "", ["http://h/s%20t"]),
    ("<area href=/no><abbr href=/no>", "", []),
    ("a < b & c", "a < b & c", []),
]


def test_markup_and_reference_probes(spark):
    from trawl.functions.urls import extract_links

    df = spark.createDataFrame([(h,) for h, _, _ in PROBES], "html string")
    got = df.select(clean_text(F.col("html")), extract_links(F.col("html"), F.lit("http://h/p"))).collect()
    assert [tuple(r) for r in got] == [(t, links) for _, t, links in PROBES]


def test_long_tags_do_not_exhaust_the_stack(spark):
    h = "<p " + " ".join(f'a{i}="x{i}>"' for i in range(3000)) + ">k</p>" + "<b>" * 20000 + "z" + "<i " * 5000
    assert spark.createDataFrame([(h,)], "html string").select(clean_text(F.col("html"))).first()[0] == "k z"


def test_references_without_semicolon_in_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id IN (28, 113, 420)")
    titles = [r[0] for r in pages.select(page_title(F.col("html"))).collect()]
    assert len(titles) == 3 and all(t.endswith("&") for t in titles)
