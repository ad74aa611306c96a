"""URL resolution / normalisation rows (RFC 3986 resolution, then hand-derived rows)."""

from pyspark.sql import functions as F

from trawl.functions.urls import domain_key, extract_links, is_valid_url, normalize_url, resolve_url

BASE = "http://A.com/x/y?q=1#f"
ROWS = [
    ("z", "http://a.com/x/z"), ("../z", "http://a.com/z"), ("/z", "http://a.com/z"),
    ("//B.org/z", "http://b.org/z"), ("HTTPS://B.org/Z", "https://b.org/Z"),
    ("?p=2", "http://a.com/x/y?p=2"), ("#top", "http://a.com/x/y?q=1#top"),
    ("mailto:a@b.c", None), ("javascript:void(0)", None), ("/a%zz", None),
    ("/èê", "http://a.com/%C3%A8%C3%AA"),
    ("", "http://a.com/x/y?q=1#f"), ("./a/./b/../c", "http://a.com/x/a/c"), ("../../../z", "http://a.com/z"),
    ("a b", "http://a.com/x/a%20b"), ("/p,q;r=s", "http://a.com/p,q;r=s"), ("/%7e", "http://a.com/%7e"),
    ("/é%7e", "http://a.com/%C3%A9~"), ("http://u:p@H.com:8080/a/..", "http://u:p@h.com:8080/"),
    ("http://h.com:x/", None), ("1a:b", None), ("x/y:z", "http://a.com/x/x/y:z"),
    ("#é", "http://a.com/x/y?q=1#%C3%A9"), ("/a?", "http://a.com/a?"), ("ftp://h/x", None),
]


def test_resolve_rows(spark):
    df = spark.createDataFrame([(BASE, h, e) for h, e in ROWS], "b string, h string, e string")
    got = df.select("h", "e", resolve_url(F.col("b"), F.col("h")).alias("g")).collect()
    assert [(r.h, r.g) for r in got] == [(r.h, r.e) for r in got]


def test_normalize_valid_domain(spark):
    df = spark.createDataFrame([("HTTP://Ex.COM/A?B#C",), ("ftp://x",), ("http://u@h.com:81/x",), (":x",)], "u string")
    got = df.select(normalize_url("u"), is_valid_url("u"), domain_key("u")).collect()
    assert [tuple(r) for r in got] == [
        ("http://ex.com/A?B#C", True, "http://ex.com"),
        ("ftp://x", False, "ftp://x"),
        ("http://u@h.com:81/x", True, "http://h.com:81"),
        (None, False, None),
    ]


def test_extract_links_first_href_dedup_order(spark):
    html = ('<a href="/b">1</a><!-- <a href="/c"> --><a class=x href=\'/a\' href="/z">2</a>'
            '<script>"<a href=/s>"</script><a href="/b">3</a><a href="mailto:x@y">4</a>'
            '<a data-href="/no">5</a><A HREF="/A&amp;B">6</a>')
    df = spark.createDataFrame([(html, "https://H.org/p/q")], "html string, url string")
    assert df.select(extract_links(F.col("html"), F.col("url"))).first()[0] == [
        "https://h.org/b", "https://h.org/a", "https://h.org/A&B"]
