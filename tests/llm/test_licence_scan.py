"""License scans: canonical forms, edge rows, and the SQL version."""

import hashlib
import re
import textwrap
import time

import duckdb

from trawl.llm import licence_scan as ls
from trawl.llm.licence_texts import NOTICES, TEXTS, published


def plain(text):
    t = re.sub(r"^[\s#*/;-]*(copyright|©|\(c\))[^\n]*$", "", (text or "").lower(), flags=re.M)
    for a, b in ls.SPELLINGS:
        t = t.replace(a, b)
    t = "".join(c if c.isalnum() or c == "\n" else " " for c in t)
    return t


def test_scan_equals_plain(spark):
    mit = dict(TEXTS)["MIT"]
    rows = [(1, None), (2, ""), (3, "MIT License\n\nCopyright (c) 2024 Someone\n\n" + mit), (4, mit.upper().replace("SUBLICENSE", "sub-license")),
            (5, mit + " and more"), (6, "prose\n  * released UNDER the mit licence \nAll rights reserved\nprose"),
            (None, "All rights reserved."), (7, "x\nAll rights reserved.\nAll Rights Reserved\n"), (7, "x\nAll rights reserved.\nAll Rights Reserved\n"),
            (8, "long " * 60000 + "\n// SPDX-License-Identifier: MIT"), (9, "© 2020 me\nSPDX-License-Identifier: Apache-2.0")]
    rows += [(100 + k, t) for k, (_, t) in enumerate((*TEXTS, *NOTICES))]
    known = {k: {" ".join(plain(t).split()): n for n, t in entries} for k, entries in (("text", TEXTS), ("notice", NOTICES))}
    want = []
    for i, t in rows:
        form = " ".join(plain(t).split())
        lines = [known["notice"].get(" ".join(x.split())) for x in plain(t).split("\n")]
        hits = [x for x in lines if x]
        want.append((i, hashlib.sha256(form.encode()).hexdigest(), known["text"].get(form), ",".join(sorted(set(hits))), len(hits)))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licence string")
    got = [tuple(r) for r in ls.scan(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[2] == "MIT" for r in got) >= 4
    assert ls.scan(docs.limit(0)).count() == 0


def test_form_does_not_depend_on_wrapping(spark):
    rows = [(f"{k} {n} {w}", textwrap.fill(" ".join(t.split()), w, break_long_words=False, break_on_hyphens=False))
            for k, (n, t) in enumerate(TEXTS) for w in (1, 20, 34, 47, 60, 72, 78, 79, 80, 100, 120)]
    statements = ["Copyright (c) 2024 Jane Doe", "copyright 1999 jane doe", "Copyright © Jane", "© 2020 me", "(c) 2011-2014 Jane", "// Copyright 2015 X",
                  "Copyright Jane Doe. All of it", "Copyright The Foo Authors", " * Copyright: Jane Doe", "Copyright [yyyy] [name]", "(C) Jane Doe and Joe Bloggs",
                  "Copyright by Jane", "Copyright (C) <year>  <name of author>", "COPYRIGHT (C) 1999 JANE DOE"]
    prose = ["copyright notice, this list of", "COPYRIGHT HOLDERS BE LIABLE", "Copyright Holder, and derivatives", "copyright owner", "Copyright License. Subject to",
             "copyright law: that", "copyrighted by Jane", "(c) You must retain, in the", "(c) the licenses granted", "(c)    Representations.", "(c) Representations. Contributor", "copyright", "(c) of the",
             "copyright on the Program", "COPYRIGHT AND PERMISSION NOTICE", "copyright the software, and"]
    mit = dict(TEXTS)["MIT"]
    rows += [(f"{99 + k} MIT x", f"{s}\n\n{mit}") for k, s in enumerate(statements)] + [(f"{199 + k} None x", f"{s}\n\n{mit}") for k, s in enumerate(prose)]
    got = {r["doc_id"]: r["licence"] for r in ls.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {i: n for i, n in got.items() if str(n) != i.split()[1]} == {} and len(got) == len(rows)
    split = spark.createDataFrame([(1, "the copyright owner may sub-license ten per cent"), (2, "the copyright\nowner may sub-\nlicense ten per\ncent")],
                                  "doc_id long, text string")
    assert ls.scan(split).select("digest").distinct().count() == 1


def test_published_texts_are_known_in_any_wrapping(spark):
    texts = published()
    assert {"Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense", "BSL-1.0"} <= {n for n, _ in texts}

    def wrapped(text, w):  # paragraphs with a statement, or a sample of one within a line, stay as they are
        return "\n\n".join(p if re.search(r"copyright\s+(\(c\)|©|\[|\d)", p, re.I) else
                           textwrap.fill(" ".join(p.split()), w, break_long_words=False, break_on_hyphens=False)
                           for p in text.split("\n\n"))

    rows = [(f"{n}|{k} {w}", wrapped(t, w) if w else t) for k, (n, t) in enumerate(texts) for w in (0, 33, 61, 77, 100)]
    got = {r["doc_id"]: r["licence"] for r in ls.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {i: n for i, n in got.items() if n != i.split("|")[0]} == {} and len(got) == len(rows)
    forms = ls.known_digests(spark).where("kind = 'text'")
    assert forms.select("digest").distinct().count() == forms.count()


def test_query_matches_sql(spark, sf):
    from trawl.llm.queries import ORACLE_SQL, op7_licence_scan

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = op7_licence_scan(spark, sf)
    want = con.execute(ORACLE_SQL["op7_licence_scan"])
    assert [d[0] for d in want.description] == got.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall()) and any(r[3] for r in rows)


def test_long_lines_end_in_time(spark):
    texts = ["(c) " + "Foo " * 250_000 + "Bar", "(c) " + "Foo and " * 100_000 + "bar", "\n" * 100_000 + "x",
             "Copyright " + "by the " * 100_000 + "Someone", "# \n" * 100_000 + "Copyright 2001 X", "a-" * 500_000]
    began = time.time()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["digest"] for r in ls.scan(docs).collect()}
    assert time.time() - began < 60
    empty = hashlib.sha256(b"").hexdigest()
    assert out[0] == empty and out[4] == empty and out[1] != empty
    assert out[2] == hashlib.sha256(b"x").hexdigest()


def test_names_after_c_in_brackets(spark):
    lines = ["(c) Ann Lee", "(c) Ann and Bob Lee", "(c) Ann of the Lee Inc.", "(c) Ann", "(c) Ann and", "(c) The Work Here",
             "(c) Ann Lee writes", "(c) Ann & Bob, Cyd."]
    docs = spark.createDataFrame([(i, x + "\nrest") for i, x in enumerate(lines)], "doc_id long, text string")
    rest = hashlib.sha256(b"rest").hexdigest()
    dropped = [r["doc_id"] for r in ls.scan(docs).orderBy("doc_id").collect() if r["digest"] == rest]
    assert dropped == [0, 1, 2, 5, 7]
