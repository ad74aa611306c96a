"""Archives: round trip over cut files, false boundaries in payloads, revisits, broken files."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from trawl.llm import warc
from trawl.session import scratch_path

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"


@pytest.fixture
def cut(spark):
    """Reads files in ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield use
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def plain(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        keep = max(ids) if len(data) >= warc.LEAST_SHARED and ids else i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if keep == i else "revisit",
                    None if keep == i else keep))
    return Counter(out)


def written(spark, rows, parts):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(*r, "x", 1) for r in rows],
                                             "page_id long, url string, html string, digest string, size int")
                       .repartition(parts), path)
    return path


def pages(seed, n):
    rng = random.Random(seed)
    bits = ["a", "é", "🙂", "\r", "\n", "\r\n", "\r\n\r\n", "WARC/1.0", "WARC/1.0\r\n", "Content-Length: 5", "\x00", " text ",
            FAKE.format(10, "b" * 10), FAKE.format(3, "b" * 9000), FAKE.format(10**17, "")]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    made += ["x" * 999, "x" * 999, "y" * 1000, "y" * 1000, "é" * 500, "é" * 500, "z" * 50_000, "", "", None, "\r\n", "\r\n\r\n\r\n"]
    rows = [(k, f"https://e.x/{k}", m) for k, m in enumerate(made)]
    rows += [(10_000 + k, None, made[k]) for k in range(0, n, 3)] + [(5000, "u\r\nWARC/1.0\r\n", "y" * 1000)] * 2
    return rows + [(None, None, "y" * 1000), (None, None, "lone" * 400), (-3, "u", "q")]


@pytest.mark.parametrize("size, parts", [(1 << 27, 3), (3000, 2), (450, 1)])
def test_round_trip(spark, cut, size, parts):
    rows = pages(size, 5)
    path = written(spark, rows, parts)
    cut(size)
    records = warc.read_archive(spark, path)
    assert Counter(tuple(r) for r in warc.page_rows(records).collect()) == plain(rows)
    texts = Counter((r["target_uri"], bytes(r["payload"]).decode()) for r in records.where("type = 'response'").collect())
    want = Counter((u and u.replace("\r", "%0D").replace("\n", "%0A"), h or "") for (i, u, h) in rows
                   if (i, len((h or "").encode())) in {(r[0], r[1]) for r in plain(rows) if r[3] == "response"})
    assert texts == want


def test_empty_and_long(spark, cut):
    assert warc.page_rows(warc.read_archive(spark, written(spark, [], 1))).collect() == []
    rows = [(1, "u", "ab\r\n\r\n" * 200_000), (2, "u", FAKE.format(4, "abcd") * 5000), (3, "u", "w" * 3_000_000)]
    path = written(spark, rows, 1)
    cut(200_000)
    assert Counter(tuple(r) for r in warc.page_rows(warc.read_archive(spark, path)).collect()) == plain(rows)


def test_broken_file_gives_what_precedes(spark, tmp_path):
    rec = lambda n, body: FAKE.format(len(body), body).replace(":77", f":{n}").encode()
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "cut").write_bytes(rec(1, "one") + rec(2, "two") + rec(3, "three" * 50)[:-40])
    (tmp_path / "w" / "junk").write_bytes(rec(4, "four") + b"garbage\r\n\r\n" + rec(5, "five"))
    (tmp_path / "w" / "none").write_bytes(b"nothing here\r\n\r\n" + rec(6, "six"))
    found = warc.read_archive(spark, str(tmp_path / "w")).collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in found) == [
        ("<urn:page:1>", b"one"), ("<urn:page:2>", b"two"), ("<urn:page:4>", b"four")]


def test_frequent_payload(spark):
    rows = [(k, None, "h" * 1200) for k in range(3000)] + [(k, None, f"{k}" * 400) for k in range(3000, 3050)]
    rows += [(9000, None, "3001" * 400)]
    path = written(spark, rows, 4)
    assert Counter(tuple(r) for r in warc.page_rows(warc.read_archive(spark, path)).collect()) == plain(rows)


def test_chain_exits():
    starts, after = np.array([0, 10, 12, 30]), np.array([10, 30, 31, 55])
    assert warc.chain_exits(starts, after, 40).tolist() == [55, 55, -1, 55]
