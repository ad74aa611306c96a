"""The trie against a plain one, with the top taken low, and its hash tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from trawl.llm import prefix_trie as pt
from trawl.llm.queries import op11_prefix_trie, rebuilt


def plain(paths):
    """paths: conv_id -> sequence of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in paths.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    out = []
    for k in members:
        below = [x for x in members if x[:len(k)] == k]
        kids = lambda x: sum(len(y) == len(x) + 1 and y[:len(x)] == x for y in members)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), kids(k),
                    sum(kids(x) == 0 for x in below), saved,
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}


def plain_rebuilt(rows):
    own = ordered(rows)
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[:h[c]] + own[c][h[c]:] for c in own}


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1, True) for r in rows],
                                 "conv_id long, turn long, role string, text string, key binary, size int, ends boolean")


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=repr)


def some(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        k = rng.choice([0, 1, 2, 3, 8, 12])
        rows += [(c, t if rng.random() < 0.97 else None, rng.choice(["user", "assistant", None]) if t else "user",
                  rng.choice(["", "hi", "é🙂", None, "a:b", f"x{rng.random()}"]) if t else "hello") for t in range(k)]
    rows = [r for i, r in enumerate(rows) if r[1] is not None or all(q[1] is not None for q in rows[:i] if q[0] == r[0])]
    return rows + [(500 + c, t, "user", f"same {t}") for c in range(40) for t in range(5)] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("least", [1000, 3])
def test_equals_plain(spark, monkeypatch, least):
    monkeypatch.setattr(pt, "LEAST_HOT", least)
    monkeypatch.setattr(pt, "SHARD_ROWS", 50)
    rows = some(least, 60)
    marks = lambda t: t.unionByName(t.selectExpr("conv_id", "0 pos", "cast(null AS binary) key", "0L size").distinct())
    assert got(pt.prefix_trie(marks(pt.turns(frame(spark, rows))))) == plain(ordered(rows))
    assert got(pt.prefix_trie(rebuilt(pt.turns(frame(spark, rows))))) == plain(plain_rebuilt(rows))


def test_edges(spark, tmp_path):
    long = [(10, t, "user", "w" * 100_000 if t == 3 else f"t{t}") for t in range(3000)]
    for rows in ([], [(1, None, None, None)], [(3, 0, "a", "b")] * 3, [(10, t, "u", "v") for t in range(3)] + [(12, 0, "u", "w")]):
        assert got(pt.prefix_trie(rebuilt(pt.turns(frame(spark, rows))))) == plain(plain_rebuilt(rows))
    nodes = got(pt.prefix_trie(rebuilt(pt.turns(frame(spark, long)))))
    assert len(nodes) == 3001 and {n[3] for n in nodes} == {1} and {n[5] for n in nodes} == {1}


def test_query_over_its_table(spark, tmp_path):
    rows = some(9, 30)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op11_prefix_trie(spark, str(tmp_path))) == plain(plain_rebuilt(rows))


def test_many_ids_end_in_one_node(spark):
    ids = spark.range(150_000).selectExpr("id conv_id", "0 pos", "cast(null AS binary) key", "0L size")
    (root,) = got(pt.prefix_trie(ids))
    assert root[:7] == (0, 0, None, 150_000, 0, 1, 0)
    assert root[7] == hashlib.sha256(",".join(map(str, range(150_000))).encode()).hexdigest()


def test_slots():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (5000, 2), dtype=np.uint64)
    keys[:1000, 0], keys[1000:2000, 1] = 5, 9
    table = pt.SlotTable(keys)
    slots = table.find(keys)
    assert sorted(slots) == list(range(5000)) and (table.keys[slots] == keys).all()
    others = rng.integers(0, 2**63, (5000, 2), dtype=np.uint64)
    others[:2000] = keys[:2000] ^ np.uint64(1 << 62)
    assert (table.find(others) == -1).all()
    assert len(pt.SlotTable(keys[:0]).find(keys)) == 5000
