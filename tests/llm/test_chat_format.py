"""Chat formatting: exact round trip and the trained spans."""

import random
from collections import defaultdict

import duckdb

from trawl.llm import chat_format as cf


def test_round_trip_and_prefixes(spark):
    rng = random.Random(9)
    bits = ["</s>", "[INST]", "<s>", "[TURN user]\n", "\\", "<", "[", "]", "]\n", "\n", "é🙂", "ok ", "\\<", "$1", "<\\"]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", "", None, "a]\\b", "\\<"])
            rows.append((c, t, role, None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))))
    rows += [(None, 0, "user", "x"), (None, 0, "assistant", "y"), (70, 0, "assistant", "dup"), (70, 0, "assistant", "dup"),
             (71, None, "user", "long " * 50000), (71, 1, "assistant", "reply")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, example int")
    want = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            want[c].append(((t is not None, t or 0), r or "", x or ""))
    made = cf.examples(df)
    for r in made.collect():
        if r["loss_start"] is not None:
            assert r["formatted"][r["loss_end"]:] == cf.CLOSE
            assert r["formatted"][:r["loss_start"]].endswith(cf.HEAD_END)
        if r["conv_id"] is not None:
            turns = sorted(want[r["conv_id"]])
            assert r["formatted"].startswith(cf.OPEN + cf.HEAD)
            assert r["formatted"].count(cf.CLOSE) <= len(turns)
    back = cf.read_back(made).collect()
    for r in back:
        if r["conv_id"] is None:
            assert len(r["turns"]) == 1
            continue
        turns = [(a, b) for _, a, b in sorted(want[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["loss_text"] == "".join(b for a, b in turns if a == "assistant")
    assert len(back) == len(want) + 2
    n = sum(1 for _, _, r, _ in rows if r == "assistant")
    assert made.where("loss_start IS NOT NULL").count() == n
    assert cf.read_back(cf.examples(df.limit(0))).count() == 0


def test_query_matches_sql(spark, sf):
    from trawl.llm.queries import ORACLE_SQL, op5_chat_format

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    got = op5_chat_format(spark, sf)
    want = con.execute(ORACLE_SQL["op5_chat_format"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
