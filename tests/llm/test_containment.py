import random

import duckdb

from tidemill.llm import containment


def test_equals_oracle(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 70)))) for i in range(30)] + [(30, "tiny item"), (31, "one two three Four five"), (32, ""), (33, None), (34, "tiny item")]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randrange(0, 900))]
        if i % 3 == 0:
            x = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randrange(0, 3)):
                if x:
                    x[rng.randrange(len(x))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = x
        docs.append((i, " \t".join(w)))
    docs += [(200, None), (201, "  "), (202, "ONE two three four FIVE six"), (203, "a tiny item"), (204, "tiny item")]
    (tmp_path / "x").mkdir()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in containment.op5_contained_items(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = sorted(con.execute("select item_id, doc_id, n_item, n_shared from (" + containment.ORACLES["op5_contained_items"] + ")").fetchall())
    assert got == want and len(got) > 20


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert containment.contained(docs, items.limit(0)).collect() == []
    assert containment.contained(docs.limit(0), items).collect() == []
    rows = docs.union(docs).selectExpr("doc_id", "text", "1 as item_id", "2 as w")
    assert [tuple(r) for r in containment.contained(rows, items).collect()] == [(1, 1, 2, 2)]
    null_id = docs.selectExpr("cast(null as long) as doc_id", "text")
    assert [tuple(r) for r in containment.contained(null_id, items).collect()] == [(1, None, 2, 2)]
