import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemill.llm import line_dedup, mixture, shard_tree


def test_targets_stop_at_three_times():
    t = mixture.targets({"a": 100, "b": 10, None: 50, "c": 0})
    assert t["c"] == 0 and t["b"] == 30 and abs(sum(t.values()) - 160) < 1e-9
    assert all(t[s] <= 3 * n + 1e-9 for s, n in {"a": 100, "b": 10, None: 50}.items())
    assert mixture.targets({}) == {}


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").selectExpr("*", "1 as threshold", "2 as whole", "3 as mix_target", "4 as hash")
    return mixture.mix(docs, mixture.word_count()).select("source", "mix_size", "mix_source_size", "mix_target", "mix_copies").collect()


def test_mix_comes_within_one_document(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["s1", "s1", "s1", "s1", "s2", "s3", None]), "x") for i in range(2000)]
    rows += [(None, None, "s2", None), (5, "", None, None)]
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    taken, size, target = Counter(), Counter(), {}
    for r in got:
        taken[r[0]] += r[1] * r[4]
        size[r[0]] += r[1]
        target[r[0]] = r[3]
        assert 0 <= r[4] <= 3
    assert target == mixture.targets(dict(size))
    for s in target:
        assert abs(taken[s] - target[s]) <= 60 and taken[s] <= 3 * size[s]
    assert sorted(map(str, got)) == sorted(map(str, mixed(spark, rows)))


def test_mix_of_nothing(spark):
    assert mixed(spark, []) == []
    assert [r[4] for r in mixed(spark, [(1, None, None, None)])] == [0]


def test_shards(spark):
    rows = [(i, f"text {i % 50}") for i in range(3000)] + [(None, None), (None, ""), (7, "text 7"), (8, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_bucket", F.lit(1)).withColumn("size", F.lit("x"))
    got = shard_tree.assign(docs.drop("_bucket"), slot_rows=100).collect()
    assert len(got) == len(rows)
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        raw = (r["text"] or "").encode()
        assert r["shard_size"] == len(raw) + 1 and r["shard_crc32"] == zlib.crc32(raw)
        assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
        slots[r["shard"]].append(r["slot"])
        where[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
    assert all(len(s) == 1 for s in where.values())
    assert 100 < sum(r["grown_shard"] == 16 for r in got) < 260
    assert shard_tree.assign(docs.limit(0)).collect() == []


def test_weights_move_only_changed_subtrees(spark):
    ids = spark.range(4000)
    before, after = shard_tree.tree(), shard_tree.tree(weights={5: 2.0})
    got = ids.select(shard_tree.place(before, F.col("id")).alias("a"), shard_tree.place(after, F.col("id")).alias("b")).where("a <> b").collect()
    # shard 5 is of rack 1, region 0: what moves ends in the region that gained, and inside it in that rack
    assert got and all(r["b"] < 8 for r in got)
    assert all(r["b"] in (4, 5, 6, 7) for r in got if r["a"] < 8)
    assert all(r["b"] == 5 for r in got if r["a"] in (4, 6, 7))


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    pool = ["", "  ", "Hot line", "hot LINE \t", "É x", "é x", "b\x0b", "x" * 3000]
    docs = []
    for i in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"line {rng.randrange(10**6)}" for _ in range(rng.randrange(1, 150))]
        docs.append((i, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (None, "hot line\nrest"), (3, "other\nhot line")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1))
    bitmaps = line_dedup.keep_bitmaps(df, least_docs=10)
    got = line_dedup.apply_bitmaps(df, bitmaps).select("doc_id", "text", F.col("n_dropped").alias("n"), "kept").collect()
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    want = []
    for i, t in docs:
        kept = [x for x in (t or "").split("\n") if not key(x) or len(held[key(x)]) < 10]
        want.append((i, t, len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    assert sorted(map(str, want)) == sorted(map(str, (tuple(r) for r in got)))
    assert line_dedup.keep_bitmaps(df.limit(0)).collect() == []


def test_line_query_equals_oracle(spark, tmp_path):
    import duckdb

    spark.createDataFrame([(i, f"same\nonly {i}\n\nÉ\nse{i % 5}") for i in range(50)] + [(50, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in line_dedup.op9_line_dedup(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(line_dedup.ORACLES["op9_line_dedup"]).fetchall())
    assert got == [(a, b, c, d) for a, b, c, d in want]
    assert got[0][3] == hashlib.sha256(b"only 0\n").hexdigest()


def test_line_query_equals_oracle_on_null_and_repeated_ids(spark, tmp_path):
    import duckdb

    rows = [(i, f"nine\nmine {i}") for i in range(9)] + [(i, f"eight\nother {i}") for i in range(8)]
    rows += [(0, "eight\neight"), (0, "eight"), (3, None), (None, "nine\nrest"), (None, "nine"), (None, "eight\nrest"), (None, "eight\nrest"), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in line_dedup.op9_line_dedup(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(got, key=str) == sorted(con.execute(line_dedup.ORACLES["op9_line_dedup"]).fetchall(), key=str)
    # nine ids and the null one hold "nine"; eight ids and the null one hold "eight"
    kept = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r[0], *r[2:]) for r in got if r[0] == 8) == [(8, 1, kept("mine 8"))]
    assert sorted(str((r[1], r[2], r[3])) for r in got if r[0] is None) == sorted(str(x) for x in [(2, 1, kept("rest")), (1, 1, kept("")), (2, 0, kept("eight\nrest")), (2, 0, kept("eight\nrest")), (1, 0, kept(""))])
