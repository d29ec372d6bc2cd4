"""Clocks, states, cuts and sums in order, against plain loops."""

import random

from pyspark.sql import functions as F

from tidemill.operators import attempts
from tidemill.plans import planning


def test_pass_clocks_are_the_plain_loop(spark):
    rng = random.Random(3)
    rows, at = [], 1000
    for pos in range(900):
        at += rng.choice([0, 5, 300, 900, 1800, 1801, 2500, -400])
        rows.append((f"t{pos % 3}", rng.choice(["a", "a", "a", "a", "b", None]), float(at), pos))
    rows.append(("t9", "a", None, 5))
    got = {r["pos"]: r["slice_epoch"] for r in attempts.pass_clocks(spark.createDataFrame(rows, "ticket string, spawn string, at double, pos long").repartition(5)).collect()}
    last, want = {}, {}
    for t, spawn, at, pos in rows[:-1]:
        old = last.get(t)
        clock = old[1] if old and spawn is not None and old[0] == spawn and 0 <= at - old[1] <= 1800 else at
        last[t], want[pos] = (spawn, clock), clock
    assert got == want and sum(want[r[3]] != r[2] for r in rows[:-1]) > 50


def test_deadlines_and_states(spark):
    rows = [(100, True, 500, 1500), (None, True, 500, 9999), (100, False, 500, 60), (100, True, 500, 10)]
    got = spark.createDataFrame(rows, "claimed int, ticket boolean, now int, budget int").select(attempts.slice_deadline(F.col("claimed"), F.col("ticket"), F.col("now"), F.col("budget")).alias("d"))
    assert [r["d"] for r in got.collect()] == [1570, 2270, None, 100]
    leaves = spark.createDataFrame([(k, s) for k, s in enumerate(["a", "a", "b", None, None, "a", "a"])], "leaf int, spawn string")
    captures = spark.createDataFrame([(0, "T", True), (1, "T", False), (5, None, True)], "leaf int, title string, has_body boolean")
    errors = spark.createDataFrame([(0, "a", True, "auth"), (1, "a", True, "auth"), (2, "a", True, "auth"), (3, None, True, "odd"), (4, None, False, "auth"), (6, "a", True, None)], "leaf int, spawn string, says_spawn boolean, why string")
    got = {r["leaf"]: (r["state"], r["title"], r["why"]) for r in attempts.leaf_states(leaves, captures, errors).collect()}
    assert got == {0: ("captured", "T", None), 1: ("failed", None, "auth"), 2: ("pending", None, None), 3: ("failed", None, "error"), 4: ("pending", None, None), 5: ("captured", None, None), 6: ("failed", None, "error")}


def test_walks_stop_where_the_plain_loop_does(spark):
    rng = random.Random(8)
    rows = [(f"https://e.com/{k}", k, f"2024-0{rng.randrange(1, 10)}-01" if rng.random() < 0.9 else None, "everyone", rng.choice(["hot", "hot", "hot", "b", None])) for k in range(1500)]
    known = {r[0] for r in rows if rng.random() < 0.3}
    landed = {r[0] for r in rows if rng.random() < 0.2}
    posts = spark.createDataFrame(rows, "url string, pos long, day string, audience string, archive string").repartition(7)
    for cap, low in ((3, "2024-01-01"), (200, "2024-02-01"), (40, None), (10_000, None)):
        out = planning.walk_archive(posts, spark.createDataFrame([(u,) for u in known], "u string"), F.lit(""), "domain", min_date=low, cap=cap, landed=spark.createDataFrame([(u,) for u in landed], "u string"))
        want, ended, fresh = set(), set(), {}
        for url, pos, day, _, archive in rows:
            if archive in ended:
                continue
            why = "min_date" if low and day and day < low else "known" if url in known else None
            stop = why == "min_date"
            if why is None and url not in landed:
                fresh[archive] = fresh.get(archive, 0) + 1
                if fresh[archive] > cap:
                    why, stop = "truncated", True
            if stop:
                ended.add(archive)
            want.add((pos, why, stop))
        assert {(r["pos"], r["why"], r["stops"]) for r in out.collect()} == want


def test_sums_and_halts_in_pieces(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["hot"] * 6 + ["b", None]), rng.choice([1, 2, 5, None]), rng.random() < 0.004) for k in range(3000)]
    df = spark.createDataFrame(rows, "pos long, host string, cost int, refused boolean").repartition(6)
    spent, refused, want, halted = {}, {}, {}, {}
    for pos, host, cost, bad in rows:
        want[pos], halted[pos] = spent.get(host, 0), refused.get(host, False)
        spent[host] = spent.get(host, 0) + (cost or 0)
        refused[host] = refused.get(host, False) or bad
    for piece in (100, 10**6):
        got = planning.sum_before(df, F.col("cost"), F.col("host"), "spent", piece=piece)
        assert {r["pos"]: r["spent"] for r in got.collect()} == want and set(got.columns) == {*df.columns, "spent"}
    assert {r["pos"]: r["reached"] for r in planning.within_budget(df, F.col("cost"), 900, F.col("host"), piece=100).collect()} == {k: v <= 900 for k, v in want.items()}
    assert {r["pos"]: r["halted"] for r in planning.halt_after_refusal(df, F.col("host"), F.col("refused")).collect()} == halted and any(halted.values())
