import math

import numpy as np

from tidemill.llm import projection_forest as forest


def brute(rows, least=0.93):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = [np.asarray(v, float) / np.linalg.norm(np.asarray(v, float)) if ok(v) else None for _, v, _ in rows]
    for x in range(n):
        for y in range(x):
            if unit[x] is not None and unit[y] is not None and rows[x][2] is not None and rows[x][2] == rows[y][2] and len(unit[x]) == len(unit[y]) and unit[x] @ unit[y] >= least:
                links[x] += 1
                links[y] += 1
                root[find(x)] = find(y)
    least_of = {}
    for x in range(n):
        least_of[find(x)] = min(rows[x][0], least_of.get(find(x), rows[x][0]))
    return sorted((rows[x][0], links[x], least_of[find(x)]) for x in range(n))


def made(seed):
    rng = np.random.default_rng(seed)
    vectors = []
    for size, noise in ((90, 0.02), (30, 0.035), (12, 0.045)):
        centre = rng.normal(size=32)
        centre /= np.linalg.norm(centre)
        vectors += [centre + rng.normal(size=32) * noise for _ in range(size)]
    vectors += list(rng.normal(size=(500, 32)))
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 2)) for i, v in enumerate(vectors)]
    rows += [(9000 + k, rows[3][1], rows[3][2]) for k in range(5)]
    rows += [(9100, None, 0), (9101, [0.0] * 32, 0), (9102, [float("nan")] * 32, 0), (9103, [None] * 32, 1), (9104, rows[0][1], None), (9105, [], 0), (9106, [1.0, 2.0], 0), (9107, [2.0, 4.0], 0), (9108, [float("inf")] * 32, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_equals_brute_force_in_one_leaf_and_in_cells(spark):
    rows = made(1)
    for block in (2048, 20):
        got = forest.near_vectors(frame(spark, rows), leaf_size=10**6, block=block).collect()
        assert sorted(tuple(r)[:3] for r in got) == brute(rows)
        assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got)


def test_recall_of_deep_trees(spark):
    rows = made(2)
    got = {r["id"]: r["n_links"] for r in forest.near_vectors(frame(spark, rows), leaf_size=16).collect()}
    want = {i: n for i, n, _ in brute(rows)}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got.values()) >= 0.98 * sum(want.values())


def test_nothing(spark):
    assert forest.near_vectors(frame(spark, [])).collect() == []
    (row,) = forest.near_vectors(frame(spark, [(None, [1.0], 1)]).withColumn("leaf", forest.F.lit(1))).collect()
    assert tuple(row) == (None, 0, None, True)


def test_query_is_brute_force(spark, tmp_path):
    rows = made(3)
    frame(spark, rows).selectExpr("*", *(f"{k} as {c}" for k, c in enumerate("id rep dim leaf n_links component_id kept vector".split()))).repartition(4).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = forest.QUERIES["op10_projection_forest"](spark, str(tmp_path)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows) and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
