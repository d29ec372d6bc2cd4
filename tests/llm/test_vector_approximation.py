"""Hard negatives against a loop over all pairs, the bounds against exact scores, and the SQL twin."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import vector_approximation as va

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n=500, seed=5):
    rng = random.Random(seed)
    unit = lambda: [rng.gauss(0, 0.2) for _ in range(8)]
    centres = [unit() for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.06) for x in rng.choice(centres)], rng.randrange(0, 4)) for i in range(n)]
    rows += [(1000 + 50 * k, rows[3][1], 1) for k in range(9)] + [(2001 + k, rows[3][1], 1 + k % 2) for k in range(40)]  # one vector many times, anchors among them
    rows += [(50, rows[50][1], rows[50][2]), (50, rows[50][1], rows[50][2]), (100, [0.9] * 8, rows[100][2]), (None, rows[60][1], 2), (None, rows[60][1], None)]
    rows += [(3000, None, 1), (3050, [0.1] * 7 + [None], 1), (3100, [0.1] * 7 + [math.nan], 1), (3150, [math.inf] + [0.0] * 7, 1), (3200, [0.0] * 8, 1), (3250, [], 1), (3251, [], 1), (3252, [], 2)]
    rows += [(3300, [0.3, -0.2], 1), (3301, [0.3, -0.1], 1), (3302, [0.2, -0.1], 0), (3303, [0.25, 0.0], 3), (3350, [-0.5] * 8, 2)]
    return rows


def plain(rows):
    whole = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    last = lambda i: math.inf if i is None else i
    out = []
    for k, (a, v, label) in enumerate(whole):
        if a is None or a % 50:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), b, m, j == k) for j, (b, w, m) in enumerate(whole) if len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, p, *_ in [s for s in scored if s[2] == label and not s[3]][:5]:
            fits = [s for s in scored if s[2] != label and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(a, p, r, s[1], ps, s[0]) for r, s in enumerate(fits, 1)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("vectors")
    spark.createDataFrame(made(), SCHEMA).selectExpr("*", *(f"{k} as {c}" for k, c in enumerate("id dim cells ids rep anchor rank score codes is_anchor vector".split()))).repartition(3).write.parquet(str(out / "embeddings.parquet"))
    return str(out)


def test_query(spark, folder):
    got = Counter(map(tuple, va.QUERIES["op12_vector_approximation"](spark, folder).collect()))
    want = Counter(plain(made()))
    assert got == want and len(want) > 100


def test_blocks_and_coarse_cells_change_nothing(spark, folder):
    v = spark.read.parquet(folder + "/embeddings.parquet").withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    for kw in ({"block": 3}, {"bits": 1}, {"sample_rows": 0, "bits": 3}):
        assert Counter(map(tuple, va.hard_negatives(v, F.col("vec_id") % 50 == 0, **kw).collect())) == Counter(plain(made())), kw


def test_sql(spark, folder, tmp_path):
    """The twin takes ids to be distinct and vectors to be of one length."""
    seen, rows = set(), []
    for r in made():
        if r[0] is not None and r[0] not in seen and (r[1] is None or len(r[1]) == 8):
            seen.add(r[0])
            rows.append(r)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = con.sql(va.SQL)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(got.fetchall()) == Counter(plain(rows)) == Counter(map(tuple, va.QUERIES["op12_vector_approximation"](spark, str(tmp_path)).collect()))


def test_bounds_hold():
    rng = np.random.default_rng(2)
    v, q = np.floor(rng.normal(0, 40, (400, 6))), np.floor(rng.normal(0, 40, (30, 6)))
    for sample in (v, v[:20], v[:0]):
        cells = va.Cells.of(sample, v.min(0), v.max(0), 3)
        mid, half = cells.lookup(cells.codes(v))
        assert ((mid - half <= v) & (v <= mid + half)).all()
        s, c, w = q @ v.T, q @ mid.T, np.abs(q) @ half.T
        assert ((c - w <= s) & (s <= c + w)).all()
    # the tables of an anchor, entry by entry
    low = np.minimum(q[0][:, None] * (cells.mid - cells.half), q[0][:, None] * (cells.mid + cells.half))
    assert np.allclose(low[np.arange(6), cells.codes(v)].sum(1), (c - w)[0])


def test_few_are_scored_exactly(spark, folder, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    v = np.floor(rng.normal(0, 30, (4000, 16)))
    cells = {16: va.Cells.of(v[:500], v.min(0), v.max(0), 6)}
    codes = cells[16].codes(v)
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(4000, np.int64)), pa.array(np.full(4000, 16, np.int32)), pa.array([x.astype(np.int16).tobytes() for x in v]), pa.array([[k] for k in range(4000)]), pa.array([c.tobytes() for c in codes])], names=["label", "dim", "cells", "ids", "codes"])
    rows = [{"anchor": k, "label": 0, "dim": 16, "cells": v[k].astype(np.int16).tobytes(), "windows": [(0, -math.inf, math.inf)]} for k in range(20)]
    scored = []
    exact = va._exact
    monkeypatch.setattr(va, "_exact", lambda a, b: scored.append(len(a)) or exact(a, b))
    monkeypatch.setattr(va, "TILE_V", 256)
    (out,) = va._searched(iter([batch]), cells, va._block(rows, True, cells), 6)
    want = {(k, i) for k in range(20) for i in np.lexsort((np.arange(4000), -(v @ v[k])))[:6].tolist()}
    assert {(a, i) for a, i in zip(out["anchor"].to_pylist(), out["id"].to_pylist(), strict=True)} == want and sum(scored) < 0.2 * 20 * 4000


def test_large_components(spark):
    rows = [(0, [1e30, 1.0], 1), (50, [3e15, -7.0], 1), (1, [2e15, 5.0], 1), (2, [1e15, 1.0], 2), (3, [1.7e308, 0.0], 2), (4, [1.5e15, 2.0], 3)]
    got = va.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 50 == 0).collect()
    assert {(r["anchor_id"], r["positive_id"]) for r in got} <= {(0, 50), (0, 1), (50, 0), (50, 1)}


def test_scores_beyond_long():
    a = np.asarray([[2.0**40, 3.0], [2.0**31, 1.0]])
    assert va._exact(a, a).tolist() == [2**63 - 1, 2**62 + 1]
