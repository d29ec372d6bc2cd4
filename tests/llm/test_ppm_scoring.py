import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemill.llm import ppm_scoring as ppm
from tidemill.llm import textkernel as tk


def brute(rows, order=4):
    trie, count = ppm.Trie(order), Counter()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False
    for i, t in rows:
        if not out(i):
            count.update(words(t))
            for step in trie.steps(t or ""):
                trie.learn(*step)
    n, v = sum(count.values()), len(count)
    res = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        res.append((i, out(i), len(w), sum(count[x] > 0 for x in w), n, base, sum(trie.log10(*s) for s in trie.steps(t or ""))))
    return res


def test_equals_byte_by_byte_model(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["The", "then", "é", "ñandú", "x" * rng.randrange(1, 5), chr(rng.randrange(33, 900))]) for _ in range(rng.randrange(0, 60)))) for i in range(150)]
    rows += [(None, None), (500, ""), (3, rows[3][1]), (3, "other text"), (501, " \t"), (502, "𝔘" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as row")
    for most in (1 << 22, 100):  # the second lowers the order to 2
        got = ppm.score(docs, *ppm.learn(docs.where(~ppm.held_out()), order=4, most_grams=most), ppm.held_out()).collect()
        want = brute(rows, 4 if most > 100 else 2)
        key = lambda r: (str(r[0]), r[2], round(r[6], 6))
        assert len(got) == len(want)
        for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert tuple(g)[:5] == w[:5]
            assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


def test_probabilities_sum_to_one():
    trie = ppm.Trie(3)
    for t in ("abracadabra", "abrasive"):
        assert trie.adaptive(t) < 0
    for context in (b"abr", b"\xffab", b"zzz"):
        assert abs(sum(10 ** trie.log10(context, b) for b in range(256)) - 1) < 1e-9


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    (row,) = ppm.score(docs, *ppm.learn(docs.limit(0)), ppm.held_out()).collect()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and math.isclose(row["score"], -3 * math.log10(256))
    assert ppm.score(docs.limit(0), *ppm.learn(docs), ppm.held_out()).collect() == []


def test_trie_in_partitions_equals_byte_by_byte_model(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["The", "then", "thence", "é", "ñandú", chr(rng.randrange(33, 900))]) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 6)
    for often in (1, 300, 1 << 24):  # no gram is frequent, some are, all are
        got = ppm.score(docs, *ppm.learn(docs.where(~ppm.held_out()), often=often, bucket_grams=50), ppm.held_out()).collect()
        assert len(got) == len(want)
        for g, w in zip(sorted(got), want, strict=True):
            assert tuple(g)[:5] == w[:5] and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


def test_order_is_kept_by_a_large_corpus(spark):
    letters = np.random.default_rng(3).integers(97, 123, (100, 30_000), np.uint8)
    rows = [(i, x.tobytes().decode()) for i, x in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    ((_, _, raw, off),) = tk.slices(pa.array([t for _, t in rows]), 1 << 30)
    grams, doc = ppm.text_grams(raw, off, 6)
    keys, n = np.unique(grams, return_counts=True)
    assert len(keys) > 2_500_000
    want = np.bincount(doc, ppm.Model.of(keys, n, 6).log10(grams))
    got = ppm.score(docs, *ppm.learn(docs), ppm.held_out()).collect()
    assert np.allclose([r["score"] for r in sorted(got)], want, rtol=1e-9)


def test_grams_by_their_definition():
    for texts, lead, ended in ((["", "aB", "", "xyzxyzxyz", "q"], b"", True), (["cde"], b"ab", False), (["cdefgh", "", "i"], b"uvwxyz", True), ([""], b"", False)):
        raw, off = np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        for order in (2, 6):
            had = lead[:order]
            want = []
            for k, t in enumerate(texts):
                data = bytes([255] * order) + (had if not k else b"") + t.lower().encode() + (b"\xff" if ended or k < len(texts) - 1 else b"")
                want += [(int.from_bytes(data[i - order : i + 1], "big"), k) for i in range(order + (0 if k else len(had)), len(data))]
            got = ppm.text_grams(raw, off, order, had, ended)
            assert list(zip(*(x.tolist() for x in got), strict=True)) == want
