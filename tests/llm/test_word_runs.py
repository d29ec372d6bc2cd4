"""Runs by partition refinement against a plain search of every start and period."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import word_runs as wr


def plain(words, periods=4, least=6):
    """All runs: for each period the longest stretches, kept if no smaller period holds there."""
    out, n = [], len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, periods * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    names = {}
    words = np.asarray([names.setdefault(w, len(names)) for t in texts for w in t], np.uint64)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    out = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in wr.runs(words, at)), strict=True):
        out[t].append(tuple(run))
    return out


piece = st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 9)).map(lambda x: x[0] * x[1])
text = st.one_of(st.text("ab", max_size=60), st.lists(piece, max_size=5).map("".join), st.lists(piece, max_size=3).map("".join).map(lambda s: s * 5))


@settings(max_examples=300, deadline=None)
@given(st.lists(text, max_size=5), st.sampled_from([0, 12, 10_000]))
def test_runs_are_those_of_the_plain_search(texts, few):
    old, wr.FEW = wr.FEW, few
    try:
        assert found(texts) == [plain(t) for t in texts]
    finally:
        wr.FEW = old


def test_known_runs():
    assert found(["aaaaa", "aaaaaa", "abababab", "abababa", "", "x" + "abc" * 4 + "ab" + "y", "aaaaaab" * 4]) == [
        [], [(0, 6, 1)], [(0, 8, 2)], [], [], [(1, 14, 3)], [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]]


def test_a_long_periodic_text_takes_few_moves_a_level():
    n = 60_000
    words = np.arange(n, dtype=np.uint64) % np.uint64(7)
    assert [x.tolist() for x in wr.runs(words, np.asarray([0, n]))] == [[0], [0], [n], [7]]


def want(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    got = plain(words)
    dropped = {k for s, l, q in got for k in range(s + q, s + l)}
    best = max(got, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(got), *top, sha("".join(f"{s},{l},{q}\n" for s, l, q in got)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)))


def test_query(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [rng.choice(["a", "A", "bé", "c.", "dd"]) for _ in range(rng.randrange(0, 60))]
        k = rng.randrange(0, len(words) + 1)
        words = words[:k] + words[k : k + rng.randrange(1, 5)] * rng.randrange(1, 7) + words[k:]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(7, None), (8, ""), (None, "x " * 9), (None, None), (20, rows[20][1]), (20, rows[20][1]), (30, "z " * 40 + " q"), (5, "é " * 9), (2, "go on " * 3000 + "y" * 4000 + " " + "up " * 500)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"{k} as {c}" for k, c in enumerate("n_runs start length period _id _text starts lang source n_chars".split()))).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    old, wr.BATCH = wr.BATCH, 3000
    try:
        got = wr.QUERIES["op13_word_runs"](spark, str(tmp_path)).collect()
    finally:
        wr.BATCH = old
    expected = [want(*r) for r in rows]
    assert Counter(map(tuple, got)) == Counter(expected) and sum(r[1] > 0 for r in expected) > 60 and sum(r[1] > 1 for r in expected) > 2


def test_windows_of_a_long_text(monkeypatch):
    import pyarrow as pa

    texts = ["go on " * 3000 + "y" * 4000 + " " + "up " * 500, "short", None, "a b " * 20, "", "tail word " * 900]
    batch = pa.RecordBatch.from_arrays([pa.array([2, 3, 4, 5, 6, None]), pa.array(texts)], names=["_id", "_text"])
    whole = [b.to_pylist() for b in wr._reported(iter([batch]), True, 4, 6)]
    monkeypatch.setattr(wr, "BATCH", 700)
    assert [b.to_pylist() for b in wr._reported(iter([batch]), True, 4, 6)] == whole
