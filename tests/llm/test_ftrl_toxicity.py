"""The classifier against a plain sum over features, a plain FTRL loop, held-out texts, and odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemill.llm import ftrl_toxicity as ft

BAD = ["fool", "Ratbag!", "scoundrel,"]
CLASHES = [f"{i} as {c}" for i, c in enumerate("o x label grams predicted held_out _text _id score size".split())]


def made(n=400, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "Th", "ou", "é", "st"]) for _ in range(rng.randrange(1, 5)))
    rows = []
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(4, 120))]
        if i % 4 == 0:
            for _ in range(rng.randrange(1, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(BAD)
        rows.append((i, " ".join(ws), "en", "s1" if i % 3 else None, 1))
    rows += [(7, None, None, None, None), (8, "", "en", "s2", 0), (9, " \t\n", "en", "é", 3), (5, rows[5][1], "x", "s2", 1), (None, "no id fool", "en", "many", 1)] + [(6, "said again", "en", "many", 1)] * 50
    rows += [(5000, "ab cd " * 200_000 + "the fool " + "x" * 500, "en", "s2", 1), (5004, "ab cd " * 200_000, "en", "s2", 1)]
    return rows


def plain(text):
    """The features by single words: the hash of each word, pair, skipping pair and beginning, one at a time."""
    one = lambda t: {int(g) for _, gs in ft.grams(pa.array([t])) for g in gs}
    words = [w for w in (text or "").split()]
    out = set()
    for i in range(len(words)):
        out |= one(words[i])
        if i + 1 < len(words):
            out |= one(" ".join(words[i : i + 2]))
        if i + 2 < len(words):
            out |= one(" ".join((words[i], words[i + 1], words[i + 2])))
    return out


def test_features_are_those_of_single_words():
    texts = [r[1] for r in made(30)[:30]] + ["One two three one two four", "...", "a... (b) c", None]
    got = [set() for _ in texts]
    for row, gram in ft.grams(pa.array(texts)):
        for r, g in zip(row.tolist(), gram.tolist(), strict=True):
            got[r].add(g)
    assert got == [plain(t) for t in texts]
    # case and signs at ends do not count, signs alone do; gaps differ from pairs
    same = lambda a, b: {int(g) for _, gs in ft.grams(pa.array([a])) for g in gs} == {int(g) for _, gs in ft.grams(pa.array([b])) for g in gs}
    assert same("Fool!", "fool") and same("(a, b)", "a b") and not same("!", "?") and not same("a b", "b a")


def test_windows_change_nothing():
    texts = pa.array(["ab cd ef gh " * 300 + "z" * 700 + " q r s", "é " * 900, None, "", "short one"])
    sets = lambda: [[set(x) for x in zip(*((r, g) for r, g in zip(row.tolist(), gram.tolist(), strict=True)), strict=True)] for row, gram in ft.grams(texts)]
    flat = lambda: {(r, g) for row, gram in ft.grams(texts) for r, g in zip(row.tolist(), gram.tolist(), strict=True)}
    whole = flat()
    ft.WINDOW, old = 500, ft.WINDOW
    try:
        assert flat() == whole and len(sets()) > 4
    finally:
        ft.WINDOW = old


def test_ftrl_is_the_plain_loop():
    rng = np.random.default_rng(4)
    texts = [np.unique(rng.integers(0, 40, 12)).astype(np.uint64) for _ in range(60)]
    labels = np.asarray([float(3 in t) for t in texts])
    m = ft.ftrl(texts, labels, epochs=2, l1=0.5)
    times = Counter(int(k) for t in texts for k in t)
    keys = [-1, *sorted(k for k in times if times[k] >= ft.COMMON)]
    z, n = dict.fromkeys(keys, 0.0), dict.fromkeys(keys, 0.0)
    share = labels.mean()
    heavy = {1.0: min(4, max(1, (1 - share) / share)), 0.0: min(4, max(1, share / (1 - share)))}

    def w(k):
        bound = 0 if k == -1 else 0.5
        return 0.0 if abs(z[k]) <= bound else -(z[k] - math.copysign(bound, z[k])) / ((1 + math.sqrt(n[k])) / 0.3 + 1)

    order = np.random.default_rng(1)
    for _ in range(2):
        for d in order.permutation(len(texts)):
            x = [-1, *(int(k) for k in texts[d] if times[int(k)] >= ft.COMMON)]
            ws = {k: w(k) for k in x}
            g = heavy[labels[d]] * (1 / (1 + math.exp(-sum(ws.values()))) - labels[d])
            for k in x:
                s = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.3
                z[k] += g - s * ws[k]
                n[k] += g * g
    want = {k: w(k) for k in keys if w(k) and k >= 0}
    assert m.keys.tolist() == sorted(want) and np.allclose(m.weights, [want[k] for k in sorted(want)]) and math.isclose(m.bias, w(-1))
    assert 3 in want and 0 < len(want) < len(keys)


def test_query(spark, tmp_path):
    rows = made()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *CLASHES).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (3, None, None)]
    runs = []
    for part, wrong in (("a", False), ("b", True)):
        # what is held out does not teach: the second run lies about it
        spark.createDataFrame([(i, q, 1 - t if wrong and t is not None and out(i) else t) for i, q, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / part / "labels.parquet"))
        (tmp_path / part / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        runs.append(ft.QUERIES["op11_ftrl_toxicity"](spark, str(tmp_path / part)).collect())
    got = runs[0]
    assert Counter(map(tuple, got)) == Counter(map(tuple, runs[1]))
    assert Counter((r["doc_id"], r["held_out"]) for r in got) == Counter((r[0], out(r[0])) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    once = [r for r in got if r["held_out"] and r["doc_id"] < 400 and sum(x[0] == r["doc_id"] for x in rows) == 1]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in once) >= 0.97 * len(once) and len(once) > 50
    # a bad word at the end of a very long text is found, and a clean long text is left alone
    assert [r["predicted"] for r in got if r["doc_id"] in (5000, 5004)] == [int(r["doc_id"] == 5000) for r in got if r["doc_id"] in (5000, 5004)]
    # a null text scores as an empty one does
    model = ft.train(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "a" / "labels.parquet")).where(~ft.held_out()))
    assert len({r["score"] for r in ft.score(spark.createDataFrame([("",), (None,), (" ",)], "text string"), model).collect()}) == 1


def test_one_label_only_and_sampled_bytes(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} said") for i in range(20)], "doc_id long, text string")
    same = ft.train(docs, spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int"))
    assert len(same.keys) == 0 and {r["predicted"] for r in ft.score(docs, same).collect()} == {0}
    few = ft.train(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(20)], "doc_id long, toxic int"), sample_bytes=1)
    assert len(few.keys) == 0
