import random

import numpy as np
import pyarrow as pa

from tidemill.llm import fm_quality as fm
from tidemill.llm import textkernel as tk


def text(rng, good):
    words = ["".join(rng.choice(["an", "er", "th", "ou", "li"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 200))]
    return " ".join(words) + "." if good else " ".join(w.upper() + "!!" if rng.random() < 0.9 else w for w in words)


def test_identity_equals_pairwise_sum():
    rng = np.random.default_rng(0)
    model = fm.Model(0.3, rng.normal(0, 0.3, (fm.BUCKETS, 1 + fm.RANK)), rng.normal(0, 0.1, (fm.STATS, 1 + fm.RANK)), np.zeros(fm.STATS), np.ones(fm.STATS))
    ((_, _, raw, off),) = tk.slices(pa.array(["Ab cd ab, zz", "", None]))
    bucket, words, stats = fm.features(raw, off)
    x = np.concatenate((np.full(4, 0.5), np.clip(stats[0], -6, 6)))
    v = np.concatenate((model.word[bucket], model.stat))
    raw_score = model.w0 + x @ v[:, 0] + sum(x[i] * x[j] * (v[i, 1:] @ v[j, 1:]) for i in range(len(x)) for j in range(i))
    got = fm._scores(model, bucket, words, stats)
    assert abs(got[0] - 1 / (1 + np.exp(-raw_score))) < 1e-9 and got[1] == got[2]


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, i % 4 > 0), "x", i) for i in range(900)] + [(None, None, "x", 1), (5000, "", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, label long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(900)] + [(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    model = fm.train(docs, labels.where(~fm.held_out()))
    got = fm.score(docs.drop("score"), model, keep=("doc_id", "label")).withColumn("held_out", fm.held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(held) > 200 and np.mean([r["predicted"] == (r["doc_id"] % 4 > 0) for r in held]) > 0.98
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = fm.train(docs, labels)
    assert all(abs(r["score"] - 0.5) < 0.01 for r in fm.score(docs, model).collect())
    assert fm.score(docs.limit(0), model, keep=("doc_id",)).collect() == []


def test_fit_reads_every_word(spark):
    # what tells the labels apart is never among 1 000 evenly spaced words
    rng = random.Random(5)
    kinds = [["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50)] for _ in range(2)]
    rows = [(i, " ".join("aaaaa" if k % 4 == 0 else rng.choice(kinds[i % 2]) for k in range(4000))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fm.train(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    got = fm.score(docs, model, keep=("doc_id",)).where("doc_id >= 60").collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)


def test_same_rows_in_any_order(spark):
    rng = random.Random(6)
    rows = [(i % 12, text(rng, i % 2)) for i in range(48)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    a, b = (fm.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels, sample=12) for r, n in ((rows, 1), (rows[::-1], 3)))
    assert a.w0 == b.w0 and np.array_equal(a.word, b.word)
