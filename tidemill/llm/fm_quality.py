"""Text quality by a factorisation machine.

Features of a text: its lowered words hashed into buckets, each occurrence weighing 1 over the
square root of the number of words, and structure statistics of its characters, words and lines. The score is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so pairwise interactions cost as much as the linear part. It is fitted here, by Adam on the logistic
loss, on a sample of labelled rows bounded by ``sample``, and scores whole texts batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from . import textkernel as tk

BUCKETS, RANK = 1 << 13, 4
STATS = 16


@dataclass
class Model:
    """Weights of words and statistics, and how the statistics are scaled."""

    w0: float
    word: np.ndarray  # BUCKETS x (1 + RANK): linear weight, then the factors
    stat: np.ndarray  # STATS x (1 + RANK)
    mean: np.ndarray
    scale: np.ndarray


def _runs(mark: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The sum of mark in each document."""
    run = np.concatenate(([0], np.cumsum(mark, dtype=np.int64)))
    return (run[off[1:]] - run[off[:-1]]).astype(np.float64)


def features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, words of each document, statistics) of a run of documents."""
    starts, ends, words = tk.word_spans(raw, off)
    h = tk.word_hashes(raw, starts, ends)
    bucket = (h >> np.uint64(40)).astype(np.int64) % BUCKETS
    at = np.concatenate(([0], np.cumsum(words)))
    size, n = np.diff(off).astype(np.float64), words.astype(np.float64)
    upper = (raw >= 65) & (raw <= 90)
    letter = upper | ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    digit = (raw >= 48) & (raw <= 57)
    space = np.isin(raw, np.asarray([32, 9, 10, 11, 12, 13], np.uint8))
    sign = ~(letter | digit | space)
    plain = np.isin(raw, np.frombuffer(b".,;:'\"-()", np.uint8))
    same = np.zeros(len(h), bool)  # the word before is the same
    same[1:] = h[1:] == h[:-1]
    twice = np.zeros(len(raw), bool)  # the sign before is the same
    twice[1:] = sign[1:] & (raw[1:] == raw[:-1])
    last = raw[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    odd_end = ~(((last >= 48) & (last <= 57)) | ((last >= 65) & (last <= 90)) | ((last >= 97) & (last <= 122)) | (last >= 128) | np.isin(last, np.frombuffer(b".,;:'\"-)?!", np.uint8)))
    lone_sign = (ends - starts == 1) & odd_end if len(ends) else np.zeros(0, bool)
    full_upper = np.zeros(len(h), bool)
    if len(h):
        up = np.concatenate(([0], np.cumsum(upper, dtype=np.int64)))
        low = np.concatenate(([0], np.cumsum((raw >= 97) & (raw <= 122), dtype=np.int64)))
        full_upper = (up[ends] - up[starts] > 0) & (low[ends] == low[starts])
    # distinct words and adjacent pairs, document by document
    distinct, pairs = np.ones(len(n)), np.ones(len(n))
    with np.errstate(over="ignore"):
        couple = tk.mix64(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
    for d in np.flatnonzero(words > 1):
        distinct[d] = len(np.unique(bucket[at[d] : at[d + 1]]))
        pairs[d] = len(np.unique(couple[at[d] : at[d + 1] - 1])) / (n[d] - 1)
    one = np.maximum(n, 1)
    chars = np.maximum(size - _runs(space, off), 1)
    newline = _runs(raw == 10, off) + 1
    stats = np.stack([
        np.log1p(n), np.log1p(size / newline), (size - _runs(space, off)) / one / 10, _runs(upper, off) / chars, _runs(digit, off) / chars, _runs(sign, off) / chars,
        _runs(sign & ~plain, off) / chars, _runs(twice, off) / chars, _runs(same, at) / one, _runs(odd_end, at) / one, _runs(lone_sign, at) / one, _runs(full_upper, at) / one,
        distinct / np.minimum(one, BUCKETS), pairs, _runs(raw == 124, off) / one, np.log1p(newline) / np.log1p(one + 1),
    ], axis=1)
    return bucket, words, stats


def _scores(model: Model, bucket: np.ndarray, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
    at = np.concatenate(([0], np.cumsum(words)))
    x = 1 / np.sqrt(np.maximum(words, 1))
    z = np.clip((stats - model.mean) / model.scale, -6, 6)
    both = np.zeros((len(words), 1 + RANK))
    square = np.zeros(len(words))
    own = (model.word[:, 1:] ** 2).sum(1)
    for k in range(1 + RANK):
        run = np.concatenate(([0], np.cumsum(model.word[bucket, k])))
        both[:, k] = (run[at[1:]] - run[at[:-1]]) * x
    run = np.concatenate(([0], np.cumsum(own[bucket])))
    square = (run[at[1:]] - run[at[:-1]]) * x**2
    both += z @ model.stat
    square += (z**2) @ (model.stat[:, 1:] ** 2).sum(1)
    raw = model.w0 + both[:, 0] + 0.5 * ((both[:, 1:] ** 2).sum(1) - square)
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], epochs: int = 60, seed: int = 1, rate: float = 0.02) -> Model:
    """A model of (buckets, words in each, statistics, label) rows; without both labels it scores all texts nearly alike."""
    rng = np.random.default_rng(seed)
    stats = np.asarray([r[2] for r in rows]).reshape(len(rows), STATS)
    y = np.asarray([r[3] for r in rows], np.float64)
    mean = stats.mean(0) if len(rows) else np.zeros(STATS)
    scale = np.maximum(stats.std(0), 1e-3) if len(rows) else np.ones(STATS)
    params = [np.zeros(1), rng.normal(0, 0.01, (BUCKETS, 1 + RANK)), rng.normal(0, 0.01, (STATS, 1 + RANK))]
    params[1][:, 0] = params[2][:, 0] = 0
    if len(set(y.tolist())) < 2:
        return Model(20.0 if len(y) and y[0] else 0.0, *params[1:], mean, scale)
    z = np.clip((stats - mean) / scale, -6, 6)
    # both labels weigh alike, so that 0.5 parts them also where one is rare
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    moment, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, size = 0, 64
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), size):
            pick = order[a : a + size]
            n = np.asarray([len(rows[i][0]) for i in pick])
            bucket = np.concatenate([rows[i][0] for i in pick]).astype(np.int64)
            times = np.concatenate([rows[i][1] for i in pick]).astype(np.float64)
            doc = np.repeat(np.arange(len(pick)), n)
            x = 1 / np.sqrt(np.maximum(np.bincount(doc, times, len(pick)), 1))[doc]
            xs = times * x  # each occurrence is a feature of its own
            vw = params[1][bucket]
            total = z[pick] @ params[2]
            for k in range(1 + RANK):
                total[:, k] += np.bincount(doc, vw[:, k] * xs, len(pick))
            square = (z[pick] ** 2) @ (params[2][:, 1:] ** 2).sum(1) + np.bincount(doc, (vw[:, 1:] ** 2).sum(1) * x * xs, len(pick))
            raw = params[0][0] + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(1) - square)
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[pick]) / len(pick)
            grads = [np.asarray([g.sum()]), np.zeros_like(params[1]), np.empty_like(params[2])]
            grads[1][:, 0] = np.bincount(bucket, g[doc] * xs, BUCKETS)
            for k in range(1, 1 + RANK):
                grads[1][:, k] = np.bincount(bucket, g[doc] * xs * (total[doc, k] - vw[:, k] * x), BUCKETS)
            grads[2][:, 0] = z[pick].T @ g
            grads[2][:, 1:] = z[pick].T @ (g[:, None] * total[:, 1:]) - ((z[pick] ** 2).T @ g)[:, None] * params[2][:, 1:]
            step += 1
            for p, d, m, s, decay in zip(params, grads, moment, second, (0, 1e-4, 1e-4), strict=True):
                d += decay * p
                m += 0.1 * (d - m)
                s += 0.01 * (d * d - s)
                p -= rate * (0.95**epoch) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Model(float(params[0][0]), params[1], params[2], mean, scale)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels and order of texts with their buckets, the words in each bucket, and statistics."""
    for batch in batches:
        for a, b, raw, off in tk.slices(batch.column("text")):
            bucket, words, stats = features(raw, off)
            at = np.concatenate(([0], np.cumsum(words)))
            own = [np.unique(bucket[x:y], return_counts=True) for x, y in zip(at[:-1], at[1:], strict=True)]
            parts = ([k.astype(np.int16).tobytes() for k, _ in own], [n.astype(np.int32).tobytes() for _, n in own], [x.tobytes() for x in stats])
            yield pa.RecordBatch.from_arrays([batch.column("label")[a:b], batch.column("o")[a:b], *(pa.array(x, pa.binary()) for x in parts)], names=["label", "o", "buckets", "times", "stats"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4000) -> Model:
    """A model fitted on at most sample of the labelled rows, picked by a hash of their id. Documents that repeat an id are rows each,
    twice sample at most of all; without labelled rows, or with an empty table, all texts score nearly alike. Other columns are not read.

    The bound keeps what the driver gathers below 2 * sample * (6 * BUCKETS + 8 * STATS) bytes, as a text has BUCKETS buckets at most. Null labels and ids
    teach nothing; of an id labelled twice the larger label counts."""
    shared.ship(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(picked), "_id")  # sample rows at most
    rows = texts.select("label", "text", F.xxhash64("_id").alias("o")).mapInArrow(_feature_rows, "label int, o long, buckets binary, times binary, stats binary")
    rows = rows.orderBy("o", "stats", "buckets", "times", "label").limit(2 * sample).collect()  # more than sample where docs repeat ids
    rows = sorted((bytes(r["stats"]), bytes(r["buckets"]), bytes(r["times"]), r["label"]) for r in rows)
    return fit([(np.frombuffer(b, np.int16), np.frombuffer(n, np.int32), np.frombuffer(s), y) for s, b, n, y in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns keep of docs with score (0 to 1) and predicted, under names, which stand beside those of keep and must differ from them.

    A null text scores as an empty one, a text of any length by all its words, rows that repeat each; an empty table gives no rows."""
    shared.ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, off in tk.slices(batch.column("_text")):
                s = _scores(held.value, *features(raw, off))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(1, part.num_columns)), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*part.schema.names[1:], *names])

    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    schema = T.StructType([*docs.select(*keep).schema.fields, *added])
    return docs.select(F.col(text_col).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def op7_fm_quality(spark, sf_dir):
    """The quality of every document."""
    docs = shared.table(spark, sf_dir, "documents")
    model = train(docs, shared.table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model, keep=("doc_id",)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op7_fm_quality": op7_fm_quality}
ORACLES: dict[str, str] = {}
