"""Toxicity by logistic regression fitted with FTRL-proximal.

Features of a text are the hashes of its words (lowered, bare of signs at their ends), of adjacent pairs and of
pairs with one word between them, and of the beginnings of long words; each counts once a text. Every coordinate has a learning rate of its own, which falls with
the squares of the gradients it has met, and the L1 term keeps a weight at zero until its evidence outgrows it. So a few hundred
of many million features have weights, and these are broadcast as two sorted arrays. Hashes have 64 bits:
the words of a long text do not meet those that have weights by chance.

The fit takes a bounded sample of the labelled rows; features that fewer than COMMON texts of it have could not outgrow the L1 term, and are
left out before the driver gathers the rest. Scoring reads whole texts, in windows.
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

#: Bytes of texts worked on at once.
WINDOW = 1_000_000
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
#: Bytes of a longer word's beginning that are a feature too, for its other endings.
HEADS = (4, 6)
#: Texts of the sample that a feature needs, and the parts in which features are counted.
COMMON, PARTS = 3, 16
#: Entries of the table that most hashes without a weight are turned away by.
_DOOR = 1 << 16


@dataclass
class Model:
    """The features that have weights, ascending, their weights, and what every text has."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    door: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, weights: np.ndarray, bias: float) -> Model:
        door = np.zeros(_DOOR, bool)
        door[(keys % np.uint64(_DOOR)).astype(np.int64)] = True
        return cls(keys, weights, bias, door)


def _bare(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without ASCII signs at their ends; a word of signs alone stays as it is."""
    solid = np.flatnonzero(~_SIGN[raw])
    if not len(solid) or not len(starts):
        return starts, ends
    a = solid[np.minimum(np.searchsorted(solid, starts), len(solid) - 1)]
    b = solid[np.maximum(np.searchsorted(solid, ends) - 1, 0)] + 1
    whole = (a < starts) | (a >= ends)
    return np.where(whole, starts, a), np.where(whole, ends, b)


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of each word, pair and skipping pair; a row may come again with the next window of a long text."""
    carried = np.zeros(0, np.uint64)
    for a, b, raw, off, before, _ in tk.windows(texts, WINDOW):
        starts, ends, words = tk.word_spans(raw, off)
        starts, ends = _bare(raw, starts, ends)
        h = tk.word_hashes(raw, starts, ends)
        row = np.repeat(np.arange(a, b), words)
        heads = []
        for size in HEADS:
            long = np.flatnonzero(ends - starts > size)
            heads.append((row[long], tk.mix64(tk.word_hashes(raw, starts[long], starts[long] + size) + np.uint64(size))))
        if before:  # pairs reach over the cut
            h, row = np.concatenate((carried, h)), np.concatenate((np.full(len(carried), a), row))
        carried = h[-2:]
        with np.errstate(over="ignore"):
            pair = tk.mix64(h[:-1] * _PAIR + h[1:])
            skip = tk.mix64(h[:-2] * _SKIP + h[2:])
        near, far = row[:-1] == row[1:], row[:-2] == row[2:]
        parts = [(row, h), (row[:-1][near], pair[near]), (row[:-2][far], skip[far]), *heads]
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def ftrl(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 5, alpha: float = 0.3, beta: float = 1.0, l1: float = 25.0, l2: float = 1.0, seed: int = 1) -> Model:
    """A model of texts, each the distinct features it has, and their labels (0 or 1); where labels are all alike, only the bias speaks."""
    y = np.asarray(labels, np.float64)
    if len(set(y.tolist())) < 2:
        return Model.of(np.zeros(0, np.uint64), np.zeros(0), 0.0 if not len(y) else 4.0 if y[0] else -4.0)
    keys, times = np.unique(np.concatenate(texts), return_counts=True)
    keys = keys[times >= COMMON]
    own = []
    for t in texts:
        at = np.searchsorted(keys, t)
        at[at == len(keys)] = 0
        own.append((at[keys[at] == t] + 1).astype(np.int32) if len(keys) else np.zeros(0, np.int32))
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)  # at 0 the bias, which L1 leaves alone
    # both labels weigh alike in sum at most fourfold, so that 0.5 parts them also where one is rare
    weight = np.where(y > 0, min(4.0, max(1.0, (1 - y.mean()) / y.mean())), min(4.0, max(1.0, y.mean() / (1 - y.mean()))))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        bound = np.full(len(z), l1)
        bound[0] = 0.0
        return np.where(np.abs(z) <= bound, 0.0, -(z - np.sign(z) * bound) / ((beta + np.sqrt(n)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(own)):
            i = np.concatenate((np.zeros(1, np.int32), own[k]))
            w = weights(z[i], n[i])
            g = weight[k] * (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[k])
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(z, n)
    kept = np.flatnonzero(w[1:])
    return Model.of(keys[kept], w[1:][kept], float(w[0]))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels and order of texts, and the distinct features of each."""
    for batch in batches:
        parts: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for row, gram in grams(batch.column("text")):
            at = np.lexsort((gram, row))
            row, gram = row[at], gram[at]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
            row, gram = row[first], gram[first]
            bounds = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                parts[row[x]].append(gram[x:y])
        sets = [p[0] if len(p) == 1 else np.unique(np.concatenate(p)) if p else np.zeros(0, np.uint64) for p in parts]
        for k in range(PARTS):
            own = [s[s % np.uint64(PARTS) == k].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("o"), batch.column("x"), pa.array([k] * len(own), pa.int32()), pa.array(own, pa.binary())], names=["label", "o", "x", "part", "grams"])


def _common(rows: pa.Table) -> pa.Table:
    """A part's rows with only those features that COMMON texts have."""
    sets = [np.frombuffer(g, np.uint64) for g in rows["grams"].to_pylist()]
    keys, times = np.unique(np.concatenate(sets), return_counts=True)
    keys = keys[times >= COMMON]
    kept = []
    for s in sets:
        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
        kept.append(s[keys[at] == s].tobytes() if len(keys) else b"")
    return rows.select(["label", "o", "x"]).append_column("grams", pa.array(kept, pa.binary()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 12_000, sample_bytes: int = 40_000_000) -> Model:
    """A model fitted on at most sample of the labelled rows with at most sample_bytes of text, picked by a hash of their id, with the whole text of each.

    Rows of over a sixteenth of sample_bytes are not picked. A text has fewer than two features for every byte, of eight bytes each, so that a part holds about sample_bytes at most, and the driver
    gathers those that COMMON texts have: as much as sample_bytes as a rule, 16 times that at the very most. Null labels and ids teach nothing, of an id labelled twice the larger label counts, a null text is empty, equal rows teach once.
    Without rows of both labels all texts score alike. Other columns are not read."""
    shared.ship(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("_id"), text.alias("text")).where(F.octet_length("text") <= sample_bytes // 16)
    rows = given.join(F.broadcast(picked), "_id").select("label", "text", F.xxhash64("_id").alias("o"), F.xxhash64("text").alias("x"))  # sample rows at most
    sizes = rows.select("o", "x", F.octet_length("text").alias("size")).distinct().orderBy("o", "x").limit(sample).collect()
    fits = np.flatnonzero(np.cumsum([r["size"] + 1 for r in sizes]) <= sample_bytes)
    if not len(fits):
        return ftrl([], np.zeros(0))
    last = sizes[int(fits[-1])]
    rows = rows.where((F.col("o") < last["o"]) | (F.col("o") == last["o"]) & (F.col("x") <= last["x"]))
    rows = rows.groupBy("o", "x").agg(F.max("label").alias("label"), F.any_value("text").alias("text"))
    parts = rows.mapInArrow(_sampled, "label int, o long, x long, part int, grams binary").groupBy("part").applyInArrow(_common, "label int, o long, x long, grams binary")
    texts: dict[tuple, list[bytes]] = {}
    for r in parts.toLocalIterator():
        texts.setdefault((r["o"], r["x"], r["label"]), []).append(bytes(r["grams"]))
    found = sorted(texts)
    return ftrl([np.sort(np.frombuffer(b"".join(texts.pop(k)), np.uint64)) for k in found], np.asarray([k[2] > 0 for k in found], np.float64))


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, gram in grams(texts):
        if len(model.keys):
            open_ = np.flatnonzero(model.door[(gram % np.uint64(_DOOR)).astype(np.int64)])
            row, gram = row[open_], gram[open_]
            at = np.minimum(np.searchsorted(model.keys, gram), len(model.keys) - 1)
            known = model.keys[at] == gram
            rows.append(row[known])
            places.append(at[known])
    hits = np.unique(np.stack((np.concatenate(rows), np.concatenate(places)), axis=1), axis=0)
    total = model.bias + np.bincount(hits[:, 0], model.weights[hits[:, 1]], len(texts)) if len(hits) else np.full(len(texts), model.bias)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = (), names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns keep of docs with score (0 to 1) and predicted, under names, which stand beside those of keep and must differ from them.

    A null text scores as an empty one, by the bias; a text of any length by all its words, in windows; rows that repeat each; an empty table gives no rows."""
    shared.ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded, as the sample is

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(held.value, batch.column("_text"))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*batch.schema.names[1:], *names])

    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    schema = T.StructType([*docs.select(*keep).schema.fields, *added])
    return docs.select(F.col(text_col).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def op11_ftrl_toxicity(spark, sf_dir):
    """The toxicity of every document."""
    docs = shared.table(spark, sf_dir, "documents")
    model = train(docs, shared.table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model, keep=("doc_id",)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op11_ftrl_toxicity": op11_ftrl_toxicity}
ORACLES: dict[str, str] = {}
