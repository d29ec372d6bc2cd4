"""Hard negatives by a vector-approximation file.

Components are whole numbers. Each dimension is cut into cells of about equal filling, and a vector's approximation is one byte a dimension, the
number of its cell. From the cells of a vector two tables give the middle and the half width of each, and with the anchor q

    sum_d q_d mid_d - sum_d |q_d| half_d  <=  score  <=  sum_d q_d mid_d + sum_d |q_d| half_d

which are the sums of the lower and upper entries of the anchor's own tables. Only vectors whose bounds may enter a window (the best few of the anchor's label, then the best few
between two scores of other labels) are scored exactly. What a task has scored so far narrows its windows on the way.

The anchors are the stated query set. They are read in blocks of bounded size, each broadcast to all tasks in turn; the vectors stay where they are, and a task gives the
best few of each window, so nothing grows with the pairs. Equal vectors of a label are one vector with its smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: Anchors and vectors whose bounds are held at once.
TILE_A, TILE_V = 512, 2048
#: Candidates scored at once.
SCORED = 20_000
_LAST = np.iinfo(np.int64).max


@dataclass
class Cells:
    """For each dimension the middle and the half width of each cell, and where the next cells begin."""

    starts: np.ndarray  # dim x (cells - 1)
    mid: np.ndarray  # dim x cells
    half: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> Cells:
        """Cells between quantiles of a sample; low and high hold all vectors, so that the outermost cells do."""
        n = 1 << bits
        starts = np.ceil(np.quantile(sample, np.arange(1, n) / n, axis=0)).T if len(sample) else np.tile(low[:, None], n - 1)
        starts = np.clip(starts, low[:, None], high[:, None])
        first = np.concatenate((low[:, None], starts), axis=1)
        last = np.concatenate((np.maximum(starts - 1, low[:, None]), high[:, None]), axis=1)
        last = np.maximum(first, last)
        return cls(np.ascontiguousarray(starts), first / 2 + last / 2, last / 2 - first / 2)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            out[:, d] = np.searchsorted(self.starts[d], vectors[:, d], "right")
        return out

    def lookup(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(codes.shape[1])
        return self.mid[d, codes], self.half[d, codes]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes of whole numbers: two bytes a component where all fit, else eight of a double."""
    for batch in batches:
        cells, dims, ok = [], [], []
        vectors = batch.column("vector")
        flat, off = vectors.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False))))
        with np.errstate(over="ignore"):
            values = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * 256)
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            v = values[a:b] + 0.0  # no negative zero
            small = bool((np.abs(v) < 2**15).all())
            cells.append(v.astype(np.int16).tobytes() if small else v.tobytes())
            dims.append(b - a if small else a - b)
            ok.append(bool(np.isfinite(v).all()))
        out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(cells, pa.binary())], names=["id", "label", "dim", "cells"])
        yield out.filter(pa.array(ok))


def _matrix(cells: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length as doubles; a negative length says that the bytes are doubles."""
    kind = np.int16 if dim >= 0 else np.float64
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), abs(dim)).astype(np.float64)


def _stacked(dims: np.ndarray, cells: list[bytes]) -> np.ndarray:
    out = np.empty((len(cells), abs(int(dims[0])) if len(dims) else 0))
    for kind in np.unique(dims):
        at = np.flatnonzero(dims == kind)
        out[at] = _matrix([cells[k] for k in at], int(kind))
    return out


def _with_self(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with their inner product with themselves."""
    for batch in batches:
        dims, every = batch.column("dim").to_numpy(), batch.column("cells").to_pylist()
        own = np.zeros(len(every), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            v = _matrix([every[k] for k in at], int(dim))
            own[at] = _exact(v, v)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "self"])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest and the largest component of each dimension that a task has met."""
    met: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        cells = batch.column("cells").to_pylist()
        for n in np.unique(np.abs(dims)):
            at = np.flatnonzero(np.abs(dims) == n)
            v = _stacked(dims[at], [cells[k] for k in at])
            low, high = met.get(int(n), (v[0], v[0]))
            met[int(n)] = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
    for n, (low, high) in met.items():
        yield pa.RecordBatch.from_arrays([pa.array([n] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(low), pa.array(high)], names=["n", "d", "low", "high"])


def _exact(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact; those beyond the range of long are its ends."""
    if not a.size or np.abs(a).max() * np.abs(v).max() * a.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", a, v).astype(np.int64)
    products = (sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), v.tolist(), strict=True))
    return np.asarray([min(max(s, -_LAST - 1), _LAST) for s in products], np.int64)


@dataclass
class Best:
    """The best few (score, id) of each window so far: greatest score, then smallest id."""

    score: np.ndarray  # windows x most
    id: np.ndarray
    many: np.ndarray
    floor: np.ndarray  # of each window the least score that may still enter

    @classmethod
    def of(cls, most: int, low: np.ndarray) -> Best:
        return cls(np.full((len(low), most), -_LAST - 1), np.full((len(low), most), _LAST), np.zeros(len(low), np.int64), low.astype(np.float64).copy())

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(window):
            return
        most = self.score.shape[1]
        order = np.lexsort((ids, ~score, window))  # ~ falls where a score rises, at every long
        w, s, i = window[order], score[order], ids[order]
        begin = np.flatnonzero(np.diff(w, prepend=-1))
        times = np.diff(np.append(begin, len(w)))
        rank = np.arange(len(w)) - np.repeat(begin, times)
        kept, names = rank < most, w[begin]
        both_s, both_i = (np.concatenate((x[names], np.full((len(names), most), y)), axis=1) for x, y in ((self.score, -_LAST - 1), (self.id, _LAST)))
        row = np.repeat(np.arange(len(names)), times)[kept]
        both_s[row, most + rank[kept]], both_i[row, most + rank[kept]] = s[kept], i[kept]
        order = np.lexsort((both_i, ~both_s), axis=-1)[:, :most]
        self.score[names], self.id[names] = np.take_along_axis(both_s, order, 1), np.take_along_axis(both_i, order, 1)
        self.many[names] = np.minimum(most, self.many[names] + times)
        full = names[self.many[names] == most]
        self.floor[full] = np.maximum(self.floor[full], self.score[full, -1])


def _searched(batches: Iterator[pa.RecordBatch], cells: dict[int, Cells], blocks: dict[int, dict], most: int) -> Iterator[pa.RecordBatch]:
    """(anchor, window's low and high, score, id): the best few of this task's vectors in each window.

    blocks: for each length of vectors, anchors by label: names, labels, vectors and windows (own: whether those of the own label or the others are sought).
    """
    best = {n: Best.of(most, b["w_low"]) for n, b in blocks.items()}
    for batch in batches:
        dims, every = batch.column("dim").to_numpy(), batch.column("cells").to_pylist()
        codes_of, ids_of, labels = batch.column("codes").to_pylist(), batch.column("ids").to_pylist(), batch.column("label").to_numpy()
        for n in np.unique(np.abs(dims)).tolist():
            if n not in blocks:
                continue
            b, own = blocks[n], np.flatnonzero(np.abs(dims) == n)
            own = own[np.argsort(labels[own], kind="stable")]
            for x in range(0, len(own), TILE_V):
                at = own[x : x + TILE_V]
                codes = np.frombuffer(b"".join([codes_of[k] for k in at]), np.uint8).reshape(len(at), n)
                mid, half = cells[n].lookup(codes)
                exact: dict[str, np.ndarray] = {}
                for y in range(0, len(b["name"]), TILE_A):
                    rows = slice(y, min(y + TILE_A, len(b["name"])))
                    lab_a, lab_v = b["label"][rows], labels[at]
                    if b["own"]:  # both are in order of label: the tile's span of common labels
                        v0, v1 = np.searchsorted(lab_v, lab_a[0]), np.searchsorted(lab_v, lab_a[-1], "right")
                    else:
                        v0, v1 = 0, len(at)
                    if v0 == v1:
                        continue
                    q = b["vectors"][rows]
                    with np.errstate(over="ignore", invalid="ignore"):
                        centre, width = q @ mid[v0:v1].T, np.abs(q) @ half[v0:v1].T
                        width += b["slack"][rows, None]
                        first, last = b["first"][y], b["first"][rows.stop]
                        w_a = b["w_anchor"][first:last] - y
                        floor = best[n].floor[first:last]
                        low = np.full(rows.stop - y, np.inf)
                        np.minimum.at(low, w_a, floor)
                        high = np.full(rows.stop - y, -np.inf)
                        np.maximum.at(high, w_a, b["w_high"][first:last])
                        out = (centre + width < low[:, None]) | (centre - width > high[:, None])
                    out |= (lab_a[:, None] != lab_v[None, v0:v1]) if b["own"] else (lab_a[:, None] == lab_v[None, :])
                    ca, cv = np.nonzero(~out)
                    if not len(ca):
                        continue
                    if "v" not in exact:
                        exact["v"] = _stacked(dims[at], [every[k] for k in at])
                        exact["many"] = np.asarray([len(ids_of[k]) for k in at])
                        exact["from"] = np.concatenate(([0], np.cumsum(exact["many"])))
                        exact["ids"] = np.asarray([_LAST if i is None else i for k in at for i in ids_of[k]], np.int64)
                    for z in range(0, len(ca), SCORED):
                        i, j = ca[z : z + SCORED], cv[z : z + SCORED] + v0
                        s = _exact(q[i], exact["v"][j])
                        # each window of the anchor that the score enters
                        many = b["first"][y + i + 1] - b["first"][y + i]
                        k = np.repeat(np.arange(len(i)), many)
                        w = np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(b["first"][y + i], many)
                        enters = (s[k] >= best[n].floor[w]) & (s[k] <= b["w_high"][w])
                        k, w = k[enters], w[enters]
                        times = exact["many"][j[k]]
                        r = np.repeat(np.arange(len(k)), times)
                        place = np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times) + exact["from"][j[k]][r]
                        best[n].add(w[r], s[k][r], exact["ids"][place])
    for n, found in best.items():
        w, rank = np.nonzero(np.arange(most) < found.many[:, None])
        named = blocks[n]["name"][blocks[n]["w_anchor"][w]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (named, blocks[n]["w_of"][w], found.score[w, rank], found.id[w, rank])], names=["anchor", "of", "score", "id"])


def _block(rows: list, own: bool, cells: dict[int, Cells]) -> dict[int, dict]:
    """Anchors as _searched takes them: rows of anchor, label, dim, cells and windows (of, low, high)."""
    out = {}
    for n in sorted({abs(r["dim"]) for r in rows}):
        mine = sorted((r for r in rows if abs(r["dim"]) == n), key=lambda r: (r["label"], r["anchor"]))
        vectors = _stacked(np.asarray([r["dim"] for r in mine]), [bytes(r["cells"]) for r in mine])
        windows = [r["windows"] for r in mine]
        reach = np.abs(cells[n].mid).max(1, initial=0) + np.abs(cells[n].half).max(1, initial=0)
        with np.errstate(over="ignore", invalid="ignore"):
            slack = 1e-12 * (np.abs(vectors) @ reach)  # of rounding; below a hundredth but for very large components
        out[n] = {
            "own": own, "name": np.asarray([r["anchor"] for r in mine], np.int64), "label": np.asarray([r["label"] for r in mine], np.int64), "vectors": vectors, "slack": slack,
            "first": np.concatenate(([0], np.cumsum([len(w) for w in windows]))).astype(np.int64), "w_anchor": np.repeat(np.arange(len(mine)), [len(w) for w in windows]),
            "w_of": np.asarray([w[0] for ws in windows for w in ws], np.int64), "w_low": np.asarray([w[1] for ws in windows for w in ws], np.float64), "w_high": np.asarray([w[2] for ws in windows for w in ws], np.float64),
        }
    return out


def _best_of(vectors: DataFrame, anchors: DataFrame, blocks: int, cells: dict[int, Cells], own: bool, most: int) -> DataFrame:
    """(anchor, of, score, id, rank): the best few of every window of every anchor, block by block of anchors."""
    spark, parts = vectors.sparkSession, []
    for k in range(blocks):
        rows = anchors.where(F.pmod(F.xxhash64("anchor"), F.lit(blocks)) == k).collect()  # a block
        held = spark.sparkContext.broadcast(_block(rows, own, cells))
        found = vectors.mapInArrow(lambda it, held=held: _searched(it, cells, held.value, most), "anchor long, of long, score long, id long")
        parts.append(shared.saved(found))
        held.unpersist()
    order = Window.partitionBy("anchor", "of").orderBy(F.desc("score"), "id")
    # of each task a few at most for each window
    return shared.saved(reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most))


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3,
    least: tuple[int, int] = (50, 100), most: tuple[int, int] = (95, 100), bits: int = 6, sample_rows: int = 20_000, block: int = 16_384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that anchor picks.

    Components count as floor(256 x), scores are exact inner products. Rows with a null label or vector, or a component that is null or not finite or leaves the range of doubles when
    taken 256 times, take no part. Only vectors of equal length meet; an empty vector meets empty ones, at score 0. An anchor's positives are its best
    rows of the same label, other than itself; its negatives for a positive the best rows of other labels whose score is between the two parts of the positive's.
    Ties go to the smaller id; a null id is last and comes out as null. Rows that repeat an id are rows of their own: each is an anchor, and each may be a positive of the other. Scores beyond the
    range of long count as its ends. An empty table gives no rows. Other columns are not read.

    Cells are fitted on sample_rows vectors of each length at most, and hold all. The driver gathers those and the anchors of a block, about block of them."""
    shared.ship(vectors.sparkSession)
    fine = F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    given = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    rows = given.select("id", F.struct("label", "is_anchor").alias("label"), "vector").mapInArrow(_whole, "id long, label struct<label: long, is_anchor: boolean>, dim int, cells binary")
    rows = shared.saved(rows.select("id", "label.label", "label.is_anchor", "dim", "cells"))
    keys = ["label", "dim", "cells"]
    # the few smallest ids stand for all rows of a vector: no window takes more
    few = max(positives + 1, negatives)
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("id")))).where(F.col("place") <= few)
    reps = shared.saved(ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("id").isNull(), "id"))).alias("ids")))
    reps = reps.withColumn("ids", F.transform("ids", lambda x: x["id"])).withColumn("rep", F.monotonically_increasing_id())  # fixed, as reps is stored
    ends = reps.select("dim", "cells").mapInArrow(_ranges, "n int, d int, low double, high double").groupBy("n", "d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("n", "d").collect()
    lengths = {n: [r for r in ends if r["n"] == n] for n in {r["n"] for r in ends}}  # those of vectors are few
    lengths |= {0: []} if reps.where("dim = 0").limit(1).count() else {}
    cells = {}
    for n, r in lengths.items():
        sample = reps.where(F.abs("dim") == n).orderBy(F.xxhash64("cells"), "rep").limit(sample_rows).select("dim", "cells").collect()
        low, high = (np.asarray([x[c] for x in r], np.float64) for c in ("low", "high"))
        cells[n] = Cells.of(_stacked(np.asarray([x["dim"] for x in sample]), [bytes(x["cells"]) for x in sample]), low, high, bits)

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, every = batch.column("dim").to_numpy(), batch.column("cells").to_pylist()
            codes: list[bytes] = [b""] * len(every)
            for n in np.unique(np.abs(dims)).tolist():
                at = np.flatnonzero(np.abs(dims) == n)
                for k, c in zip(at.tolist(), cells[n].codes(_stacked(dims[at], [every[k] for k in at])), strict=True):
                    codes[k] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], names=[*batch.schema.names, "codes"])

    file = shared.saved(reps.select("label", "dim", "cells", "ids").mapInArrow(approximated, "label long, dim int, cells binary, ids array<long>, codes binary"))
    # equal anchors of a label are one
    asked = rows.where("is_anchor").select(*keys).distinct().mapInArrow(_with_self, "label long, dim int, cells binary, self long")
    asked = shared.saved(asked).withColumn("anchor", F.monotonically_increasing_id())
    blocks = max(1, -(-asked.count() // block))
    every = F.array(F.struct(F.lit(0).cast("long").alias("of"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
    near = _best_of(file, asked.withColumn("windows", every), blocks, cells, True, positives + 1)
    # a score's window: the whole numbers n with least <= n / score <= most
    window = F.struct(F.col("score").alias("of"), F.ceil(F.col("score").cast("decimal(20,0)") * least[0] / least[1]).cast("double").alias("low"), F.floor(F.col("score").cast("decimal(20,0)") * most[0] / most[1]).cast("double").alias("high"))
    windows = near.select("anchor", window.alias("w")).where("w.low <= w.high").groupBy("anchor").agg(F.collect_set("w").alias("windows"))  # at most one for each positive
    far = _best_of(file, asked.join(windows, "anchor"), blocks, cells, False, negatives)
    null_id = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    # each row of an anchor leaves itself out of the list once
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("near"))
    own = rows.where("is_anchor").select("id", *keys).join(asked.select("anchor", "self", *keys), keys).select(F.col("id").alias("anchor_id"), "anchor", "self").join(lists, "anchor")
    itself = F.array_min(F.transform(F.filter("near", lambda x: (x["id"] == F.coalesce("anchor_id", F.lit(_LAST))) & (x["score"] == F.col("self"))), lambda x: x["rank"]))
    own = own.withColumn("itself", F.coalesce(itself, F.lit(positives + 1))).select("anchor_id", "anchor", F.explode(F.filter("near", lambda x: x["rank"] != F.col("itself"))).alias("p"))
    out = own.join(far, (own["anchor"] == far["anchor"]) & (F.col("p.score") == far["of"]))
    return out.select("anchor_id", null_id("p.id").alias("positive_id"), "rank", null_id("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_vector_approximation(spark, sf_dir):
    """The hard negatives of the anchors among all embeddings."""
    vectors = shared.table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


SQL = """
WITH cells AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, a.rowid_ = b.rowid_ AS itself,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM cells) a, (SELECT *, row_number() OVER () AS rowid_ FROM cells) b
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same AND NOT itself
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other)::INTEGER AS rank,
       n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) <= 3
"""

QUERIES = {"op12_vector_approximation": op12_vector_approximation}
ORACLES = {"op12_vector_approximation": SQL}
