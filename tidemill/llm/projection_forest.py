"""Near-duplicate embeddings by a forest of random-projection trees.

Each node of a tree splits on a random direction of its own at the median of the sampled vectors that reach
it; a vector within a margin of a split goes to both sides. Vectors of a leaf are compared with one another, and links
unite. A label's vectors go down only as many levels as its number asks for, and a node that fewer than
LEAST sampled vectors reach is a leaf.

A pair that meets in several leaves is counted in the first only: a task works out the leaves of its vectors
again, as the trees are at hand, so rows carry one leaf and the vector, and no rows of pairs are made. A leaf of more
than ``block`` vectors is cut into cells, one for each two of its blocks, so no pair of it is left out. Equal vectors
are one vector with a count.

The trees are fitted on as many vectors as ``sample_bytes`` hold; every vector is indexed. At cosine 0.93 a split at the
default margin parts about one pair in a hundred, so that four trees of eight levels miss fewer than one in 10,000.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Sampled vectors that a node needs for a split of its own.
LEAST = 32
#: Leaves of over a block that a broadcast may hold; beyond it both sides are shuffled.
MOST_FULL = 200_000


@dataclass
class Tree:
    """For each level the nodes that split, ascending, their directions, and where each is cut. A node's number is 1 for the root, 2 n and 2 n + 1 below n."""

    nodes: list[np.ndarray] = field(default_factory=list)
    directions: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 5) -> list[Tree]:
    """Trees over unit vectors, the rows of sample."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        tree, node = Tree(), np.ones(len(sample), np.int64)
        for _ in range(depth):
            names, at, n = np.unique(node, return_inverse=True, return_counts=True)
            splits = n >= LEAST
            if not splits.any():
                break
            directions = rng.normal(size=(int(splits.sum()), sample.shape[1]))
            directions = (directions / np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-12)).astype(np.float32)
            which = np.where(splits, np.cumsum(splits) - 1, -1)[at]
            goes = np.flatnonzero(which >= 0)
            p = np.einsum("ij,ij->i", sample[goes], directions[which[goes]])
            by = np.lexsort((p, which[goes]))
            first = np.concatenate(([0], np.cumsum(n[splits])))
            cuts = np.asarray([np.median(p[by[a:b]]) for a, b in zip(first[:-1], first[1:], strict=True)])
            below = np.full(len(node), -1, np.int64)  # vectors of leaves take no further part
            below[goes] = 2 * node[goes] + (p > cuts[which[goes]])
            tree.nodes.append(names[splits])
            tree.directions.append(directions)
            tree.cuts.append(cuts)
            sample, node = (sample[goes], below[goes]) if len(goes) < len(node) else (sample, below)
        out.append(tree)
    return out


def leaves(forest: list[Tree], vectors: np.ndarray, depths: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, code of a leaf) of each unit vector; a code names the tree and the node."""
    rows, codes = [], []
    for t, tree in enumerate(forest):
        row, node = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        for level, names in enumerate(tree.nodes):
            at = np.minimum(np.searchsorted(names, node), len(names) - 1)
            going = (depths[row] > level) & (names[at] == node)
            if not going.any():
                break
            still_row, still_node = row[~going], node[~going]
            row, node, at = row[going], node[going], at[going]
            off = np.einsum("ij,ij->i", vectors[row], tree.directions[level][at]) - tree.cuts[level][at]
            right, left = off > -margin, off <= margin
            row = np.concatenate((still_row, row[right], row[left]))
            node = np.concatenate((still_node, 2 * node[right] + 1, 2 * node[left]))
        rows.append(row)
        codes.append((np.int64(t) << np.int64(48)) | node)
    return np.concatenate(rows), np.concatenate(codes)


def _unit(vectors: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column, all of length dim, in double precision and of length one."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    v = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    most = np.maximum(np.abs(v).max(1, keepdims=True, initial=0), 5e-324)
    v = v / most  # squares of very large or small components would leave the range
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _indexed(batches: Iterator[pa.RecordBatch], forest: dict[int, list[Tree]], margin: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            mine = batch.filter(pa.array(dims == dim))
            for a in range(0, mine.num_rows, 2000):
                p = mine.slice(a, 2000)
                row, code = leaves(forest[int(dim)], _unit(p.column("vector"), int(dim)), p.column("depth").to_numpy(), margin / np.sqrt(dim))
                by = np.argsort(row, kind="stable")
                out = p.take(pa.array(row[by]))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(code[by])], names=[*out.schema.names, "leaf"])


def _met(codes: np.ndarray, own: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the vectors x and y (places) share one of their codes; own has where those of each begin in codes, ascending."""
    width = int(np.diff(own).max(initial=0))
    table = np.full((len(own) - 1, width), -1, np.int64)
    at = np.repeat(np.arange(len(own) - 1), np.diff(own))
    table[at, np.arange(len(codes)) - own[at]] = codes
    out = np.zeros(len(x), bool)
    for a in range(0, len(x), 20_000):
        p, q = table[x[a : a + 20_000]], table[y[a : a + 20_000]]
        for k in range(width):
            out[a : a + 20_000] |= ((p[:, k : k + 1] == q) & (q >= 0)).any(1)
    return out


def _compare(pdf: pa.Table, forest: dict[int, list[Tree]], margin: float, least: float) -> pa.Table:
    """(rep, links, root) of a cell: the links found here first, and a vector that they reach."""
    pdf = pdf.sort_by("rep")
    dim, leaf = pdf["dim"][0].as_py(), pdf["leaf"][0].as_py()
    v, m, block, rep = _unit(pdf["vector"], dim), *(pdf[c].to_numpy() for c in ("m", "block", "rep"))
    n = len(v)
    cross = block.min() != block.max() or pdf["cell"][0].as_py() != block.min()
    row, code = leaves(forest[dim], v, pdf["depth"].to_numpy(), margin / np.sqrt(dim))
    row, code = row[code < leaf], code[code < leaf]
    by = np.lexsort((code, row))
    own = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n))))
    links, root = np.zeros(n, np.int64), np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a in range(0, n, 512):
        linked = v[a : a + 512] @ v.T >= least
        linked[np.arange(min(512, n - a)), np.arange(a, min(a + 512, n))] = False
        if cross:
            linked &= block[a : a + 512, None] != block[None, :]
        x, y = np.nonzero(linked)
        new = ~_met(code[by], own, x + a, y) if len(code) else np.ones(len(x), bool)
        x, y = x[new] + a, y[new]
        np.add.at(links, x, m[y])
        bounds = np.concatenate((np.flatnonzero(np.diff(x, prepend=-1)), [len(x)]))
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            roots = {find(z) for z in np.unique(root[y[i:j]]).tolist()} | {find(int(x[i]))}
            low = min(roots)
            for r in roots:
                root[r] = low
    ends = np.asarray([find(x) for x in range(n)])
    out = links > 0
    return pa.table({"rep": rep[out], "links": links[out], "root": rep[ends[out]]})


def _sampled(groups: DataFrame, dim: int, most: int) -> np.ndarray:
    """Unit vectors: at most so many of those of a length, picked by a hash."""
    picked = groups.where(F.col("dim") == dim).orderBy(F.xxhash64("vector"), "rep").limit(most).select("vector").toArrow()
    return _unit(picked["vector"], dim)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, trees: int = 4, leaf_size: int = 256, sample_bytes: int = 16_000_000, spill: float = 0.65, block: int = 2048) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Vectors are compared only where labels are equal and not null and lengths are equal. A vector that
    is null, empty or zero or holds a null or a value that is not finite links with nothing: its
    component is its own id. Rows that repeat an id are vectors of their own; a null id is kept as it is. Equal vectors
    of a label, of any number, link as one. An empty table gives no rows. Other columns, of whatever names, are not read.

    The driver gathers sample_bytes of vectors in double precision for each length of vectors."""
    shared.ship(vectors.sparkSession)
    ok = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector_col, lambda x: x != 0)
    given = vectors.select(F.col(id_col).alias("id"), F.when(F.coalesce(ok, F.lit(False)), F.col(label_col)).alias("label"), F.col(vector_col).alias("vector"))
    # two hashes stand for a vector
    keyed = given.select("id", "label", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    valid = keyed.where("label is not null")
    groups = valid.groupBy("label", "h1", "h2").agg(F.any_value("vector").alias("vector"), F.min("id").alias("first"), F.count("*").alias("m")).withColumn("dim", F.size("vector"))
    groups = shared.saved(groups).withColumn("rep", F.monotonically_increasing_id())  # fixed, as groups is stored
    sizes = groups.groupBy("label", "dim").agg(F.count("*").alias("n"))
    depth = sizes.withColumn("depth", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / leaf_size))).cast("int")).drop("n")
    deepest = {r["dim"]: r["d"] for r in depth.groupBy("dim").agg(F.max("depth").alias("d")).collect()}  # lengths of vectors are few
    forest = {dim: grow(_sampled(groups, dim, sample_bytes // (8 * dim)) if most else np.zeros((0, dim)), trees, most) for dim, most in deepest.items()}
    held = vectors.sparkSession.sparkContext.broadcast(forest)
    margin = spill * float(np.sqrt(2 - 2 * least))
    label_type, vector_type = (dict(groups.dtypes)[c] for c in ("label", "vector"))
    schema = f"label {label_type}, dim int, rep long, m long, vector {vector_type}, depth int, leaf long"
    indexed = shared.saved(groups.join(depth, ["label", "dim"]).select("label", "dim", "rep", "m", "vector", "depth").mapInArrow(lambda it: _indexed(it, held.value, margin), schema))
    keys = ["label", "dim", "leaf"]
    # the fullest leaves are cut into blocks, and each two blocks of one meet in a cell
    counts = indexed.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    full = shared.saved(counts.where("blocks > 1"))  # a row for each block of vectors at most
    full = F.broadcast(full) if full.count() <= MOST_FULL else full
    placed = indexed.join(full, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("cell", F.greatest("block", "other")).withColumn("side", F.least("block", "other"))
    # dealt out by cell, so that those of a leaf go to many tasks
    cells = cells.repartition(*keys, "side", "cell")
    found = cells.groupBy(*keys, "side", "cell").applyInArrow(lambda pdf: _compare(pdf, held.value, margin, least), "rep long, links long, root long")
    found = shared.saved(found)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = shared.components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct()).withColumnsRenamed({"id": "rep", "root": "class"})
    known = groups.select("label", "h1", "h2", "first", "m", "rep").join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep")).join(links, "rep", "left")
    known = shared.saved(known)
    least_of = shared.saved(known.groupBy("class").agg(F.min("first").alias("component_id")))  # both sides of the join are stored, so that Spark can split a large class
    known = known.join(least_of, "class").select(F.col("label").alias("l"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), (F.col("m") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("n"), "component_id")
    same = (F.col("label") == F.col("l")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    out = keyed.select("id", "label", "h1", "h2").join(known, same, "left")
    out = out.select("id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op10_projection_forest(spark, sf_dir):
    """Links and components of all embeddings."""
    return near_vectors(shared.table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id").withColumn("component_id", F.col("component_id").cast("long"))


QUERIES = {"op10_projection_forest": op10_projection_forest}
ORACLES: dict[str, str] = {}
