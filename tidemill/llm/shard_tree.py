"""Sharding by a hierarchical weighted hash tree, in SQL functions only.

Regions, racks and shards form a tree. At each level every child of the node reached draws
log(u) / weight with u a uniform hash of the document id and the child's name, and the highest draw wins; a
node weighs what its shards weigh. A change of weights moves documents only into subtrees that gained or out of those that
lost. A tree grows by a region of its own for each further shard, so that the subtree that gains is the new shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared


#: Sets of very many equal rows that a broadcast may hold; beyond it both sides are shuffled.
MOST_HOT = 100_000


@dataclass(frozen=True)
class Node:
    """A region, a rack or a shard: a shard has its number, the others have children."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int = -1


def tree(shards: int = 16, racks: int = 4, in_rack: int = 4, base: int = 16, weights: dict[int, float] | None = None) -> Node:
    """Shards below base in racks of in_rack, racks of half the number in a region; each one from base on in its own region.

    base is the number of shards that the first layout had, and stays as it was when shards are added: fewer shards than base are
    refused, as grouping them anew would move rows between shards that stay."""
    if not 0 < base <= shards:
        raise ValueError(f"{shards} shards are fewer than the {base} of the first layout: give the base that the first layout had")
    weigh = lambda k: (weights or {}).get(k, 1.0)
    leaves = [Node(f"s{k}", weigh(k), (), k) for k in range(shards)]

    def group(kind: str, nodes: list[Node], by: int) -> list[Node]:
        parts = [tuple(nodes[i : i + by]) for i in range(0, len(nodes), by)]
        return [Node(f"{kind}{k}", sum(x.weight for x in p), p) for k, p in enumerate(parts)]

    regions = group("region", group("rack", leaves[:base], in_rack), max(1, racks // 2))
    for leaf in leaves[base:]:
        rack = Node(f"rack-of-{leaf.name}", leaf.weight, (leaf,))
        regions.append(Node(f"region-of-{leaf.name}", leaf.weight, (rack,)))
    root = Node("root", sum(r.weight for r in regions), tuple(regions))
    if any(x.weight < 0 for x in leaves) or not root.weight > 0:
        raise ValueError("weights are 0 or more, and one of them is more")
    return root


def place(node: Node, key: Column) -> Column:
    """The shard to which the tree sends a key; a null key is a key like any other. A node of weight 0 gets nothing."""
    if not node.children:
        return F.lit(node.shard)
    children = [c for c in node.children if c.weight > 0]
    if len(children) == 1:
        return place(children[0], key)
    draws = []
    for i, child in enumerate(children):
        # 53 bits of the hash, in (0, 1)
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(child.name), F.coalesce(key.cast("string"), F.lit("null key"))), 11).cast("double") + 0.5) / float(2**53)
        draws.append(F.struct((F.log(u) / F.lit(child.weight)).alias("draw"), F.lit(i).alias("i")))
    won = F.greatest(*draws)["i"]
    out = place(children[-1], key)
    for i in range(len(children) - 2, -1, -1):
        out = F.when(won == i, place(children[i], key)).otherwise(out)
    return out


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, slot_rows: int = 50_000, base: int = 16) -> DataFrame:
    """docs with shard, slot, shard_size, shard_crc32 and grown_shard (the shard if there is one more), in place of columns of these names.

    The grown shard of any number of shards is the shard of one more, and differs only where it is the new one, as long as base, the number of the first layout
    (at most shards, else an error), is kept.

    Size: the text's UTF-8 bytes plus 1, for null 1, however long. Slots count from 0 in each shard without gaps, in the order of
    buckets of about slot_rows rows and within these of (id, checksum, size); rows equal in these are interchangeable, and where
    over slot_rows are equal they come last in their shard. An empty table gives no rows."""
    now, grown = tree(shards, base=base), tree(shards + 1, base=base)
    sized = docs.withColumns({
        "shard_size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1,
        "shard_crc32": F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")),
        "shard": place(now, F.col(id_col)).cast("int"),
        "grown_shard": place(grown, F.col(id_col)).cast("int"),
    })
    return slots(sized.drop("slot"), id_col, slot_rows)


def slots(placed: DataFrame, id_col: str, slot_rows: int) -> DataFrame:
    """placed with slot. Rows are numbered within buckets of a shard, and a table of the buckets' counts gives where each begins."""
    same = [id_col, "shard_crc32", "shard_size"]
    each = placed.groupBy(*same).agg(F.count("*").alias("_rows"))
    found = each.agg(F.sum("_rows").alias("n"), F.max("_rows").alias("most")).first()
    buckets = max(1, -(-(found["n"] or 0) // slot_rows))
    own = F.pmod(F.xxhash64(*same), F.lit(buckets))
    if (found["most"] or 0) > slot_rows:
        # equal rows beyond a bucket's size are dealt by the part of a stored table that they are in: a task gets a part's at most
        hot = each.where(F.col("_rows") > slot_rows).select(*(F.col(c).alias(f"_h{i}") for i, c in enumerate(same)))  # one for each slot_rows rows at most
        hot = F.broadcast(hot) if hot.limit(MOST_HOT + 1).count() <= MOST_HOT else hot
        on = F.col(same[0]).eqNullSafe(F.col("_h0"))
        for i, c in enumerate(same[1:], 1):
            on = on & (F.col(c) == F.col(f"_h{i}"))
        rest = placed.join(hot, on, "left_anti").withColumn("_bucket", F.struct(F.lit(0).alias("hot"), own.alias("at"), *(F.lit(None).cast(t).alias(f"k{i}") for i, t in enumerate(dict(placed.dtypes)[c] for c in same)), F.lit(0).cast("long").alias("part")))
        many = shared.saved(placed.join(hot, on, "left_semi")).withColumn("_row", F.monotonically_increasing_id())
        many = many.withColumn("_bucket", F.struct(F.lit(1).alias("hot"), F.lit(0).cast("long").alias("at"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(same)), F.shiftright("_row", 33).alias("part"))).drop("_row")
        dealt = rest.unionByName(many)
    else:
        dealt = placed.withColumn("_bucket", own)
    counts = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_from"))
    within = Window.partitionBy("shard", "_bucket").orderBy(F.col(id_col).asc_nulls_first(), "shard_crc32", "shard_size")
    numbered = dealt.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(begins, (F.col("shard") == F.col("_s")) & F.col("_bucket").eqNullSafe(F.col("_b"))).withColumn("slot", (F.col("_from") + F.col("_at")).cast("long")).drop("_s", "_b", "_from", "_at", "_bucket")


def op8_shard_tree(spark, sf_dir):
    """Every document's shard, slot and place after growth by one shard."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = assign(docs, slot_rows=2_000).select("doc_id", F.col("shard_size").alias("size"), F.col("shard_crc32").alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")
    return out


QUERIES = {"op8_shard_tree": op8_shard_tree}
ORACLES: dict[str, str] = {}
