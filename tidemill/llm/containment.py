"""Benchmark decontamination: which short test items are contained in which documents, in SQL functions only.

A test item of n shingles that a document contains to the share t lacks (1 - t) n of them at most, so
that any floor((1 - t) n) + 1 of its shingles hold one that the document has: the item's MinHash sketch is
its so many smallest shingle hashes. Items are partitioned by size; a partition has the
largest hash of its sketches as a bound, and of a document only hashes below the largest bound of
the partitions that fit into it are looked up. What shares a hash is verified on the words of all shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

BLANK = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
#: Rows that a broadcast may hold; beyond it both sides are shuffled.
MOST_BROADCAST = 500_000


def words(text: Column) -> Column:
    """The lowered words of a text; null and blank texts have none."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP, -1))


def _once(column: Column) -> Column:
    """column as a generated one, so that the optimiser doesn't repeat it wherever it is used (within lambdas: for each element)."""
    return F.explode(F.array(column))


def _places(w: str, width: Column | int) -> Column:
    """0-based starts of the runs of width words."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(w) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashes(w: str, width: int) -> Column:
    return F.transform(_places(w, width), lambda i: F.xxhash64(*(F.get(F.col(w), i + j) for j in range(width))))


def _texts(w: str, width: Column) -> Column:
    return F.array_distinct(F.transform(_places(w, width), lambda i: F.array_join(F.slice(F.col(w), i + 1, width), " ")))


def _small(df: DataFrame) -> DataFrame:
    """df, broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """(item_id, doc_id, n_item, n_shared) where 100 * n_shared >= percent * n_item, over distinct shingles.

    An item of fewer than size words is one shingle of all its words, looked for at its own width. Items and documents
    without words (null, empty, blank) contain nothing and are in nothing. Of rows that repeat an id the fullest match
    counts, the one of more shingles among equals; null ids are an id. Empty tables give no rows; texts of any length are read whole; other columns are not read."""
    best = F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("share"), "n_shared", "n_item")).alias("m")
    return matches(docs, items, id_col, text_col, item_col, item_text, size, percent).groupBy("item_id", "doc_id").agg(best).select("item_id", "doc_id", "m.n_item", "m.n_shared")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """contained, for each text of an id: (item_id, doc_id, body, n_item, n_shared) with body the xxhash64 of the text."""
    it = items.select(F.col(item_col).alias("item_id"), F.xxhash64(item_text).alias("item_body"), _once(words(F.col(item_text))).alias("w")).where("size(w) > 0").distinct()
    it = it.withColumn("width", F.least(F.lit(size), F.size("w"))).withColumn("shingles", _texts("w", F.col("width")))
    it = shared.saved(it.withColumn("n_item", F.size("shingles")).withColumn("most_absent", F.floor(F.col("n_item") * (100 - percent) / 100).cast("int")))
    hashed = F.array().cast("array<long>")
    for k in range(1, size + 1):
        hashed = F.when(F.col("width") == k, _hashes("w", k)).otherwise(hashed)
    it = it.withColumn("sketch", F.slice(F.array_sort(F.array_distinct(hashed)), 1, F.col("most_absent") + 1))
    # size partitions: octaves of n_item, by width; one row each
    parts = it.groupBy("width", F.floor(F.log2("n_item")).alias("octave")).agg(F.min(F.col("n_item") - F.col("most_absent")).alias("fits"), F.max(F.array_max("sketch")).alias("bound")).collect()
    if not parts:
        kinds = dict(items.dtypes)[item_col], dict(docs.dtypes)[id_col]
        return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, doc_id {kinds[1]}, body long, n_item long, n_shared long")
    index = _small(it.select("item_id", "item_body", F.col("width").alias("at"), F.explode("sketch").alias("hash")))
    read = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("body"), _once(words(F.col(text_col))).alias("w"))
    hits = None
    for width in sorted({p["width"] for p in parts}):
        own = [p for p in parts if p["width"] == width]
        places = F.size("w") - width + 1
        bound = F.greatest(*(F.when(places >= p["fits"], p["bound"]) for p in own), F.lit(-(2**63)))
        found = read.select("doc_id", "body", bound.alias("bound"), _hashes("w", width).alias("hashes")).select("doc_id", "body", "bound", F.explode("hashes").alias("hash"))
        found = found.where(F.col("hash") <= F.col("bound")).join(index.where(F.col("at") == width), "hash").select("doc_id", "body", "item_id", "item_body")
        hits = found if hits is None else hits.union(found)
    hits = shared.saved(hits.distinct())
    # verify: all shingles of the documents found, as text
    wanted = _small(hits.select(F.col("doc_id").alias("d"), F.col("body").alias("b")).distinct())
    texts = read.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("body") == F.col("b"))).select("doc_id", "body", "w").dropDuplicates(["doc_id", "body"])
    pairs = hits.join(it.select(F.col("item_id").alias("i"), F.col("item_body").alias("ib"), "width", "n_item", "shingles"), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_body") == F.col("ib")))
    own = texts.withColumnsRenamed({"doc_id": "d", "body": "b"})
    both = pairs.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("body") == F.col("b"))).withColumn("n_shared", F.size(F.array_intersect("shingles", _texts("w", F.col("width")))))
    kept = both.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return kept.select("item_id", "doc_id", "body", F.col("n_item").cast("long").alias("n_item"), F.col("n_shared").cast("long").alias("n_shared"))


def op5_contained_items(spark, sf_dir):
    """Benchmark items that documents contain to three quarters or more."""
    return contained(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_contained_items": op5_contained_items}
ORACLES = {
    "op5_contained_items": r"""
WITH iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), ip AS (
  SELECT item_id, w, least(5, len(w)) AS width, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS i FROM iw WHERE len(w) > 0
), ish AS (
  SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM ip
), widths AS (
  SELECT DISTINCT width FROM ish
), dp AS (
  SELECT doc_id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i FROM dw, widths WHERE len(w) >= width
), dsh AS (
  SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM dp
), n AS (
  SELECT item_id, count(*) AS n_item FROM ish GROUP BY item_id
)
SELECT item_id, doc_id, n_item, count(*) AS n_shared
FROM ish JOIN dsh USING (width, s) JOIN n USING (item_id)
GROUP BY item_id, doc_id, n_item HAVING 100 * count(*) >= 75 * n_item
"""
}
