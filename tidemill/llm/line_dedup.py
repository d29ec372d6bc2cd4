"""Line deduplication that returns keep bitmaps instead of text, in SQL functions only.

Every line goes as (key hash, document, position), range-partitioned on hash and document and sorted
within on position as well. A stream over that order takes the first occurrence of each key in each
document; counting those per key, combined before the shuffle, gives the documents that hold it, so a
line in a third of all documents is spread over partitions. Keys are 64-bit hashes: two
different lines of equal hash count as one.

A document's bitmap holds 64 lines in a word, words without a dropped line left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\x0b\x0c\r"
#: Keys of dropped lines that a broadcast may hold (8 bytes each, 16 in the hash table); beyond it they are joined.
MOST_BROADCAST = 2_000_000


def line_keys(text: Column) -> Column:
    """The hash of each line's key, in order; null where the key is empty. A null text is one empty line."""
    # only A-Z is lowered: folding runs over the whole text once, before lines are split
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.transform(F.split(folded, "\n", -1), lambda x: F.nullif(F.btrim(x, F.lit(BLANK)), F.lit("")))


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(hash, id, body, pos) for each line with a key; body tells texts of the same id apart."""
    body = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("body"), F.posexplode(line_keys(F.col(text_col))).alias("pos", "key"))
    return body.where("key is not null").select(F.xxhash64("key").alias("hash"), "id", "body", "pos")


def frequent_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """(hash) of the keys that least_docs documents hold; rows of one id are one document."""
    ordered = lines.repartitionByRange("hash", "id").sortWithinPartitions("hash", "id", "body", "pos")
    first = ordered.withColumn("first", F.row_number().over(Window.partitionBy("hash", "id").orderBy("body", "pos")) == 1)
    return first.where("first").groupBy("hash").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs).select("hash")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = 10) -> DataFrame:
    """(id, body, n_dropped, dropped) for each document that loses lines: dropped is an array of
    struct<word, bits>, bit p of word w set where line 64 * w + p goes, ordered by word.

    Lines are split at \\n; a key is the line stripped of 0x20 and 0x09-0x0D with A-Z lowered; lines of empty keys stay.
    A key in least_docs documents or more goes from all of them. body is xxhash64 of the text: rows that repeat
    an id and a text have one bitmap, rows that repeat an id with other texts have their own; a null id is an id."""
    lines = occurrences(docs, id_col, text_col)
    frequent = shared.saved(frequent_keys(lines, least_docs))
    few = frequent.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    gone = lines.join(F.broadcast(frequent) if few else frequent, "hash", "left_semi")
    words = gone.groupBy("id", "body", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    return words.groupBy("id", "body").agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text_col, n_lines, n_dropped and kept (the lines that stay, joined by \\n) for every row of docs."""
    held = bitmaps.withColumnsRenamed({"id": "_id", "body": "_body"})
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_body"))
    joined = docs.select(id_col, text_col).join(held, same, "left")
    # generated columns, so that lambdas read them and don't make them again for each line
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    made = joined.select(id_col, text_col, "n_dropped", "dropped", F.explode(F.array(lines)).alias("lines"))
    made = made.select("*", F.explode(F.array(F.map_from_entries("dropped"))).alias("words"))
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)))
    gone = lambda i: F.coalesce(F.element_at("words", F.shiftright(i, 6)), F.lit(0).cast("long")).bitwiseAND(bit(i)) != 0
    kept = F.array_join(F.filter("lines", lambda x, i: ~gone(i)), "\n")
    return made.select(
        id_col, text_col, F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept).alias("kept"),
    )


def op9_line_dedup(spark, sf_dir):
    """What each document keeps when lines that ten documents hold are gone."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {"op9_line_dedup": op9_line_dedup}
ORACLES = {
    "op9_line_dedup": """
WITH rows AS (
  SELECT doc_id, text, row_number() OVER () AS r FROM documents
), lines AS (
  SELECT r, doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 10
), flagged AS (
  SELECT k.r, k.doc_id, k.pos, k.line, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY r, doc_id
"""
}
