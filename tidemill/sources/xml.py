"""Feeds and sitemaps as rows, by Spark's XML reader: references, CDATA, quotes and encodings are the reader's, and a broken file is refused.

A file is read as a stream of its row tag, so that no file is held whole and no list of its entries meets in one row. A file that breaks off fails the job:
its first entries would pass for the whole of a venue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemill.functions import times as d
from tidemill.functions import urls as u

ITEM = "title: string, pubDate: string, `itunes:duration`: string, enclosure: struct<_url: string, _length: string>"
PAGE = "loc string, lastmod string"


def tag_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """(file, pos, the fields of schema) of each element tag in the files of path; fields that an element lacks are null.

    pos counts from 0 in each file: a file is one task's, whose ids ascend, so its first id is all that a row needs, one row a file."""
    rows = spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(DataType.fromDDL(schema)).load(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"), "*")
    first = rows.groupBy(F.col("file").alias("_file")).agg(F.min("_id").alias("_first"))
    return rows.join(first, F.col("file") == F.col("_file")).select("file", (F.col("_id") - F.col("_first")).cast("int").alias("pos"), *(f"`{c}`" for c in rows.columns if c not in ("file", "_id")))


def _text(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def _entry(x) -> list[Column]:
    """The columns of a feed's item; x gives its fields by name. Only an address of http or https may be fetched; bytes are 0 where an enclosure does not say."""
    has = x("enclosure").isNotNull()
    size = F.coalesce(x("enclosure")["_length"].try_cast("bigint"), F.lit(0))
    return [
        _text(x("title")).alias("title"), _text(x("pubDate")).alias("pub_date"), d.feed_seconds(x("`itunes:duration`")).alias("duration_s"),
        u.http_url(x("enclosure")["_url"]).alias("enclosure"), F.when(has, size).alias("bytes"),
    ]


def feed_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, title, pub_date, duration_s, enclosure, bytes) of the items of RSS files, wherever they are in them."""
    return tag_rows(spark, path, "item", f"struct<{ITEM}>").select("file", "pos", *_entry(F.col))


def feed_items(files: DataFrame) -> DataFrame:
    """The same of feeds (file, content) in a column, each whole: items of a channel, or of the root. A feed that is no XML is refused."""
    shape = f"struct<channel: struct<item: array<struct<{ITEM}>>>, item: array<struct<{ITEM}>>>"
    x = F.from_xml("content", shape, {"mode": "FAILFAST"})
    listed = F.concat(F.coalesce(x["channel"]["item"], F.array()), F.coalesce(x["item"], F.array()))
    rows = files.select("file", F.posexplode(listed).alias("pos", "x"))
    return rows.select("file", "pos", *_entry(lambda name: F.col(f"x.{name}")))


def sitemap_rows(spark: SparkSession, path: str, tag: str = "url") -> DataFrame:
    """(file, pos, url, lastmod) of the pages of sitemap files; with the tag sitemap, the children of index files. Entries without an address are left out.

    Names are taken without a prefix, in whatever namespace."""
    rows = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", True)
    rows = rows.option("mode", "FAILFAST").schema(PAGE).load(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"), "*")
    first = rows.groupBy(F.col("file").alias("_file")).agg(F.min("_id").alias("_first"))
    rows = rows.join(first, F.col("file") == F.col("_file")).select("file", (F.col("_id") - F.col("_first")).cast("int").alias("pos"), F.nullif(_text(F.col("loc")), F.lit("")).alias("url"), d.day_part(F.nullif(_text(F.col("lastmod")), F.lit(""))).alias("lastmod"))
    return rows.where("url is not null")
