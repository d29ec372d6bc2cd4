"""Queries of the readers: files are written from pages into columns and read back as a venue's would be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.registry import read, split
from tidemill.sources import landed, xml


def _files(spark, sf_dir, piece: Column, head: str, tail: str, between: str = "") -> DataFrame:
    """(file, content): a file for each 200 pages of a language at most, their pieces in order."""
    name = F.concat(F.regexp_extract("url", "/(en|fr|de|es)/", 1), F.lit("-"), F.floor(F.col("page_id") / 200).cast("string"))
    pages = read(spark, sf_dir, "pages").select(name.alias("file"), F.struct("page_id", piece.alias("x")).alias("p"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["x"]), between)
    return pages.groupBy("file").agg(F.concat(F.lit(head), body, F.lit(tail)).alias("content"))


def sitemap_read(spark, sf_dir):
    amp = F.replace("url", F.lit("&"), F.lit("&amp;"))
    files = _files(spark, sf_dir, F.concat(F.lit("<url><loc>"), amp, F.lit("</loc>"), F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-03-01T00:00Z</lastmod>").otherwise(""), F.lit("</url>")), "<?xml version='1.0'?><urlset>", "</urlset>")
    return landed.sitemap_pages(files)


def url_lines_read(spark, sf_dir):
    return landed.sitemap_pages(_files(spark, sf_dir, F.col("url"), "﻿", "\n\n", "\n"))


def url_json_read(spark, sf_dir):
    return landed.sitemap_pages(_files(spark, sf_dir, F.to_json(F.struct("url")), "[", "]", ","))


def feed_read(spark, sf_dir):
    """Feeds with references, CDATA, quotes of both kinds, durations of three forms, and enclosures that are none or not to be fetched."""
    k = F.col("page_id")
    ident = k.cast("string")
    amp = F.replace("url", F.lit("&"), F.lit("&amp;"))
    title = F.when(k % 3 == 0, F.concat(F.lit("Tom &amp; &#74;"), ident)).when(k % 3 == 1, F.concat(F.lit("<![CDATA[<b> & "), ident, F.lit("]]>"))).otherwise(F.concat(F.lit("\n T"), ident, F.lit(" ")))
    long = F.when(k % 4 == 0, "1:01:05").when(k % 4 == 1, "1:05").when(k % 4 == 2, "77")
    duration = F.coalesce(F.concat(F.lit("<itunes:duration>"), long, F.lit("</itunes:duration>")), F.lit(""))
    enclosure = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit("<enclosure length='"), ident, F.lit("' url='"), amp, F.lit("'/>"))).when(k % 5 == 2, F.concat(F.lit('<enclosure url="ftp://x/'), ident, F.lit('" length="3"></enclosure>'))).otherwise(F.concat(F.lit('<enclosure length="" url="'), amp, F.lit('"/>')))
    item = F.concat(F.lit("<item><title>"), title, F.lit("</title>"), duration, enclosure, F.lit("<pubDate>d</pubDate></item><!-- <item/> -->"))
    return xml.feed_items(_files(spark, sf_dir, item, '<?xml version="1.0"?><rss xmlns:itunes="http://www.itunes.com/dtds/podcast-1.0.dtd"><channel><title>no</title>', "</channel></rss>"))


def json_list_read(spark, sf_dir):
    rows = F.to_json(F.struct(F.col("page_id").alias("id"), F.lit("s").alias("slug"), F.col("url").alias("canonical_url")))
    return landed.json_rows(_files(spark, sf_dir, rows, "[", "]", ","), landed.POST).select("file", "pos", "id", "canonical_url", "title")


def archive_read(spark, sf_dir):
    pages = _files(spark, sf_dir, F.to_json(F.struct(F.col("page_id").alias("id"))), "[", "]", ",")
    return landed.archive_posts(pages.withColumnRenamed("file", "page")).select("page", "place", "id")


def keyless_read(spark, sf_dir):
    """JSON inside a script element of a page."""
    embedded = F.concat(F.lit('<script id="__NEXT_DATA__">{"props":{"id":'), F.col("page_id").cast("string"), F.lit("}}</script>"), F.col("html"))
    found = F.regexp_extract(embedded, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    return read(spark, sf_dir, "pages").select("page_id", F.get_json_object(found, "$.props.id").cast("long").alias("id"), F.lit(True).alias("keyless"))


def item_file_order(spark, sf_dir):
    """Day files stamp--id.json by name: the first and last of each day."""
    name = F.concat(F.lpad(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), 13, "0"), F.lit("--"), F.col("event_id").cast("string"), F.lit(".json"))
    return read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), name.alias("name")).groupBy("day").agg(F.min("name").alias("first"), F.max("name").alias("last"), F.count("*").alias("n"))


def sitemap_odd_read(spark, sf_dir):
    """Tags with a prefix, CDATA, numbered references, and an index."""
    k = F.col("page_id")
    loc = F.when(k % 3 == 0, F.concat(F.lit("<![CDATA["), "url", F.lit("]]>"))).when(k % 3 == 1, F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&#38;")), F.lit("/"), F.lit("&#x2F;")), F.lit("="), F.lit("&#61;"))).otherwise(F.concat(F.lit("\n "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("\t")))
    pieces = F.concat(F.lit('<s:url id="1"><s:loc>'), loc, F.lit("</s:loc><s:lastmod >2024-01-02</s:lastmod></s:url>"))
    return landed.sitemap_pages(_files(spark, sf_dir, pieces, '\n<s:urlset xmlns:s="urn:x">', "</s:urlset>")).unionByName(landed.sitemap_pages(_files(spark, sf_dir, F.concat(F.lit("<sitemap><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc></sitemap>")), "<sitemapindex>", "</sitemapindex>")))


def manifest_read(spark, sf_dir):
    leaf = F.to_json(F.struct(F.col("page_id").cast("string").alias("asset_id"), F.lit("n").alias("name"), F.array(F.lit("a"), F.lit("b")).alias("path"), F.col("url").alias("view_url")))
    return landed.share_leaves(_files(spark, sf_dir, leaf, '{"leaves":[', "]}", ",")).select("file", "pos", "asset_id", F.array_join("path", "/").alias("path"), "view_url")


def tree_walk(spark, sf_dir):
    """400 pages are a share: each fifth a folder, three of them below one; the others are leaves of the folder before them. A walk enters 50 folders."""
    k, n = F.col("page_id"), F.floor(F.col("page_id") % 400 / 5)
    share = F.concat(F.lit("s"), F.floor(k / 400).cast("string"))
    folder = lambda j: F.concat(F.lit("f"), j.cast("string"))
    up = F.when(k % 5 > 0, folder(n)).when(n == 0, share).otherwise(folder(F.floor((n - 1) / 3)))
    cards = read(spark, sf_dir, "pages").select(share.alias("share"), up.alias("parent"), F.when(k % 5 == 0, folder(n)).otherwise(F.concat(F.lit("leaf"), k.cast("string"))).alias("id"), F.regexp_extract("url", "([^/]*)$", 1).alias("name"), (k % 5 == 0).alias("is_folder"), k.alias("pos"))
    return landed.tree_leaves(cards, most_folders=51).select("share", "id", F.array_join("path", "/").alias("path"))


def stored_items(spark, sf_dir):
    """Documents as mails whose fields change their types; every fifth is cut off."""
    k = F.col("doc_id")
    thread = F.when(k % 3 == 0, F.to_json(F.struct("source"))).when(k % 3 == 1, F.col("n_chars").cast("string")).otherwise(F.concat(F.lit('"'), F.col("source"), F.lit('"')))
    labels = F.when(k % 4 == 0, F.concat(F.lit('["a", 1, null, "'), F.col("lang"), F.lit('"]'))).when(k % 4 == 1, "7").otherwise('["x"]')
    item = F.concat(F.lit('{"thread": '), thread, F.lit(', "from": "'), F.col("lang"), F.lit('", "labels": '), labels, F.lit(', "attachments": [{"name": "'), F.col("source"), F.lit('", "mime": 3}, "no"]'), F.when(k % 5 == 0, "").otherwise("}"))
    x = landed.stored_item(item)
    return read(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", "x.thread", F.col("x.from").alias("sender"), F.array_join("x.labels", ",").alias("labels"), F.size("x.attachments").alias("files"), F.get("x.attachments", 0)["name"].alias("file"))


FILE = "regexp_extract(url, '/(en|fr|de|es)/', 1) || '-' || page_id // 200"
N = f"CAST(row_number() OVER (PARTITION BY {FILE} ORDER BY page_id) - 1 AS INTEGER)"
MS = "lpad(CAST(epoch_us(ts) // 1000 AS VARCHAR), 13, '0')"
PAIRS = {
    "sitemap_read": (sitemap_read, f"SELECT {FILE} AS file, {N} AS pos, url, CASE WHEN page_id % 2 = 0 THEN '2024-03-01' END AS lastmod, false AS child FROM pages"),
    "url_lines_read": (url_lines_read, f"SELECT {FILE} AS file, {N} AS pos, url, CAST(NULL AS VARCHAR) AS lastmod, false AS child FROM pages"),
    "url_json_read": (url_json_read, f"SELECT {FILE} AS file, {N} AS pos, url, CAST(NULL AS VARCHAR) AS lastmod, false AS child FROM pages"),
    "feed_read": (feed_read, f"""SELECT {FILE} AS file, {N} AS pos, ['Tom & J' || page_id, '<b> & ' || page_id, 'T' || page_id][page_id % 3 + 1] AS title, 'd' AS pub_date, [3665, 65, 77, NULL][page_id % 4 + 1] AS duration_s,
 CASE WHEN page_id % 5 IN (1, 3, 4) THEN url END AS enclosure, CASE page_id % 5 WHEN 1 THEN page_id WHEN 2 THEN 3 WHEN 3 THEN 0 WHEN 4 THEN 0 END AS bytes FROM pages"""),
    "json_list_read": (json_list_read, f"SELECT {FILE} AS file, {N} AS pos, page_id AS id, url AS canonical_url, CAST(NULL AS VARCHAR) AS title FROM pages"),
    "archive_read": (archive_read, f"SELECT {FILE} AS page, {N} AS place, page_id AS id FROM pages"),
    "sitemap_odd_read": (sitemap_odd_read, f"SELECT {FILE} AS file, {N} AS pos, url, '2024-01-02' AS lastmod, false AS child FROM pages UNION ALL SELECT {FILE}, {N}, url, NULL, true FROM pages"),
    "manifest_read": (manifest_read, f"SELECT {FILE} AS file, {N} AS pos, CAST(page_id AS VARCHAR) AS asset_id, 'a/b' AS path, url AS view_url FROM pages"),
    "tree_walk": (tree_walk, """WITH RECURSIVE f AS (SELECT page_id AS pos, page_id // 400 AS s, page_id % 400 // 5 AS j, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages WHERE page_id % 5 = 0),
w AS (SELECT s, j, [pos] AS places, name AS path FROM f WHERE j = 0 UNION ALL SELECT f.s, f.j, list_append(w.places, f.pos), w.path || '/' || f.name FROM f JOIN w ON f.s = w.s AND (f.j - 1) // 3 = w.j AND f.j > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY places) AS nth FROM w)
SELECT 's' || page_id // 400 AS share, 'leaf' || page_id AS id, path FROM pages JOIN n ON s = page_id // 400 AND j = page_id % 400 // 5 WHERE page_id % 5 > 0 AND nth <= 50"""),
    "stored_items": (stored_items, """SELECT doc_id, CASE WHEN doc_id % 5 > 0 AND doc_id % 3 = 2 THEN source END AS thread, CASE WHEN doc_id % 5 > 0 THEN lang END AS sender,
 CASE WHEN doc_id % 5 = 0 THEN '' ELSE ['a,' || lang, '', 'x', 'x'][doc_id % 4 + 1] END AS labels, CAST(doc_id % 5 > 0 AS INTEGER) AS files, CASE WHEN doc_id % 5 > 0 THEN source END AS file FROM documents"""),
    "keyless_read": (keyless_read, "SELECT page_id, page_id AS id, true AS keyless FROM pages"),
    "item_file_order": (item_file_order, f"WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, {MS} || '--' || event_id || '.json' AS name FROM events) SELECT day, min(name) AS first, max(name) AS last, count(*) AS n FROM e GROUP BY 1"),
}
QUERIES, ORACLES = split(PAIRS)
