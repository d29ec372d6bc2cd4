"""Landed files as tables: sitemaps, feeds, archives, captions, documents. No source opens a network connection.

Schemas are given, never inferred; what cannot be read is null or an empty list.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidemill.functions import text as t
from tidemill.functions import times as d
from tidemill.storage import saved

POST = "id bigint, slug string, title string, audience string, post_date string, canonical_url string, type string"
MAIL = "id string, internal_date bigint, thread string, from string, to string, date string, subject string, labels array<string>, attachments array<struct<name:string,mime:string>>, body string"
TASK = "id string, last_edited string, database string, title string, status string, due string, assignee string, url string, body string"
LINKS = "url string, final_url string, title string, discovered_lesson_links array<struct<href:string,text:string>>"
ENTITY = "type string, id string, url string, name string, creator string, description string, images array<string>, release_date string, total int, items array<struct<type:string,id:string,url:string,name:string,show:string,artists:array<struct<name:string>>,duration_ms:bigint,release_date:string,explicit:boolean,preview_url:string>>"
VIDEO = "id string, title string, uploader string, channel string, channel_url string, upload_date string, duration int, duration_string string, view_count bigint, like_count bigint, thumbnail string, description string, chapters array<struct<start_time:double,end_time:double,title:string>>"
VERDICT = "id string, line string, junk string"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of text files, one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content"))


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", "length")


def sitemap_pages(files: DataFrame) -> DataFrame:
    """(file, pos, url, lastmod, child) of sitemaps, JSON lists and plain lists, told apart by their first character.
    A sitemap index gives its children only (child true). Tags may have a prefix, texts references and CDATA. A file that begins as
    XML or as a list and is broken is refused: the job fails, as an empty plan would look like a venue without pages."""
    text = F.regexp_replace("content", "^[\ufeff \\t\\r\\n]+", "")
    body = files.select("file", text.alias("x")).withColumn("kind", F.when(F.startswith("x", F.lit("<")), F.when(F.col("x").rlike(r"(?s)<(?:[\w.-]+:)?sitemapindex\b"), "index").otherwise("xml")).when(F.startswith("x", F.lit("[")), "json").otherwise("lines"))
    entries = F.regexp_extract_all("x", F.lit(r"(?s)<((?:[\w.-]+:)?(?:url|sitemap))(?:\s[^>]*)?>(.*?)</\1\s*>"), F.lit(2))
    inner = lambda e, tag: F.regexp_extract(e, rf"(?s)<((?:[\w.-]+:)?{tag})(?:\s[^>]*)?>(.*?)</\1\s*>", 2)
    # a text with references or CDATA is read as XML is
    shown = lambda t: F.when(t.rlike("[&<]"), F.xpath_string(F.concat(F.lit("<t>"), t, F.lit("</t>")), F.lit("/t"))).otherwise(t)
    value = lambda e, tag: F.nullif(F.trim(F.regexp_replace(shown(inner(e, tag)), r"^\s+|\s+$", "")), F.lit(""))
    whole = F.xpath_boolean("x", F.lit("/*"))  # fails for what is no XML
    from_xml = F.when(whole, F.transform(entries, lambda e: F.struct(value(e, "loc").alias("url"), value(e, "lastmod").alias("lastmod"))))
    raw = F.coalesce(F.from_json("x", "array<string>"), F.raise_error(F.concat(F.lit("not a list of addresses: "), F.left("x", F.lit(80)))).cast("array<string>"))
    from_list = F.transform(raw, lambda e: F.when(F.startswith(F.ltrim(e), F.lit("{")), F.from_json(e, "url string, lastmod string")).otherwise(F.struct(e.alias("url"), F.lit(None).cast("string").alias("lastmod"))))
    from_lines = F.transform(F.filter(F.split("x", "\r?\n", -1), lambda e: F.trim(e) != ""), lambda e: F.struct(F.trim(e).alias("url"), F.lit(None).cast("string").alias("lastmod")))
    listed = F.when(F.col("kind").isin("xml", "index"), from_xml).when(F.col("kind") == "json", from_list).otherwise(from_lines)
    rows = body.select("file", (F.col("kind") == "index").alias("child"), F.posexplode(F.coalesce(listed, F.array())).alias("pos", "e"))
    return rows.select("file", "pos", "e.url", d.day_part(F.col("e.lastmod")).alias("lastmod"), "child").where("url is not null")


def share_leaves(files: DataFrame) -> DataFrame:
    """(file, pos, asset_id, name, path, view_url) of share manifests. The first leaf without an http(s) address refuses the whole input."""
    held = json_object(F.col("content"), "leaves array<struct<asset_id:string,name:string,path:array<string>,view_url:string>>")
    leaves = held["leaves"]
    good = lambda x: F.coalesce(x["view_url"].rlike(r"^(?i:https?):") & ~x["view_url"].rlike(r"[\s\p{Z}]"), F.lit(False))
    first_bad = F.array_position(F.transform(leaves, lambda x: ~good(x)), True)
    refused = lambda *said: F.raise_error(F.concat(*said)).cast("array<struct<asset_id:string,name:string,path:array<string>,view_url:string>>")
    checked = F.when(held.isNull() | leaves.isNull(), refused(F.lit("a manifest without a list of leaves: "), F.col("file"))).when(first_bad > 0, refused(F.lit("leaves["), (first_bad - 1).cast("string"), F.lit("] has no http(s) address"))).otherwise(leaves)
    return files.select("file", F.posexplode(checked).alias("pos", "l")).select("file", "pos", "l.*")


def tree_leaves(cards: DataFrame, most_folders: int = 200, most_rounds: int = 1000) -> DataFrame:
    """cards (share, parent, id, name, is_folder, pos) that the walk of each share's folders finds: (share, id, name, path, ord).

    The walk begins at the parent that equals the share, goes depth first in the order of pos, into a folder once, and
    into so many folders at most. ord orders a share's leaves; a leaf that is in several of them, or is repeated, comes with each.

    Depth first is the order of the places along a path, and a folder is entered by the least path that leads to it. So paths are carried from the root downwards, a join a level: of
    several paths to a folder the least stays, and of a share only the most_folders least, as what is behind these cannot come before them any more.
    The state of a share is that many rows; rounds are as many as levels."""
    folders = saved(cards.where("is_folder").select("share", "parent", "id", "name", F.col("pos").cast("int").alias("pos")))
    start = cards.select("share").distinct()
    state = saved(start.select("share", F.col("share").alias("folder"), F.array().cast("array<string>").alias("path"), F.array().cast("array<int>").alias("ord"), F.lit(True).alias("new")))
    first = Window.partitionBy("share").orderBy("ord")
    for _ in range(most_rounds):
        below = state.where("new").join(folders.withColumnRenamed("parent", "folder"), ["share", "folder"])
        found = below.select("share", F.col("id").alias("folder"), F.concat("path", F.array("name")).alias("path"), F.concat("ord", F.array("pos")).alias("ord"), F.lit(True).alias("new"))
        both = found.unionByName(state.withColumn("new", F.lit(False)))
        least = both.groupBy("share", "folder").agg(F.min_by(F.struct("path", "new"), F.struct("ord", "new")).alias("x"), F.min("ord").alias("ord"))
        ranked = least.select("share", "folder", "x.path", "ord", "x.new", F.row_number().over(first).alias("at")).where(F.col("at") <= most_folders).drop("at")
        state = saved(ranked)
        if not state.where("new").limit(1).count():
            break
    else:
        raise RuntimeError(f"folders did not end in {most_rounds} levels")
    leaves = cards.where("not is_folder").join(state.select("share", F.col("folder").alias("parent"), "path", "ord"), ["share", "parent"])
    return leaves.select("share", "id", "name", "path", F.concat("ord", F.array(F.col("pos").cast("int"))).alias("ord"))


def day_items(spark: SparkSession, root: str, schema: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """(day, pos, name, id, item) of the item files root/day/items/stamp--id.json, of the days from first to last; pos is their order, oldest first, as names begin with the time.

    Files that are not named so are no items. item is null where a file holds no object. Days are read off the paths, which are filtered before any file is opened."""
    path = F.col("_metadata.file_path")
    day = F.element_at(F.split(path, "/"), -3)
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*--*.json").text(root, wholetext=True).where(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & path.rlike("/items/[^/]*$"))
    if first is not None:
        files = files.where(day >= first)
    if last is not None:
        files = files.where(day <= last)
    name = F.col("_metadata.file_name")
    rows = files.select(day.alias("day"), name.alias("name"), t.id_in_name(name).alias("id"), json_object(F.col("value"), schema).alias("item")).where("id is not null")
    return rows.withColumn("pos", (F.row_number().over(Window.partitionBy("day").orderBy("name")) - 1).cast("int")).select("day", "pos", "name", "id", "item")


def stored_item(item: Column) -> Column:
    """What is kept of a mail beside its own line: texts (null where there are none), labels that are texts, and the names and types of attachments that are objects, never bytes.

    item is JSON text, as its fields change their types from one venue to the next; anything else than an object has nothing."""
    v = F.try_parse_json(item)
    kind = lambda x: F.schema_of_variant(x)
    text = lambda key: F.when(kind(F.try_variant_get(v, f"$.{key}", "variant")) == "STRING", F.try_variant_get(v, f"$.{key}", "string"))
    listed = lambda key: F.coalesce(F.try_variant_get(v, f"$.{key}", "array<variant>"), F.array().cast("array<variant>"))
    words = F.transform(F.filter(listed("labels"), lambda x: kind(x) == "STRING"), lambda x: x.cast("string"))
    inner = lambda x, key: F.when(kind(F.try_variant_get(x, f"$.{key}", "variant")) == "STRING", F.try_variant_get(x, f"$.{key}", "string"))
    files = F.transform(F.filter(listed("attachments"), lambda x: F.startswith(kind(x), F.lit("OBJECT"))), lambda x: F.struct(inner(x, "name").alias("name"), inner(x, "mime").alias("mime")))
    return F.struct(*(text(k).alias(k) for k in ("thread", "from", "to", "date")), words.alias("labels"), files.alias("attachments"))


def json_rows(files: DataFrame, schema: str, keep: str = "file") -> DataFrame:
    """The objects of JSON lists with pos; fields of a wrong type are null. A file that is no list is refused: the job fails, as no items would pass for an empty pull."""
    kind = f"array<struct<{_fields(schema)}>>"
    listed = F.when(F.coalesce(F.col("content").rlike(r"(?s)^[\ufeff\s]*\["), F.lit(False)), F.from_json("content", kind))
    rows = files.select(keep, F.posexplode(F.coalesce(listed, F.raise_error(F.concat(F.lit("not a JSON list: "), F.coalesce(F.left("content", F.lit(80)), F.lit("null")))).cast(kind))).alias("pos", "r"))
    return rows.select(keep, "pos", "r.*")


def _fields(schema: str) -> str:
    return re.sub(r"(^|,\s*)(\w+) ", r"\1\2:", schema)


def json_object(content: Column, schema: str) -> Column:
    """One object; what is not an object is null."""
    return F.when(F.trim(content).startswith("{"), F.from_json(content, f"struct<{_fields(schema)}>"))


def archive_posts(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """Posts of archive pages in their order (page, place), walked until the first page without posts."""
    rows = pages.select(page_col, F.from_json("content", f"array<struct<{_fields(POST)}>>").alias("posts"))
    empty = F.coalesce(F.size("posts") <= 0, F.lit(True))
    ended = rows.agg(F.min(F.when(empty, F.col(page_col))).alias("_end"))  # one row
    walked = rows.crossJoin(F.broadcast(ended)).where(F.col("_end").isNull() | (F.col(page_col) < F.col("_end")))
    return walked.select(page_col, F.posexplode("posts").alias("place", "p")).select(page_col, "place", "p.*")


def course_links(files: DataFrame) -> DataFrame:
    """(file, pos, url, text) of a course page's sidebar, texts cut to 80 characters."""
    rows = files.select("file", F.posexplode(json_object(F.col("content"), LINKS)["discovered_lesson_links"]).alias("pos", "l"))
    return rows.where(F.col("l.href").rlike("/(lessons|sections)/")).select("file", "pos", F.col("l.href").alias("url"), F.left("l.text", F.lit(80)).alias("text"))


def entity_items(content: Column) -> Column:
    """The items of a media entity, numbered, artists joined."""
    items = json_object(content, ENTITY)["items"]
    return F.transform(items, lambda x, i: F.struct((i + 1).alias("n"), x["type"].alias("type"), x["id"].alias("id"), x["name"].alias("name"), F.array_join(F.transform(x["artists"], lambda a: a["name"]), ", ").alias("artist"), x["duration_ms"].alias("duration_ms"), x["release_date"].alias("release_date")))


def caption_cues(files: DataFrame) -> DataFrame:
    """(file, pos, start, text) of WEBVTT cues, timing tags removed."""
    cue = F.posexplode(F.regexp_extract_all("content", F.lit(r"(?s)(\d[\d:.]+ --> .*?)(?:\r?\n\r?\n|\z)"), F.lit(1))).alias("pos", "x")
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("x", r"^[^\n]*\n?", ""), "<[^>]*>", ""), r"^\s+|\s+$", "")
    return files.select("file", cue).select("file", "pos", F.regexp_extract("x", r"^([\d:.]+)", 1).alias("start"), text.alias("text"))


def caption_pick(names: DataFrame, patterns: list[str]) -> DataFrame:
    """The file of the first pattern that has any, those not -orig first, then by name; one row a folder."""
    rank = F.lit(None).cast("int")
    for i in range(len(patterns) - 1, -1, -1):
        rank = F.when(F.col("name").rlike(patterns[i]), i).otherwise(rank)
    fits = names.withColumn("rank", rank).where("rank is not null")
    return fits.groupBy("folder").agg(F.min_by("name", F.struct("rank", F.contains("name", F.lit("-orig")).alias("orig"), "name")).alias("name"))


@pandas_udf(T.StringType())
def document_text(content: pd.Series, extension: pd.Series) -> pd.Series:
    """The text of pptx and xlsx files by their XML; what cannot be read says so. Cut to 200 000 characters with a note."""
    return pd.Series([_document(c, e) for c, e in zip(content, extension, strict=True)])


def _document(content: bytes, extension: str) -> str:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            text = _slides(z) if extension == "pptx" else _sheets(z) if extension == "xlsx" else f"(no reader for {extension})"
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
        text = f"(could not be read: {type(e).__name__})"
    return text if len(text) <= 200_000 else text[:200_000] + "\n\n(cut)"


def _numbered(z: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m[1]), n) for n in z.namelist() if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def _slides(z: zipfile.ZipFile) -> str:
    out = []
    for i, name in enumerate(_numbered(z, r"ppt/slides/slide(\d+)\.xml"), 1):
        lines = ["".join(t.text or "" for t in p.iter() if t.tag.endswith("}t")) for p in ElementTree.fromstring(z.read(name)).iter() if p.tag.endswith("}p")]
        lines = [x for x in lines if x.strip()]
        if lines:
            out.append(f"**Slide {i}**\n" + "\n".join(lines))
    return "\n\n".join(out)


def _sheets(z: zipfile.ZipFile, rows: int = 40) -> str:
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in s.iter() if t.tag.endswith("}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if s.tag.endswith("}si")]
    out = []
    for i, name in enumerate(_numbered(z, r"xl/worksheets/sheet(\d+)\.xml"), 1):
        lines, more = [], 0
        for row in (r for r in ElementTree.fromstring(z.read(name)).iter() if r.tag.endswith("}row")):
            cells = []
            for c in (x for x in row if x.tag.endswith("}c")):
                value = "".join(v.text or "" for v in c.iter() if v.tag.endswith(("}v", "}t")))
                cells.append(shared[int(value)] if c.get("t") == "s" and value else value)
            if any(cells):
                if len(lines) < rows:
                    lines.append(" | ".join(cells))
                else:
                    more += 1
        out.append("\n".join([f"**Sheet {i}**", *lines, *([f"({more} more rows)"] if more else [])]))
    return "\n\n".join(out)


def site_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """hosts with the rule of the host itself, its bare form, www. and the bare form, or *, the first that there is."""
    bare = F.regexp_replace("host", "^www[.]", "")
    keys = F.posexplode(F.array_distinct(F.array("host", bare, F.concat(F.lit("www."), bare), F.lit("*")))).alias("rank", "key")
    found = hosts.select("host", keys).join(rules.withColumnRenamed("host", "key"), "key")
    return found.groupBy("host").agg(F.min_by("rule", "rank").alias("rule"))
