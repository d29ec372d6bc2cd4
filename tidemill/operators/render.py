"""Pages as text: facts, frontmatter, tables, captures, asset manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import text as t
from tidemill.functions import times as d
from tidemill.functions import urls as u
from tidemill.registry import read, split

RESERVED = ("title", "item", "slug")


def frontmatter(facts: Column, reserved: tuple[str, ...] = RESERVED) -> Column:
    """A map of facts without unknown ones and without names that the host keeps."""
    return F.map_filter(facts, lambda k, v: v.isNotNull() & (v != "") & ~k.isin(*reserved))


def frontmatter_text(facts: Column) -> Column:
    keys = F.array_sort(F.map_keys(facts))
    return F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit(": "), F.element_at(facts, k))), "\n")


def facts_block(facts: list[tuple[str, Column]]) -> Column:
    """- **Name**: value for each value that there is."""
    return F.array_join(F.array_compact(F.array(*(F.when(t.fold(v) != "", F.concat(F.lit(f"- **{n}**: "), t.fold(v))) for n, v in facts))), "\n")


def item_table(items: Column) -> Column:
    """A Markdown table of items (n, name, duration_ms)."""
    row = lambda x: F.concat(F.lit("| "), x["n"].cast("string"), F.lit(" | "), t.table_cell(x["name"]), F.lit(" | "), d.clock(x["duration_ms"]), F.lit(" |"))
    return F.concat(F.lit("| # | Title | Length |\n| --- | --- | --- |\n"), F.array_join(F.transform(items, row), "\n"))


def entity_page(name: Column, creator: Column, description: Column, items: Column, truncated: Column) -> Column:
    return F.concat_ws("\n\n", F.concat(F.lit("# "), t.safe_title(name)), F.when(t.fold(creator) != "", F.concat(F.lit("by "), t.fold(creator))), F.when(truncated, F.lit("> The list is cut.")), F.when(t.fold(description) != "", t.quoted(description)), F.when(F.size(items) > 0, item_table(items)))


def document_page(title: Column, crumb: Column, facts: Column, extracted: Column) -> Column:
    body = F.when(F.trim(F.coalesce(extracted, F.lit(""))) != "", F.concat(F.lit("<details><summary>Extracted text</summary>\n\n"), extracted, F.lit("\n\n</details>")))
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.when(F.size(crumb) > 0, F.array_join(crumb, " / ")), F.nullif(facts, F.lit("")), body)


def video_page(title: Column, thumbnail: Column, embed: Column, facts: Column, description: Column, transcript: Column) -> Column:
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.concat(F.lit("![]("), thumbnail, F.lit(")")), F.concat(F.lit('<iframe src="'), embed, F.lit('"></iframe>')), F.nullif(facts, F.lit("")), description, F.concat(F.lit("## Transcript\n\n"), transcript))


def guard_transcript(text: Column) -> Column:
    """Block openers escaped on all lines but time heads."""
    lines = F.split(text, "\n", -1)
    return F.array_join(F.transform(lines, lambda x: F.when(x.rlike(r"^#{1,6} .*\[[0-9]"), x).otherwise(t.unblocked(x))), "\n")


def safe_chapters(chapters: Column) -> Column:
    kept = F.filter(chapters, lambda c: c["start_time"].isNotNull())
    return F.transform(kept, lambda c: F.struct(c["start_time"].alias("start"), c["end_time"].alias("end"), t.video_plain(t.fold(c["title"])).alias("title")))


def description_markdown(text: Column) -> Column:
    """A description as a quote: a time list under its heading, hashtag walls dropped, blank runs one, openers escaped."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", -1), lambda x: ~((F.size(F.split(F.trim(x), r"\s+", -1)) > 3) & x.rlike(r"^\s*(#\w+\s*){4,}$")))
    link = lambda x: F.regexp_replace(t.video_plain(x), r"(https?://[^\s<>()\[\]]+)", "<$1>")
    made = F.transform(lines, lambda x: F.when(x.rlike(r"(?i)^\s*(timestamps|chapters)\s*:?\s*$"), F.lit("**Timestamps**\n")).when(x.rlike(r"^\s*\(?(?:[0-9]+:)?[0-9]{1,2}:[0-9]{2}\)?\s+\S"), F.regexp_replace(x, r"^\s*\(?((?:[0-9]+:)?[0-9]{1,2}:[0-9]{2})\)?\s*[-–—]?\s*", "- `$1` ")).otherwise(t.unblocked(link(F.rtrim(x)))))
    whole = F.trim(F.regexp_replace(F.array_join(made, "\n"), r"\n{3,}", "\n\n"))
    return F.when(whole == "", F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(whole, "(?m)^", "> "), "(?m)^> $", ">"))


def shared_top(paths: DataFrame, path: str = "path") -> DataFrame:
    """(skip): 1 if all paths begin with the same folder, else 0. One row."""
    first = F.get(path, 0)
    return paths.agg(F.when((F.count_distinct(F.coalesce(first, F.lit(""))) == 1) & (F.max(F.coalesce(first, F.lit(""))) != ""), 1).otherwise(0).alias("skip"))


def patch_assets(assets: DataFrame, drop: list[str], extra: DataFrame | None = None) -> DataFrame:
    """assets (page, pos, src_url, status) without marked ones, with extra rows, defaults and ids by place."""
    kept = assets.where(~F.exists(F.array(*(F.lit(x) for x in drop)), lambda m: F.contains("src_url", m)))
    if extra is not None:
        kept = kept.unionByName(extra)
    at = F.row_number().over(Window.partitionBy("page").orderBy("pos"))
    return kept.withColumn("status", F.coalesce("status", F.lit("pending"))).withColumn("id", F.format_string("asset-%03d", at))


def asset_ext(content_type: Column, name: Column) -> Column:
    """The extension of a document by its type, else by its name, else bin."""
    known = F.create_map(*(F.lit(x) for pair in (("application/pdf", "pdf"), ("text/html", "html"), ("image/png", "png"), ("image/jpeg", "jpg"), ("text/plain", "txt")) for x in pair))
    bare = F.trim(F.substring_index(F.lower(content_type), ";", 1))
    return F.coalesce(F.try_element_at(known, bare), F.nullif(F.lower(F.regexp_extract(name, r"[.]([A-Za-z0-9]{1,5})$", 1)), F.lit("")), F.lit("bin"))


def capture_record(slug: str, item: Column, title: Column, body: Column, kind: Column, at: Column) -> Column:
    return F.struct(F.lit(1).alias("v"), F.lit(slug).alias("slug"), item.alias("item"), title.alias("title"), body.alias("body"), kind.alias("content_type"), at.alias("fetched_at"))


def stored_body(body: Column, most: int = 50_000) -> Column:
    return F.struct(F.left(body, F.lit(most)).alias("body"), (F.char_length(body) > most).alias("body_truncated"))


# ------------------------------------------------------------------ queries


def conversation_rollup(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_distinct("role").alias("roles"), F.sum(F.char_length("text").cast("long")).alias("chars"), F.min_by(t.fold(F.col("text")), "turn").alias("opening"))


def facts_page(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    facts = facts_block([("Source", F.col("source")), ("Language", F.col("lang")), ("Length", F.col("n_chars").cast("string")), ("None", F.lit(None).cast("string"))])
    return docs.select("doc_id", document_page(F.concat(F.lit("Document "), F.col("doc_id").cast("string")), F.array("source", "lang"), facts, F.lit("")).alias("page"))


def frontmatter_maps(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    facts = F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.when(F.col("lang") != "en", F.col("lang")), F.lit("title"), F.lit("kept by the host"), F.lit("size"), F.col("n_chars").cast("string"))
    return docs.select("doc_id", frontmatter_text(frontmatter(facts)).alias("head"))


def asset_manifest(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select(u.registered(F.col("url")).alias("page"), F.col("page_id").alias("pos"), F.col("url").alias("src_url"), F.when(F.contains("url", F.lit("/en/")), "downloaded").alias("status"))
    return patch_assets(pages, ["utm_source", "#top"]).select("page", "pos", "status", "id")


def asset_types(spark, sf_dir):
    kind = F.when(F.col("page_id") % 2 == 0, "text/html; charset=utf-8")
    return read(spark, sf_dir, "pages").select("page_id", asset_ext(kind, F.regexp_extract("url", "^https?://([^/]*)", 1)).alias("ext"))


def shared_top_folder(spark, sf_dir):
    return shared_top(read(spark, sf_dir, "pages").select(F.split(F.regexp_extract("url", "^https?://[^/]*/([^?#]*)", 1), "/", -1).alias("path")))


def stored_bodies(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", stored_body(F.col("text")).alias("s")).select("doc_id", F.sha1(F.encode("s.body", "UTF-8")).alias("body_sha1"), "s.body_truncated")


def description_md(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", description_markdown(F.col("text")).alias("markdown"))


PAIRS = {
    "conversation_rollup": (conversation_rollup, "SELECT conv_id, count(*) AS turns, count(DISTINCT role) AS roles, CAST(sum(length(text)) AS BIGINT) AS chars, arg_min(trim(regexp_replace(text, '[\\pC\\pZ]+', ' ', 'g')), turn) AS opening FROM conversations GROUP BY conv_id"),
    "facts_page": (facts_page, "SELECT doc_id, '# Document ' || doc_id || chr(10) || chr(10) || source || ' / ' || lang || chr(10) || chr(10) || '- **Source**: ' || source || chr(10) || '- **Language**: ' || lang || chr(10) || '- **Length**: ' || n_chars AS page FROM documents"),
    "frontmatter_maps": (frontmatter_maps, "SELECT doc_id, CASE WHEN lang <> 'en' THEN 'lang: ' || lang || chr(10) ELSE '' END || 'size: ' || n_chars || chr(10) || 'source: ' || source AS head FROM documents"),
    "asset_manifest": (asset_manifest, "WITH a AS (SELECT array_to_string(string_split(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '.')[-2:], '.') AS page, page_id AS pos, url FROM pages WHERE NOT contains(url, 'utm_source') AND NOT contains(url, '#top')) SELECT page, pos, CASE WHEN contains(url, '/en/') THEN 'downloaded' ELSE 'pending' END AS status, printf('asset-%03d', row_number() OVER (PARTITION BY page ORDER BY pos)) AS id FROM a"),
    "asset_types": (asset_types, "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'html' ELSE coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^https?://([^/]*)', 1), '[.]([A-Za-z0-9]{1,5})$', 1)), ''), 'bin') END AS ext FROM pages"),
    "shared_top_folder": (shared_top_folder, "WITH f AS (SELECT string_split(regexp_extract(url, '^https?://[^/]*/([^?#]*)', 1), '/')[1] AS t FROM pages) SELECT CASE WHEN count(DISTINCT t) = 1 AND max(t) <> '' THEN 1 ELSE 0 END AS skip FROM f"),
    "stored_bodies": (stored_bodies, "SELECT doc_id, sha1(left(text, 50000)) AS body_sha1, length(text) > 50000 AS body_truncated FROM documents"),
    "description_md": (description_md, ""),
}
QUERIES, ORACLES = split(PAIRS)
