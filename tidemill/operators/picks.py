"""Ranked picks, set operations and small joins of the capture flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import urls as u
from tidemill.registry import read, split


def pick_document(files: DataFrame, by: str, wanted: Column, ranks: dict[str, int]) -> DataFrame:
    """One file of each by: of the wanted extension first, then by known rank, no bin, and name."""
    ext = F.lower(F.regexp_extract("name", "[.]([^.]*)$", 1))
    rank = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv)), ext), F.lit(len(ranks)))
    return files.groupBy(by).agg(F.min_by("name", F.struct((ext != wanted).alias("other"), rank.alias("rank"), (ext == "bin").alias("bin"), "name")).alias("name"))


def first_request(log: DataFrame, by: str, patterns: list[str]) -> DataFrame:
    """The first row (by pos) of a network log that a pattern fits; within a row the first pattern counts."""
    which = F.lit(None).cast("int")
    for i in range(len(patterns) - 1, -1, -1):
        which = F.when(F.col("url").rlike(patterns[i]), i).otherwise(which)
    return log.withColumn("pattern", which).where("pattern is not null").groupBy(by).agg(F.min_by(F.struct("url", "pattern"), F.struct("pos", "pattern")).alias("m")).select(by, "m.url", "m.pattern")


def resolve_feed(candidates: DataFrame) -> DataFrame:
    """The first candidate (show, feed, rank, parsed) of each show whose feed could be read and is an http(s) address."""
    return candidates.where(F.col("parsed") & u.is_http(F.col("feed"))).groupBy("show").agg(F.min_by("feed", "rank").alias("feed"))


def next_leaf(leaves: DataFrame, captures: DataFrame) -> DataFrame:
    """The first planned leaf (pos, url) without a capture, or no row."""
    return leaves.join(captures.select("url").distinct(), "url", "left_anti").orderBy("pos").limit(1)


def first_names(links: DataFrame, section: Column, name: Column) -> DataFrame:
    """(section, name): the first name (by pos) of each section that has one."""
    return links.select(section.alias("section"), name.alias("name"), "pos").where("section <> '' and name is not null").groupBy("section").agg(F.min_by("name", "pos").alias("name"))


def merge_first(rows: DataFrame, key: Column, *values: str) -> DataFrame:
    """One row a key at its first place, each value the first that is not null."""
    held = rows.withColumn("key", key).where("key is not null")
    return held.groupBy("key").agg(F.min("pos").alias("pos"), *(F.min_by(v, F.when(F.col(v).isNotNull(), F.col("pos"))).alias(v) for v in values))


def with_target(pages: DataFrame, target: str) -> DataFrame:
    """pages (pos, url) and the target after them, unless it is among them."""
    one = pages.sparkSession.createDataFrame([(2**31 - 1, target)], "pos long, url string")
    return pages.unionByName(one.join(pages.select("url"), "url", "left_anti").select("pos", "url"))


def asset_of_stream(assets: DataFrame, metas: DataFrame) -> DataFrame:
    """For each page the first downloaded asset whose source is the page's stream."""
    both = assets.where("status = 'downloaded'").join(metas, F.col("src_url") == F.col("stream_url"))
    return both.groupBy("page").agg(F.min_by("src_url", "pos").alias("src_url"))


def _pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "url")


def document_pick(spark, sf_dir):
    files = _pages(spark, sf_dir).select(u.registered(F.col("url")).alias("folder"), F.concat(F.lit("f"), F.col("pos").cast("string"), F.lit("."), F.element_at(F.array(*(F.lit(x) for x in ("bin", "html", "pdf", "txt"))), (F.char_length("url") % 4 + 1).cast("int"))).alias("name"))
    return pick_document(files, "folder", F.lit("pdf"), {"html": 0, "txt": 1})


def network_first(spark, sf_dir):
    log = _pages(spark, sf_dir).withColumn("host", u.registered(F.col("url")))
    return first_request(log, "host", ["page=2", "#", "/$"])


def feed_resolve(spark, sf_dir):
    shows = _pages(spark, sf_dir).select(F.regexp_extract("url", "/(en|fr|de|es)/", 1).alias("show"), F.col("url").alias("feed"), F.col("pos").alias("rank"), F.contains("url", F.lit("example.net")).alias("parsed"))
    return resolve_feed(shows)


def next_unlanded(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return next_leaf(pages, pages.where(~F.contains("url", F.lit("utm_source"))))


def section_names(spark, sf_dir):
    return first_names(_pages(spark, sf_dir), F.regexp_extract("url", "/(en|fr|de|es)/", 1), F.when(F.contains("url", F.lit("?")), u.host(F.col("url"))))


def duplicate_merge(spark, sf_dir):
    rows = _pages(spark, sf_dir).select("pos", "url", F.when(F.contains("url", F.lit("?")), F.col("url")).alias("title"))
    return merge_first(rows, u.registered(F.col("url")), "title").select("key", "pos", "title")


def set_operations(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    feed, marked = pages.where(F.contains("url", F.lit("utm"))).select("url"), pages.where(F.contains("url", F.lit("/en/"))).select("url")
    made = {"either": feed.union(marked).distinct(), "both": feed.intersect(marked), "only_feed": feed.exceptAll(marked), "with_target": with_target(pages, "https://new.example.com/").select("url")}
    out = None
    for k, df in made.items():
        n = df.agg(F.lit(k).alias("name"), F.count("*").alias("n"))
        out = n if out is None else out.union(n)
    return out


def token_overlap(spark, sf_dir):
    """Words that a conversation's turns share with its first turn, as sets."""
    c = read(spark, sf_dir, "conversations")
    words = lambda x: F.array_distinct(F.split(F.lower(x), " ", -1))
    first = c.where("turn = 0").select(F.col("conv_id").alias("k"), F.col("text").alias("head"))
    return c.join(first, F.col("conv_id") == F.col("k")).select("conv_id", "turn", F.size(F.array_intersect(words(F.col("text")), words(F.col("head")))).cast("long").alias("common"), F.arrays_overlap(words(F.col("text")), words(F.col("head"))).alias("any"))


def stream_assets(spark, sf_dir):
    pages = _pages(spark, sf_dir).withColumn("page", u.registered(F.col("url")))
    assets = pages.select("page", "pos", F.col("url").alias("src_url"), F.when(F.contains("url", F.lit("/en/")), "downloaded").otherwise("pending").alias("status"))
    return asset_of_stream(assets, pages.select(F.col("url").alias("stream_url")).distinct())


def halted_host_list(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return pages.where(F.contains("url", F.lit("#"))).agg(F.array_join(F.array_sort(F.collect_set(u.registered(F.col("url")))), ", ").alias("hosts"), F.coalesce(F.nullif(F.count("*"), F.lit(0)), F.lit(-1).cast("long")).alias("total"))


REG = "array_to_string(string_split(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '.')[-2:], '.')"
LANG = "regexp_extract(url, '/(en|fr|de|es)/', 1)"
EXT = "['bin', 'html', 'pdf', 'txt'][length(url) % 4 + 1]"
PAIRS = {
    "document_pick": (document_pick, f"WITH f AS (SELECT {REG} AS folder, 'f' || page_id || '.' || {EXT} AS name, {EXT} AS e FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY e <> 'pdf', CASE e WHEN 'html' THEN 0 WHEN 'txt' THEN 1 ELSE 2 END, e = 'bin', name) AS nth FROM f) SELECT folder, name FROM r WHERE nth = 1"),
    "network_first": (network_first, f"WITH l AS (SELECT {REG} AS host, page_id, url, CASE WHEN contains(url, 'page=2') THEN 0 WHEN contains(url, '#') THEN 1 WHEN url LIKE '%/' THEN 2 END AS pattern FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS nth FROM l WHERE pattern IS NOT NULL) SELECT host, url, pattern FROM r WHERE nth = 1"),
    "feed_resolve": (feed_resolve, f"SELECT {LANG} AS show, arg_min(url, page_id) AS feed FROM pages WHERE contains(url, 'example.net') GROUP BY 1"),
    "next_unlanded": (next_unlanded, "SELECT page_id AS pos, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE NOT contains(url, 'utm_source')) ORDER BY page_id LIMIT 1"),
    "section_names": (section_names, f"SELECT {LANG} AS section, arg_min(lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)), page_id) AS name FROM pages WHERE contains(url, '?') AND {LANG} <> '' GROUP BY 1"),
    "duplicate_merge": (duplicate_merge, f"SELECT {REG} AS key, min(page_id) AS pos, arg_min(url, page_id) FILTER (contains(url, '?')) AS title FROM pages GROUP BY 1"),
    "set_operations": (set_operations, """WITH f AS (SELECT url FROM pages WHERE contains(url, 'utm')), m AS (SELECT url FROM pages WHERE contains(url, '/en/'))
SELECT 'either' AS name, count(*) AS n FROM (SELECT * FROM f UNION SELECT * FROM m) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM f INTERSECT SELECT * FROM m)
UNION ALL SELECT 'only_feed', count(*) FROM (SELECT * FROM f EXCEPT ALL SELECT * FROM m) UNION ALL SELECT 'with_target', count(*) + 1 FROM pages"""),
    "token_overlap": (token_overlap, "WITH c AS (SELECT conv_id, turn, list_distinct(string_split(lower(text), ' ')) AS w FROM conversations) SELECT a.conv_id, a.turn, len(list_intersect(a.w, b.w)) AS common, list_has_any(a.w, b.w) AS any FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = 0"),
    "stream_assets": (stream_assets, f"SELECT {REG} AS page, arg_min(url, page_id) AS src_url FROM pages WHERE contains(url, '/en/') GROUP BY 1"),
    "halted_host_list": (halted_host_list, f"SELECT array_to_string(list_sort(list(DISTINCT {REG})), ', ') AS hosts, count(*) AS total FROM pages WHERE contains(url, '#')"),
}
QUERIES, ORACLES = split(PAIRS)
