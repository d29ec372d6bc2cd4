"""Media entities: raw records of seven kinds flattened to one shape, paged lists with what cut them short, search results, and the capture plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import times as d
from tidemill.functions import urls as u
from tidemill.operators.report import why_said
from tidemill.plans.planning import first_reason
from tidemill.registry import read, split

# Kinds, and how refused audio is described.
KINDS = ("album", "artist", "audiobook", "episode", "playlist", "show", "track", "chapter")
UNMATCHED, PROTECTED = "episode not matched in any public feed", "Spotify catalog audio is DRM-protected"

NAMED = "array<struct<name:string>>"
ITEM = f"struct<type:string,id:string,name:string,show:struct<name:string,publisher:string>,artists:{NAMED},duration_ms:bigint,release_date:string,explicit:boolean,preview_url:string,audio_preview_url:string>"
RAW = (
    f"struct<id:string,type:string,name:string,description:string,html_description:string,images:array<struct<url:string>>,release_date:string,publisher:string,"
    f"owner:struct<display_name:string>,artists:{NAMED},authors:{NAMED},show:struct<name:string,publisher:string>,duration_ms:bigint,explicit:boolean,preview_url:string,audio_preview_url:string,total_episodes:bigint,total_chapters:bigint>"
)


def _names(people: Column) -> Column:
    return F.array_join(F.transform(F.coalesce(people, F.array().cast(NAMED)), lambda a: F.coalesce(a["name"], F.lit(""))), ", ")


def normal_item(x: Column, origin: str, kind: str | None = None, show: Column | None = None) -> Column:
    """An item in the one shape: its kind is given, its own, or told by whether it has a show."""
    of = F.lit(kind) if kind else F.coalesce(x["type"], F.when(x["show"].isNotNull(), F.lit("episode")).otherwise(F.lit("track")))
    known = x["id"].rlike("^[A-Za-z0-9]{1,64}$") & of.isin(*KINDS)
    return F.struct(
        of.alias("type"), x["id"].alias("id"), F.when(known, u.entity_url(of, x["id"], origin)).alias("url"), x["name"].alias("name"), (show if show is not None else x["show"]["name"]).alias("show"),
        F.nullif(_names(x["artists"]), F.lit("")).alias("artist"), x["duration_ms"].alias("duration_ms"), x["release_date"].alias("release_date"), x["explicit"].alias("explicit"), u.http_url(F.coalesce(x["preview_url"], x["audio_preview_url"])).alias("preview_url"),
    )


def flattened(records: DataFrame, origin: str) -> DataFrame:
    """records (kind, e of type RAW, listed: an array of ITEM) with creator, description, image, items numbered from 1, and total."""
    e, kind = F.col("e"), F.col("kind")
    own = F.struct(e["type"].alias("type"), e["id"].alias("id"), e["name"].alias("name"), e["show"].alias("show"), e["artists"].alias("artists"), e["duration_ms"].alias("duration_ms"), e["release_date"].alias("release_date"), e["explicit"].alias("explicit"), e["preview_url"].alias("preview_url"), e["audio_preview_url"].alias("audio_preview_url"))
    listed = F.filter(F.coalesce("listed", F.array().cast(f"array<{ITEM}>")), lambda x: x.isNotNull())
    each = lambda kind_, show=None: F.transform(listed, lambda x: normal_item(x, origin, kind_, show))
    items = (
        F.when(kind == "playlist", each(None)).when(kind == "show", each("episode", e["name"])).when(kind == "album", each("track")).when(kind == "audiobook", each("chapter"))
        .when(kind == "episode", F.array(normal_item(own, origin, "episode"))).when(kind == "track", F.array(normal_item(own, origin, "track")))
    )
    creator = (
        F.when(kind == "playlist", e["owner"]["display_name"]).when(kind == "show", e["publisher"]).when(kind == "episode", e["show"]["publisher"])
        .when(kind.isin("album", "track"), _names(e["artists"])).when(kind == "audiobook", _names(e["authors"])).otherwise(e["name"])
    )
    images = F.filter(F.transform(F.coalesce(e["images"], F.array().cast("array<struct<url:string>>")), lambda i: u.http_url(i["url"])), lambda x: x.isNotNull())
    out = records.withColumn("items", F.coalesce(items, F.transform(F.filter(listed, lambda x: F.lit(False)), lambda x: normal_item(x, origin))))
    return out.select(
        "*", F.posexplode_outer("items").alias("_at", "item"), creator.alias("creator"), F.coalesce(F.nullif(e["description"], F.lit("")), F.nullif(e["html_description"], F.lit("")), F.lit("")).alias("description"),
        F.get(images, 0).alias("image"), F.coalesce(F.nullif(F.size("items").cast("bigint"), F.lit(0)), F.nullif(e["total_episodes"], F.lit(0)), e["total_chapters"]).alias("total"),
    ).withColumn("n", F.col("_at") + 1).drop("_at", "e", "listed", "items")


def walked(pages: DataFrame, by: str, host: str) -> DataFrame:
    """pages (by, page, url, status, error, size, total) with cut: the first page that was not had, or whose address is not the venue's, ends a list."""
    strange = ~F.coalesce(F.endswith(u.host(F.col("url")), F.lit(host)), F.lit(False)) & (F.col("page") > 0)
    lost = strange | F.col("error").isNotNull() | F.coalesce(F.col("status") != 200, F.lit(True))
    first = pages.withColumn("_said", F.when(strange, "the next page is not the venue's").when(F.col("error").isNotNull(), F.col("error")).otherwise(F.concat(F.lit("HTTP "), F.col("status").cast("string"))))
    why = F.when(strange, "error").otherwise(why_said(F.col("_said")))
    ends = first.where(lost).groupBy(by).agg(F.min("page").alias("_end"), F.min_by(F.struct("url", why.alias("why"), F.left("_said", F.lit(200)).alias("said")), "page").alias("_cut"))
    return pages.join(ends, by, "left").withColumn("had", F.col("_end").isNull() | (F.col("page") < F.col("_end"))).withColumnRenamed("_cut", "cut").drop("_end")


def truncations(pages: DataFrame, by: str, host: str) -> DataFrame:
    """(by, got, url, why, said, expected) of each list: what was had, and of one that stops short where and why, and how many the first page promised."""
    out = walked(pages, by, host).groupBy(by).agg(F.sum(F.when(F.col("had"), F.col("size")).otherwise(0)).alias("got"), F.any_value("cut").alias("cut"), F.min_by("total", "page").alias("total"))
    return out.select(by, "got", "cut.url", "cut.why", "cut.said", F.when(F.col("cut").isNotNull(), F.col("total")).alias("expected"))


def found(results: DataFrame, origin: str) -> DataFrame:
    """Rows of search results (buckets: a map of kind in the plural to ITEMs): type, name, by, release_date, duration, url."""
    rows = results.select("*", F.explode("buckets").alias("bucket", "listed")).select("*", F.explode("listed").alias("x")).where("x is not null").drop("buckets", "listed")
    plural = F.regexp_replace("bucket", "s+$", "")
    n = normal_item(F.col("x"), origin)
    return rows.select(
        *(c for c in results.columns if c != "buckets"), F.coalesce(n["type"], plural).alias("type"), n["name"].alias("name"), F.coalesce(n["show"], n["artist"]).alias("by"), n["release_date"].alias("release_date"),
        F.when(n["duration_ms"] > 0, d.clock(n["duration_ms"])).alias("duration"), F.coalesce(n["url"], u.entity_url(plural, F.col("x.id"), origin)).alias("url"),
    )


def recent(items: DataFrame, min_date: str | None) -> DataFrame:
    """Items of min_date or later, or without a date."""
    return items if min_date is None else items.where(F.col("release_date").isNull() | (F.col("release_date") == "") | (F.col("release_date") >= min_date))


def planned(items: DataFrame, by: str, min_date: str | None = None, no_audio: bool = False) -> DataFrame:
    """items (by, n, type, name, show, url, release_date, and of a match enclosure, feed, matched, score) with route, asset_id, src_url, note.

    An episode of a show goes by its feed where it is matched, else by none; tracks and chapters are protected."""
    open_ = F.lit(not no_audio)
    episode = (F.col("type") == "episode") & (F.coalesce("show", F.lit("")) != "")
    by_feed = u.http_url(F.col("enclosure")).isNotNull()
    route = first_reason([("rss", open_ & episode & by_feed), ("none", open_ & episode), ("drm", open_ & F.col("type").isin("track", "chapter"))])
    kept = recent(items, min_date).withColumn("route", route)
    at = F.row_number().over(Window.partitionBy(by, F.col("route") == "rss", F.when(F.coalesce(F.col("route") != "rss", F.lit(True)), F.col("n"))).orderBy("n"))
    note = F.when(F.col("route") == "rss", F.concat(F.lit("open RSS enclosure ("), "feed", F.lit("); matched '"), "matched", F.lit("' score="), F.col("score").cast("string"))).when(F.col("route") == "none", UNMATCHED).when(F.col("route") == "drm", PROTECTED)
    return kept.withColumn("asset_id", F.when(F.col("route") == "rss", F.format_string("asset-audio-%03d", at))).withColumn("src_url", F.when(F.col("route") == "rss", F.col("enclosure"))).withColumn("note", note)


def capture_counts(items: DataFrame, by: str) -> DataFrame:
    """(by, items, audio_resolved, drm_or_unmatched) of planned items; after another date floor they are counted again."""
    return items.groupBy(by).agg(F.count("*").alias("items"), F.count_if(F.col("route") == "rss").alias("audio_resolved"), F.count_if(F.col("route").isin("drm", "none")).alias("drm_or_unmatched"))


# ------------------------------------------------------------------ queries

ORIGIN = "https://open.example.com"


def entity_flatten(spark, sf_dir):
    """A record of each page, of seven kinds in turn, as the venue's JSON and back."""
    k = F.col("page_id")
    ident = k.cast("string")
    person = lambda x: F.array(F.struct(F.concat(F.lit(x), ident).alias("name")), F.struct(F.lit("Z").alias("name")))
    kinds = F.array(*(F.lit(x) for x in ("playlist", "show", "episode", "album", "track", "audiobook", "artist")))
    raw = F.struct(
        ident.alias("id"), F.concat(F.lit("N"), ident).alias("name"), F.when(k % 2 == 0, "").otherwise("D").alias("description"), F.when(k % 3 == 0, "H").alias("html_description"), F.array(F.struct(F.lit("data:x").alias("url")), F.struct(F.col("url").alias("url"))).alias("images"),
        F.lit("P").alias("publisher"), F.struct(F.lit("O").alias("display_name")).alias("owner"), person("A").alias("artists"), person("B").alias("authors"), F.struct(F.lit("S").alias("name"), F.lit("Q").alias("publisher")).alias("show"), (k * 1000).alias("duration_ms"), F.lit(40).alias("total_episodes"),
    )
    item = F.struct(F.concat(F.lit("i"), ident).alias("id"), F.concat(F.lit("T"), ident).alias("name"), F.when(k % 4 == 0, F.array(F.struct(F.lit("A1").alias("name")), F.struct(F.lit("A2").alias("name")))).alias("artists"), F.lit("https://p.example.com/x").alias("preview_url"))
    listed = F.to_json(F.array(item, item))
    pages = read(spark, sf_dir, "pages").select("page_id", F.element_at(kinds, (k % 7 + 1).cast("int")).alias("kind"), F.from_json(F.to_json(raw), RAW).alias("e"), F.when(k % 5 > 0, F.from_json(F.concat(F.lit("[null,"), F.substr(listed, F.lit(2))), f"array<{ITEM}>")).alias("listed"))
    out = flattened(pages, ORIGIN)
    return out.select("page_id", "kind", "creator", "description", "image", "total", "n", "item.type", "item.id", F.col("item.url").alias("item_url"), "item.show", "item.artist", "item.duration_ms", "item.preview_url")


def paged_lists(spark, sf_dir):
    k = F.col("page_id")
    error = F.when(k == 87, "read timed out").when(k == 65, "Tunnel connection failed: 403 Forbidden")
    status = F.when(k == 45, 429).when(k == 60, 403).when(error.isNotNull(), None).otherwise(200)
    url = F.concat(F.when(k == 76, "https://api.example.com.evil.org/p").otherwise("https://api.example.com/p"), k.cast("string"))
    pages = read(spark, sf_dir, "pages").select((k % 8).alias("entity"), F.floor(k / 8).alias("page"), url.alias("url"), status.alias("status"), error.alias("error"), (k % 3 + 1).alias("size"), (k + 100).alias("total"))
    return truncations(pages, "entity", ".example.com")


def catalog_search(spark, sf_dir):
    k = F.col("page_id")
    item = lambda kind: F.from_json(F.to_json(F.struct(F.lit(kind).alias("type"), F.concat(F.lit("x"), k.cast("string")).alias("id"), F.lit("N").alias("name"), F.when(k % 2 == 0, F.struct(F.lit("S").alias("name"))).alias("show"), (k * 61000).alias("duration_ms"))), ITEM)
    buckets = F.create_map(F.lit("episodes"), F.array(item("episode"), F.lit(None).cast(ITEM)), F.lit("tracks"), F.array(item(None)))
    return found(read(spark, sf_dir, "pages").select("page_id", buckets.alias("buckets")), ORIGIN)


def capture_items(spark, sf_dir, **options):
    """Events as the items of their kinds: every third is matched in a feed."""
    k = F.col("event_id")
    kind = F.when(k % 4 == 0, "track").when(k % 4 == 3, "artist").otherwise("episode")
    items = read(spark, sf_dir, "events").select(
        (k % 50).alias("entity"), k.alias("n"), kind.alias("type"), F.lit("t").alias("name"), F.when(k % 4 == 1, "S").otherwise(F.when(k % 8 == 2, "S2")).alias("show"), F.when(k % 10 > 0, F.date_format("ts", "yyyy-MM-dd")).alias("release_date"),
        F.when(k % 3 == 0, F.concat(F.lit("https://f.example.com/"), k.cast("string"))).when(k % 3 == 1, F.lit("ftp://x/y")).alias("enclosure"), F.lit("https://f.example.com/rss").alias("feed"), F.lit("t").alias("matched"), F.lit(1.25).alias("score"),
    )
    return planned(items, "entity", **options)


def capture_plan(spark, sf_dir):
    return capture_items(spark, sf_dir).select("entity", "n", "route", "asset_id", "src_url", "note")


def capture_recount(spark, sf_dir):
    """The counts of a plan after the date floor of another ticket."""
    return capture_counts(recent(capture_items(spark, sf_dir), "2024-01-10"), "entity")


EVENT_SQL = """SELECT event_id % 50 AS entity, event_id AS n, CASE WHEN event_id % 10 > 0 THEN strftime(ts, '%Y-%m-%d') END AS release_date,
  CASE WHEN event_id % 4 = 0 THEN 'drm' WHEN event_id % 4 = 1 OR event_id % 8 = 2 THEN CASE WHEN event_id % 3 = 0 THEN 'rss' ELSE 'none' END END AS route FROM events"""
PAIRS = {
    "entity_flatten": (entity_flatten, """WITH p AS (SELECT page_id AS k, url, ['playlist', 'show', 'episode', 'album', 'track', 'audiobook', 'artist'][page_id % 7 + 1] AS kind FROM pages),
c AS (SELECT *, CASE WHEN kind IN ('episode', 'track') THEN 1 WHEN kind = 'artist' OR k % 5 = 0 THEN 0 ELSE 2 END AS items FROM p),
r AS (SELECT *, unnest(CASE WHEN items = 0 THEN [NULL] ELSE generate_series(1, items) END) AS n FROM c),
t AS (SELECT *, CASE WHEN n IS NULL THEN NULL WHEN kind IN ('playlist', 'album', 'track') THEN 'track' WHEN kind = 'audiobook' THEN 'chapter' ELSE 'episode' END AS type, CASE WHEN n IS NULL THEN NULL WHEN kind IN ('episode', 'track') THEN CAST(k AS VARCHAR) ELSE 'i' || k END AS id FROM r)
SELECT k AS page_id, kind, CASE kind WHEN 'playlist' THEN 'O' WHEN 'show' THEN 'P' WHEN 'episode' THEN 'Q' WHEN 'audiobook' THEN 'B' || k || ', Z' WHEN 'artist' THEN 'N' || k ELSE 'A' || k || ', Z' END AS creator,
  CASE WHEN k % 2 = 1 THEN 'D' WHEN k % 3 = 0 THEN 'H' ELSE '' END AS description, url AS image, CASE WHEN items = 0 THEN 40 ELSE items END AS total, n, type, id, 'https://open.example.com/' || type || '/' || id AS item_url,
  CASE WHEN n IS NULL THEN NULL WHEN kind = 'show' THEN 'N' || k WHEN kind IN ('episode', 'track') THEN 'S' END AS show,
  CASE WHEN n IS NULL THEN NULL WHEN kind IN ('episode', 'track') THEN 'A' || k || ', Z' WHEN k % 4 = 0 THEN 'A1, A2' END AS artist,
  CASE WHEN kind IN ('episode', 'track') THEN k * 1000 END AS duration_ms, CASE WHEN n IS NOT NULL AND kind NOT IN ('episode', 'track') THEN 'https://p.example.com/x' END AS preview_url FROM t"""),
    "paged_lists": (paged_lists, """WITH p AS (SELECT page_id AS k, page_id % 8 AS entity, page_id // 8 AS page, page_id % 3 + 1 AS size FROM pages),
e AS (SELECT entity, min(k) AS k FROM p WHERE k IN (45, 60, 65, 76, 87) GROUP BY entity),
g AS (SELECT entity, CAST(sum(CASE WHEN e.k IS NULL OR p.k < e.k THEN size ELSE 0 END) AS BIGINT) AS got, min(p.k) + 100 AS total, min(e.k) AS k FROM p LEFT JOIN e USING (entity) GROUP BY entity)
SELECT entity, got, CASE WHEN k = 76 THEN 'https://api.example.com.evil.org/p76' WHEN k IS NOT NULL THEN 'https://api.example.com/p' || k END AS url,
  CASE k WHEN 45 THEN 'error' WHEN 60 THEN 'auth' WHEN 65 THEN 'denied' WHEN 76 THEN 'error' WHEN 87 THEN 'timeout' END AS why,
  CASE k WHEN 45 THEN 'HTTP 429' WHEN 60 THEN 'HTTP 403' WHEN 65 THEN 'Tunnel connection failed: 403 Forbidden' WHEN 76 THEN 'the next page is not the venue''s' WHEN 87 THEN 'read timed out' END AS said, CASE WHEN k IS NOT NULL THEN total END AS expected FROM g"""),
    "catalog_search": (catalog_search, """WITH r AS (SELECT page_id, unnest(['episode', CASE WHEN page_id % 2 = 0 THEN 'episode' ELSE 'track' END]) AS type FROM pages)
SELECT page_id, type, 'N' AS name, CASE WHEN page_id % 2 = 0 THEN 'S' END AS "by", CAST(NULL AS VARCHAR) AS release_date,
  CASE WHEN page_id = 0 THEN NULL WHEN page_id * 61 >= 3600 THEN printf('%d:%02d:%02d', page_id * 61 // 3600, page_id * 61 % 3600 // 60, page_id * 61 % 60) ELSE printf('%d:%02d', page_id * 61 // 60, page_id * 61 % 60) END AS duration, 'https://open.example.com/' || type || '/x' || page_id AS url FROM r"""),
    "capture_plan": (capture_plan, f"""WITH e AS ({EVENT_SQL}), c AS (SELECT *, count(*) FILTER (route = 'rss') OVER (PARTITION BY entity ORDER BY n) AS seq FROM e)
SELECT entity, n, route, CASE WHEN route = 'rss' THEN 'asset-audio-' || CASE WHEN seq < 1000 THEN lpad(CAST(seq AS VARCHAR), 3, '0') ELSE CAST(seq AS VARCHAR) END END AS asset_id, CASE WHEN route = 'rss' THEN 'https://f.example.com/' || n END AS src_url,
  CASE route WHEN 'rss' THEN 'open RSS enclosure (https://f.example.com/rss); matched ''t'' score=1.25' WHEN 'none' THEN 'episode not matched in any public feed' WHEN 'drm' THEN 'Spotify catalog audio is DRM-protected' END AS note FROM c"""),
    "capture_recount": (capture_recount, f"""WITH e AS ({EVENT_SQL}) SELECT entity, count(*) AS items, count(*) FILTER (route = 'rss') AS audio_resolved, count(*) FILTER (route IN ('drm', 'none')) AS drm_or_unmatched FROM e WHERE release_date IS NULL OR release_date >= '2024-01-10' GROUP BY entity"""),
}
QUERIES, ORACLES = split(PAIRS)
