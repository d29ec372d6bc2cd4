"""Queries of rules whose inputs the tables do not hold: rows are made from whole tables so that every outcome is met."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import html
from tidemill.operators import items, render, report
from tidemill.plans.planning import first_reason, single
from tidemill.registry import read, split
from tidemill.sources import landed, sinks


def course_sidebar(spark, sf_dir):
    """Three links a page: a lesson or a section, the page itself, and one without an address."""
    k = F.col("page_id")
    kind = F.when(k % 2 == 0, "/lessons/").otherwise("/sections/")
    link = lambda href, text: F.struct(href.alias("href"), text.alias("text"))
    links = F.array(link(F.concat("url", kind), F.repeat(F.lit("ab"), (k % 60).cast("int"))), link(F.col("url"), F.lit("self")), link(F.lit(None).cast("string"), F.lit("none")))
    files = read(spark, sf_dir, "pages").select(k.cast("string").alias("file"), F.to_json(F.struct("url", links.alias("discovered_lesson_links"))).alias("content"))
    return landed.course_links(files)


def caption_files(spark, sf_dir):
    """A folder for every seven pages, each page a file of one of five names; the wanted language first, then any captions."""
    k = F.col("page_id")
    ends = F.element_at(F.array(*(F.lit(x) for x in (".en.vtt", ".en-orig.vtt", ".de.vtt", ".de-orig.vtt", ".txt"))), (F.floor(k * 3 / 2) % 5 + 1).cast("int"))
    names = read(spark, sf_dir, "pages").select(F.floor(k / 7).cast("long").alias("folder"), F.concat(F.lit("f"), k.cast("string"), ends).alias("name"))
    return landed.caption_pick(names, [r"[.]en(-orig)?[.]vtt$", r"[.]vtt$"])


def pages_upserted(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("t"), F.col("page_id").cast("string")).alias("title"), F.col("url").alias("body"))
    new = pages.where("page_id % 3 = 0").select("title", F.lit("new").alias("body")).union(pages.where("page_id % 6 = 0").select("title", F.lit("newer").alias("body")))
    return sinks.upsert_pages(pages.where("page_id % 2 = 0").select("title", "body"), new)


def bodies_set_aside(spark, sf_dir):
    refused = F.when(F.col("page_id") % 3 == 0, True).when(F.col("page_id") % 3 == 1, False)
    kept, aside = sinks.split_refused(read(spark, sf_dir, "pages").select("page_id"), refused)
    return kept.withColumn("place", F.lit("kept")).union(aside.withColumn("place", F.lit("refused")))


def transcript_guard(spark, sf_dir):
    """Every document below a time head, a heading, a list and a rule."""
    head = F.concat(F.lit("## Part "), F.col("doc_id").cast("string"), F.lit(" [0:12]\n# Title\n 1) one\n12 two\n``` x\n"))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha1(F.encode(render.guard_transcript(F.concat(head, F.coalesce("text", F.lit("")))), "UTF-8")).alias("guarded_sha1"))


def chapter_list(spark, sf_dir):
    k = F.col("page_id").cast("double")
    chapter = lambda a, b, x: F.struct(a.cast("double").alias("start_time"), b.cast("double").alias("end_time"), x.cast("string").alias("title"))
    listed = F.array(chapter(k, k + 1, F.concat(F.lit(" Part\t<"), F.col("page_id").cast("string"), F.lit(" $$ [[x"))), chapter(F.lit(None), k, F.lit("lost")), chapter(F.lit(0), F.lit(None), F.lit(None)))
    rows = read(spark, sf_dir, "pages").select("page_id", F.posexplode(render.safe_chapters(listed)).alias("pos", "c"))
    return rows.select("page_id", "pos", F.col("c.start").alias("begins"), F.col("c.end").alias("ends"), "c.title")


def caption_tracks(spark, sf_dir):
    """Captions of a known and an unknown language among tracks of other kinds and without text."""
    track = lambda kind, lang, label, text: F.struct(F.lit(kind).alias("kind"), lang.cast("string").alias("srclang"), F.lit(label).alias("label"), text.alias("text"))
    tracks = F.array(
        track("chapters", F.lit("en"), "a", F.lit("x")), track("captions", F.when(F.col("page_id") % 2 == 0, "en"), "b", F.col("url")),
        track("subtitles", F.lit("de"), "c", F.lit("  ")), track("subtitles", F.lit(""), "d", F.lit("y")),
    )
    rows = read(spark, sf_dir, "pages").select("page_id", F.posexplode(html.caption_records(tracks)).alias("pos", "c"))
    return rows.select("page_id", "pos", "c.lang", "c.label", "c.file", "c.text")


def outage_probe(spark, sf_dir):
    k = F.col("event_id")
    statuses = F.when(k % 3 == 0, F.array(F.lit(200), F.lit(503))).when(k % 3 == 1, F.array(F.lit(200), F.lit(404))).otherwise(F.array().cast("array<int>"))
    return read(spark, sf_dir, "events").select("event_id", html.outage(k % 2 == 0, statuses, k % 5, k % 7 * 50).alias("up"))


def entity_pages(spark, sf_dir):
    k = F.col("doc_id")
    item = lambda n, name, ms: F.struct(F.lit(n).alias("n"), F.lit(name).alias("name"), F.lit(ms).cast("long").alias("duration_ms"))
    listed = F.when(k % 3 != 0, F.array(item(1, "a|b", 61_000), item(2, "c", None), item(3, "d", 3_600_000))).otherwise(F.array().cast("array<struct<n:int,name:string,duration_ms:bigint>>"))
    page = render.entity_page(F.concat(F.lit("Set: "), k.cast("string")), F.when(k % 2 == 1, "A  maker"), F.when(k % 4 == 0, "One  line\n# two <x>\n"), listed, k % 5 == 0)
    return read(spark, sf_dir, "documents").select("doc_id", page.alias("page"))


def video_pages(spark, sf_dir):
    facts = F.when(F.col("page_id") % 2 == 0, "").otherwise("- **By**: x")
    description = F.when(F.col("page_id") % 3 != 0, "> said")
    page = render.video_page(F.concat(F.lit("Video "), F.col("page_id").cast("string")), F.concat("url", F.lit(".jpg")), F.col("url"), facts, description, F.lit("words"))
    return read(spark, sf_dir, "pages").select("page_id", page.alias("page"))


def capture_rows(spark, sf_dir):
    k = F.col("page_id")
    record = render.capture_record("web", k.cast("string"), F.concat(F.lit("T"), k.cast("string")), F.sha1(F.encode("html", "UTF-8")), F.lit("text/html"), F.lit("2024-01-02T03:04:05Z"))
    return read(spark, sf_dir, "pages").select(record.alias("r")).select("r.*")


def leaf_plan_single(spark, sf_dir):
    """Pages planned one by one: known before excluded."""
    why = first_reason([("known", F.col("page_id") % 2 == 0), ("excluded", F.col("page_id") % 3 == 0)])
    return read(spark, sf_dir, "pages").select("page_id", single(F.col("url"), why).alias("p")).select("page_id", "p.url", "p.why")


def site_rule_pick(spark, sf_dir):
    """Rules of bare hosts, of www. forms, of both, and of any other host."""
    hosts = read(spark, sf_dir, "pages").select(F.substring_index(F.substring_index("url", "/", 3), "/", -1).alias("host")).distinct()
    bare = hosts.select(F.regexp_replace("host", "^www[.]", "").alias("host")).distinct()
    rules = bare.where("length(host) % 3 = 0").select("host", F.lit("bare").alias("rule"))
    rules = rules.union(bare.where("length(host) % 2 = 0").select(F.concat(F.lit("www."), "host"), F.lit("www"))).union(spark.range(1).select(F.lit("*"), F.lit("any")))
    return landed.site_rules(hosts, rules)


def reports_carried(spark, sf_dir):
    """A report of every event, every other one with a former report of its ticket."""
    status = lambda n: F.element_at(F.array(F.lit("ok"), F.lit("partial"), F.lit("failed")), (n % 3 + 1).cast("int"))
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("ticket"))
    now = events.select("ticket", status(F.col("ticket")).alias("status"), F.lit("now").alias("reason"))
    then = events.where("ticket % 2 = 0").select("ticket", status(F.floor(F.col("ticket") / 6)).alias("status"), F.lit("then").alias("reason"))
    return report.carried(now, then)


def cursor_ties(spark, sf_dir):
    """The item at the cursor is behind it where the cursor names it, and only then; where no item is named a tie is kept."""
    k = F.col("event_id")
    when, ident = F.floor(k / 2) * 1000, F.concat(F.lit("i"), k.cast("string"))
    return read(spark, sf_dir, "events").select("event_id", items.behind_mail(when, ident, 50_000, "i101").alias("mail"), items.behind_task(when, 50_000).alias("task"))


def page_statuses(spark, sf_dir):
    bit = lambda n: F.floor(F.col("event_id") / n) % 2 == 0
    return read(spark, sf_dir, "events").select("event_id", report.page_status(bit(1), bit(2), bit(4), bit(8)).alias("status"))


NL, BS = "chr(10)", "chr(92)"
PAIRS = {
    "course_sidebar": (course_sidebar, """SELECT CAST(page_id AS VARCHAR) AS file, 0 AS pos, url || CASE WHEN page_id % 2 = 0 THEN '/lessons/' ELSE '/sections/' END AS url, left(repeat('ab', page_id % 60), 80) AS text FROM pages
UNION ALL SELECT CAST(page_id AS VARCHAR), 1, url, 'self' FROM pages WHERE contains(url, '/lessons/') OR contains(url, '/sections/')"""),
    "caption_files": (caption_files, """WITH n AS (SELECT page_id // 7 AS folder, page_id * 3 // 2 % 5 AS e, 'f' || page_id AS stem FROM pages),
named AS (SELECT folder, e, stem || CASE e WHEN 0 THEN '.en.vtt' WHEN 1 THEN '.en-orig.vtt' WHEN 2 THEN '.de.vtt' WHEN 3 THEN '.de-orig.vtt' END AS name FROM n WHERE e < 4)
SELECT folder, name FROM named QUALIFY row_number() OVER (PARTITION BY folder ORDER BY e, name) = 1"""),
    "pages_upserted": (pages_upserted, "SELECT 't' || page_id AS title, CASE WHEN page_id % 6 = 0 THEN 'newer' WHEN page_id % 3 = 0 THEN 'new' ELSE url END AS body FROM pages WHERE page_id % 2 = 0 OR page_id % 3 = 0"),
    "bodies_set_aside": (bodies_set_aside, "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'refused' ELSE 'kept' END AS place FROM pages"),
    "transcript_guard": (transcript_guard, f"""WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), {NL})) AS x, generate_subscripts(string_split(coalesce(text, ''), {NL}), 1) AS pos FROM documents),
bare AS (SELECT *, ltrim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM lines),
marked AS (SELECT *, left(t, 1) IN ('#', '>', '+', '*', '-', '|') OR left(t, 3) IN ('```', '~~~') OR (ltrim(t, '0123456789') <> t AND left(ltrim(t, '0123456789'), 1) IN ('.', ')')) AS opens,
  string_split(x, ' ')[1] IN ('#', '##', '###', '####', '#####', '######') AND len([d FOR d IN range(10) IF contains(x, '[' || d)]) > 0 AS head FROM bare)
SELECT doc_id, sha1('## Part ' || doc_id || ' [0:12]' || {NL} || {BS} || '# Title' || {NL} || {BS} || ' 1) one' || {NL} || '12 two' || {NL} || {BS} || '``` x' || {NL} || string_agg(CASE WHEN opens AND NOT head THEN {BS} ELSE '' END || x, {NL} ORDER BY pos)) AS guarded_sha1 FROM marked GROUP BY doc_id"""),
    "chapter_list": (chapter_list, f"""SELECT page_id, 0 AS pos, CAST(page_id AS DOUBLE) AS begins, page_id + 1.0::DOUBLE AS ends, 'Part &lt;' || page_id || ' ' || {BS} || '$' || {BS} || '$ ' || {BS} || '[' || {BS} || '[x' AS title FROM pages
UNION ALL SELECT page_id, 1, 0.0::DOUBLE, NULL, '' FROM pages"""),
    "caption_tracks": (caption_tracks, """SELECT page_id, 0 AS pos, CASE WHEN page_id % 2 = 0 THEN 'en' END AS lang, 'b' AS label, CASE WHEN page_id % 2 = 0 THEN 'en.vtt' ELSE 'track-1.vtt' END AS file, url AS text FROM pages
UNION ALL SELECT page_id, 1, '', 'd', 'track-2.vtt', 'y' FROM pages"""),
    "outage_probe": (outage_probe, "SELECT event_id, event_id % 2 = 0 AND event_id % 3 <> 0 AND NOT (event_id % 5 = 0 AND event_id % 7 < 5) AS up FROM events"),
    "entity_pages": (entity_pages, f"""SELECT doc_id, '# Set - ' || doc_id || CASE WHEN doc_id % 2 = 1 THEN {NL} || {NL} || 'by A maker' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN {NL} || {NL} || '> The list is cut.' ELSE '' END
  || CASE WHEN doc_id % 4 = 0 THEN {NL} || {NL} || '> One line' || {NL} || '> ' || {BS} || '# two &lt;x>' ELSE '' END
  || CASE WHEN doc_id % 3 <> 0 THEN {NL} || {NL} || '| # | Title | Length |' || {NL} || '| --- | --- | --- |' || {NL} || '| 1 | a' || {BS} || '|b | 1:01 |' || {NL} || '| 2 | c | ? |' || {NL} || '| 3 | d | 1:00:00 |' ELSE '' END AS page FROM documents"""),
    "video_pages": (video_pages, f"""SELECT page_id, '# Video ' || page_id || {NL} || {NL} || '![](' || url || '.jpg)' || {NL} || {NL} || '<iframe src="' || url || '"></iframe>' || CASE WHEN page_id % 2 = 1 THEN {NL} || {NL} || '- **By**: x' ELSE '' END
  || CASE WHEN page_id % 3 <> 0 THEN {NL} || {NL} || '> said' ELSE '' END || {NL} || {NL} || '## Transcript' || {NL} || {NL} || 'words' AS page FROM pages"""),
    "capture_rows": (capture_rows, "SELECT 1 AS v, 'web' AS slug, CAST(page_id AS VARCHAR) AS item, 'T' || page_id AS title, sha1(html) AS body, 'text/html' AS content_type, '2024-01-02T03:04:05Z' AS fetched_at FROM pages"),
    "leaf_plan_single": (leaf_plan_single, "SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN 'known' WHEN page_id % 3 = 0 THEN 'excluded' END AS why FROM pages"),
    "site_rule_pick": (site_rule_pick, """WITH h AS (SELECT DISTINCT string_split(url, '/')[3] AS host FROM pages), b AS (SELECT host, starts_with(host, 'www.') AS w, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END AS bare FROM h)
SELECT host, CASE WHEN w AND length(bare) % 2 = 0 THEN 'www' WHEN length(bare) % 3 = 0 THEN 'bare' WHEN length(bare) % 2 = 0 THEN 'www' ELSE 'any' END AS rule FROM b"""),
    "reports_carried": (reports_carried, """WITH e AS (SELECT event_id AS ticket, event_id % 3 AS now, CASE WHEN event_id % 2 = 0 THEN event_id // 6 % 3 ELSE 9 END AS before FROM events)
SELECT ticket, ['ok', 'partial', 'failed'][least(now, before) + 1] AS status, CASE WHEN before < now THEN 'then' ELSE 'now' END AS reason FROM e"""),
    "cursor_ties": (cursor_ties, "SELECT event_id, event_id < 100 OR event_id = 101 AS mail, event_id < 100 AS task FROM events"),
    "page_statuses": (page_statuses, "SELECT event_id, CASE WHEN event_id & 1 = 1 THEN 'failed' WHEN event_id & 2 = 0 THEN 'ok' WHEN event_id & 4 = 0 THEN 'gone' WHEN event_id & 8 = 0 THEN 'failed' ELSE 'ok' END AS status FROM events"),
}
QUERIES, ORACLES = split(PAIRS)
