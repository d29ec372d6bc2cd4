"""Planning queries over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import queries as fq
from tidemill.functions import urls as u
from tidemill.plans import planning as p
from tidemill.registry import read, split

EXCLUDE = ["*/fr/*", "*page=2*"]


def candidates(spark, sf_dir):
    """Pages as a venue's list, with the address of the first as the target."""
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "url")
    first = pages.agg(F.min_by("url", "pos").alias("target"))  # one row
    return pages.crossJoin(F.broadcast(first))


def feed_links(pages, key):
    """The addresses that came by a feed stand for what is held already."""
    return pages.where(F.contains("url", F.lit("utm_source"))).select(key)


def plan_pages_counts(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    key = u.safe_sitemap(u.normalized(u.safe_sitemap(F.trim("url")), ("utm_source",)))
    pages = p.keep_first(pages.withColumn("normal", key), F.col("normal"), F.col("pos"))
    pages = p.flag_known(pages, F.col("normal"), feed_links(pages, F.col("normal")))
    why = p.first_reason([
        ("unsafe_url", F.col("normal").isNull()), ("duplicate", F.col("repeat")), ("scope", ~p.scope_share(F.col("normal"), F.col("target"), "domain")),
        ("excluded", p.excluded_sitemap(F.col("normal"), EXCLUDE)), ("known", F.col("known")),
    ])
    return pages.groupBy(F.coalesce(why, F.lit("keep")).alias("why")).agg(F.count("*").alias("n"))


def plan_course(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    out = p.plan_course(pages, feed_links(pages, u.same_key(u.clean_course(F.col("url")))), F.col("target"), "domain", ["/en/1", "www.example.com/fr"])
    return out.select("pos", "cleaned", "why", "order_no")


def plan_sitemap(spark, sf_dir):
    pages = candidates(spark, sf_dir).withColumn("lastmod", F.concat(F.lit("2024-01-"), F.lpad((F.col("pos") % 28 + 1).cast("string"), 2, "0")))
    known = feed_links(pages, u.normalized(F.col("url"), ("utm_source",)))
    out = p.plan_sitemap(pages, known, F.lit("https://blog.example.com/"), "domain", EXCLUDE, "2024-01-05", ("utm_source",))
    return out.groupBy("why").agg(F.count("*").alias("n"))


def plan_sitemap_limit(spark, sf_dir):
    pages = candidates(spark, sf_dir).withColumn("lastmod", F.concat(F.lit("2024-01-"), F.lpad((F.col("pos") % 28 + 1).cast("string"), 2, "0"))).withColumn("url", F.concat(F.lit("https://one.example.com/a/"), F.col("pos").cast("string")))
    landed = pages.where("lastmod >= '2024-01-20'").select("url")
    out = p.plan_sitemap(pages, pages.limit(0).select("url"), F.lit("https://one.example.com/a"), "section", limit=20, landed=landed)
    return out.select("pos", "normal", "why", "landed")


def plan_share(spark, sf_dir):
    pages = candidates(spark, sf_dir).withColumn("name", F.concat(F.lit("clip."), F.when(F.col("pos") % 2 == 0, "mp4").otherwise("pdf")))
    out = p.plan_share(pages, feed_links(pages, F.col("url")), F.col("target"), "domain", ["*/fr/*"], reference=True)
    return out.select("pos", "url", "why", "order_no")


def archive(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    # newest first: the further down, the older; each language is an archive
    day = F.date_format(F.date_sub(F.lit("2024-06-30").cast("date"), (F.col("pos") % 400).cast("int")), "yyyy-MM-dd")
    lang = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    return pages.withColumn("day", day).withColumn("archive", lang).withColumn("audience", F.when(F.char_length("url") % 3 == 0, "only_paid").when(F.char_length("url") % 3 == 1, "everyone"))


def walk_archive(spark, sf_dir):
    posts = archive(spark, sf_dir)
    out = p.walk_archive(posts, feed_links(posts, F.col("url")), F.lit(""), "domain", ["*page=2*"], "2023-12-01", "2024-06-25", "free", cap=25)
    return out.select("pos", "archive", "why", "stops")


def audience_counts(spark, sf_dir):
    posts = archive(spark, sf_dir)
    out = p.walk_archive(posts, feed_links(posts, F.col("url")), F.lit(""), "domain", ["*page=2*"], "2023-12-01", "2024-06-25", "free", cap=25)
    return out.groupBy("archive", F.coalesce("audience", F.lit("unknown")).alias("audience")).agg(F.count("*").alias("n"))


def halted_hosts(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    out = p.halt_after_refusal(pages, u.registered(F.col("url")), F.contains("url", F.lit("#")))
    return out.select("pos", "halted")


def within_budget(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    out = p.within_budget(pages, F.char_length("url"), 2000, u.registered(F.col("url")))
    return out.select("pos", "reached")


def known_anti(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    known = feed_links(pages, u.same_key(F.col("url")).alias("k"))
    return pages.join(known, u.same_key(F.col("url")) == F.col("k"), "left_anti").select("pos", "url")


def exclusion_rules(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", p.excluded_course(url, ["/en/1", "http://www.m.ththth.example.net/en"]).alias("course"), p.excluded_archive(url, ["*/fr/*", "https://m.ththth.example.net/en"]).alias("archive"),
        p.excluded_sitemap(url, ["http*://[bm]*.example.???/*"]).alias("sitemap"), p.excluded_share(url, ["https://b", "*utm_*"]).alias("share"), p.excluded_by(F.lit("Title"), url, ["zzz", "BLOG", "example"]).alias("rule"),
    )


def scope_rules(spark, sf_dir):
    pages = candidates(spark, sf_dir)
    url, target = F.col("url"), F.col("target")
    made = {f"{k}_{s}": f(url, target, s) for k, f in (("course", p.scope_course), ("sitemap", p.scope_sitemap), ("share", p.scope_share), ("archive", p.scope_archive)) for s in ("page", "section", "domain")}
    return pages.select("pos", *(c.alias(k) for k, c in made.items()))


# ------------------------------------------------------------------ the SQL twins


def _with(x: str, url: str) -> str:
    """An expression over url, over another value."""
    return x.replace("url", url)


NET, PATH, QUERY = fq.NETLOC, fq.PATH, fq.QUERY
NORMAL = fq.NORMAL
SAFE = fq.SAFE_URL("trim(url)")
NORMED = f"CASE WHEN {SAFE} THEN {_with(NORMAL, 'trim(url)').replace('trim(url)', 'url')} END"
LAST2 = lambda x: f"array_to_string(string_split(regexp_replace(lower({_with(NET, x)}), '^www[.]', ''), '.')[-2:], '.')"
GLOB = "contains(normal, '/fr/') OR contains(normal, 'page=2')"
BASE = "c AS (SELECT page_id AS pos, url, (SELECT arg_min(url, page_id) FROM pages) AS target FROM pages)"
CLEAN_URL = fq.COURSE
LASTMOD = "'2024-01-' || lpad(CAST(pos % 28 + 1 AS VARCHAR), 2, '0')"
DAY = "strftime(DATE '2024-06-30' - CAST(pos % 400 AS INTEGER), '%Y-%m-%d')"
ARCHIVE = f"""{BASE}, a AS (SELECT *, {DAY} AS day, regexp_extract(url, '/(en|fr|de|es)/', 1) AS archive,
  CASE WHEN length(url) % 3 = 0 THEN 'only_paid' WHEN length(url) % 3 = 1 THEN 'everyone' END AS audience FROM c),
w AS (SELECT *, CASE WHEN day < '2023-12-01' THEN 'min_date' WHEN day > '2024-06-25' THEN 'newer' WHEN regexp_matches(url, '^(?s:.*page=2.*)$') THEN 'excluded'
  WHEN coalesce(audience, 'unknown') <> 'everyone' THEN 'paywalled' WHEN contains(url, 'utm_source') THEN 'known' END AS why FROM a),
f AS (SELECT *, sum(CASE WHEN why IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY archive ORDER BY pos) AS planned FROM w),
s AS (SELECT *, coalesce(why, '') = 'min_date' OR (why IS NULL AND planned > 25) AS stops FROM f),
r AS (SELECT *, coalesce(bool_or(stops) OVER (PARTITION BY archive ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after FROM s)"""
# of equal addresses that came by a feed all rows are known, so the walk's join is by row
SHORT = lambda x: f"regexp_replace({_with(PATH, x)}, '/+$', '')"
BAREH = lambda x: _with(fq.BARE, x)
BNET = lambda x: f"regexp_replace({_with(NET, x)}, '^www[.]', '')"
NHOST = lambda x: f"regexp_replace(lower({_with(NET, x)}), '^www[.]', '')"
SAMEK = lambda x: _with(fq.SAME, x)

PAIRS = {
    "plan_pages_counts": (plan_pages_counts, f"""WITH {BASE}, n AS (SELECT *, {NORMED} AS normal FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY normal ORDER BY pos) AS nth FROM n),
k AS (SELECT DISTINCT normal AS held FROM n WHERE contains(url, 'utm_source'))
SELECT CASE WHEN normal IS NULL THEN 'unsafe_url' WHEN nth > 1 THEN 'duplicate' WHEN {LAST2('normal')} <> {LAST2('target')} THEN 'scope'
  WHEN {GLOB} THEN 'excluded' WHEN held IS NOT NULL THEN 'known' ELSE 'keep' END AS why, count(*) AS n
FROM r LEFT JOIN k ON normal = held GROUP BY 1"""),
    "plan_course": (plan_course, f"""WITH {BASE}, n AS (SELECT *, {CLEAN_URL} AS cleaned FROM c), m AS (SELECT *, {SAMEK('cleaned')} AS same FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY same ORDER BY pos) AS nth FROM m), k AS (SELECT DISTINCT same AS held FROM m WHERE contains(url, 'utm_source')),
w AS (SELECT pos, cleaned, CASE WHEN cleaned IS NULL THEN 'unsafe_url' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches({_with(PATH, 'cleaned')}, '/') THEN 'not_lesson'
  WHEN {BAREH('cleaned')} <> {BAREH('target')} THEN 'scope'
  WHEN {SHORT('cleaned')} = '/en/1' OR starts_with({SHORT('cleaned')}, '/en/1/') OR ({BAREH('cleaned')} = 'example.com' AND ({SHORT('cleaned')} = '/fr' OR starts_with({SHORT('cleaned')}, '/fr/'))) THEN 'excluded'
  WHEN held IS NOT NULL THEN 'known' END AS why FROM r LEFT JOIN k ON same = held)
SELECT *, CASE WHEN why IS NULL THEN row_number() OVER (PARTITION BY why IS NULL ORDER BY pos) END AS order_no FROM w"""),
    "plan_sitemap": (plan_sitemap, f"""WITH {BASE}, n AS (SELECT *, {NORMED} AS normal, {LASTMOD} AS lastmod FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY normal ORDER BY pos) AS nth FROM n), k AS (SELECT DISTINCT normal AS held FROM n WHERE contains(url, 'utm_source'))
SELECT CASE WHEN normal IS NULL THEN 'unsafe_url' WHEN nth > 1 THEN 'duplicate' WHEN {BNET('normal')} <> 'blog.example.com' THEN 'scope' WHEN {GLOB} THEN 'excluded'
  WHEN lastmod < '2024-01-05' THEN 'older_than_min_date' WHEN held IS NOT NULL THEN 'known' END AS why, count(*) AS n FROM r LEFT JOIN k ON normal = held GROUP BY 1"""),
    "plan_sitemap_limit": (plan_sitemap_limit, f"""WITH {BASE}, n AS (SELECT pos, 'https://one.example.com/a/' || pos AS normal, {LASTMOD} AS lastmod FROM c),
l AS (SELECT *, lastmod >= '2024-01-20' AS landed FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY landed ORDER BY lastmod DESC, pos) AS nth FROM l)
SELECT pos, normal, CASE WHEN NOT landed AND nth > 20 THEN 'over_limit' END AS why, landed FROM r"""),
    "plan_share": (plan_share, f"""WITH {BASE}, r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS nth FROM c),
w AS (SELECT pos, url, CASE WHEN nth > 1 THEN 'duplicate' WHEN {LAST2('url')} <> {LAST2('target')} THEN 'scope' WHEN regexp_matches(url, '^(?s:.*/fr/.*)$') THEN 'excluded'
  WHEN contains(url, 'utm_source') THEN 'known' WHEN pos % 2 = 0 THEN 'reference' END AS why FROM r)
SELECT *, CASE WHEN why IS NULL THEN row_number() OVER (PARTITION BY why IS NULL ORDER BY pos) END AS order_no FROM w"""),
    "walk_archive": (walk_archive, f"WITH {ARCHIVE} SELECT pos, archive, CASE WHEN why IS NULL AND stops THEN 'truncated' ELSE why END AS why, stops FROM r WHERE NOT after"),
    "audience_counts": (audience_counts, f"WITH {ARCHIVE} SELECT archive, coalesce(audience, 'unknown') AS audience, count(*) AS n FROM r WHERE NOT after GROUP BY 1, 2"),
    "halted_hosts": (halted_hosts, f"WITH {BASE} SELECT pos, coalesce(bool_or(contains(url, '#')) OVER (PARTITION BY array_to_string(string_split({fq.HOST}, '.')[-2:], '.') ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS halted FROM c"),
    "within_budget": (within_budget, f"WITH {BASE} SELECT pos, coalesce(sum(length(url)) OVER (PARTITION BY array_to_string(string_split({fq.HOST}, '.')[-2:], '.') ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= 2000 AS reached FROM c"),
    "known_anti": (known_anti, f"WITH {BASE} SELECT pos, url FROM c WHERE {fq.SAME} NOT IN (SELECT {fq.SAME} FROM c WHERE contains(url, 'utm_source'))"),
    "exclusion_rules": (exclusion_rules, f"""SELECT page_id, {SHORT('url')} = '/en/1' OR starts_with({SHORT('url')}, '/en/1/') OR ({fq.BARE} = 'm.ththth.example.net' AND ({SHORT('url')} = '/en' OR starts_with({SHORT('url')}, '/en/'))) AS course,
  contains(url, '/fr/') OR rtrim(url, '/') = 'https://m.ththth.example.net/en' OR regexp_matches(url, '^https://m[.]ththth[.]example[.]net/en[/?#]') AS archive,
  regexp_matches(url, '^http.*://[bm].*[.]example[.].../.*$') AS sitemap, starts_with(url, 'https://b') OR contains(url, 'utm_') AS share, CASE WHEN contains(lower(url), 'blog') THEN 'BLOG' WHEN contains(lower(url), 'example') THEN 'example' END AS rule FROM pages"""),
    "scope_rules": (scope_rules, f"""WITH {BASE}, e AS (SELECT pos, url, target, {SAMEK('url')} = {SAMEK('target')} AS course_page, {BAREH('url')} = {BAREH('target')} AS course_domain,
  {_with(PATH, 'url')} AS p, {_with(PATH, 'target')} AS tp, {SHORT('url')} AS sp, {SHORT('target')} AS st, {BNET('url')} = {BNET('target')} AS sitemap_domain, {_with(QUERY, 'url')} = {_with(QUERY, 'target')} AS same_query, {NHOST('url')} AS h, {NHOST('target')} AS th FROM c)
SELECT pos, course_page, course_domain AND (p = st OR starts_with(p, st || '/')) AS course_section, course_domain,
  sitemap_domain AND sp = st AND same_query AS sitemap_page, sitemap_domain AND (sp = st OR starts_with(sp, st || '/')) AS sitemap_section, sitemap_domain,
  rtrim(url, '/') = rtrim(target, '/') AS share_page, h = th AND starts_with(sp || '/', st || '/') AS share_section, array_to_string(string_split(h, '.')[-2:], '.') = array_to_string(string_split(th, '.')[-2:], '.') AS share_domain,
  rtrim(url, '/') = rtrim(target, '/') AS archive_page, course_domain AND (st = '' OR p = st OR starts_with(p, st || '/')) AS archive_section, course_domain AS archive_domain FROM e"""),
}

QUERIES, ORACLES = split(PAIRS)
