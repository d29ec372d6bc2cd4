import io
import random
import re
import unicodedata
import zipfile

from pyspark.sql import functions as F

from tidemill.functions import html, text, urls
from tidemill.operators import items, matching, render, report, titles
from tidemill.plans import planning
from tidemill.sources import landed, sinks
from tidemill.streaming import pulls


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_urls(spark):
    clean = lambda x: one(spark, urls.clean_course(F.col("u")), u=x)
    assert clean("HTTPS://Ex.com/a?b=1#c") == "https://Ex.com/a?b=1"
    for bad in ("ftp://x/y", "https://u@x/y", "https://x/a b", "https://x:99999/", "https://x/" + "a" * 2000, "javascript:alert(1)", None, "https://x/\ta"):
        assert clean(bad) is None
    assert one(spark, urls.same_key(F.col("u")), u="HTTPS://Ex.com/A//?q=1#f") == "https://ex.com/A?q=1"
    assert one(spark, urls.normalized(F.col("u")), u="https://EX.com/?hsLang=en&a=&b#x") == "https://ex.com/?a=&b="
    assert one(spark, urls.host_suffixes(F.col("u")), u="https://www.a.b.com/x") == ["www.a.b.com", "a.b.com", "b.com"]
    assert one(spark, urls.slug(F.lit("a" * 59 + " b")), u="") == "a" * 59 + "-"
    assert one(spark, urls.share_slug(F.lit("a" * 59 + " b")), u="") == "a" * 59
    assert one(spark, F.col("u").rlike(urls.glob_pattern("a?c*[x-z]")), u="abc--y") is True
    assert one(spark, F.col("u").rlike(urls.glob_pattern("a?c*[x]", classes=False)), u="abcx") is False


def test_titles_and_lines(spark):
    safe = lambda x: one(spark, text.safe_title(F.col("t")), t=x)
    assert safe(" .a: b/c|d?*\"<e>\n") == "a - b-c-d’(e)"
    assert safe("INDEX") == "INDEX (page)" and safe(None) == "Untitled" and safe("...") == "Untitled"
    assert safe("字" * 100) == "字" * 66 + "…" and safe("x" * 130) == "x" * 120 + "…"
    assert one(spark, text.bullet_line(F.col("t")), t="see [x](http://www.a) `b`") == "see (x)(http:∕∕www․a) 'b'"
    assert one(spark, text.page_key(F.col("t")), t=" STRASSE É ") == "strasse é"
    assert one(spark, text.match_title(F.col("t")), t="Résumé!") == "re sume"
    assert one(spark, text.link_title(F.col("t")), t="Lesson one\n\n04:07") == "Lesson one"
    assert one(spark, text.card_name(F.col("t")), t="NEW\n3:12\nclip.mp4") == "clip.mp4"


def test_title_fold_is_stable():
    rows = [("A", ["s", "h1"]), ("a", ["s", "h2"]), ("A", ["t", "h3"]), ("A", []), ("A (t)", ["z"]), ("字" * 67, ["q"]), ("字" * 67, ["r" * 30])]
    first = titles.settle(rows)
    assert first[:5] == ["A", "a (h2)", "A (t)", "A (2)", "A (t) (z)"]
    assert len({t.casefold() for t in first}) == len(first) and all(len(t.encode()) <= 203 for t in first)
    assert titles.settle([(t, q) for t, (_, q) in zip(first, rows, strict=True)]) == first


def test_html():
    page = """<html><head><title>T</title></head><body><nav>menu</nav><main><h2>Head</h2><p>One <b>two</b> <a href="/x">link</a><br>next</p><ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><pre><code class="language-py">x = 1</code></pre><video src="v"></video><iframe src="https://ads.example/x"></iframe><table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>a|b</td></tr></table><blockquote><p>q</p></blockquote><img data-src="/i.png" alt="i"><p class="cta">buy</p></main></body></html>"""
    got = html.to_markdown(page, "https://e.com/p", drop=(".cta",), title_selector="h2")
    assert got["title"] == "Head" and got["dropped"] == 1 and got["media"] == {"video": 1, "audio": 0, "embed": 0}
    assert got["markdown"] == (
        "# Head\n\nOne **two** [link](https://e.com/x)  \nnext\n\n- a\n\n  - b\n- c\n\n```py\nx = 1\n```\n\n <!-- media:video:1 --> \n\n"
        "| k | v |\n|---|---|\n| 1 | a|b |\n\n> q\n\n![i](https://e.com/i.png)\n"
    )
    shape = html.shape_of('<title>X</title><h1>Log in</h1><div class="c d"><p>in</p></div>after<script>no</script>', "c")
    assert shape == {"roots": 1, "title": "X", "h1": ["Log in"], "outside": "Log inafter"}
    for odd in ("", "<", "<p", "</div>", "<a <b>", "<!-- x"):
        html.to_markdown(odd)


def test_html_checks(spark):
    df = spark.createDataFrame([("<h1>Sign in</h1>",), ("<p>Too many requests</p>",), ('<div class="c">x</div> subscribe to read',), (None,)], "p string").select(html.shape_column(F.col("p"), "c").alias("s"))
    got = [tuple(r) for r in df.select(html.unusable(F.col("s"), ".c", soft=("too many requests",))["why"], html.paywalled(F.col("s"), ["subscribe to read"])).collect()]
    assert got == [("auth", False), ("error", False), (None, True), ("error", False)]
    assert one(spark, html.meta_content(F.col("p"), "og:title"), p='<meta content="A b" property="og:title"><meta property="og:title" content="c">') == "A b"


def test_matching(spark):
    its = spark.createDataFrame([("s", 1, "deep sea fish", 100), ("s", 2, "other", None), ("t", 3, "deep sea fish", 100)], "show string, item int, want string, seconds int")
    feed = spark.createDataFrame([("s", 10, "the deep sea fish show", 120, 0), ("s", 11, "deep sea fish", 100, 1), ("s", 12, "deep sea", 900, 2)], "show string, entry int, have string, seconds int, pos int")
    assert [tuple(r) for r in matching.best_matches(its, feed).select("item", "entry", "score").collect()] == [(1, 10, 1.75)]


def test_matching_is_the_plain_search(spark):
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice(["art", "ear", "s", "the", "par", "ty", " ", " ", " "]) for _ in range(rng.randrange(0, n)))
    title = lambda n: " ".join(say(n).split())
    its = [(f"s{k % 3}", k % 40, title(14), rng.choice([None, 0, 100, 900])) for k in range(120)]
    its = list({r[:2]: r for r in its}.values())
    feed = [(f"s{k % 3}", k // 3, rng.choice([title(14), title(4), rng.choice(its)[2], title(3) + " " + rng.choice(its)[2] + say(2)]).strip(), rng.choice([None, 120, 1000]), (k * 7) % 240) for k in range(240)]
    feed = [(*r[:2], " ".join(r[2].split()), *r[3:]) for r in feed]
    want = []
    for show, item, name, secs in its:
        best, top = None, 0.0
        for s, entry, have, had, _ in sorted(feed, key=lambda r: r[4]):
            if s != show:
                continue
            a, b = set(name.split()), set(have.split())
            fits = had is None or not secs or abs(had - secs) <= 150
            score = len(a & b) / max(1, len(a)) + (0.5 if name in have or have in name else 0) + (0.25 if fits else -0.5)
            if score > top:
                best, top = entry, score
        if top >= 1.0:
            want.append((show, item, best, round(top, 6)))
    its, feed = spark.createDataFrame(its, "show string, item int, want string, seconds int"), spark.createDataFrame(feed, "show string, entry int, have string, seconds int, pos int")
    got = sorted((r["show"], r["item"], r["entry"], round(r["score"], 6)) for r in matching.best_matches(its, feed).collect())
    assert got == sorted(want) and len(want) > 30


def test_match_title_is_the_rule_for_every_character(spark):
    signs = [chr(c) for c in (*range(32, 0xD800), *range(0xE000, 0x110000))]
    texts = ["a" + "b".join(signs[k : k + 500]) + "A" for k in range(0, len(signs), 500)] + ["Résumé!", " ﬁne ½ K ", "", None, "x" + "é" * 3]
    rule = lambda s: re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", s).lower()).strip()
    got = [r["k"] for r in spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string").select("i", text.match_title(F.col("s")).alias("k")).orderBy("i").collect()]
    bad = [(s, g) for s, g in zip(texts, got, strict=True) if g != (None if s is None else rule(s))]
    assert not bad


def test_pull_rules(spark):
    now = 1_700_000_000_000
    rows = [("a", 5), ("b", 10), ("c", 10), ("d", None), ("e", now * 1000), (None, 7), ("f", 20)]
    got = {r["sid"]: r["why"] for r in items.pull(spark.createDataFrame(rows, "id string, when_ms long"), now, (10, "b"), cap=4).collect()}
    # oldest four by time and id: a, b, c, f; untrusted ones are filed at now
    assert got == {"a": "already_pulled", "b": "already_pulled", "c": None, "d": "held_back", "e": "held_back", None: "invalid", "f": None}
    ties = {r["sid"]: r["why"] for r in items.pull(spark.createDataFrame(rows, "id string, when_ms long"), now, (10, "b"), ties_stay=True).collect()}
    assert ties["b"] is None and ties["a"] == "already_pulled" and ties["d"] is None


def test_statuses(spark):
    zero, no = F.lit(0), F.lit(False)
    status = lambda c: one(spark, c, u="")
    assert status(report.course_status(F.lit(2), F.lit(1), F.lit(1), no, no, no)) == "partial"
    assert status(report.course_status(zero, zero, zero, no, F.lit(True), no)) == "ok"
    assert status(report.sitemap_status(F.lit(2), F.lit(2), zero, F.lit(1), zero, zero, no, no)) == "partial"
    assert status(report.sitemap_status(zero, zero, zero, zero, F.lit(3), zero, no, no)) == "failed"
    assert status(report.share_status(zero, zero, zero, zero, F.lit(1), zero, zero)) == "failed"
    assert status(report.archive_status(zero, zero, no, no, zero, no, no)) == "ok"
    new = spark.createDataFrame([("t", "partial", "x")], "ticket string, status string, reason string")
    old = spark.createDataFrame([("t", "ok", None)], "ticket string, status string, reason string")
    assert tuple(report.carried(new, old).first()) == ("t", "ok", None)


def test_sources(spark, tmp_path):
    files = spark.createDataFrame([
        ("a.xml", '<urlset><url><loc>https://e.com/a?x=1&amp;y=2</loc><lastmod>2024-01-02T03:00Z</lastmod></url><url><loc>https://e.com/b</loc></url></urlset>'),
        ("i.xml", "<sitemapindex><sitemap><loc>https://e.com/s.xml</loc></sitemap></sitemapindex>"), ("j", '["https://e.com/c", {"url": "https://e.com/d", "lastmod": "2024-02-01"}]'), ("l", "﻿https://e.com/e\n\nhttps://e.com/f\n"),
    ], "file string, content string")
    got = sorted((r["file"], r["pos"], r["url"], r["lastmod"], r["child"]) for r in landed.sitemap_pages(files).collect())
    assert got == [("a.xml", 0, "https://e.com/a?x=1&y=2", "2024-01-02", False), ("a.xml", 1, "https://e.com/b", None, False), ("i.xml", 0, "https://e.com/s.xml", None, True), ("j", 0, "https://e.com/c", None, False), ("j", 1, "https://e.com/d", "2024-02-01", False), ("l", 0, "https://e.com/e", None, False), ("l", 1, "https://e.com/f", None, False)]
    pages = spark.createDataFrame([(0, '[{"id": 1, "slug": "a"}, {"id": 2}]'), (1, '[{"id": 3}]'), (2, "[]"), (3, '[{"id": 4}]')], "page int, content string")
    assert [r["id"] for r in landed.archive_posts(pages).orderBy("page", "place").collect()] == [1, 2, 3]
    cues = spark.createDataFrame([("v", "WEBVTT\n\n00:01.000 --> 00:02.000\nhi <c>there</c>\n\n00:03.000 --> 00:04.000\nyou\n")], "file string, content string")
    assert [r["text"] for r in landed.caption_cues(cues).orderBy("pos").collect()] == ["hi there", "you"]
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("ppt/slides/slide1.xml", '<p:sld xmlns:p="p" xmlns:a="a"><a:p><a:r><a:t>Hello</a:t></a:r></a:p></p:sld>')
    docs = spark.createDataFrame([(bytearray(book.getvalue()), "pptx"), (bytearray(b"no"), "xlsx")], "c binary, e string")
    assert [r[0] for r in docs.select(landed.document_text("c", "e")).collect()] == ["**Slide 1**\nHello", "(could not be read: BadZipFile)"]
    rules = spark.createDataFrame([("*", "r0"), ("a.com", "r1"), ("www.b.com", "r2")], "host string, rule string")
    hosts = spark.createDataFrame([("www.a.com",), ("b.com",), ("c.com",)], "host string")
    assert sorted(map(tuple, landed.site_rules(hosts, rules).collect())) == [("b.com", "r2"), ("c.com", "r0"), ("www.a.com", "r1")]


def test_stream_equals_batches(spark, tmp_path):
    now = 1_700_000_000_000
    schema = "id string, when_ms long, event_type string"
    parts = [[("a", 1, "x"), ("b", 2, "y")], [("b", 2, "y"), ("c", 3, "x"), ("a", 1, "x")], [("d", None, "x"), ("c", 3, "x")]]
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        pulls.pull_batch(spark.read.schema(schema).parquet(str(tmp_path / f"in/{k}")), str(tmp_path / "batch"), now)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        pulls.run_available(spark, str(tmp_path / "src"), schema, str(tmp_path / "stream"), now, str(tmp_path / "state"))
    read = lambda name: sorted(map(str, spark.read.parquet(str(tmp_path / name / "items")).select("sid", "filed_ms", "is_trusted").collect()))
    assert read("batch") == read("stream") and len(read("batch")) == 4
    assert sinks.read_cursor(spark, str(tmp_path / "stream/cursor")) == (3, "c")


def test_planner_walk_and_limits(spark):
    posts = spark.createDataFrame([(1, "u1", "2024-05-05", "everyone"), (2, "u2", None, None), (3, "u3", "2024-05-03", "everyone"), (4, "u4", "2024-01-01", "everyone"), (5, "u5", "2024-05-01", "everyone")], "pos int, url string, day string, audience string").withColumn("archive", F.lit("a"))
    got = planning.walk_archive(posts, posts.limit(0).select("url"), F.lit(""), min_date="2024-02-01", cap=9).orderBy("pos").collect()
    assert [(r["pos"], r["why"]) for r in got] == [(1, None), (2, None), (3, None), (4, "min_date")]
    got = planning.walk_archive(posts, posts.where("pos = 1").select("url"), F.lit(""), cap=1).orderBy("pos").collect()
    assert [(r["pos"], r["why"]) for r in got] == [(1, "known"), (2, None), (3, "truncated")]


def test_render(spark):
    assert one(spark, render.description_markdown(F.col("t")), t="Hi https://e.com/x\n# no\n#a #b #c #d\n\n\n\nTimestamps:\n0:00 Start\n1:02 - Next") == "> Hi <https://e.com/x>\n> \\# no\n>\n> **Timestamps**\n>\n> - `0:00` Start\n> - `1:02` Next"
