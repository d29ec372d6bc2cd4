"""Refusals, walks and small operators against written-out results."""

import pytest
from pyspark.sql import functions as F

from tidemill.functions import html, text, urls
from tidemill.operators import matching, render
from tidemill.plans import planning
from tidemill.sources import landed, sinks


def refused(df):
    with pytest.raises(Exception):  # noqa: B017  whatever the reader raises, the job must not end well
        df.collect()


def files(spark, *contents):
    return spark.createDataFrame([(f"f{i}", c) for i, c in enumerate(contents)], "file string, content string")


def test_broken_files_are_refused(spark):
    for broken in ("[nope", "<urlset><url><loc>https://e.com/a</loc></urlset>", "<html", '[{"url": '):
        refused(landed.sitemap_pages(files(spark, broken)))
    for broken in ('{"id": 1}', "", None, "no list"):
        refused(landed.json_rows(files(spark, broken), landed.VERDICT))
    assert landed.json_rows(files(spark, "[]"), landed.VERDICT).collect() == []
    good = '{"leaves": [{"asset_id": "1", "name": "n", "path": ["p"], "view_url": "HTTPS://e.com/1"}]}'
    assert [r["view_url"] for r in landed.share_leaves(files(spark, good, '{"leaves": []}')).collect()] == ["HTTPS://e.com/1"]
    for broken in ("[]", "{}", '{"leaves": [{"name": "x"}]}', '{"leaves": [{"view_url": "ftp://x"}]}', '{"leaves": [{"view_url": "https://e.com/a b"}]}'):
        refused(landed.share_leaves(files(spark, good, broken)))


def test_safe_sitemap(spark):
    cases = {"https://e.com/a;rm$x&y!": False, "https://localhost/x": False, "https://e.com/a#b?c=d%20,+": True, "https://u@e.com:8080/": True, "https://e.com:/": True, "https://e.com:70000/": False, "https://e_.com/": False, "https://e..com/": False, "ftp://e.com/": False, "https://a-b.e.co/" + "x" * 3000: True, "": False}
    got = spark.createDataFrame([(u,) for u in cases] + [(None,)], "u string").select("u", urls.safe_sitemap(F.col("u")).alias("s")).collect()
    assert {r["u"]: r["s"] is not None and r["s"] == r["u"] for r in got if r["u"] is not None} == cases and got[-1]["s"] is None


def test_tree_walk(spark):
    cards = [("s", "s", "a", "A", True, 0), ("s", "s", "x", "leaf x", False, 1), ("s", "a", "b", "B", True, 0), ("s", "a", "y", "leaf y", False, 1), ("s", "b", "a", "again", True, 0), ("s", "b", "z", "leaf z", False, 1), ("s", "gone", "q", "lost", False, 0), ("t", "t", "w", "w", False, 0)]
    df = spark.createDataFrame(cards, "share string, parent string, id string, name string, is_folder boolean, pos int")
    rows = sorted(landed.tree_leaves(df).collect(), key=lambda r: (r["share"], r["ord"]))
    assert [(r["share"], r["id"], r["path"]) for r in rows] == [("s", "z", ["A", "B"]), ("s", "y", ["A"]), ("s", "x", []), ("t", "w", [])]
    assert sorted(r["id"] for r in landed.tree_leaves(df, most_folders=2).collect()) == ["w", "x", "y"]


def test_course_links_and_caption_pick(spark):
    page = '{"discovered_lesson_links": [{"href": "https://e.com/lessons/1", "text": "%s"}, {"href": "https://e.com/about", "text": "no"}]}' % ("t" * 90)
    assert [tuple(r) for r in landed.course_links(files(spark, page, "[]")).collect()] == [("f0", 0, "https://e.com/lessons/1", "t" * 80)]
    names = spark.createDataFrame([("v", "a.en-orig.vtt"), ("v", "b.en.vtt"), ("v", "c.de.vtt"), ("w", "x.de.vtt"), ("u", "none.txt")], "folder string, name string")
    assert sorted(map(tuple, landed.caption_pick(names, ["[.]en", "[.]de"]).collect())) == [("v", "b.en.vtt"), ("w", "x.de.vtt")]


def test_pages_are_upserted_once(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "title string, body int")
    new = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], "title string, body int")
    assert sorted(map(tuple, sinks.upsert_pages(old, new).collect())) == [("a", 1), ("b", 4), ("c", 5)]


def test_tables_are_replaced_as_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.current(spark, path, "id long") is None
    for k in range(4):
        sinks.replace(spark.range(k + 1), path)
        assert sinks.current(spark, path, "id long").count() == k + 1
    assert sorted(x.name for x in (tmp_path / "table").iterdir()) == ["v=3", "v=4"]
    (tmp_path / "table" / "v=9").mkdir()  # a writer that died
    assert sinks.current(spark, path, "id long").count() == 4


def test_rendering(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(render.guard_transcript(F.lit("# Talk [0:01]\n# no head\n- item\nplain"))) == "# Talk [0:01]\n\\# no head\n\\- item\nplain"
    chapters = F.array(F.struct(F.lit(1.0).alias("start_time"), F.lit(2.0).alias("end_time"), F.lit(" a <b>\n").alias("title")), F.struct(F.lit(None).cast("double").alias("start_time"), F.lit(2.0).alias("end_time"), F.lit("x").alias("title")))
    assert [tuple(r) for r in one(render.safe_chapters(chapters))] == [(1.0, 2.0, "a &lt;b>")]
    items = F.array(F.struct(F.lit(1).alias("n"), F.lit("a|b").alias("name"), F.lit(61000).cast("long").alias("duration_ms")))
    assert one(render.entity_page(F.lit("N"), F.lit("C"), F.lit(""), items, F.lit(True))) == "# N\n\nby C\n\n> The list is cut.\n\n| # | Title | Length |\n| --- | --- | --- |\n| 1 | a\\|b | 1:01 |"
    assert one(render.video_page(F.lit("T"), F.lit("i.png"), F.lit("e"), F.lit(""), F.lit(None).cast("string"), F.lit("said"))) == '# T\n\n![](i.png)\n\n<iframe src="e"></iframe>\n\n## Transcript\n\nsaid'
    assert one(text.video_plain(F.lit("<a> [[b]] 100%% $$ [x](javascript:1) [y](https://e.com)"))) == "&lt;a> \\[\\[b]] 100\\%\\% \\$\\$ [x]\\(javascript:1) [y](https://e.com)"


def test_outage_and_captions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    up = lambda ok, statuses, children, chars: one(html.outage(F.lit(ok), F.array(*(F.lit(s) for s in statuses)), F.lit(children), F.lit(chars)))
    assert up(True, [200, 404], 1, 0) and up(True, [200], 0, 201) and not up(True, [200, 503], 5, 900) and not up(False, [200], 1, 1) and not up(True, [200], 0, 200)
    track = lambda kind, lang, said: F.struct(F.lit(kind).alias("kind"), F.lit(lang).cast("string").alias("srclang"), F.lit("l").alias("label"), F.lit(said).cast("string").alias("text"))
    got = one(html.caption_records(F.array(track("captions", "en", "hi"), track("chapters", "en", "x"), track("subtitles", None, "yo"), track("subtitles", "de", "  "))))
    assert [(r["file"], r["text"]) for r in got] == [("en.vtt", "hi"), ("track-2.vtt", "yo")]


def test_numbers_and_limits_without_one_task(spark):
    rows = [(k * 3 % 1000, None if k % 3 else "x") for k in range(1000)]
    got = planning.numbered(spark.createDataFrame(rows, "pos int, why string"), ranges=7).collect()
    want = {p: i for i, p in enumerate(sorted(p for p, w in rows if w is None), 1)}
    assert len(got) == 1000 and all(r["order_no"] == (want[r["pos"]] if r["why"] is None else None) for r in got)
    assert planning.numbered(spark.createDataFrame([], "pos int, why string")).collect() == []


def test_matches_need_no_frequent_word(spark):
    items = spark.createDataFrame([("s", 1, "the quick brown fox", None), ("s", 2, "the the of", None), ("s", 3, "nothing alike here", None), ("s", 4, "", None)], "show string, item int, want string, seconds int")
    entries = spark.createDataFrame([("s", 10, "quick brown", 5, 1), ("s", 11, "the of", 5, 2), ("s", 12, "the quick brown fox runs", 5, 3), ("t", 13, "the quick brown fox", 5, 4)], "show string, entry int, have string, seconds int, pos int")
    assert sorted(map(tuple, matching.best_matches(items, entries).select("item", "entry", "score").collect())) == [(1, 12, 1.75), (2, 11, 1.75)]
