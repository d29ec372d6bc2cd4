"""Matching items to feed entries by title, with the length as a second sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text as t
from tidemill.registry import read, split


def best_matches(items: DataFrame, entries: DataFrame, tolerance: float = 150, least: float = 1.0) -> DataFrame:
    """(show, item, entry, score) of the best entry of each item (show, item, want, seconds) among the entries (show, entry, have, seconds, pos) of its show.

    want and have are titles, compared by match_title; an entry without an enclosure is not one to be given. score: the share of the item's words
    that the entry has, 0.5 if one title contains the other, and 0.25 if the lengths agree or one is not known (the item's: null or 0), else -0.5. The first by pos of the best wins, if it
    reaches least (over 0.75). Ids may repeat over shows, and an entry's within a show where pos differs; an item has one row a show. Null titles are empty and match nothing.

    An exact join of word sets, by three ways in which a pair may reach least, each with its bound on what is shared:
    without containment (least - 0.25) of the item's n words, so any n - k + 1 of them hold one, and the rarest do; with the item's title inside the
    entry's, all its words but the first and the last, so the rarest of these alone; with the entry's inside the item's, the rarest of the entry's in the same way.
    What is rare is read off one entry in 16, which changes the work and not the result."""
    words = lambda c: F.array_remove(F.array_distinct(F.split(c, " ")), "")
    key = lambda c: t.match_title(F.coalesce(c, F.lit("")))
    had = entries.select("show", "entry", key(F.col("have")).alias("have"), "pos")
    wanted = items.select("show", "item", key(F.col("want")).alias("want"), F.col("seconds").alias("want_s")).where("want <> ''")
    # words between the first and the last are whole in what contains the title; of two words at least one is shared
    inner = lambda c: F.when(F.size(F.split(c, " ")) > 2, F.array_distinct(F.slice(F.split(c, " "), F.lit(2), F.size(F.split(c, " ")) - 2))).otherwise(words(c))
    asked = wanted.select("show", "item", F.explode(words(F.col("want"))).alias("word"))
    times_asked = asked.groupBy("show", "word").agg(F.count("*").alias("asked"))
    # only what an item asks for is looked at, whatever else the entries hold
    known = had.select("show", "entry", "pos", F.explode(words(F.col("have"))).alias("word")).join(times_asked, ["show", "word"]).select("show", "entry", "pos", "word")
    few = had.where(F.pmod(F.xxhash64("show", "entry"), F.lit(16)) == 0)
    seen = few.select("show", F.explode(words(F.col("have"))).alias("word")).join(times_asked, ["show", "word"]).groupBy("show", "word").agg(F.count("*").alias("n"))
    ranked = wanted.select("show", "item", "want", "want_s", inner(F.col("want")).alias("inner"), F.explode(words(F.col("want"))).alias("word")).join(seen, ["show", "word"], "left").withColumn("inner", F.array_contains("inner", F.col("word")))
    ranked = ranked.groupBy("show", "item", "want", "want_s").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "inner"))).alias("rare"))
    size, short = F.size("rare"), F.size(F.split("want", " ")) <= 2
    shared = F.greatest(F.lit(1), F.least(size, F.ceil(size * (least - 0.25) - 1e-9).cast("int")))
    within = F.filter("rare", lambda r: r["inner"])
    picks = F.array_union(F.transform(F.slice("rare", F.lit(1), size - shared + 1), lambda r: r["word"]), F.transform(F.when(short, within).otherwise(F.slice(within, 1, 1)), lambda r: r["word"]))
    by_item = ranked.select("show", "item", F.explode(picks).alias("word")).join(known, ["show", "word"]).select("show", "item", "entry", "pos")
    # an entry inside an item's title is no longer than the longest of these, and all its inner words are asked for
    longest = wanted.groupBy("show").agg(F.max(F.char_length("want")).alias("longest"))
    # the key of a beginning is no longer than that of the whole
    begun = entries.join(longest, "show").where(F.char_length(key(F.substring("have", F.lit(1), 2 * F.col("longest")))) <= F.col("longest")).select("show", "entry", "pos", "longest", key(F.col("have")).alias("have"))
    small = begun.where(F.char_length("have") <= F.col("longest")).select("show", "entry", "pos", (F.size(F.split("have", " ")) <= 2).alias("brief"), inner(F.col("have")).alias("inner"))
    inside = small.select("show", "entry", "pos", "brief", F.size("inner").alias("words"), F.explode("inner").alias("word")).join(times_asked, ["show", "word"])
    inside = inside.groupBy("show", "entry", "pos", "brief", "words").agg(F.sort_array(F.collect_list(F.struct("asked", "word"))).alias("rare")).where(F.col("brief") | (F.size("rare") == F.col("words")))
    rarest = F.when(F.col("brief"), F.col("rare")).otherwise(F.slice("rare", 1, 1))
    by_entry = inside.select("show", "entry", "pos", F.explode(F.transform(rarest, lambda r: r["word"])).alias("word")).join(asked, ["show", "word"]).select("show", "item", "entry", "pos")
    pairs = by_item.union(by_entry).distinct()
    # each entry that is in a pair is read once more, with the items it may serve
    served = pairs.groupBy("show", "entry", "pos").agg(F.collect_list("item").alias("item"))
    again = entries.join(served, ["show", "entry", "pos"]).select("show", "entry", "pos", key(F.col("have")).alias("have"), F.col("seconds").alias("have_s"), "item")
    full = again.withColumn("had", words(F.col("have"))).withColumn("item", F.explode("item")).join(wanted, ["show", "item"])
    agree = F.col("have_s").isNull() | (F.coalesce("want_s", F.lit(0)) == 0) | (F.abs(F.col("have_s") - F.col("want_s")) <= tolerance)
    contained = F.contains("have", F.col("want")) | (F.contains("want", F.col("have")))
    overlap = F.size(F.array_intersect(words(F.col("want")), F.col("had"))) / F.size(words(F.col("want")))
    score = overlap + F.when(contained, 0.5).otherwise(0.0) + F.when(F.coalesce(agree, F.lit(True)), 0.25).otherwise(-0.5)
    best = full.withColumn("score", score).where(F.col("score") >= least).groupBy("show", "item").agg(F.max_by(F.struct("entry", "score"), F.struct("score", (-F.col("pos")).alias("first"))).alias("m"))
    return best.select("show", "item", "m.entry", "m.score")


def match_best(spark, sf_dir):
    """Benchmark items as wanted titles of two shows, whole documents as entries of one of them; items of an odd id have a length."""
    seconds = F.floor(F.char_length("text") / 15)
    bench = read(spark, sf_dir, "benchmark").select(F.explode(F.array(F.lit("even"), F.lit("odd"))).alias("show"), F.col("item_id").alias("item"), F.col("text").alias("want"), F.when(F.col("item_id") % 2 == 1, seconds).alias("seconds"))
    docs = read(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("show"), F.floor(F.col("doc_id") / 2).alias("entry"), F.col("text").alias("have"), F.when(F.col("doc_id") % 3 > 0, seconds).alias("seconds"), F.col("doc_id").alias("pos"))
    return best_matches(bench, docs).select("show", "item", "entry", F.round("score", 6).alias("score"))


def route_choice(spark, sf_dir):
    """How each page's audio would be had: matched by feed, none, protected, or not settled."""
    url = F.col("url")
    route = F.when(F.contains(url, F.lit("utm_source")), "rss").when(F.contains(url, F.lit("#")), "drm").when(F.contains(url, F.lit("page=")), "none")
    return read(spark, sf_dir, "pages").groupBy(F.coalesce(route, F.lit("unset")).alias("route")).agg(F.count("*").alias("items"), F.count_if(route == "rss").alias("audio_resolved"), F.count_if(route.isNull() | route.isin("drm", "none")).alias("drm_or_unmatched"))


TITLE_SQL = "trim(regexp_replace(translate(regexp_replace(lower(coalesce(text, '')), '([àáâãäåçèéêëìíîïñòóôõöùúûüý])', '\\1 ', 'g'), 'àáâãäåçèéêëìíîïñòóôõöùúûüý', 'aaaaaaceeeeiiiinooooouuuuy'), '[^a-z0-9]+', ' ', 'g'))"
PAIRS = {
    "match_best": (match_best, f"""WITH i AS (SELECT item_id AS item, {TITLE_SQL} AS want, CASE WHEN item_id % 2 = 1 THEN length(text) // 15 END AS want_s, unnest(['even', 'odd']) AS "show" FROM benchmark),
e AS (SELECT doc_id AS pos, doc_id // 2 AS entry, {TITLE_SQL} AS have, CASE WHEN doc_id % 3 > 0 THEN length(text) // 15 END AS have_s, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS "show" FROM documents),
iw AS (SELECT DISTINCT "show", item, unnest(string_split(want, ' ')) AS word FROM i), ew AS (SELECT DISTINCT "show", pos, unnest(string_split(have, ' ')) AS word FROM e),
n AS (SELECT "show", item, count(*) AS n_words FROM iw GROUP BY ALL),
p AS (SELECT "show", item, pos, count(*) AS common FROM iw JOIN ew USING ("show", word) WHERE word <> '' GROUP BY ALL),
s AS (SELECT "show", item, entry, pos, common / n_words + CASE WHEN contains(have, want) OR contains(want, have) THEN 0.5 ELSE 0 END
  + CASE WHEN have_s IS NULL OR coalesce(want_s, 0) = 0 OR abs(have_s - want_s) <= 150 THEN 0.25 ELSE -0.5 END AS score FROM p JOIN n USING ("show", item) JOIN i USING ("show", item) JOIN e USING ("show", pos)),
r AS (SELECT *, row_number() OVER (PARTITION BY "show", item ORDER BY score DESC, pos) AS nth FROM s)
SELECT "show", item, entry, round(score, 6) AS score FROM r WHERE nth = 1 AND score >= 1.0"""),
    "route_choice": (route_choice, """WITH r AS (SELECT CASE WHEN contains(url, 'utm_source') THEN 'rss' WHEN contains(url, '#') THEN 'drm' WHEN contains(url, 'page=') THEN 'none' END AS route FROM pages)
SELECT coalesce(route, 'unset') AS route, count(*) AS items, count(*) FILTER (route = 'rss') AS audio_resolved, count(*) FILTER (route IS NULL OR route IN ('drm', 'none')) AS drm_or_unmatched FROM r GROUP BY 1"""),
}
QUERIES, ORACLES = split(PAIRS)
