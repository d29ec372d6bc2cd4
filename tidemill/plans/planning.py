"""Planning: every candidate is kept or gets the first reason of an ordered chain that holds for it.

A candidate table has url and pos, its place in the venue's list; the order of the tests is semantics, as it
decides the counts. Known addresses are a table, joined by the planner's own key and so
broadcast only where the optimiser finds it small.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import urls as u


def first_reason(chain: Iterable[tuple[str, Column]]) -> Column:
    """The name of the first condition that holds; null if none does. A null condition does not hold."""
    out = F.lit(None).cast("string")
    for name, condition in reversed(list(chain)):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def keep_first(df: DataFrame, key: Column, order: Column, name: str = "repeat") -> DataFrame:
    """df with whether a row repeats the key of an earlier one; rows of a null key never do, and are dealt out by their order."""
    at = F.row_number().over(Window.partitionBy(key, F.when(key.isNull(), order)).orderBy(order))
    return df.withColumn(name, key.isNotNull() & (at > 1))


def flag_known(df: DataFrame, key: Column, known: DataFrame, name: str = "known") -> DataFrame:
    """df with whether known (one column) holds the key: a semi join that keeps all rows."""
    held = known.toDF("_held").where("_held is not null").distinct().withColumn("_is", F.lit(True))
    return df.join(held, key == F.col("_held"), "left").withColumn(name, F.coalesce("_is", F.lit(False))).drop("_held", "_is")


# ------------------------------------------------------------------ scope, four rules


def scope_course(url: Column, target: Column, scope: str) -> Column:
    """page: equal keys; else equal bare hosts; section: path at or under the target's."""
    if scope == "page":
        return u.same_key(url) == u.same_key(target)
    same = u.bare_host(url) == u.bare_host(target)
    top = F.regexp_replace(u.path(target), "/+$", "")
    return same if scope == "domain" else same & ((u.path(url) == top) | F.startswith(u.path(url), F.concat(top, F.lit("/"))))


def scope_sitemap(url: Column, target: Column, scope: str) -> Column:
    """The host first for every scope (with its port); page needs the query too."""
    bare = lambda x: F.regexp_replace(u.netloc(x), "^www[.]", "")
    path = lambda x: F.regexp_replace(u.path(x), "/+$", "")
    same = bare(url) == bare(target)
    if scope == "domain":
        return same
    if scope == "section":
        return same & ((path(url) == path(target)) | F.startswith(path(url), F.concat(path(target), F.lit("/"))))
    return same & (path(url) == path(target)) & (u.query(url) == u.query(target))


def scope_share(url: Column, target: Column, scope: str) -> Column:
    """page: equal text; section: host and path; domain and anything else: the last two labels."""
    if scope == "page":
        return F.rtrim(url, F.lit("/")) == F.rtrim(target, F.lit("/"))
    if scope == "section":
        path = lambda x: F.concat(F.regexp_replace(u.path(x), "/+$", ""), F.lit("/"))
        return (u.netloc_host(url) == u.netloc_host(target)) & F.startswith(path(url), path(target))
    return F.substring_index(u.netloc_host(url), ".", -2) == F.substring_index(u.netloc_host(target), ".", -2)


def scope_archive(url: Column, target: Column, scope: str) -> Column:
    """As section of a course, but no target is every page's, and an empty path too."""
    path = F.regexp_replace(u.path(target), "/+$", "")
    same = u.bare_host(url) == u.bare_host(target)
    if scope == "page":
        inside = F.rtrim(url, F.lit("/")) == F.rtrim(target, F.lit("/"))
    elif scope == "domain":
        inside = same
    else:
        inside = same & ((path == "") | (u.path(url) == path) | F.startswith(u.path(url), F.concat(path, F.lit("/"))))
    return target.isNull() | (target == "") | inside


# ------------------------------------------------------------------ exclusion, five rules


def excluded_course(url: Column, entries: list[str]) -> Column:
    """An entry drops what it names and all under it by whole segments; scheme, www., case of the host and query aside."""
    path = F.regexp_replace(u.path(url), "/+$", "")
    out = F.lit(False)
    for entry in (e.strip() for e in entries):
        if not entry:
            continue
        if entry.startswith("/"):
            hosted, base = F.lit(True), entry.split("?")[0].split("#")[0].rstrip("/")
        else:
            rest = entry.split("://", 1)[-1].split("#")[0].split("?")[0]
            name, _, tail = rest.partition("/")
            name = name.lower().removeprefix("www.").split(":")[0]
            hosted, base = u.bare_host(url) == name, ("/" + tail).rstrip("/") if tail else ""
        out = out | (hosted & ((path == base) | F.startswith(path, F.lit(base + "/"))))
    return out


def excluded_archive(url: Column, entries: list[str]) -> Column:
    """Equal (a last / aside), a prefix that ends at a segment, or a * pattern in which ? and [ are themselves."""
    out = F.lit(False)
    for entry in filter(None, entries):
        if "*" in entry:
            out = out | url.rlike(u.glob_pattern(entry, classes=False))
        else:
            stem = entry.rstrip("/")
            out = out | (F.rtrim(url, F.lit("/")) == stem) | (F.startswith(url, F.lit(stem)) & F.substring(url, len(stem) + 1, 1).isin("/", "?", "#"))
    return out


def excluded_sitemap(url: Column, entries: list[str]) -> Column:
    """Shell patterns over the whole address."""
    out = F.lit(False)
    for entry in entries:
        out = out | url.rlike(u.glob_pattern(entry))
    return out


def excluded_share(url: Column, entries: list[str]) -> Column:
    """With a *: a shell pattern; else a plain prefix without any boundary."""
    out = F.lit(False)
    for entry in filter(None, entries):
        out = out | (url.rlike(u.glob_pattern(entry)) if "*" in entry else F.startswith(url, F.lit(entry)))
    return out


def excluded_by(name: Column, url: Column, rules: list[str]) -> Column:
    """The first rule that name or address holds, whatever the case; null if none."""
    hay = F.lower(F.concat_ws("\n", name, url))
    return F.get(F.filter(F.array(*(F.lit(r) for r in rules)), lambda r: F.contains(hay, F.lower(r))), 0)


# ------------------------------------------------------------------ the planners


def plan_course(links: DataFrame, known: DataFrame, target: Column, scope: str = "section", exclude: list[str] | None = None, lesson: str = "/", access: str = "licensed") -> DataFrame:
    """links with cleaned, why and order_no, the number of each kept one."""
    df = links.withColumn("cleaned", u.clean_course(F.col("url")))
    df = keep_first(df, u.same_key(F.col("cleaned")), F.col("pos"))
    df = flag_known(df, u.same_key(F.col("cleaned")), known)
    cleaned = F.col("cleaned")
    why = first_reason([
        ("unsafe_url", cleaned.isNull()), ("duplicate", F.col("repeat")), ("not_lesson", ~u.path(cleaned).rlike(lesson)), ("scope", ~scope_course(cleaned, target, scope)),
        ("excluded", excluded_course(cleaned, exclude or [])), ("known", F.col("known")), ("access", F.lit(access == "free")),
    ])
    return numbered(df.withColumn("why", why))


def plan_sitemap(pages: DataFrame, known: DataFrame, target: Column, scope: str = "section", exclude: list[str] | None = None, min_date: str | None = None, strip: tuple[str, ...] = (), limit: int | None = None, landed: DataFrame | None = None) -> DataFrame:
    """pages (url, pos, lastmod) with normal and why; a limit counts only what has not landed, newest first, undated last."""
    safe = u.safe_sitemap(u.normalized(u.safe_sitemap(F.trim("url")), strip))
    df = keep_first(pages.withColumn("normal", safe), F.col("normal"), F.col("pos"))
    df = flag_known(df, F.col("normal"), known)
    df = flag_known(df, F.col("normal"), landed, "landed") if landed is not None else df.withColumn("landed", F.lit(False))
    old = (F.lit(min_date) > F.col("lastmod")) if min_date else F.lit(False)
    why = first_reason([
        ("unsafe_url", F.col("normal").isNull()), ("duplicate", F.col("repeat")), ("scope", ~scope_sitemap(F.col("normal"), u.normalized(target, strip), scope)),
        ("excluded", excluded_sitemap(F.col("normal"), exclude or [])), ("older_than_min_date", old), ("known", F.col("known")),
    ])
    df = df.withColumn("why", why)
    if limit:
        fresh = F.col("why").isNull() & ~F.col("landed")
        # a top-k: each task sends limit rows at most
        first = df.where(fresh).orderBy(F.col("lastmod").desc_nulls_last(), "pos").limit(limit).select(F.col("pos").alias("_pos"))
        df = df.join(F.broadcast(first), F.col("pos") == F.col("_pos"), "left")  # limit rows
        df = df.withColumn("why", F.when(fresh & F.col("_pos").isNull(), F.lit("over_limit")).otherwise(F.col("why"))).drop("_pos")
    return df


def plan_share(leaves: DataFrame, known: DataFrame, target: Column, scope: str = "domain", exclude: list[str] | None = None, reference: bool = False, media: tuple[str, ...] = ("mp4", "mov", "mp3", "wav", "m4a", "webm")) -> DataFrame:
    """leaves (url, pos, name) with why; an address counts as seen whatever became of its first row."""
    df = keep_first(leaves, F.col("url"), F.col("pos"))
    df = flag_known(df, F.col("url"), known)
    is_media = F.lower(F.regexp_extract("name", "[.]([^.]*)$", 1)).isin(*media)
    why = first_reason([("duplicate", F.col("repeat")), ("scope", ~scope_share(F.col("url"), target, scope)), ("excluded", excluded_share(F.col("url"), exclude or [])), ("known", F.col("known")), ("reference", F.lit(reference) & is_media)])
    return numbered(df.withColumn("why", why))


def walk_archive(posts: DataFrame, known: DataFrame, target: Column, scope: str = "section", exclude: list[str] | None = None, min_date: str | None = None, max_date: str | None = None, access: str = "licensed", cap: int = 200, landed: DataFrame | None = None, by: str = "archive") -> DataFrame:
    """posts (url, pos, day, audience) up to the row that stops the walk, with why: its first below min_date or the first new one beyond the cap.

    Where an archive (column by) is left is found first: the least place of an old row, and the place of the fresh row after the cap, for which each task
    sends cap + 1 places of an archive at most. Rows behind it are dropped by a join with one row an archive, so that no archive, however long, meets in one task."""
    df = flag_known(posts, F.col("url"), known)
    df = flag_known(df, F.col("url"), landed, "landed") if landed is not None else df.withColumn("landed", F.lit(False))
    old = F.coalesce(F.lit(min_date) > F.col("day"), F.lit(False)) if min_date else F.lit(False)
    newer = F.coalesce(F.lit(max_date) < F.col("day"), F.lit(False)) if max_date else F.lit(False)
    why = first_reason([
        ("min_date", old), ("newer", newer), ("scope", ~scope_archive(F.col("url"), target, scope)), ("excluded", excluded_archive(F.col("url"), exclude or [])),
        ("paywalled", F.lit(access == "free") & (F.coalesce("audience", F.lit("unknown")) != "everyone")), ("known", F.col("known")),
    ])
    df = df.withColumn("why", why).withColumn("fresh", F.col("why").isNull() & ~F.col("landed"))
    ends = df.where("why = 'min_date'").groupBy(by).agg(F.min("pos").alias("_end"))
    first = df.where("fresh").select(by, "pos").withColumn("_nth", F.row_number().over(Window.partitionBy(by).orderBy("pos"))).where(F.col("_nth") <= cap + 1)
    full = first.where(F.col("_nth") == cap + 1).select(by, F.col("pos").alias("_end"))
    stop = ends.unionByName(full).groupBy(F.col(by).alias("_by")).agg(F.min("_end").alias("_end"))
    walked = df.join(stop, F.col(by).eqNullSafe(F.col("_by")), "left").where("_end is null or pos <= _end")
    return walked.withColumn("stops", F.coalesce(F.col("pos") == F.col("_end"), F.lit(False))).withColumn("why", F.when(F.col("fresh") & F.col("stops"), F.lit("truncated")).otherwise(F.col("why"))).drop("fresh", "_by", "_end")


def numbered(df: DataFrame, by: Column | None = None, ranges: int = 64) -> DataFrame:
    """df with order_no, the number of each kept row by pos (a number) within by.

    Without by, rows are numbered within ranges of pos, and the counts of the ranges, one row each, give where each begins."""
    kept = F.col("why").isNull()
    if by is not None:
        return df.withColumn("order_no", F.when(kept, F.row_number().over(Window.partitionBy(kept, by).orderBy("pos"))))
    cuts = df.where(kept).agg(F.percentile_approx("pos", [k / ranges for k in range(1, ranges)]).alias("_cuts"))
    dealt = df.crossJoin(F.broadcast(cuts)).withColumn("_range", F.when(kept, F.size(F.filter("_cuts", lambda c: c < F.col("pos")))).otherwise(-1)).drop("_cuts")
    counts = dealt.where("_range >= 0").groupBy("_range").agg(F.count("*").alias("_n"))
    begins = counts.select(F.col("_range").alias("_r"), (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_from"))  # a row a range
    own = Window.partitionBy("_range", F.when(~kept, F.col("pos"))).orderBy("pos")
    out = dealt.withColumn("_at", F.row_number().over(own)).join(F.broadcast(begins), F.col("_range") == F.col("_r"), "left")
    return out.withColumn("order_no", F.when(kept, (F.col("_from") + F.col("_at")).cast("int"))).drop("_range", "_r", "_from", "_at")


def single(target: Column, why: Column | None = None) -> Column:
    """The plan of one page: the row itself, known before excluded where that is asked."""
    return F.struct(target.alias("url"), (why if why is not None else F.lit(None).cast("string")).alias("why"))


def halt_after_refusal(fetches: DataFrame, host: Column, refused: Column) -> DataFrame:
    """fetches with halted: an earlier fetch (by pos) of the host was refused. The first refusal of each host is combined in the tasks and joined, one row a host."""
    df = fetches.withColumn("_host", host)
    first = df.where(refused).groupBy(F.col("_host").alias("_h")).agg(F.min("pos").alias("_first"))
    return df.join(first, F.col("_host").eqNullSafe(F.col("_h")), "left").withColumn("halted", F.coalesce(F.col("pos") > F.col("_first"), F.lit(False))).drop("_host", "_h", "_first")


def sum_before(df: DataFrame, value: Column, by: Column, name: str, order: str = "pos", piece: int = 200_000) -> DataFrame:
    """df with the sum of value over the rows before it (by order, a number without ties) within by; null counts as 0.

    A scan of two levels: keys of more than piece rows are cut at quantiles of their order, rows are summed within each piece, and the sums of the pieces, one row each,
    give what stands before them. So a hot key goes to as many tasks as it has pieces."""
    df = df.withColumn("_by", by).withColumn("_value", F.coalesce(value, F.lit(0)))
    sizes = df.groupBy(F.col("_by").alias("_b")).agg(F.count("*").alias("_n")).where(F.col("_n") > piece)  # a row for each piece rows at most
    hot = df.join(sizes, F.col("_by").eqNullSafe(F.col("_b")))
    most = 256
    cuts = hot.groupBy("_b").agg(F.percentile_approx(order, [k / most for k in range(1, most)]).alias("_cuts"))
    dealt = df.join(cuts, F.col("_by").eqNullSafe(F.col("_b")), "left").withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(order))), F.lit(0)))
    dealt = dealt.withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).otherwise(F.col("_piece"))).drop("_cuts", "_b")
    pieces = dealt.groupBy("_by", "_piece").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy("_by").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows a key at most
    begins = pieces.select(F.col("_by").alias("_b"), F.col("_piece").alias("_p"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_from"))
    own = Window.partitionBy("_by", "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_own", F.coalesce(F.sum("_value").over(own), F.lit(0)))
    return summed.join(begins, F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_piece") == F.col("_p"))).withColumn(name, F.col("_from") + F.col("_own")).drop("_by", "_value", "_piece", "_own", "_b", "_p", "_from")


def within_budget(fetches: DataFrame, cost: Column, budget: float, by: Column, piece: int = 200_000) -> DataFrame:
    """fetches with reached: the sum of costs before it (by pos) is within the budget."""
    return sum_before(fetches, cost, by, "_spent", piece=piece).withColumn("reached", F.col("_spent") <= budget).drop("_spent")
