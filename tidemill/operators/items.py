"""Incremental item pulls, their cursor, verdicts and daily ledgers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import text as t
from tidemill.functions import times as d
from tidemill.plans.planning import first_reason
from tidemill.registry import read, split

DAY_MS = 86_400_000


def trusted(when: Column, now: int) -> Column:
    """Whether an item's own time is believed: there, and not over a day ahead of now."""
    return F.coalesce(when <= now + DAY_MS, F.lit(False))


def behind_mail(when: Column, ident: Column, at: int | None, at_id: str | None) -> Column:
    """Before the cursor, or the very item that it names."""
    return F.lit(False) if at is None else (when < at) | ((when == at) & (ident == F.lit(at_id)))


def behind_task(when: Column, at: int | None) -> Column:
    """Strictly before the cursor: a tie is kept."""
    return F.lit(False) if at is None else when < at


def sender_excluded(sender: Column, entries: list[str]) -> Column:
    """An address in the list, or one of an @domain of it."""
    bare = F.lower(F.coalesce(F.nullif(F.regexp_extract(sender, "<([^<>]*)>", 1), F.lit("")), sender))
    out = F.lit(False)
    for e in (x.lower() for x in entries):
        out = out | (bare == e) | (F.endswith(bare, F.lit(e)) if e.startswith("@") else F.lit(False))
    return out


def pull(items: DataFrame, now: int, cursor: tuple[int | None, str | None] = (None, None), min_date: str | None = None, cap: int = 0, filters: list[tuple[str, Column]] | None = None, held: DataFrame | None = None, ties_stay: bool = False) -> DataFrame:
    """items (id, when_ms) with sid, filed_ms, is_trusted and why (invalid, held_back, already_pulled, min_date or a filter's name).

    An item without a believable time is kept and filed at now. The cap takes the oldest by (time, id), before filters:
    with a cap one ordering over all items is needed, as a cap is over the pull; without one there is none.
    held: (filed_ms, sid) of other days, which are not pulled again."""
    sid = t.safe_id(F.col("id"))
    df = items.withColumn("sid", sid).withColumn("is_trusted", trusted(F.col("when_ms"), now)).withColumn("filed_ms", F.when(F.col("is_trusted"), F.col("when_ms")).otherwise(F.lit(now)))
    capped = F.lit(False)
    if cap:
        oldest = df.where("sid is not null").orderBy("filed_ms", "sid").limit(cap + 1)  # a top-k: each task keeps cap + 1 rows
        edge = oldest.select(F.struct("filed_ms", "sid").alias("e")).agg(F.when(F.count("*") > cap, F.max("e")).alias("edge"))
        df = df.crossJoin(F.broadcast(edge))  # one row
        capped = F.coalesce(F.struct("filed_ms", "sid") >= F.col("edge"), F.lit(False))
    behind = behind_task(F.col("when_ms"), cursor[0]) if ties_stay else behind_mail(F.col("when_ms"), F.col("sid"), *cursor)
    if held is not None:
        known = held.toDF("_ms", "_sid").distinct().withColumn("_is", F.lit(True))
        df = df.join(known, (F.col("filed_ms") == F.col("_ms")) & (F.col("sid") == F.col("_sid")), "left").drop("_ms", "_sid")
        behind = behind | F.col("_is").isNotNull()
    early = (F.col("when_ms") < int(datetime.fromisoformat(f"{min_date}T00:00:00+00:00").timestamp() * 1000)) if min_date else F.lit(False)
    why = first_reason([("invalid", F.col("sid").isNull()), ("held_back", capped), ("already_pulled", F.col("is_trusted") & behind), ("min_date", F.col("is_trusted") & early), *(filters or [])])
    return df.withColumn("why", why).drop("edge", "_is")


def newest(pulled: DataFrame) -> DataFrame:
    """(when_ms, id) to which the cursor may go: the last trusted item that was not held back, filtered ones included; no row if none."""
    able = pulled.where("is_trusted and sid is not null and coalesce(why, '') <> 'held_back'")
    return able.agg(F.max(F.struct("filed_ms", "sid")).alias("m")).where("m is not null").select("m.filed_ms", "m.sid")


def advanced(at: Column, newest_at: Column, now: int) -> Column:
    """The cursor after a pull: never beyond now, never back."""
    to = F.least(newest_at, F.lit(now))
    return F.when(at.isNull() | (to >= at), F.coalesce(to, at)).otherwise(at)


def usable_cursor(at: Column, now: int) -> Column:
    """A cursor that is unreadable or over a day ahead is none."""
    return F.when((at >= 0) & (at <= now + DAY_MS), at)


def pull_start(at: Column, now: int, lookback_days: int, min_date: Column) -> Column:
    """Where a pull begins: the cursor, or the lookback; not before min_date."""
    return F.greatest(F.coalesce(at, F.lit(now - lookback_days * DAY_MS)), F.coalesce(d.from_day(min_date), F.lit(0)))


def upsert_by_key(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: the latest by order, new before old where equal."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc(), F.col("_new").desc()))
    return both.withColumn("_at", at).where("_at = 1").drop("_at", "_new")


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """The last verdict (by pos) of each id; rows without an id name no item."""
    return verdicts.where("id is not null").groupBy("id").agg(F.max_by(F.struct("line", "junk"), "pos").alias("v")).select("id", "v.line", "v.junk")


def judged(items: DataFrame, verdicts: DataFrame) -> DataFrame:
    """items (id, subject) with discarded, unjudged and bullet (null for a discarded one)."""
    df = items.join(latest_verdicts(verdicts).withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").drop("_id")
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    line = F.when(blank("line"), F.coalesce("subject", F.lit(""))).otherwise(F.col("line"))
    head = F.when(F.trim(line) == "", F.lit("")).otherwise(F.concat(t.bullet_line(line), F.lit(" — ")))
    df = df.withColumn("discarded", ~blank("junk")).withColumn("unjudged", blank("junk") & blank("line"))
    return df.withColumn("bullet", F.when(~F.col("discarded"), F.concat(F.lit("- "), head, t.bullet_line(F.col("id")))))


def ledger(items: DataFrame, verdicts: DataFrame, day: str = "day", order: str = "order") -> DataFrame:
    """One page a day: its bullets by order, the tally of discarded items, and the counts. A page is one text, so a day's kept lines meet in one row."""
    df = judged(items, verdicts)
    bullets = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("discarded"), F.struct(F.col(order), F.col("bullet"))))), lambda x: x["bullet"]), "\n")
    counted = df.groupBy(day).agg(bullets.alias("bullets"), F.count_if(~F.col("discarded")).alias("kept"), F.count_if("discarded").alias("discarded"), F.count_if("unjudged").alias("unjudged"))
    return counted.withColumn("body", F.concat("bullets", F.lit("\n\ndiscarded: "), F.col("discarded").cast("string"), F.lit(" (junk rules)\n"))).drop("bullets")


# ------------------------------------------------------------------ queries

NOW = 1706659200000  # 31 January 2024


def events(spark, sf_dir):
    return read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("when_ms"), "event_type", "user_id")


CURSOR = (1705000000000, "77")
MS = "(epoch_us(ts) // 1000)"
PULL_SQL = f"""e AS (SELECT CAST(event_id AS VARCHAR) AS id, {MS} AS when_ms, event_type, user_id FROM events),
x AS (SELECT *, when_ms <= {NOW + DAY_MS} AS is_trusted, CASE WHEN when_ms <= {NOW + DAY_MS} THEN when_ms ELSE {NOW} END AS filed_ms FROM e),
k AS (SELECT *, row_number() OVER (ORDER BY filed_ms, id) AS nth FROM x),
w AS (SELECT id, filed_ms, is_trusted, CASE WHEN nth > 900 THEN 'held_back' WHEN is_trusted AND when_ms < {CURSOR[0]} THEN 'already_pulled'
  WHEN is_trusted AND when_ms < epoch_ms(TIMESTAMP '2024-01-15') THEN 'min_date' WHEN event_type IN ('click', 'error') THEN 'label' END AS why FROM k)"""


def _pulled(spark, sf_dir):
    return pull(events(spark, sf_dir), NOW, CURSOR, "2024-01-15", 900, [("label", F.col("event_type").isin("click", "error"))])


def incremental_pull(spark, sf_dir):
    return _pulled(spark, sf_dir).select("id", "filed_ms", "is_trusted", "why")


def incremental_skip_counts(spark, sf_dir):
    return _pulled(spark, sf_dir).groupBy(F.coalesce("why", F.lit("written")).alias("why")).agg(F.count("*").alias("n"))


def cursor_advance(spark, sf_dir):
    return newest(_pulled(spark, sf_dir)).select(advanced(F.lit(CURSOR[0]), F.col("filed_ms"), NOW).alias("at"), "sid")


def pull_starts(spark, sf_dir):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").select("event_id", pull_start(usable_cursor(at, 1704500000000), 1704500000000, 7, F.lit("2024-01-02")).alias("start_ms"))


def held_other_days(spark, sf_dir):
    items = events(spark, sf_dir)
    held = items.where("event_type = 'view'").select(F.col("when_ms"), F.col("id"))
    return pull(items, NOW, held=held).groupBy("event_type", "why").agg(F.count("*").alias("n"))


def sort_newest_limit(spark, sf_dir):
    return events(spark, sf_dir).orderBy(F.col("when_ms").desc_nulls_last(), "id").limit(25).select("id", "when_ms")


def latest_by_user(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "id", "when_ms")
    return upsert_by_key(e.limit(0), e.groupBy("user_id", "when_ms").agg(F.max("id").alias("id")), ["user_id"], "when_ms").select("user_id", "when_ms", "id")


def _documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("day"), F.col("doc_id").alias("order"), t.mail_pointer(F.col("doc_id").cast("string")).alias("id"), F.substring_index("text", "\n", 1).alias("subject"))
    labels = read(spark, sf_dir, "labels").select(t.mail_pointer(F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("pos"), F.when(F.col("quality") == 1, F.concat(F.lit("read [it] "), F.col("doc_id").cast("string"))).alias("line"), F.when(F.col("toxic") == 1, "junk").alias("junk"))
    return docs, labels


def ledger_day(spark, sf_dir):
    return ledger(*_documents(spark, sf_dir))


def ledger_counts(spark, sf_dir):
    return ledger(*_documents(spark, sf_dir)).agg(F.sum("kept").alias("kept"), F.sum("discarded").alias("discarded"), F.sum("unjudged").alias("unjudged"))


def verdict_unmatched(spark, sf_dir):
    docs, labels = _documents(spark, sf_dir)
    bench = read(spark, sf_dir, "benchmark").select(t.mail_pointer((F.col("item_id") * 100003).cast("string")).alias("id"))
    return labels.select("id").union(bench).join(docs.select("id"), "id", "left_anti").agg(F.count("*").alias("unmatched"))


def sender_filter(spark, sf_dir):
    sender = F.concat(F.lit("Name <u"), F.col("user_id").cast("string"), F.lit("@"), F.col("event_type"), F.lit(".Example.com>"))
    return events(spark, sf_dir).select("id", sender_excluded(sender, ["@click.example.com", "u7@view.example.com"]).alias("excluded"))


FIRST_LINE = "string_split(text, chr(10))[1]"


def _bullet(x: str) -> str:
    from tidemill.functions.queries import FOLD, _sql_swaps, _sub

    made = _sub(_sql_swaps(f"translate({FOLD(x)}, '`[]', '''()')", t.LINE_SWAPS), r"(?i)\bwww[.]", "www․")
    return f"(CASE WHEN length({made}) <= 200 THEN {made} ELSE left({made}, 199) || '…' END)"


LEDGER_SQL = f"""v AS (SELECT doc_id, quality = 1 AS lined, toxic = 1 AS junk FROM labels),
i AS (SELECT d.source AS day, d.doc_id, coalesce(junk, false) AS gone, coalesce(lined, false) AS lined, {FIRST_LINE} AS subject FROM documents d LEFT JOIN v USING (doc_id)),
b AS (SELECT *, CASE WHEN lined THEN {_bullet("'read [it] ' || doc_id")} || ' — ' WHEN trim(coalesce(subject, '')) = '' THEN '' ELSE {_bullet('subject')} || ' — ' END AS head FROM i),
l AS (SELECT day, coalesce(string_agg('- ' || head || {_bullet("'gmail:' || doc_id")}, chr(10) ORDER BY doc_id) FILTER (NOT gone), '') AS bullets, count(*) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS discarded, count(*) FILTER (NOT gone AND NOT lined) AS unjudged FROM b GROUP BY day)"""

PAIRS = {
    "incremental_pull": (incremental_pull, f"WITH {PULL_SQL} SELECT id, filed_ms, is_trusted, why FROM w"),
    "incremental_skip_counts": (incremental_skip_counts, f"WITH {PULL_SQL} SELECT coalesce(why, 'written') AS why, count(*) AS n FROM w GROUP BY 1"),
    "cursor_advance": (cursor_advance, f"WITH {PULL_SQL} SELECT greatest(least(filed_ms, {NOW}), {CURSOR[0]}) AS at, id AS sid FROM w WHERE is_trusted AND coalesce(why, '') <> 'held_back' ORDER BY filed_ms DESC, id DESC LIMIT 1"),
    "pull_starts": (pull_starts, f"SELECT event_id, greatest(CASE WHEN {MS} <= 1704500000000 + {DAY_MS} THEN {MS} ELSE 1704500000000 - 7 * {DAY_MS} END, epoch_ms(TIMESTAMP '2024-01-02')) AS start_ms FROM events"),
    "held_other_days": (held_other_days, f"SELECT event_type, CASE WHEN {MS} <= {NOW + DAY_MS} AND event_type = 'view' THEN 'already_pulled' END AS why, count(*) AS n FROM events GROUP BY 1, 2"),
    "sort_newest_limit": (sort_newest_limit, f"SELECT CAST(event_id AS VARCHAR) AS id, {MS} AS when_ms FROM events ORDER BY when_ms DESC NULLS LAST, id LIMIT 25"),
    "latest_by_user": (latest_by_user, f"SELECT user_id, max({MS}) AS when_ms, max(CAST(event_id AS VARCHAR)) FILTER ({MS} = m) AS id FROM events JOIN (SELECT user_id AS u, max({MS}) AS m FROM events GROUP BY 1) ON user_id = u GROUP BY user_id"),
    "ledger_day": (ledger_day, f"WITH {LEDGER_SQL} SELECT day, kept, discarded, unjudged, bullets || chr(10) || chr(10) || 'discarded: ' || discarded || ' (junk rules)' || chr(10) AS body FROM l"),
    "ledger_counts": (ledger_counts, f"WITH {LEDGER_SQL} SELECT CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(discarded) AS BIGINT) AS discarded, CAST(sum(unjudged) AS BIGINT) AS unjudged FROM l"),
    "verdict_unmatched": (verdict_unmatched, "SELECT count(*) AS unmatched FROM (SELECT doc_id FROM labels UNION ALL SELECT item_id * 100003 FROM benchmark) WHERE doc_id NOT IN (SELECT doc_id FROM documents)"),
    "sender_filter": (sender_filter, "SELECT CAST(event_id AS VARCHAR) AS id, event_type = 'click' OR (user_id = 7 AND event_type = 'view') AS excluded FROM events"),
}

QUERIES, ORACLES = split(PAIRS)
