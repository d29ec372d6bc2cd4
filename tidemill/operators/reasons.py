"""The reasons beside the statuses of course, share and archive reports: what was had, what was not, and what another run could mend.

The wording is the venues' fixed form. What names a command or a platform is the caller's, as a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import report as r
from tidemill.registry import read, split


def _said(*parts) -> Column:
    """Texts and numbers in a row; null if one is."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _first(cases: list[tuple[Column, Column | None]]) -> Column:
    out = F.lit(None).cast("string")
    for condition, text in reversed(cases):
        out = F.when(condition, F.lit(None).cast("string") if text is None else text).otherwise(out)
    return out


def _count(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def course_report(planned: Column, captured: Column, unreached: Column, missing: Column, known: Column, access: Column, gone: Column, refresh: Column, has_plan: Column, late: Column, expired: Column, unsafe: Column, min_date: Column, resume: Column, free: str, undated: str) -> Column:
    """(status, reason) of a course. known, access: whether links were dropped for these; expired: the host whose session is over, or null; resume: how another run is had;
    free, undated: what is said of access free, and of a min_date that cannot be applied. Null counts are 0."""
    over, none, all_ = gone & refresh & (captured == 0), has_plan & (planned == 0), (captured > 0) & (captured == planned)
    # without a plan nothing is known, whatever was asked for
    state = r.course_status(planned, captured, unreached, over, known & has_plan, access & has_plan)
    had = _said(captured, " of ", planned, " lessons captured")
    away = F.when(missing > 0, _said(missing, " url(s) could not be reached"))
    own = _first([
        (over, F.lit("the lesson answered 404/410")), (all_, away),
        ((captured > 0) & (unreached > 0), F.concat(had, F.lit("; "), unreached.cast("string"), F.lit(" not reached — "), F.when(late, "the slice's deadline passed; ").otherwise(""), resume)),
        (captured > 0, F.concat_ws("; ", had, away)), (none & known, F.lit("known: every lesson in scope is already held")), (none & access, F.lit(free)),
        (~has_plan, F.lit("no plan.json: the root capture did not land")), (F.lit(True), F.lit("nothing was captured")),
    ])
    named = F.concat_ws(" — ", F.concat(F.lit("auth_expired:"), expired), own)
    refused = F.when(_count(unsafe) > 0, _said(unsafe, " sidebar link(s) refused as unsafe_url (see plan.json dropped[])"))
    dated = F.when(~state.isin("gone", "failed"), F.concat(F.lit("min_date "), min_date, F.lit(f" NOT applied: {undated}")))
    return F.struct(state.alias("status"), F.nullif(F.concat_ws("; ", F.nullif(named, F.lit("")), refused, dated), F.lit("")).alias("reason"))


def share_report(planned: Column, captured: Column, missing: Column, pending: Column, known: Column, scope: Column, excluded: Column, reference: Column, asked: str, target: Column) -> Column:
    """(status, reason) of a share; asked: the scope that was asked for."""
    state, none = r.share_status(planned, captured, pending, known, scope, excluded, reference), planned == 0
    had = _said(captured, " of ", planned, " leaves captured; ", missing, " failed")
    reason = _first([
        (none & (known > 0), _said("known: all ", known, " leaves in the plan are already pages")),
        (none & (scope > 0), F.concat(F.lit(f"harvest.scope={asked} excludes all "), scope.cast("string"), F.lit(" leaves of "), target, F.lit(" — a leaf is /share/<share-id>/view/<asset-id>; set harvest.scope=domain"))),
        (none & (excluded > 0), _said("harvest.exclude_urls excludes all ", excluded, " leaves")),
        (none & (reference > 0), _said("harvest.assets=reference plans no media leaf, and all ", reference, " leaves are media")),
        (none, F.lit("the share enumerated no leaves")), (captured == planned, None), ((captured > 0) & (pending == 0), had),
        (F.lit(True), _said(had, ", ", pending, " not reached")),
    ])
    return F.struct(state.alias("status"), reason.alias("reason"))


def archive_report(leaves: Column, captured: Column, paywalled: Column, unreached: Column, halted: Column, truncated: Column, fetch_failed: Column, refresh: Column, gone: Column, auth_only: Column, skipped: Column, newsletter: Column, access: str = "free") -> Column:
    """(status, reason) of an archive. halted: the expired sessions (array of text, sorted); fetch_failed: why the walk broke off, or null; gone: what
    each leaf said (array) if all of them are over, or null; auth_only: whether something is missing, and all of it for the session; skipped: a map of reason (scope, known, paywalled, excluded) to posts."""
    how_many = lambda name: _count(F.element_at(skipped, name))
    held, paid, dropped, outside = (how_many(n) for n in ("known", "paywalled", "excluded", "scope"))
    over = refresh & gone.isNotNull() & (leaves > 0)
    short = F.concat_ws(
        "; ", F.when(captured < leaves, _said(captured, " of ", leaves, " planned posts captured")), F.when(paywalled > 0, _said(paywalled, " paywalled")), F.when(unreached > 0, _said(unreached, " not reached before the deadline")),
        F.when(F.size(halted) > 0, F.concat(F.array_join(halted, ", "), F.lit(" — fetching stopped there"))), F.when(truncated, "the archive goes on past this plan's cap; the job's next pull continues through known[]"),
        _said("the archive walk stopped early (", fetch_failed, ")"),
    )
    state = r.archive_status(captured, unreached, truncated, over, leaves, fetch_failed.isNotNull(), (outside > 0) & (held == 0))
    reason = _first([
        (captured > 0, F.nullif(short, F.lit(""))), (over, F.array_join(gone, "; ")), ((leaves > 0) & auth_only, F.concat(F.lit("auth_expired:"), newsletter)),
        (leaves > 0, F.coalesce(F.nullif(short, F.lit("")), F.lit("nothing captured"))), (fetch_failed.isNotNull(), _said("the archive would not load (", fetch_failed, ")")),
        ((outside > 0) & (held == 0), _said("harvest.scope kept none of ", outside, " posts — an archive job needs harvest.scope=domain, on the host its posts are served from")),
        (held > 0, F.concat(F.lit("known: nothing new on "), newsletter, F.lit(" ("), held.cast("string"), F.lit(" already held"), F.when(paid > 0, _said(", ", paid, " paid-tier not fetched)")).otherwise(")"))),
        (paid > 0, F.concat(F.lit("paywalled: every post in range on "), newsletter, F.lit(" is paid-tier ("), paid.cast("string"), F.lit(f") and harvest.access is {access} — nothing to capture"))),
        (dropped > 0, F.concat(F.lit("excluded: harvest.exclude_urls dropped every post in range on "), newsletter, F.lit(" ("), dropped.cast("string"), F.lit(")"))),
        (F.lit(True), F.concat(F.lit("nothing in range on "), newsletter)),
    ])
    return F.struct(state.alias("status"), reason.alias("reason"))


def _tickets(spark, sf_dir) -> DataFrame:
    """A ticket for each source and language: long documents are planned, labelled ones captured, the others missing or not reached; short ones were passed over."""
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    long, labelled, even = F.col("n_chars") > 2500, F.col("quality").isNotNull(), F.col("doc_id") % 2 == 0
    return docs.groupBy("source", "lang").agg(
        F.count_if(long).alias("planned"), F.count_if(long & labelled).alias("captured"), F.count_if(long & ~labelled & even).alias("unreached"), F.count_if(long & ~labelled & ~even).alias("missing"),
        F.count_if(~long & (F.col("toxic") == 1)).alias("known"), F.count_if(~long & (F.col("quality") == 0)).alias("scope"), F.count_if(~long & labelled).alias("excluded"), F.count_if(~long & ~labelled).alias("reference"), F.min("doc_id").alias("first"),
    )


def course_reasons(spark, sf_dir):
    c = F.col
    got = course_report(
        c("planned"), c("captured"), c("unreached"), c("missing"), c("known") > 0, c("scope") > 0, c("first") % 3 == 0, c("lang") == "en", c("first") % 7 > 0, c("first") % 2 == 0, F.when(c("first") % 5 == 0, F.concat(c("source"), F.lit(".example.com"))),
        c("excluded") % 3, F.when(c("lang") == "de", "2024-01-01"), F.concat(F.lit("ask again for "), c("source")), "access is free: nothing is open", "lessons have no date",
    )
    return _tickets(spark, sf_dir).select("source", "lang", got.alias("r")).select("source", "lang", "r.status", "r.reason")


def share_reasons(spark, sf_dir):
    c = F.col
    got = share_report(c("planned"), c("captured"), c("missing"), c("unreached"), c("known"), c("scope"), c("excluded"), c("reference"), "section", F.concat(F.lit("https://e.com/share/"), c("source")))
    return _tickets(spark, sf_dir).select("source", "lang", got.alias("r")).select("source", "lang", "r.status", "r.reason")


def archive_reasons(spark, sf_dir):
    c = F.col
    halted = F.when(c("first") % 4 == 0, F.array(F.concat(F.lit("auth_expired:"), c("source")))).otherwise(F.array().cast("array<string>"))
    gone = F.when(c("first") % 3 == 0, F.array(F.lit("404"), F.lit("410")))
    got = archive_report(
        c("planned"), c("captured"), c("missing"), c("unreached"), halted, c("first") % 6 == 1, F.when(c("first") % 9 == 2, "HTTP 500"), c("lang") == "en", gone, (c("missing") > 0) & (c("unreached") == 0),
        F.create_map(F.lit("known"), F.when(c("first") % 2 == 0, c("known")), F.lit("scope"), c("scope"), F.lit("paywalled"), c("excluded"), F.lit("excluded"), c("reference")), c("source"),
    )
    return _tickets(spark, sf_dir).select("source", "lang", got.alias("r")).select("source", "lang", "r.status", "r.reason")


T = """WITH t AS (SELECT source, lang, count(*) FILTER (n_chars > 2500) AS p, count(*) FILTER (n_chars > 2500 AND quality IS NOT NULL) AS c, count(*) FILTER (n_chars > 2500 AND quality IS NULL AND doc_id % 2 = 0) AS un,
 count(*) FILTER (n_chars > 2500 AND quality IS NULL AND doc_id % 2 = 1) AS mis, count(*) FILTER (n_chars <= 2500 AND toxic = 1) AS known, count(*) FILTER (n_chars <= 2500 AND quality = 0) AS scope,
 count(*) FILTER (n_chars <= 2500 AND quality IS NOT NULL) AS excl, count(*) FILTER (n_chars <= 2500 AND quality IS NULL) AS ref, min(doc_id) AS f FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2)"""
JOIN = lambda sep, *parts: f"nullif(array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL AND x <> ''), '{sep}'), '')"
PAIRS = {
    "course_reasons": (course_reasons, f"""{T}, k AS (SELECT *, CASE WHEN f % 3 = 0 AND lang = 'en' AND c = 0 THEN 1 WHEN c > 0 AND c = p THEN 2 WHEN c > 0 AND un > 0 THEN 3 WHEN c > 0 THEN 4 WHEN f % 7 > 0 AND p = 0 AND known > 0 THEN 5 WHEN f % 7 > 0 AND p = 0 AND scope > 0 THEN 6
  WHEN f % 7 = 0 THEN 7 ELSE 8 END AS kind FROM t),
s AS (SELECT *, ['gone', 'ok', 'partial', 'ok', 'ok', 'ok', 'failed', 'failed'][kind] AS status, CASE WHEN mis > 0 THEN mis || ' url(s) could not be reached' END AS away FROM k)
SELECT source, lang, status, {JOIN('; ', JOIN(' — ', "CASE WHEN f % 5 = 0 THEN 'auth_expired:' || source || '.example.com' END", "CASE kind WHEN 1 THEN 'the lesson answered 404/410' WHEN 2 THEN away WHEN 3 THEN c || ' of ' || p || ' lessons captured; ' || un || ' not reached — ' || CASE WHEN f % 2 = 0 THEN 'the slice' || chr(39) || 's deadline passed; ' ELSE '' END || 'ask again for ' || source WHEN 4 THEN c || ' of ' || p || ' lessons captured' || coalesce('; ' || away, '') WHEN 5 THEN 'known: every lesson in scope is already held' WHEN 6 THEN 'access is free: nothing is open' WHEN 7 THEN 'no plan.json: the root capture did not land' ELSE 'nothing was captured' END"),
  "CASE WHEN excl % 3 > 0 THEN excl % 3 || ' sidebar link(s) refused as unsafe_url (see plan.json dropped[])' END", "CASE WHEN lang = 'de' AND status NOT IN ('gone', 'failed') THEN 'min_date 2024-01-01 NOT applied: lessons have no date' END")} AS reason FROM s"""),
    "share_reasons": (share_reasons, f"""{T}, k AS (SELECT *, CASE WHEN p = 0 AND known > 0 THEN 1 WHEN p = 0 AND scope > 0 THEN 2 WHEN p = 0 AND excl > 0 THEN 3 WHEN p = 0 AND ref > 0 THEN 4 WHEN p = 0 THEN 5 WHEN c = p THEN 6 WHEN c > 0 AND un > 0 THEN 7 WHEN c > 0 THEN 8 ELSE 9 END AS kind FROM t)
SELECT source, lang, ['ok', 'failed', 'ok', 'ok', 'failed', 'ok', 'partial', 'ok', 'failed'][kind] AS status, CASE kind WHEN 1 THEN 'known: all ' || known || ' leaves in the plan are already pages'
  WHEN 2 THEN 'harvest.scope=section excludes all ' || scope || ' leaves of https://e.com/share/' || source || ' — a leaf is /share/<share-id>/view/<asset-id>; set harvest.scope=domain' WHEN 3 THEN 'harvest.exclude_urls excludes all ' || excl || ' leaves'
  WHEN 4 THEN 'harvest.assets=reference plans no media leaf, and all ' || ref || ' leaves are media' WHEN 5 THEN 'the share enumerated no leaves' WHEN 7 THEN c || ' of ' || p || ' leaves captured; ' || mis || ' failed, ' || un || ' not reached'
  WHEN 8 THEN c || ' of ' || p || ' leaves captured; ' || mis || ' failed' WHEN 9 THEN '0 of ' || p || ' leaves captured; ' || mis || ' failed, ' || un || ' not reached' END AS reason FROM k"""),
    "archive_reasons": (archive_reasons, f"""{T}, h AS (SELECT *, CASE WHEN f % 2 = 0 THEN known ELSE 0 END AS held FROM t),
k AS (SELECT *, CASE WHEN c > 0 THEN 1 WHEN lang = 'en' AND f % 3 = 0 AND p > 0 THEN 2 WHEN p > 0 AND mis > 0 AND un = 0 THEN 3 WHEN p > 0 THEN 4 WHEN f % 9 = 2 THEN 5 WHEN scope > 0 AND held = 0 THEN 6 WHEN held > 0 THEN 7 WHEN excl > 0 THEN 8 WHEN ref > 0 THEN 9 ELSE 10 END AS kind,
  {JOIN('; ', "CASE WHEN c < p THEN c || ' of ' || p || ' planned posts captured' END", "CASE WHEN mis > 0 THEN mis || ' paywalled' END", "CASE WHEN un > 0 THEN un || ' not reached before the deadline' END", "CASE WHEN f % 4 = 0 THEN 'auth_expired:' || source || ' — fetching stopped there' END",
  "CASE WHEN f % 6 = 1 THEN 'the archive goes on past this plan' || chr(39) || 's cap; the job' || chr(39) || 's next pull continues through known[]' END", "CASE WHEN f % 9 = 2 THEN 'the archive walk stopped early (HTTP 500)' END")} AS short FROM h)
SELECT source, lang, CASE WHEN kind = 1 AND (un > 0 OR f % 6 = 1) THEN 'partial' ELSE ['ok', 'gone', 'failed', 'failed', 'failed', 'failed', 'ok', 'ok', 'ok', 'ok'][kind] END AS status,
 CASE kind WHEN 1 THEN short WHEN 2 THEN '404; 410' WHEN 3 THEN 'auth_expired:' || source WHEN 4 THEN coalesce(short, 'nothing captured') WHEN 5 THEN 'the archive would not load (HTTP 500)'
  WHEN 6 THEN 'harvest.scope kept none of ' || scope || ' posts — an archive job needs harvest.scope=domain, on the host its posts are served from'
  WHEN 7 THEN 'known: nothing new on ' || source || ' (' || held || ' already held' || CASE WHEN excl > 0 THEN ', ' || excl || ' paid-tier not fetched)' ELSE ')' END
  WHEN 8 THEN 'paywalled: every post in range on ' || source || ' is paid-tier (' || excl || ') and harvest.access is free — nothing to capture'
  WHEN 9 THEN 'excluded: harvest.exclude_urls dropped every post in range on ' || source || ' (' || ref || ')' ELSE 'nothing in range on ' || source END AS reason FROM k"""),
}
QUERIES, ORACLES = split(PAIRS)
