"""Reports: states of leaves counted and turned into one status with a reason.

A shortfall that another run cannot mend is ok with a reason; partial means that another run gets more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import queries as fq
from tidemill.functions import urls as u
from tidemill.plans.planning import first_reason
from tidemill.registry import read, split


def course_status(planned: Column, captured: Column, unreached: Column, gone: Column, known: Column, access: Column) -> Column:
    return first_reason([
        ("gone", gone & (captured == 0)), ("ok", (captured > 0) & (captured == planned)), ("partial", (captured > 0) & (unreached > 0)),
        ("ok", (captured > 0) | ((planned == 0) & (known | access))), ("failed", F.lit(True)),
    ])


def sitemap_status(planned: Column, captured: Column, unattempted: Column, over: Column, skipped: Column, closing: Column, failed: Column, gone: Column) -> Column:
    return first_reason([
        ("failed", failed), ("gone", gone), ("ok", (planned > 0) & (captured == planned) & (over == 0)), ("partial", (captured > 0) & ((over > 0) | (unattempted > 0))),
        ("ok", captured > 0), ("failed", planned > 0), ("ok", (skipped > 0) & (closing > 0)), ("failed", F.lit(True)),
    ])


def sitemap_report(planned: Column, captured: Column, unattempted: Column, over: Column, skipped: Column, missing: Column, said: Column, gone: Column, failed: Column, how: str, scope: str, target: str) -> Column:
    """(status, reason) of a sitemap's run. skipped: a map of reason to rows; said: the caller's reason or null.

    What another run cannot mend is named and stays ok; partial is what another run gets more of."""
    number = lambda c: c.cast("string")
    closing = F.exists(F.map_keys(skipped), lambda k: k.isin("known", "older_than_min_date", "over_limit"))
    none = F.size(skipped) == 0
    listed = F.array_join(F.transform(F.array_sort(F.map_keys(skipped)), lambda k: F.concat(k, F.lit(": "), number(F.element_at(skipped, k)))), ", ")
    left = planned + over
    state = sitemap_status(planned, captured, unattempted, over, F.size(skipped), closing.cast("int"), failed, gone)
    some = ~failed & ~gone
    short = some & (captured > 0) & ~((captured == planned) & (over == 0)) & ((over > 0) | (unattempted > 0))
    own = F.when(short, F.concat(number(captured), F.lit(" of "), number(left), F.lit(" pages captured, "), number(left - captured), F.lit(f" left for another run; {how}")))
    own = own.when(some & (planned == 0) & ~none & closing, F.concat(F.lit("nothing new in scope — "), listed))
    own = own.when(some & (planned == 0) & ~none, F.concat(F.lit(f"nothing enumerated is inside harvest.scope `{scope}` of the job's target {target} ("), listed, F.lit(") — a job rooted at a leaf, or on another host, captures nothing: point it at the section ROOT")))
    otherwise = F.when(failed, "failed").when(some & (planned > 0) & (captured == 0), F.concat(F.lit("none of "), number(planned), F.lit(" pages captured"))).when(some & (planned == 0) & none, "no pages enumerated")
    unreached = F.when(missing > 0, F.concat(number(missing), F.lit(" url(s) could not be reached")))
    reason = F.concat_ws("; ", F.coalesce(said, otherwise), own, unreached)
    return F.struct(state.alias("status"), F.nullif(reason, F.lit("")).alias("reason"))


# Why an address may be missing, and the one shape of each fact of a rendered page.
WHY = ("denied", "timeout", "auth", "error")
FACTS = {
    "stream_url": r"^https://stream[.]mux[.]com/[A-Za-z0-9]{20,}[.]m3u8$", "mux_playback_id": r"^[A-Za-z0-9]{20,}$", "fetched_at": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$",
    "player_url": r"^https://play[.]hubspotvideo[.]com/v/[0-9]+/id/[0-9]+$", "embed_url": r"^https://play[.]hubspotvideo[.]com/v/[0-9]+/id/[0-9]+([?][A-Za-z0-9._~%&=+:/,-]*)?$",
}


def missing_host(why: Column, host: Column) -> Column:
    """A missing row (host, url, why) of a host by itself; null where the reason or the host is none."""
    low = F.lower(host)
    return F.when(why.isin(*WHY) & low.rlike(u.DOTTED_HOST), F.struct(low.alias("host"), F.concat(F.lit("https://"), low, F.lit("/")).alias("url"), why.alias("why")))


def missing_url(why: Column, host: Column, url: Column) -> Column:
    """A missing row of an address, cleaned; null where reason, host or address is none."""
    low, cleaned = F.lower(host), u.clean_course(url)
    return F.when(why.isin(*WHY) & low.rlike(u.DOTTED_HOST) & cleaned.isNotNull(), F.struct(low.alias("host"), cleaned.alias("url"), why.alias("why")))


def clean_facts(facts: Column) -> Column:
    """A map of a rendered page's facts with only those values that have their one legal shape."""
    legal = lambda k, v: F.when(k == "final_url", u.safe_sitemap(v).isNotNull()).when(k == "title", True)

    def kept(k: Column, v: Column) -> Column:
        out = legal(k, v)
        for name, shape in FACTS.items():
            out = out.when(k == name, v.rlike(shape))
        return F.coalesce(out.otherwise(False), F.lit(False))

    return F.map_filter(facts, kept)


def share_status(planned: Column, captured: Column, pending: Column, known: Column, scope: Column, excluded: Column, reference: Column) -> Column:
    none = planned == 0
    return first_reason([
        ("ok", none & (known > 0)), ("failed", none & (scope > 0)), ("ok", none & ((excluded > 0) | (reference > 0))), ("failed", none), ("ok", captured == planned),
        ("partial", (captured > 0) & (pending > 0)), ("ok", captured > 0), ("failed", F.lit(True)),
    ])


def archive_status(captured: Column, unreached: Column, truncated: Column, gone: Column, leaves: Column, fetch_failed: Column, scope_only: Column) -> Column:
    return first_reason([
        ("partial", (captured > 0) & ((unreached > 0) | truncated)), ("ok", captured > 0), ("gone", gone), ("failed", leaves > 0), ("failed", fetch_failed), ("failed", scope_only), ("ok", F.lit(True)),
    ])


def entity_status(recorded: Column, truncated: Column) -> Column:
    return first_reason([("failed", ~recorded), ("partial", truncated), ("ok", F.lit(True))])


def process_status(written: Column, missing: Column, strict: bool = False) -> Column:
    """strict: nothing written and nothing missing is a failure too."""
    return first_reason([("ok", written > 0), ("failed", missing > 0), ("failed" if strict else "ok", F.lit(True))])


def write_status(failed: Column, all_invalid: Column, partial: Column, held_back: Column) -> Column:
    return first_reason([("failed", failed | all_invalid), ("partial", partial | (held_back > 0)), ("ok", F.lit(True))])


def task_ledger_status(unlined: Column, unmatched: Column) -> Column:
    return first_reason([("partial", (unlined > 0) | (unmatched > 0)), ("ok", F.lit(True))])


def page_status(supported: Column, known: Column, gone: Column, failed: Column) -> Column:
    return first_reason([("failed", ~supported), ("ok", known), ("gone", gone), ("failed", failed), ("ok", F.lit(True))])


def carried(updates: DataFrame, previous: DataFrame) -> DataFrame:
    """updates (ticket, status, reason), none below the status that its ticket reported before."""
    rank = lambda c: F.when(c == "ok", 2).when(c == "partial", 1).otherwise(0)
    old = previous.select(F.col("ticket").alias("_t"), F.col("status").alias("_s"), F.col("reason").alias("_r"))
    better = rank(F.col("_s")) > rank(F.col("status"))
    both = updates.join(old, F.col("ticket") == F.col("_t"), "left")
    return both.select("ticket", F.when(better, F.col("_s")).otherwise(F.col("status")).alias("status"), F.when(better, F.col("_r")).otherwise(F.col("reason")).alias("reason"))


# What a refusal by the proxy says, and the statuses of a session that is not let in or a page that is over.
DENIED = ("tunnel connection failed", "not in the allowlist")
AUTH_CODES, GONE_CODES = (401, 403, 407), (404, 410)


def denied(error: Column) -> Column:
    """Whether a failure is the proxy's refusal of a host, whatever status it came with."""
    return F.coalesce(F.exists(F.array(*(F.lit(m) for m in DENIED)), lambda m: F.contains(F.lower(error), m)), F.lit(False))


def why_for(error: Column, code: Column) -> Column:
    """denied, auth, timeout or error of a failed fetch. code: the answer's status; null if there was none, and then only it may have timed out."""
    late = F.coalesce(error.rlike("(?i)timed out"), F.lit(False)) & code.isNull()
    return first_reason([("denied", denied(error)), ("auth", code.isin(*AUTH_CODES)), ("timeout", late), ("error", F.lit(True))])


def why_said(said: Column) -> Column:
    """The same four words, of a failure that is known by its text alone: a timeout comes before a status."""
    status = rf"\b({'|'.join(map(str, AUTH_CODES))})\b|auth/paywall"
    return first_reason([("denied", denied(said)), ("timeout", said.rlike("(?i)timed out|timeout")), ("auth", F.lower(said).rlike(status)), ("error", F.lit(True))])


def gone_status(code: Column, refused: Column) -> Column:
    """Whether a page is over; not if the proxy made the status up."""
    return F.coalesce(code.isin(*GONE_CODES), F.lit(False)) & ~refused


def halts(why: Column, code: Column) -> Column:
    """Whether a failure ends the fetches of its host."""
    return why.isin("auth", "denied") | F.coalesce(code == 429, F.lit(False))


def first_missing(missing: DataFrame) -> DataFrame:
    """The first (by pos) row of each address, as missing rows are kept once in order."""
    return missing.groupBy("url").agg(F.min_by(F.struct("host", "why", "pos"), "pos").alias("m")).select("url", "m.host", "m.why", "m.pos")


def state_tally(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("state")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("n_over"), F.bool_and(F.col("value") > 0).alias("all_positive"))


def status_report(spark, sf_dir):
    """Sources as tickets: labelled documents are captured ones, toxic ones over the limit."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    c = docs.join(labels, "doc_id", "left").groupBy(F.col("source").alias("ticket")).agg(F.count("*").alias("planned"), F.count("quality").alias("captured"), F.count_if(F.col("quality") == 0).alias("unattempted"), F.count_if(F.col("toxic") == 1).alias("over"))
    zero, no = F.lit(0), F.lit(False)
    p, k, un, over = (F.col(x) for x in ("planned", "captured", "unattempted", "over"))
    return c.select(
        "ticket", course_status(p, k, un, no, no, no).alias("course"), sitemap_status(p, k, un, over, zero, zero, no, no).alias("sitemap"), share_status(p, k, un, zero, zero, zero, zero).alias("share"),
        archive_status(k, un, over > 3, no, p, no, no).alias("archive"), entity_status(k > 0, over > 2).alias("entity"), process_status(k, un).alias("process"), write_status(no, k == 0, no, over).alias("written"), task_ledger_status(un, zero).alias("ledger"),
    )


def failure_reasons(spark, sf_dir):
    """Every page as a fetch that failed, with a message of a venue, a proxy or a socket about the page's own host."""
    host = u.host(F.col("url"))
    said = [
        (None, "<urlopen error Tunnel connection failed: 403 Forbidden>"), (403, "HTTP Error 403: Forbidden: host {}:80 is not in the allowlist"), (404, "HTTP Error 404: host {}:80 is NOT IN THE ALLOWLIST"), (403, "HTTP Error 403: Forbidden"),
        (None, "<urlopen error [Errno 111] Connection refused>"), (None, "The read operation timed out"), (504, "HTTP Error 504: {} timed out"), (410, "HTTP Error 410: Gone"), (None, "proxy denied access to {}"), (401, "HTTP Error 401: timeout of the session at {}"),
        (None, "Auth/Paywall at {}"), (None, "error 4031 at {}"), (429, "HTTP Error 429: Too Many Requests"), (404, "HTTP Error 404: Not Found"), (None, None),
    ]
    k = F.col("page_id") % len(said)
    code, error = F.lit(None).cast("int"), F.lit(None).cast("string")
    for n, (c, text) in enumerate(said[:-1]):
        parts = [F.lit(x) for x in text.split("{}")]
        code, error = F.when(k == n, F.lit(c).cast("int")).otherwise(code), F.when(k == n, F.concat(parts[0], host, parts[1]) if len(parts) > 1 else parts[0]).otherwise(error)
    rows = read(spark, sf_dir, "pages").select("page_id", code.alias("code"), error.alias("error"))
    why = why_for(F.col("error"), F.col("code"))
    return rows.select("page_id", why.alias("why"), why_said(F.col("error")).alias("entity_why"), gone_status(F.col("code"), denied(F.col("error"))).alias("gone"), halts(why, F.col("code")).alias("halts"))


def missing_dedupe(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("url"), F.regexp_extract("url", "^https?://([^/]*)", 1).alias("host"), F.lit("error").alias("why"), F.col("page_id").alias("pos"))
    return first_missing(pages)


def sitemap_reasons(spark, sf_dir):
    """Events as runs: every combination of pages planned, captured, left and skipped."""
    k = F.col("event_id")
    pick = lambda n, by: F.floor(k / by) % n
    planned, captured, over = pick(4, 1), F.least(pick(4, 4), pick(4, 1)), pick(2, 16)
    skipped = F.map_filter(F.create_map(F.lit("known"), pick(3, 32), F.lit("scope"), pick(2, 96) * 7, F.lit("over_limit"), over), lambda _, v: v > 0)
    row = read(spark, sf_dir, "events").select("event_id", planned.alias("p"), captured.alias("c"), over.alias("o"), skipped.alias("s"), pick(2, 3).alias("m"), F.when(k % 5 == 0, "said so").alias("said"), (k % 11 == 0).alias("gone"), (k % 13 == 0).alias("failed"))
    un = F.greatest(F.lit(0), F.col("p") - F.col("c") - F.col("m"))
    got = sitemap_report(F.col("p"), F.col("c"), un, F.col("o"), F.col("s"), F.col("m"), F.col("said"), F.col("gone"), F.col("failed"), "go on", "section", "https://e.com/a")
    return row.select("event_id", got.alias("r")).select("event_id", "r.status", "r.reason")


def missing_arguments(spark, sf_dir):
    k = F.col("page_id")
    why = F.element_at(F.array(*(F.lit(x) for x in (*WHY, "because"))), (k % 5 + 1).cast("int"))
    host = F.when(k % 3 == 0, u.host(F.col("url"))).when(k % 3 == 1, F.concat(F.lit("CDN"), k.cast("string"), F.lit(".Example.com"))).otherwise("bad_host")
    url = F.when(k % 2 == 0, F.col("url")).otherwise("javascript:x")
    rows = read(spark, sf_dir, "pages").select("page_id", missing_host(why, host).alias("h"), missing_url(why, host, url).alias("a"))
    return rows.select("page_id", F.col("h.host").alias("host"), F.col("h.url").alias("host_url"), F.col("a.url").alias("url"), F.coalesce("h.why", "a.why").alias("why"))


def facts_cleaned(spark, sf_dir):
    k = F.col("page_id")
    ident = F.repeat(F.concat(F.lit("a"), (k % 10).cast("string")), (F.lit(9) + k % 3).cast("int"))
    facts = F.create_map(
        F.lit("title"), F.lit("any"), F.lit("mux_playback_id"), ident, F.lit("stream_url"), F.concat(F.lit("https://stream.mux.com/"), ident, F.lit(".m3u8")), F.lit("final_url"), F.when(k % 2 == 0, F.col("url")).otherwise("https://localhost/x"),
        F.lit("fetched_at"), F.when(k % 4 > 0, "2024-01-02T03:04:05Z").otherwise("2024-01-02"), F.lit("player_url"), F.concat(F.lit("https://play.hubspotvideo.com/v/1/id/2"), F.when(k % 5 == 0, "?x=1").otherwise("")), F.lit("embed_url"), F.lit("https://play.hubspotvideo.com/v/1/id/2?x=1"), F.lit("other"), F.lit("x"),
    )
    return read(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(F.map_keys(clean_facts(facts))), " ").alias("kept"))


SKIPS = "list_filter([CASE WHEN event_id // 32 % 3 > 0 THEN 'known: ' || event_id // 32 % 3 END, CASE WHEN o > 0 THEN 'over_limit: 1' END, CASE WHEN event_id // 96 % 2 > 0 THEN 'scope: 7' END], lambda x: x IS NOT NULL)"
PAIRS = {
    "sitemap_reasons": (sitemap_reasons, f"""WITH e AS (SELECT event_id, event_id % 4 AS p, least(event_id // 4 % 4, event_id % 4) AS c, event_id // 16 % 2 AS o, event_id // 3 % 2 AS m, event_id % 5 = 0 AS says, event_id % 11 = 0 AS gone, event_id % 13 = 0 AS failed FROM events),
r AS (SELECT *, greatest(0, p - c - m) AS un, {SKIPS} AS skips, CASE WHEN says THEN 'said so' END AS said FROM e),
k AS (SELECT *, CASE WHEN failed THEN 1 WHEN gone THEN 2 WHEN p > 0 AND c = p AND o = 0 THEN 3 WHEN c > 0 AND (o > 0 OR un > 0) THEN 4 WHEN c > 0 THEN 5 WHEN p > 0 THEN 6 WHEN len(skips) = 0 THEN 7 WHEN event_id // 32 % 3 > 0 OR o > 0 THEN 8 ELSE 9 END AS kind FROM r)
SELECT event_id, ['failed', 'gone', 'ok', 'partial', 'ok', 'failed', 'failed', 'ok', 'failed'][kind] AS status, nullif(array_to_string(list_filter([
  CASE WHEN said IS NOT NULL THEN said WHEN kind = 1 THEN 'failed' WHEN kind = 6 THEN 'none of ' || p || ' pages captured' WHEN kind = 7 THEN 'no pages enumerated' END,
  CASE kind WHEN 4 THEN c || ' of ' || (p + o) || ' pages captured, ' || (p + o - c) || ' left for another run; go on' WHEN 8 THEN 'nothing new in scope — ' || array_to_string(skips, ', ')
   WHEN 9 THEN 'nothing enumerated is inside harvest.scope `section` of the job''s target https://e.com/a (' || array_to_string(skips, ', ') || ') — a job rooted at a leaf, or on another host, captures nothing: point it at the section ROOT' END,
  CASE WHEN m > 0 THEN m || ' url(s) could not be reached' END], lambda x: x IS NOT NULL), '; '), '') AS reason FROM k"""),
    "missing_arguments": (missing_arguments, f"""WITH h AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN {fq.HOST_OF('url')} WHEN 1 THEN 'cdn' || page_id || '.example.com' END AS host, ['denied', 'timeout', 'auth', 'error', NULL][page_id % 5 + 1] AS why, {fq.COURSE} AS cleaned FROM pages),
v AS (SELECT *, host IS NOT NULL AND why IS NOT NULL AND contains(host, '.') AS ok FROM h)
SELECT page_id, CASE WHEN ok THEN host END AS host, CASE WHEN ok THEN 'https://' || host || '/' END AS host_url, CASE WHEN ok AND page_id % 2 = 0 THEN cleaned END AS url, CASE WHEN ok THEN why END AS why FROM v"""),
    "facts_cleaned": (facts_cleaned, f"""SELECT page_id, array_to_string(list_filter(['embed_url', CASE WHEN page_id % 4 > 0 THEN 'fetched_at' END, CASE WHEN page_id % 2 = 0 AND {fq.SAFE} THEN 'final_url' END, CASE WHEN page_id % 3 > 0 THEN 'mux_playback_id' END,
  CASE WHEN page_id % 5 > 0 THEN 'player_url' END, CASE WHEN page_id % 3 > 0 THEN 'stream_url' END, 'title'], lambda x: x IS NOT NULL), ' ') AS kept FROM pages"""),
    "state_tally": (state_tally, "SELECT event_type AS state, count(*) AS n, count(*) FILTER (value > 50) AS n_over, bool_and(value > 0) AS all_positive FROM events GROUP BY 1"),
    "status_report": (status_report, """WITH c AS (SELECT source AS ticket, count(*) AS p, count(quality) AS k, count(*) FILTER (quality = 0) AS un, count(*) FILTER (toxic = 1) AS over FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT ticket, CASE WHEN k > 0 AND k = p THEN 'ok' WHEN k > 0 AND un > 0 THEN 'partial' WHEN k > 0 THEN 'ok' ELSE 'failed' END AS course,
 CASE WHEN k = p AND over = 0 THEN 'ok' WHEN k > 0 AND (over > 0 OR un > 0) THEN 'partial' WHEN k > 0 THEN 'ok' ELSE 'failed' END AS sitemap,
 CASE WHEN k = p THEN 'ok' WHEN k > 0 AND un > 0 THEN 'partial' WHEN k > 0 THEN 'ok' ELSE 'failed' END AS share,
 CASE WHEN k > 0 AND (un > 0 OR over > 3) THEN 'partial' WHEN k > 0 THEN 'ok' ELSE 'failed' END AS archive, CASE WHEN k = 0 THEN 'failed' WHEN over > 2 THEN 'partial' ELSE 'ok' END AS entity,
 CASE WHEN k > 0 THEN 'ok' WHEN un > 0 THEN 'failed' ELSE 'ok' END AS process, CASE WHEN k = 0 THEN 'failed' WHEN over > 0 THEN 'partial' ELSE 'ok' END AS written, CASE WHEN un > 0 THEN 'partial' ELSE 'ok' END AS ledger FROM c"""),
    "failure_reasons": (failure_reasons, """SELECT page_id, string_split('denied denied denied auth error timeout error error error auth error error error error error', ' ')[page_id % 15 + 1] AS why,
 string_split('denied denied denied auth error timeout timeout error error timeout auth error error error error', ' ')[page_id % 15 + 1] AS entity_why, page_id % 15 IN (7, 13) AS gone, page_id % 15 IN (0, 1, 2, 3, 9, 12) AS halts FROM pages"""),
    "missing_dedupe": (missing_dedupe, "SELECT regexp_replace(url, '[?#].*$', '') AS url, arg_min(regexp_extract(url, '^https?://([^/]*)', 1), page_id) AS host, 'error' AS why, min(page_id) AS pos FROM pages GROUP BY regexp_replace(url, '[?#].*$', '')"),
}
QUERIES, ORACLES = split(PAIRS)
