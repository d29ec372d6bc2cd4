"""Attempts: the clock of a slice over its passes, deadlines, and what each leaf owes to the spawn that asks.

A pass is one run of a driver for a ticket. Passes of one spawn share the clock of the first of them, for as long as a slice may last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.report import WHY
from tidemill.plans.planning import first_reason
from tidemill.registry import read, ship, split

# Fixed values, in seconds: how long a slice may last, what is kept back of it, and when a download is stopped.
SLICE_CAP, CLAIM_MARGIN, HARD_STOP = 1800, 30, 1620


def pass_clocks(passes: DataFrame, by: str = "ticket", cap: float = SLICE_CAP) -> DataFrame:
    """passes (by, spawn, at in seconds, pos) with slice_epoch: the clock of the pass before, if that was the same spawn's and the clock is at most cap old
    and not ahead, else its own time. A pass without a spawn always begins a clock; rows with a null time have none and take no part.

    A pass that comes over cap after the one before it, or is of another spawn, begins a clock whatever came earlier: passes between two of these are an
    island, and only within an island is a clock carried from pass to pass. So a ticket's passes are sorted in one task, and no more than an island is gathered."""
    ship(passes.sparkSession)
    run = Window.partitionBy(by).orderBy("pos")
    begins = F.coalesce((F.lag("spawn").over(run) != F.col("spawn")) | (F.col("at") - F.lag("at").over(run) > cap), F.lit(True))
    cut = passes.where("at is not null").withColumn("_begins", begins).withColumn("_island", F.sum(F.col("_begins").cast("long")).over(run))
    lone = Window.partitionBy(by, "_island")
    sized = cut.withColumn("_many", F.count("*").over(lone))

    def carried(island: pa.Table) -> pa.Table:
        order = np.argsort(island["pos"].to_numpy(), kind="stable")
        at, clock = island["at"].to_numpy(), np.empty(island.num_rows)
        own = at[order[0]]
        for k in order:
            own = own if 0 <= at[k] - own <= cap else at[k]
            clock[k] = own
        return island.append_column("slice_epoch", pa.array(clock))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields) + ", slice_epoch double"
    many = sized.where("_many > 1").groupBy(by, "_island").applyInArrow(carried, schema)
    once = sized.where("_many = 1").withColumn("slice_epoch", F.col("at").cast("double"))
    return many.unionByName(once).drop("_begins", "_island", "_many")


def slice_deadline(claimed: Column, on_ticket: Column, now: Column, budget: Column) -> Column:
    """When a slice starts nothing more: its claim (now, where a ticket has none) and the budget, at most the cap, less the margin. A run without a ticket has no deadline."""
    spawned = F.when(on_ticket, F.coalesce(claimed, now))
    return spawned + F.greatest(F.lit(0), F.least(budget, F.lit(SLICE_CAP)) - CLAIM_MARGIN)


def page_deadlines(spawned: Column, minutes: Column) -> Column:
    """(deadline, hard_stop): no page is begun past the first, no download goes on past the second."""
    return F.struct((spawned + minutes * 60).alias("deadline"), (spawned + HARD_STOP).alias("hard_stop"))


def leaf_states(leaves: DataFrame, captures: DataFrame, errors: DataFrame) -> DataFrame:
    """leaves (leaf, spawn) with state, title and why: captured if a capture (leaf, title, has_body) has its body, failed if an error (leaf, spawn,
    says_spawn, why) was recorded by the leaf's own spawn, else pending: a later spawn owes each leaf a fresh attempt.

    A null spawn is a run by hand and equals another one; an error that does not say its spawn counts for none. A reason that is none of the four is error. A leaf has a capture and an error at most."""
    had = captures.where("has_body").select("leaf", "title", F.lit(True).alias("_had"))
    failed = errors.where("says_spawn").select(F.col("leaf").alias("_leaf"), F.col("spawn").alias("_spawn"), F.when(F.col("why").isin(*WHY), F.col("why")).otherwise("error").alias("_why"), F.lit(True).alias("_failed"))
    both = leaves.join(had, "leaf", "left").join(failed, (F.col("leaf") == F.col("_leaf")) & F.col("spawn").eqNullSafe(F.col("_spawn")), "left")
    state = first_reason([("captured", F.col("_had")), ("failed", F.col("_failed")), ("pending", F.lit(True))])
    return both.withColumn("state", state).withColumn("why", F.when(F.col("state") == "failed", F.col("_why"))).drop("_had", "_leaf", "_spawn", "_why", "_failed")


def slice_clocks(spark, sf_dir):
    """Events as passes of eight tickets, a worker for each two hours; every tenth pass is by hand."""
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    spawn = F.when(F.col("event_id") % 10 != 3, F.concat(F.lit("w"), F.floor(at / 7200).cast("string")))
    passes = read(spark, sf_dir, "events").select((F.col("user_id") % 8).alias("ticket"), spawn.alias("spawn"), at.alias("at"), F.col("event_id").alias("pos"))
    out = pass_clocks(passes)
    clock = F.col("slice_epoch").cast("long")
    due = slice_deadline(clock, F.col("spawn").isNotNull(), F.col("at"), F.col("pos") % 3000)
    return out.select("pos", "ticket", clock.alias("slice_epoch"), due.alias("deadline"), page_deadlines(clock, F.lit(20))["hard_stop"].alias("hard_stop"))


def attempt_states(spark, sf_dir):
    """Documents as leaves: those with a label are captured, events are errors that some spawn recorded."""
    worker = lambda c: F.when(c % 4 > 0, F.concat(F.lit("w"), (c % 4).cast("string")))
    leaves = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("leaf"), worker(F.col("doc_id")).alias("spawn"))
    captures = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("leaf"), F.col("quality").cast("string").alias("title"), (F.col("toxic") == 0).alias("has_body"))
    why = F.when(F.col("value") > 20, "timeout").when(F.col("event_type") == "click", "auth").otherwise(F.col("event_type"))
    errors = read(spark, sf_dir, "events").select(F.col("event_id").alias("leaf"), worker(F.col("user_id")).alias("spawn"), (F.col("event_id") % 3 > 0).alias("says_spawn"), why.alias("why"))
    return leaf_states(leaves, captures, errors).select("leaf", "state", "title", "why")


PAIRS = {
    "slice_clocks": (slice_clocks, """WITH RECURSIVE p AS (SELECT event_id AS pos, user_id % 8 AS ticket, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CASE WHEN event_id % 10 <> 3 THEN 'w' || CAST(floor(floor(epoch(ts)) / 7200) AS BIGINT) END AS spawn FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY ticket ORDER BY pos) AS nth FROM p),
r AS (SELECT ticket, nth, pos, spawn, sec, sec AS clock FROM n WHERE nth = 1
  UNION ALL SELECT n.ticket, n.nth, n.pos, n.spawn, n.sec, CASE WHEN n.spawn = r.spawn AND n.sec - r.clock BETWEEN 0 AND 1800 THEN r.clock ELSE n.sec END FROM r JOIN n ON n.ticket = r.ticket AND n.nth = r.nth + 1)
SELECT pos, ticket, clock AS slice_epoch, CASE WHEN spawn IS NOT NULL THEN clock + greatest(0, least(pos % 3000, 1800) - 30) END AS deadline, clock + 1620 AS hard_stop FROM r"""),
    "attempt_states": (attempt_states, """WITH s AS (SELECT doc_id AS leaf, nullif(doc_id % 4, 0) AS spawn FROM documents),
e AS (SELECT event_id AS leaf, nullif(user_id % 4, 0) AS spawn, CASE WHEN value > 20 THEN 'timeout' WHEN event_type = 'click' THEN 'auth' ELSE 'error' END AS why FROM events WHERE event_id % 3 > 0)
SELECT s.leaf, CASE WHEN l.doc_id IS NOT NULL THEN 'captured' WHEN e.leaf IS NOT NULL THEN 'failed' ELSE 'pending' END AS state, CAST(l.quality AS VARCHAR) AS title, CASE WHEN l.doc_id IS NULL THEN e.why END AS why
FROM s LEFT JOIN labels l ON l.doc_id = s.leaf AND l.toxic = 0 LEFT JOIN e ON e.leaf = s.leaf AND e.spawn IS NOT DISTINCT FROM s.spawn"""),
}
QUERIES, ORACLES = split(PAIRS)
