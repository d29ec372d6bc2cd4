"""Mixing sources to target weights by hash-threshold histograms.

A source's target is split into whole repeats of all its documents and a budget for one more copy of
some. Documents are ordered by a hash of all that they hold. The sizes are summed by source and bucket of the
hash's next bits; the bucket in which a source's running sum crosses its budget is refined by the following bits,
and only that one, until it holds a single hash. Filtering on the threshold found needs no sort of documents,
and thresholds are nested: a smaller budget takes a subset. Rows of one hash are equal in everything: of those
at a threshold as many are taken as come nearest to the budget, whichever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

WORD = r"[^\x20\x09-\x0D]+"
BITS = 12
#: Sources whose sums the driver may hold and tasks be sent; with more, targets are found and joined as tables.
MOST_SOURCES = 50_000


def targets(sizes: dict[str | None, int], cycle: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """Each source's share of all sizes, weights in turn by code point (null last), none above most times its size;
    what exceeds that is shared again by weight among the others until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    open_, left = list(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] > most * sizes[s] * total]
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            open_.remove(s)
        left -= sum(out[s] for s in above)
    return out


def _bucket(level: int) -> Column:
    """The level-th run of BITS bits of the hash, from the top (the last run is shorter)."""
    from_top = min(64, BITS * (level + 1))
    bits = BITS if from_top == BITS * (level + 1) else 64 - BITS * level
    return F.shiftrightunsigned("hash", 64 - from_top).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _planned(sums: DataFrame, cycle: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_size, target) of many sources: what targets() does, with the sources as a table."""
    spark = sums.sparkSession
    order = sums.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0]["source"], x[0]["size"], x[1]))
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    rows = spark.createDataFrame(order, f"source {dict(sums.dtypes)['source']}, size long, at long")
    rows = shared.saved(rows.select("source", "size", F.get(weights, (F.col("at") % len(cycle)).cast("int")).alias("weight"), F.lit(None).cast("double").alias("target")))
    while True:
        is_open = F.col("target").isNull()
        now = rows.agg(F.sum(F.when(is_open, F.col("weight"))).alias("weight"), (F.sum("size") - F.coalesce(F.sum("target"), F.lit(0.0))).alias("left")).first()
        share = F.lit(float(now["left"] or 0)) * F.col("weight")
        above = is_open & (share > F.lit(most) * F.col("size") * F.lit(now["weight"]))
        if not now["weight"] or not rows.where(above).limit(1).count():
            return rows.select("source", F.col("size").alias("source_size"), F.coalesce("target", share / F.lit(now["weight"] or 1.0)).alias("target"))
        rows = shared.saved(rows.withColumn("target", F.when(above, F.lit(most) * F.col("size")).otherwise(F.col("target"))))


def mix(docs: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id", cycle: tuple[float, ...] = (1, 2, 3), most: float = 3.0, most_sources: int = MOST_SOURCES) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies (0 and more).

    size null counts as 0, so a null or empty text has none. Rows that repeat an id are ordered by the rest of what they
    hold; of rows equal in everything as many are taken as the budget asks for. A source of size 0 has target 0; null is a source.
    A clash with the four new names replaces the old columns. An empty table gives no rows. A text counts whole, however long."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[source_col]
    added = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
    base = docs.withColumn("mix_size", F.coalesce(size.cast("long"), F.lit(0).cast("long")))
    held = [c for c, t in docs.dtypes if c not in (id_col, *added) and "map<" not in t and t != "variant"]  # maps have no hash
    hashed = base.drop(*added[1:]).withColumn("_mix_hash", F.xxhash64(id_col, "mix_size", F.lit(20240607), *held))
    keyed = shared.saved(hashed.select(F.col(source_col).alias("source"), F.col("mix_size").alias("size"), F.col("_mix_hash").alias("hash")))
    sums = shared.saved(keyed.groupBy("source").agg(F.sum("size").alias("size")))
    few = sums.count() <= most_sources
    side = F.broadcast if few else (lambda df: df)  # a row a source
    if few:
        sizes = {r["source"]: r["size"] for r in sums.collect()}
        goals = spark.createDataFrame([(s, sizes[s], t) for s, t in targets(sizes, cycle, most).items()], f"source {kind}, source_size long, target double")
    else:
        goals = _planned(sums, cycle, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = shared.saved(goals.withColumn("whole", whole.cast("int")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")).coalesce(1 if few else 200))
    # state of the search: the budget left inside the hash prefix fixed so far
    state = goals.where("budget > 0").select(F.col("source").alias("s"), "budget")
    inside = keyed.where("size > 0").join(side(state), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    done = None
    levels = -(-64 // BITS)
    for level in range(levels):
        histogram = inside.groupBy("source", "budget", _bucket(level).alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        run = Window.partitionBy("source").orderBy("bucket")  # 2^BITS rows a source
        summed = histogram.withColumn("before", F.coalesce(F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        crossing = shared.saved(summed.where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("size") >= F.col("budget"))))
        # a bucket of one hash is settled: so many of its rows are taken as come nearest to the budget
        nearest = F.floor((F.col("budget") - F.col("before")) / (F.col("size") / F.col("rows")) + 0.5)
        single = crossing.where("low = high").select("source", F.col("low").alias("threshold"), F.least(nearest, F.col("rows")).alias("take"), "rows")
        done = single if done is None else done.union(single)
        rest = crossing.where("low < high").select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("budget") - F.col("before")).alias("left"))
        if level + 1 == levels or not rest.limit(1).count():
            break
        inside = inside.join(side(rest), F.col("source").eqNullSafe(F.col("s")) & (_bucket(level) == F.col("b"))).select("source", "size", "hash", F.col("left").alias("budget"))
    thresholds = goals.join(done.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("_mix_s"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("whole").alias("_mix_whole"), F.col("threshold").alias("_mix_at"), F.col("take").alias("_mix_take"), F.col("rows").alias("_mix_rows")
    )
    thresholds = shared.saved(thresholds.coalesce(1 if few else 200))
    order = lambda c: F.col(c).bitwiseXOR(F.lit(-(2**63)))  # noqa: E731  hashes compare as unsigned numbers
    out = hashed.join(side(thresholds), F.col(source_col).eqNullSafe(F.col("_mix_s")))
    at = F.col("_mix_hash").eqNullSafe(F.col("_mix_at"))
    some = (F.col("_mix_take") > 0) & (F.col("_mix_take") < F.col("_mix_rows"))
    taken = F.coalesce((F.col("mix_size") > 0) & ((order("_mix_hash") < order("_mix_at")) | (at & (F.col("_mix_take") > 0))), F.lit(False))
    whole_rows = out.where(~F.coalesce(at & some, F.lit(False))).withColumn("_mix_extra", taken.cast("int"))
    if thresholds.where(some).limit(1).count():
        whole_rows = whole_rows.unionByName(_some_of(out.where(at & some)))
    return whole_rows.withColumn("mix_copies", (F.col("_mix_whole") + F.col("_mix_extra")).cast("int")).drop("_mix_hash", "_mix_s", "_mix_whole", "_mix_at", "_mix_take", "_mix_rows", "_mix_extra")


def _some_of(ties: DataFrame) -> DataFrame:
    """The rows at thresholds with _mix_extra, 1 for _mix_take of a source's. Rows are numbered within parts of the stored
    table, and the parts' counts give where each begins, so that no source's ties meet in a task."""
    ties = shared.saved(ties).withColumn("_mix_row", F.monotonically_increasing_id())
    ties = ties.withColumn("_mix_part", F.shiftright("_mix_row", 33))
    counts = ties.groupBy("_mix_s", "_mix_part").agg(F.count("*").alias("n"))
    begins = counts.select(F.col("_mix_s").alias("s"), F.col("_mix_part").alias("p"), (F.sum("n").over(Window.partitionBy("_mix_s").orderBy("_mix_part")) - F.col("n")).alias("_mix_from"))
    numbered = ties.withColumn("_mix_no", F.row_number().over(Window.partitionBy("_mix_s", "_mix_part").orderBy("_mix_row")))
    out = numbered.join(begins, F.col("_mix_s").eqNullSafe(F.col("s")) & (F.col("_mix_part") == F.col("p")))
    return out.withColumn("_mix_extra", (F.col("_mix_from") + F.col("_mix_no") <= F.col("_mix_take")).cast("int")).drop("_mix_row", "_mix_part", "_mix_from", "_mix_no", "s", "p")


def word_count(text_col: str = "text") -> Column:
    """Runs of characters other than 0x20 and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def op6_source_mixture(spark, sf_dir):
    """How many words of each document the mix takes."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    docs = shared.saved(docs)
    return mix(docs, F.col("size")).select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("size") * F.col("mix_copies")).alias("taken"))


QUERIES = {"op6_source_mixture": op6_source_mixture}
ORACLES: dict[str, str] = {}
