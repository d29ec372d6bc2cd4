"""What several operators share: tables, checkpoints, and connected components."""

from __future__ import annotations

import gc
import tempfile
import time

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.registry import read as table  # noqa: F401  a table of the data folder
from tidemill.registry import ship


def folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names.

    Only where the session names none and all of Spark is on this machine, as in tests, a temporary folder serves."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemill-"))
    return named or context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    ship(df.sparkSession)
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tidied(spark: SparkSession) -> None:
    """Has Spark remove now what no table at hand needs any more: shuffles behind a checkpoint, and checkpoints where
    spark.cleaner.referenceTracking.cleanCheckpoints says so. Else they stay until the driver happens to collect its garbage, and a job's disk is their sum."""
    gc.collect()
    for wait in (1.2, 0.4):  # py4j tells the JVM once a second what Python has dropped; one collection does not reach all
        time.sleep(wait)
        spark.sparkContext._jvm.System.gc()


def may_hold(column: Column, keys: DataFrame, bits: int = 1 << 26) -> Column:
    """Whether a hash of column is among those of keys (one column): true for every value that keys hold, and for few others as long as
    keys are well under bits. It leaves rows out before they are dealt out to an exact join; its bitmap is of 8 MB whatever keys hold."""
    spark, each = keys.sparkSession, 1 << 15  # the bits of one of Spark's bitmaps
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    found = keys.select((place(F.col(keys.columns[0])) + 1).alias("h")).select(F.bitmap_bucket_number("h").alias("part"), F.bitmap_bit_position("h").alias("bit"))
    full = np.zeros((-(-bits // each), each // 8), np.uint8)
    for r in found.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("map")).collect():
        full[r["part"] - 1] = np.frombuffer(r["map"], np.uint8)
    held = spark.sparkContext.broadcast(full.ravel())

    @F.pandas_udf("boolean")
    def seen(h: pd.Series) -> pd.Series:
        h = h.to_numpy()
        return pd.Series((held.value[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1)

    return seen(place(column))


def components(edges: DataFrame, most_rounds: int = 60, rows_a_task: int = 200_000) -> DataFrame:
    """(id, root): the smallest vertex that each vertex of edges (a, b) reaches.

    Each round a vertex takes the least root next to it; then every root takes the least root that one of its
    members has met, or its own, so that paths halve, and vertices follow their roots. Rounds grow with
    the logarithm of a component's diameter; rows stay in proportion to the edges. Edges with a null
    end and loops link nothing.

    A vertex of very many edges and a root of very many vertices are each one key of a join: both sides of these joins
    are stored tables, dealt out for the join alone, which Spark splits where a key is hot. What is grouped is combined before it is dealt out."""
    both = saved(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a"))).distinct())
    # few rows make few tasks, whatever the number of shuffle partitions
    tasks = max(1, -(-both.count() // rows_a_task))
    both = both.coalesce(tasks)
    label = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("root")).coalesce(tasks))
    for _ in range(most_rounds):
        near = both.join(label.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        met = saved(label.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root")).coalesce(tasks))
        ups = met.where("root < old").select(F.col("old").alias("r"), F.col("root").alias("up")).union(met.where("root < id").select("id", "root"))
        ups = saved(ups.groupBy("r").agg(F.min("up").alias("up")).coalesce(tasks))
        new = met.join(ups, F.col("root") == F.col("r"), "left").select("id", F.coalesce("up", "root").alias("root"), (F.col("old") != F.coalesce("up", "root")).alias("moved"))
        new = saved(new.coalesce(tasks))
        label = new.select("id", "root")
        if not new.where("moved").limit(1).count():
            return label
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
