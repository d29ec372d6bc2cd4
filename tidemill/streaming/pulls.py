"""Pulls as a stream: each micro-batch is a pull with the cursor of the last one.

Data goes first, then the report, then the cursor: a batch that is repeated after a failure upserts the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import times as d
from tidemill.operators import items as it
from tidemill.sources import sinks


def pull_batch(batch: DataFrame, out: str, now: int, filters=None, min_date: str | None = None) -> None:
    """One pull of batch (id, when_ms, ...) into out/items (by day of the pull), out/reports and out/cursor."""
    spark = batch.sparkSession
    at, ident = sinks.read_cursor(spark, f"{out}/cursor")
    pulled = it.pull(batch, now, (at, ident), min_date, filters=filters).persist()
    try:
        kept = pulled.where("why is null").withColumn("day", d.day_of(F.lit(now)))
        sinks.upsert_days(kept, f"{out}/items")
        counts = pulled.groupBy(F.coalesce("why", F.lit("written")).alias("why")).agg(F.count("*").alias("n"), F.count_if(~F.col("is_trusted")).alias("bad_time"))
        sinks.append(counts.withColumn("at", F.lit(now)), f"{out}/reports")
        last = it.newest(pulled).first()
        if last is not None:
            to = min(last["filed_ms"], now)
            if at is None or to >= at:
                sinks.write_cursor(spark, f"{out}/cursor", to, last["sid"])
    finally:
        pulled.unpersist()


def run_available(spark: SparkSession, source: str, schema: str, out: str, now: int, checkpoint: str, **options) -> None:
    """Pulls all files of source that no earlier run has read, a file a batch in the order they came."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.foreachBatch(lambda df, _: pull_batch(df, out, now, **options)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
