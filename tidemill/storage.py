"""Tables whose lineage is cut, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame

from tidemill.registry import ship


def saved(df: DataFrame) -> DataFrame:
    """df, stored in spark.checkpoint.dir. Only where none is named and all of Spark is on this machine, as in tests, a temporary folder serves."""
    spark = df.sparkSession
    ship(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemill-"))
    return df.checkpoint(eager=True)
