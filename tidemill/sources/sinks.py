"""Sinks: whole-table commits, upserts by day, the cursor's state, quarantine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.items import upsert_by_key


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is there, on whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of a table, oldest first: a version is complete once its writer has committed it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(where)]
    return sorted(int(n[2:]) for n in names if re.fullmatch(r"v=\d+", n) and exists(spark, f"{path}/{n}/_SUCCESS"))


def replace(df: DataFrame, path: str, keep: int = 2) -> None:
    """The table as a whole, as a new version beside the old one: readers see one or the other, and a writer that dies loses neither.
    All but the last keep versions go."""
    spark = df.sparkSession
    known = _versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/v={(known[-1] if known else 0) + 1}")
    for old in known[: max(0, len(known) + 1 - keep)]:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={old}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def current(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The last complete version of a table that replace() writes; None if there is none."""
    known = _versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/v={known[-1]}") if known else None


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def upsert_days(df: DataFrame, path: str, key: str = "sid", order: str = "filed_ms") -> None:
    """Items into their day partitions, one row a key and day, the latest by order; other days are not touched."""
    spark = df.sparkSession
    df = df.withColumn("day", F.col("day").cast("string"))
    if exists(spark, path):
        # a partition that is read cannot be overwritten in place, so the days at hand are cut off from it first
        days = df.select("day").distinct()
        old = spark.read.schema(df.schema).parquet(path).withColumn("day", F.date_format(F.to_date("day"), "yyyy-MM-dd")).join(days, "day", "left_semi")
        df = upsert_by_key(old.select(df.columns), df, ["day", key], order).checkpoint()
    else:
        df = upsert_by_key(df.limit(0), df, ["day", key], order)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def upsert_pages(old: DataFrame, new: DataFrame, key: str = "title") -> DataFrame:
    """Pages by title: a new one replaces the old one whole; of new ones of a title one stays, the greatest of their rows."""
    rest = [c for c in new.columns if c != key]
    last = new.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, *(F.col("_row")[c].alias(c) for c in rest)) if rest else new.distinct()
    return old.join(last.select(key), key, "left_anti").unionByName(last)


def split_refused(captures: DataFrame, refused) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): bodies that were refused are set aside, not lost."""
    return captures.where(~F.coalesce(refused, F.lit(False))), captures.where(refused)


def write_cursor(spark: SparkSession, path: str, at: int, ident: str) -> None:
    """The cursor's only row; it is written after data and report, so that a failure repeats a pull and loses nothing."""
    replace(spark.createDataFrame([(at, ident)], "at long, ident string"), path)


def read_cursor(spark: SparkSession, path: str) -> tuple[int | None, str | None]:
    held = current(spark, path, "at long, ident string")
    row = held.first() if held is not None else None
    return (row["at"], row["ident"]) if row else (None, None)


def posted(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Addresses as a progress row carries them: commas escaped."""
    return urls.withColumn(url_col, F.replace(F.col(url_col), F.lit(","), F.lit("%2C")))
