"""How scalar operators become queries: a table, its key columns, and for each result a Spark column and its DuckDB twin."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once a context: their Python need not have it installed.

    The driver serves the archive, so that its folder need not be shared."""
    context = spark.sparkContext
    if getattr(context, "_tidemill_shipped", None) != context.applicationId:
        home = Path(__file__).resolve().parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='tidemill-')}/tidemill", "zip", home.parent, home.name))
        context._tidemill_shipped = context.applicationId


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scalar(table: str, keys: str, **columns: tuple[Callable[[], Column], str]) -> tuple[Callable, str]:
    """(query, SQL) that puts columns beside the keys of a whole table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, table).select(*keys.split(), *(make().alias(name) for name, (make, _) in columns.items()))

    shown = ", ".join([*keys.split(), *(f"{sql} AS {name}" for name, (_, sql) in columns.items())])
    return query, f"SELECT {shown} FROM {table}"


def made(table: str, key: str, values: dict[str, list[tuple[Callable[[], Column], str]]], **columns: tuple[Callable[[], Column], str]) -> tuple[Callable, str]:
    """scalar over columns that are made for it: each row takes one of the given values, in turn by its key, so that all outcomes of a rule are met."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read(spark, sf_dir, table)
        for name, shapes in values.items():
            n, out = len(shapes), shapes[-1][0]()
            for k in range(n - 2, -1, -1):
                out = F.when(F.col(key) % n == k, shapes[k][0]()).otherwise(out)
            df = df.withColumn(name, out)
        return df.select(key, *values, *(make().alias(name) for name, (make, _) in columns.items()))

    cases = ", ".join(f"CASE {key} % {len(shapes)} " + " ".join(f"WHEN {k} THEN {sql}" for k, (_, sql) in enumerate(shapes)) + f" END AS {name}" for name, shapes in values.items())
    shown = ", ".join([key, *values, *(f"{sql} AS {name}" for name, (_, sql) in columns.items())])
    return query, f"SELECT {shown} FROM (SELECT {key}, {cases} FROM {table})"


def split(pairs: dict[str, tuple[Callable, str]]) -> tuple[dict, dict]:
    """(QUERIES, ORACLES) of name -> (query, SQL)."""
    return {k: q for k, (q, _) in pairs.items()}, {k: s for k, (_, s) in pairs.items() if s}
