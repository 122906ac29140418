"""Named queries over the given tables, each with its SQL oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table for row-heavy work: rows are dealt out by ``key`` when it is read by fewer tasks than there are cores.

    A single small file is read by one task however many cores wait. Large files are split by row group, so a large
    table is left as it is and nothing is shuffled where size already gives parallelism.
    """
    df = table(spark, sf_dir, name)
    if df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        return df.repartition(spark.sparkContext.defaultParallelism, key)
    return df


def sql_text(s: str) -> str:
    """A Python string as an SQL literal."""
    return "'" + s.replace("'", "''") + "'"
