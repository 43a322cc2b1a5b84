"""Where queries register: a name, a function of a table reader, and its SQL twin for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
Reader = Callable[[str], DataFrame]


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function from a table reader to a DataFrame."""

    def keep(f: Callable[[Reader], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            SQL[name] = sql
        return f

    return keep


def dealt(df: DataFrame) -> DataFrame:
    """A scanned table of fewer partitions than cores is dealt out before heavy expressions; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df._jdf.rdd().getNumPartitions() < cores else df


def s(c: Column | str | int) -> Column:
    """A column or a number as text."""
    return (F.col(c) if isinstance(c, str) else F.lit(c) if isinstance(c, int) else c).cast("string")


def said(*parts: Column | str) -> Column:
    """Literals and columns as one text."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else s(x) for x in parts])
