"""Ranks over a whole table without one task that sorts it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, leading: Column, order: list[Column], name: str = "rank") -> DataFrame:
    """Place of each row, from 1, in the order of ``leading`` first and ``order`` then.

    Rows are numbered within a value of ``leading``; only the counts of its values, one row each, are added up
    in one task.  ``leading`` is a prefix of the order: a unit of addresses, say, not a chapter.
    """
    rows = df.withColumn("_lead", leading)
    counts = rows.groupBy("_lead").count()
    before = counts.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    within = F.row_number().over(Window.partitionBy("_lead").orderBy(*order))
    return rows.join(before, "_lead").withColumn(name, within + F.col("_before")).drop("_lead", "_before")
