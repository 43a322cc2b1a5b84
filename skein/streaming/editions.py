"""New editions as a stream: topic files that arrive in a folder become chunk rows once each.

An extension: the batch engine's shredder is a stateless projection, so it runs unchanged on a stream.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.topics import ShredConfig, shred_topics

_FILE = "path string, modificationTime timestamp, length long, content binary"


def stream_topics(spark: SparkSession, folder: str, cfg: ShredConfig, suffix: str = ".dita", files_per_batch: int = 1000) -> DataFrame:
    """Streaming chunk rows of topic files as they appear."""
    files = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", f"*{suffix}").option("maxFilesPerTrigger", files_per_batch).load(folder)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), re.escape(suffix) + "$", "")
    return shred_topics(files.select("path", name.alias("file"), F.col("content").cast("string").alias("raw")), cfg)


def usage_by_window(usage: DataFrame, at: str = "at", size: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Token usage by stage and time window, late rows up to ``late`` included."""
    return usage.withWatermark(at, late).groupBy(F.window(at, size), "stage").agg(F.count("*").alias("calls"), F.sum("total").alias("total"))
