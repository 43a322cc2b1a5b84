"""Typed JSON scans and the sinks of a run."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MENTIONS = "array<struct<kind:string,evidence:string>>"
FINDING = "unit string, pos int, target string, evidence string, scope string, ref_type string, alternate string"
EDGE_INTERNAL = f"target string, alternate string, confidence string, mentions {MENTIONS}, status string"
EDGE_EXTERNAL = f"ref_type string, target string, locator string, node_label string, division_levels array<string>, citation string, href string, confidence string, mentions {MENTIONS}, status string"
DECISION = "unit string, scope string, target string, locator string, alternate string, status string, choice string, value array<string>, edit struct<document:string,section:string,ref_type:string>, by string"
USAGE = "stage string, unit string, prompt long, output long, thinking long, total long, reported boolean"
LEDGER = (
    "unit string, url string, scope string, target string, locator string, alternate string, ref_type string, node_label string, href string, citation string, division_levels array<string>, status string, validation string, "
    "parser struct<kind:string,evidence:string>, llm struct<evidence:string>, judge struct<choice:string,value:array<string>,rationale:string>, needs_review boolean"
)


def typed(c: Column, schema: str) -> Column:
    """A JSON text as a value of an explicit schema; what does not fit is null."""
    return F.from_json(c, schema)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array or JSON lines with an explicit schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    """``{unit: [finding, ...]}`` as rows with their ordinal; null scope and alternate stay null."""
    one = "array<struct<target:string,evidence:string,scope:string,ref_type:string,alternate:string>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{one}>")).alias("unit", "items"))
    return raw.select("unit", F.posexplode("items").alias("pos", "x")).select("unit", "pos", "x.*")


def read_decisions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Decision files in the order given; (file_idx, item_idx) keep their order."""
    out = None
    for i, p in enumerate(paths):
        raw = spark.read.text(p, wholetext=True).select(F.from_json("value", _array_of(DECISION)).alias("items"))
        d = raw.select(F.posexplode("items").alias("item_idx", "x")).select(F.lit(i).alias("file_idx"), "item_idx", "x.*")
        out = d if out is None else out.unionByName(d)
    return out


def _array_of(columns: str):  # noqa: ANN201
    """An array-of-struct type from a column list."""
    from pyspark.sql.types import ArrayType, StructType

    return ArrayType(StructType.fromDDL(columns))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, kind: str = "parquet") -> None:
    """Columnar or JSON-lines sink; chunks are partitioned by part, so a selection of units prunes folders."""
    w = df.write.mode("overwrite").format(kind)
    (w.partitionBy(*partition_by) if partition_by else w).save(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """K1-K7: one indented UTF-8 JSON array, written row by row on the driver: for exports, not for large tables."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, row in enumerate(df.toJSON().toLocalIterator()):
            f.write(",\n" if i else "\n")
            f.write("\n".join("  " + x for x in json.dumps(json.loads(row), indent=2, ensure_ascii=False).split("\n")))
        f.write("\n]\n")
