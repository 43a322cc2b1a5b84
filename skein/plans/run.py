"""The entry plans of a run: build a ledger from topics and findings, decide, apply, and write what a run leaves."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import first_evidence
from skein.operators import apply as ap
from skein.operators import audit, refs
from skein.operators import reconcile as rc
from skein.sources import tables, topics
from skein.sources.topics import ShredConfig, shred_topics, with_addresses


@dataclass
class Built:
    """What a run knows.  ``seen`` holds a row a chunk or skipped file and is kept in memory until ``close``."""

    seen: DataFrame
    chunks: DataFrame
    internal: DataFrame
    external: DataFrame
    addresses: DataFrame
    ledger: DataFrame

    def close(self) -> None:
        self.seen.unpersist()


def load_config(defaults: dict, file: str | None = None, env_prefix: str = "SKEIN_", overrides: dict | None = None) -> dict:
    """Precedence: defaults, then a JSON file, then the environment, then explicit overrides that are not None."""
    cfg = dict(defaults)
    if file and os.path.exists(file):
        with open(file, encoding="utf-8") as f:
            cfg |= json.load(f)
    cfg |= {k: os.environ[env_prefix + k.upper()] for k in cfg if env_prefix + k.upper() in os.environ}
    return cfg | {k: v for k, v in (overrides or {}).items() if v is not None}


def build(files: DataFrame, cfg: ShredConfig, findings: DataFrame, addresses: DataFrame | None = None, verdicts: DataFrame | None = None) -> Built:
    """Shred, extract, reconcile.  Chunks are keyed by (citation, alternate).

    ``addresses`` is a map of the whole corpus where ``files`` is a selection; ``verdicts`` are a judge's answers.
    """
    seen = with_addresses(shred_topics(files, cfg), cfg).withColumn("chunk_id", F.concat_ws("|", "citation", "alternate")).persist()
    used = seen.where("skip_reason is null")
    internal, external = refs.internal_edges(used, cfg.prefix), refs.external_edges(used)
    known = rc.address_map(used) if addresses is None else addresses
    units = rc.base_units(used).select("chunk_id", F.col("citation").alias("unit"), "url")
    ev = first_evidence(F.col("mentions")).alias("evidence")
    p_int = rc.parser_internal(internal.join(units, "chunk_id").select("unit", "pos", "target", "alternate", "confidence", ev))
    p_ext = external.join(units, "chunk_id").select("unit", "pos", "target", "locator", "ref_type", "node_label", "href", "citation", "division_levels", ev)
    own = findings.join(units.select("unit"), "unit")
    book = rc.ledger(rc.reconcile_internal(p_int, rc.finder_internal(own), known), rc.reconcile_external(p_ext, own)).join(units.select("unit", "url"), "unit", "left")
    none = F.lit(None).cast("struct<choice:string,value:array<string>,rationale:string>")
    book = book.withColumn("judge", none) if verdicts is None else rc.attach_verdicts(book, verdicts)
    return Built(seen, used, internal, external, known, book)


def verified(built: Built, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(internal edges, external edges) of all chunks after decisions, with their status."""
    d = ap.merge_decisions(decisions)
    rows = built.chunks.select("chunk_id", F.col("citation").alias("unit"), F.col("alternate").alias("row_alternate"), "type")
    units = rc.base_units(built.chunks).select(F.col("citation").alias("unit"))
    e_int = ap.tag_and_drop(built.internal.join(rows, "chunk_id"), d, built.ledger, "internal")
    e_ext = ap.tag_and_drop(built.external.join(rows, "chunk_id"), d, built.ledger, "external")
    new_int = ap.additions_internal(d, e_int, units).withColumn("row_alternate", F.lit(""))
    new_ext = ap.additions_external(d, e_ext, built.ledger, units).withColumn("row_alternate", F.lit(""))
    return e_int.unionByName(new_int, allowMissingColumns=True), e_ext.unionByName(new_ext, allowMissingColumns=True)


def cached_addresses(spark: SparkSession, files: DataFrame, cfg: ShredConfig, path: str) -> DataFrame:
    """K8: the address map of a whole corpus, made again when its files change: their number or any content."""
    whole = files.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("path", "raw")), F.lit(0)).alias("sum")).first()
    stamp = f"{path}/of={whole['n']}-{whole['sum'] & 0xFFFFFFFFFFFFFFFF:016x}"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{stamp}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        rc.address_map(shred_topics(files, cfg).where("skip_reason is null")).write.mode("overwrite").parquet(stamp)
    return spark.read.schema("address string").parquet(stamp)


def counters(ledger: DataFrame, calls: int, canned: bool = False) -> DataFrame:
    """One row: rows, rows to review, rows of each status, units, and units answered from a cache."""
    units = F.count_distinct("unit")
    counts = [F.count_if(F.col("status") == s).alias(s) for s in rc.STATUSES]
    return ledger.agg(F.count("*").alias("rows"), F.count_if("needs_review").alias("to_review"), *counts, units.alias("units"), audit.cache_hits(units, F.lit(calls), canned).alias("cache_hits"))


def applied_counters(internal: DataFrame, external: DataFrame, built: Built) -> DataFrame:
    """Edges added by decisions, and edges that decisions took away."""
    new = F.col("status").isin("auto_accepted", "human_approved").cast("int")
    flags = lambda d, added, kept, had: d.select(added.alias("added"), kept.alias("kept"), F.lit(had).alias("had"))
    parts = [flags(d, new, 1 - new, 0) for d in (internal, external)] + [flags(d, F.lit(0), F.lit(0), 1) for d in (built.internal, built.external)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.agg(total("added").alias("added"), (total("had") - total("kept")).alias("removed"))


def write_run(built: Built, out: str, changes: DataFrame | None = None, usage: DataFrame | None = None, missing: DataFrame | None = None, canned: bool = False) -> None:
    """K1-K5: the tables of a run under ``out``: chunks by part, manifest, changelog, ledger, summary and usage."""
    tables.write_table(built.chunks, f"{out}/chunks", ["part"])
    tables.write_table(topics.manifest(built.seen, missing), f"{out}/manifest", kind="json")
    tables.write_table(built.ledger, f"{out}/ledger")
    calls = 0
    if changes is not None:
        tables.write_table(changes, f"{out}/changelog", kind="json")
    if usage is not None:
        calls = usage.where("stage = 'audit'").count()
        tables.write_table(audit.usage_rollup(usage), f"{out}/usage", kind="json")
    tables.write_table(counters(built.ledger, calls, canned), f"{out}/summary", kind="json")


def write_applied(built: Built, decisions: DataFrame, out: str) -> None:
    """K6, K7: decisions as given, and the verified edges of every chunk."""
    internal, external = verified(built, decisions)
    tables.write_table(decisions, f"{out}/decisions", kind="json")
    tables.write_table(internal, f"{out}/verified_internal")
    tables.write_table(external, f"{out}/verified_external")
    tables.write_table(applied_counters(internal, external, built), f"{out}/applied", kind="json")
