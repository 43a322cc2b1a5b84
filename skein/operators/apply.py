"""Decisions applied to edges: last-wins merge, drop, tag, append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.citation import norm_citation
from skein.functions.external import build_edge
from skein.functions.text import text_of
from skein.operators.reconcile import last_wins

INTERNAL, EXTERNAL = ["unit", "norm", "alternate"], ["unit", "target", "locator"]


def merge_decisions(decisions: DataFrame) -> DataFrame:
    """Q9: decisions of several files (file_idx, item_idx); the later wins for each unit, scope and key.

    Internal keys are compared in normal form, external ones as written.
    """
    scope = F.when(F.col("scope") == "external", "external").otherwise("internal")
    d = decisions.withColumn("scope", scope).withColumn("norm", F.when(scope == "external", text_of(F.col("target"))).otherwise(norm_citation(F.col("target"))))
    d = d.withColumn("qualifier", F.when(scope == "external", text_of(F.col("locator"))).otherwise(text_of(F.col("alternate"))))
    return last_wins(d, ["unit", "scope", "norm", "qualifier"], ["file_idx", "item_idx"])


def _replaced(d: DataFrame, scope: str) -> DataFrame:
    return d.where((F.col("scope") == scope) & F.col("choice").isin("reject", "manual")).select("unit", "norm", "qualifier").distinct()


def _corroborated(ledger: DataFrame, scope: str) -> DataFrame:
    """Q8."""
    internal = scope == "internal"
    key = norm_citation(F.col("target")) if internal else F.col("target")
    q = text_of(F.col("alternate") if internal else F.col("locator"))
    return ledger.where((F.col("scope") == scope) & (F.col("status") == "corroborated")).select("unit", key.alias("norm"), q.alias("qualifier")).distinct().withColumn("_hit", F.lit(True))


def tag_and_drop(edges: DataFrame, decisions: DataFrame, ledger: DataFrame, scope: str) -> DataFrame:
    """Edges without the rejected and replaced ones, each with a ``status``.

    ``edges``: unit (the row's own citation), row_alternate, pos, target, alternate or locator, and the rest.
    Rows of alternates keep all edges as parser_only.  Paragraph rows have no ledger entry, so neither a
    rejection nor a corroboration of their unit touches them.
    """
    internal = scope == "internal"
    e = edges.withColumn("norm", norm_citation(F.col("target")) if internal else F.col("target")).withColumn("qualifier", text_of(F.col("alternate") if internal else F.col("locator")))
    base = F.col("row_alternate") == ""
    gone = _replaced(decisions, scope)
    kept = e.where(base).join(gone, ["unit", "norm", "qualifier"], "left_anti").unionByName(e.where(~base))
    tagged = kept.join(_corroborated(ledger, scope), ["unit", "norm", "qualifier"], "left")
    return tagged.withColumn("status", F.when((F.col("row_alternate") == "") & F.coalesce("_hit", F.lit(False)), "corroborated").otherwise("parser_only")).drop("_hit")


def _mark(by: Column) -> tuple[Column, Column]:
    """Q13: (status, evidence) of an addition."""
    auto = F.coalesce(by == "auto", F.lit(False))
    return F.when(auto, "auto_accepted").otherwise("human_approved"), F.when(auto, "(auto-accept)").otherwise("(human review)")


def additions_internal(decisions: DataFrame, kept: DataFrame, units: DataFrame) -> DataFrame:
    """Accepted findings and manual corrections that a base unit does not have yet."""
    d = decisions.where("scope = 'internal'")
    targets = F.when(F.col("choice") == "manual", F.coalesce("value", F.expr("cast(array() as array<string>)"))).when((F.col("choice") == "accept") & F.col("status").isin("llm_only", "added"), F.array("target"))
    status, evidence = _mark(F.col("by"))
    new = d.join(units.select("unit").distinct(), "unit").select("unit", F.col("qualifier").alias("alternate"), "first_at", status.alias("status"), evidence.alias("evidence"), F.posexplode(targets).alias("at", "target"))
    new = new.withColumn("norm", norm_citation(F.col("target")))
    once = new.groupBy("unit", "norm", "alternate").agg(F.min_by(F.struct("target", "status", "evidence"), F.struct("first_at", "at")).alias("r"), F.min(F.struct("first_at", "at")).alias("added_at"))
    have = kept.where("row_alternate = ''").select("unit", "norm", F.col("qualifier").alias("alternate")).distinct()
    return once.join(have, ["unit", "norm", "alternate"], "left_anti").select(
        "unit", "r.target", "alternate", F.lit("inferred").alias("confidence"), F.array(F.struct(F.lit("inferred").alias("kind"), F.col("r.evidence").alias("evidence"))).alias("mentions"), "r.status", "added_at"
    )


def additions_external(decisions: DataFrame, kept: DataFrame, ledger: DataFrame, units: DataFrame) -> DataFrame:
    """Accepted findings through the ledger, manual ones rebuilt from what was typed."""
    about = ["ref_type", "node_label", "href", "citation", "division_levels"]
    status, evidence = _mark(F.col("by"))
    d = decisions.where("scope = 'external'").join(units.select("unit").distinct(), "unit").withColumn("_status", status).withColumn("_evidence", evidence)
    found = ledger.where("scope = 'external'").select("unit", F.col("target").alias("norm"), text_of(F.col("locator")).alias("qualifier"), *about)
    accepted = d.where("choice = 'accept' and status = 'llm_only'").join(found, ["unit", "norm", "qualifier"]).select("unit", F.col("norm").alias("target"), F.col("qualifier").alias("locator"), *about, "first_at", "_status", "_evidence")
    e = build_edge(F.col("edit.document"), F.col("edit.section"), F.col("edit.ref_type"))
    typed = d.where((F.col("choice") == "manual") & (text_of(F.col("edit.document")) != "")).select("unit", e.alias("e"), "first_at", "_status", "_evidence")
    typed = typed.select("unit", "e.target", "e.locator", "e.ref_type", "e.node_label", F.lit("").alias("href"), "e.citation", "e.division_levels", "first_at", "_status", "_evidence")
    new = accepted.unionByName(typed)
    once = new.groupBy("unit", "target", "locator").agg(F.min_by(F.struct(*about, "_status", "_evidence"), "first_at").alias("r"), F.min("first_at").alias("added_at"))
    have = kept.where("row_alternate = ''").select("unit", "target", "locator").distinct()
    return once.join(have, ["unit", "target", "locator"], "left_anti").select(
        "unit", "target", "locator", *(f"r.{c}" for c in about), F.array(F.struct(F.lit("inferred").alias("kind"), F.col("r._evidence").alias("evidence"))).alias("mentions"), F.col("r._status").alias("status"), "added_at"
    )
