"""Reconciliation of two independent finders into a status-tagged ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.citation import alternate_number, grammar_ok, norm_citation, section_root, sort_key, split_alternate, strip_agency
from skein.functions.external import parse_external
from skein.functions.text import bind, text_of

#: An address map up to this many rows is broadcast; a larger one is joined by key.
BROADCAST_ADDRESSES = 1_000_000
STATUSES = ("corroborated", "parser_explicit", "parser_inferred", "llm_only")


def base_units(chunks: DataFrame) -> DataFrame:
    """units themselves, without paragraphs and alternates."""
    return chunks.where(F.col("type").isin("section", "subsection") & (F.col("alternate") == ""))


def address_map(chunks: DataFrame) -> DataFrame:
    """Bare citations and section roots, distinct."""
    bare = norm_citation(strip_agency(F.col("citation")))
    return chunks.select(F.explode(F.array_distinct(F.array(bare, section_root(bare)))).alias("address")).distinct()


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """U4: the first row of each key; a partial aggregate, not a window."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*key, "_r.*")


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, with the place of its first appearance as ``first_at``."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"), F.min(F.struct(*order)).alias("first_at"))
    return picked.select(*key, "_r.*", "first_at")


def validate(df: DataFrame, addresses: DataFrame, target: str = "target") -> DataFrame:
    """``validation`` - invalid by grammar, resolves if target or root is an address, else not_loaded."""
    small = addresses.select("address").distinct()
    if small.limit(BROADCAST_ADDRESSES + 1).count() <= BROADCAST_ADDRESSES:
        small = F.broadcast(small)
    whole = small.select(F.col("address").alias("_a"), F.lit(True).alias("_hit_a"))
    root = small.select(F.col("address").alias("_b"), F.lit(True).alias("_hit_b"))
    out = df.withColumn("_root", section_root(F.col(target)))
    out = out.join(whole, F.col(target) == F.col("_a"), "left").join(root, F.col("_root") == F.col("_b"), "left")
    kind = F.when(~grammar_ok(F.col(target)), "invalid").when(F.coalesce("_hit_a", "_hit_b", F.lit(False)), "resolves").otherwise("not_loaded")
    return out.withColumn("validation", kind).drop("_root", "_a", "_b", "_hit_a", "_hit_b")


def status_of(parser: Column, kind: Column, llm: Column) -> Column:
    """Q2."""
    return F.when(parser & llm, "corroborated").when(parser & (kind == "explicit"), "parser_explicit").when(parser, "parser_inferred").otherwise("llm_only")


def _normal(df: DataFrame, target: Column, alternate: Column, **rest: Column) -> DataFrame:
    """Rows (unit, target, alternate, ...) under the normal form of their target; empty ones and the unit itself go.

    One outer generator computes each row once: a filter on computed columns would be pushed down and compute
    them again in front of every exchange.
    """
    own = norm_citation(strip_agency(F.col("unit")))
    row = lambda x: F.struct(x["t"].alias("target"), alternate_number(alternate).alias("alternate"), *[c.alias(n) for n, c in rest.items()])
    both = F.struct(norm_citation(target).alias("t"), own.alias("own"))
    kept = bind(both, lambda x: F.when((x["t"] != "") & (x["t"] != x["own"]), F.array(row(x))))
    return df.select("unit", F.inline_outer(kept)).where("target is not null")


def parser_internal(edges: DataFrame) -> DataFrame:
    """Parser edges (unit, pos, target, alternate, confidence, evidence) under their normal form, first wins."""
    e = _normal(edges, F.col("target"), F.col("alternate"), pos=F.col("pos"), kind=F.coalesce("confidence", F.lit("inferred")), evidence=text_of(F.col("evidence")))
    return first_wins(e, ["unit", "target", "alternate"], ["pos"])


def without_self(edges: DataFrame) -> DataFrame:
    """edges (unit, target, ...) to something else than the unit itself, all columns kept."""
    return edges.where((F.col("target") != "") & (F.col("target") != norm_citation(strip_agency(F.col("unit")))))


def finder_internal(findings: DataFrame) -> DataFrame:
    """Findings (unit, pos, target, evidence, scope, alternate) that are internal, in normal form, first wins."""
    f = findings.where((text_of(F.col("scope")) != "external") & (text_of(F.col("target")) != ""))
    named = F.lower("target").contains("alternate")
    parts = split_alternate(F.col("target"))
    own = F.when(text_of(F.col("alternate")) != "", F.col("alternate")).when(named, parts["alternate"])
    e = _normal(f, F.when(named, parts["base"]).otherwise(F.col("target")), own, pos=F.col("pos"), evidence=text_of(F.col("evidence")))
    return first_wins(e, ["unit", "target", "alternate"], ["pos"])


def reconcile_internal(parser: DataFrame, finder: DataFrame, addresses: DataFrame) -> DataFrame:
    """One ledger row for each (unit, target, alternate) that either side found."""
    key = ["unit", "target", "alternate"]
    p = parser.select(*key, F.struct("kind", "evidence").alias("parser"))
    f = finder.select(*key, F.struct("evidence").alias("llm"))
    both = p.join(f, key, "full")
    status = status_of(F.col("parser").isNotNull(), F.col("parser.kind"), F.col("llm").isNotNull())
    out = both.withColumn("scope", F.lit("internal")).withColumn("status", status)
    return validate(out, addresses).withColumn("needs_review", F.col("status").isin("parser_inferred", "llm_only"))


def reconcile_external(parser: DataFrame, findings: DataFrame) -> DataFrame:
    """By (unit, target, locator); findings of no recognised form are dropped."""
    key = ["unit", "target", "locator"]
    about = ["ref_type", "node_label", "href", "citation", "division_levels"]
    p = first_wins(parser.select(*key, *about, "pos", text_of(F.col("evidence")).alias("evidence")), key, ["pos"]).select(*key, F.struct(*about).alias("_p"), F.struct(F.lit("explicit").alias("kind"), "evidence").alias("parser"))
    f = findings.where((F.col("scope") == "external") & (text_of(F.col("target")) != ""))
    known = bind(parse_external(F.col("target")), lambda r: F.when(r.isNotNull(), F.array(r)))  # an outer generator: parsed once
    f = f.select("unit", "pos", text_of(F.col("evidence")).alias("evidence"), F.inline_outer(known)).where("target is not null").withColumn("href", F.lit(""))
    f = first_wins(f, key, ["pos"]).select(*key, F.struct(*about).alias("_f"), F.struct("evidence").alias("llm"))
    both = p.join(f, key, "full").withColumn("_s", F.coalesce("_p", "_f"))
    status = F.when(F.col("parser").isNotNull() & F.col("llm").isNotNull(), "corroborated").when(F.col("parser").isNotNull(), "parser_explicit").otherwise("llm_only")
    return both.select(*key, *(F.col(f"_s.{c}").alias(c) for c in about), "parser", "llm", F.lit("external").alias("scope"), status.alias("status"), F.lit("external").alias("validation"), (status == "llm_only").alias("needs_review"))


def ledger(internal: DataFrame, external: DataFrame) -> DataFrame:
    """One wide table of both scopes."""
    return internal.unionByName(external, allowMissingColumns=True)


def findings_of(units: DataFrame, findings: DataFrame) -> DataFrame:
    """Every unit with its findings, or with none."""
    return units.join(findings, "unit", "left")


def ledger_order(ledger_: DataFrame) -> list[Column]:
    """Units in natural order; in a unit internal rows by natural order and alternate, then external ones as text."""
    inside = F.col("scope") == "internal"
    unit = sort_key(strip_agency(F.col("unit")))
    return [unit, "unit", F.when(inside, 0).otherwise(1), F.when(inside, sort_key(F.col("target"))), F.when(inside, text_of(F.col("alternate"))), "target", text_of(F.col("locator"))]


def overlap(parser: DataFrame, finder: DataFrame, key: list[str]) -> dict[str, DataFrame]:
    """Keys of both finders, of the parser alone, of the other alone, as set operations."""
    p, f = parser.select(*key), finder.select(*key)
    return {"corroborated": p.intersect(f), "parser_only": p.subtract(f), "llm_only": f.subtract(p)}


def attach_verdicts(ledger_: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The judge's choice, value and rationale on the internal rows that it was asked about; null elsewhere.

    ``verdicts``: unit, target, alternate, choice, value, rationale, one a key.
    """
    v = verdicts.select("unit", "target", "alternate", F.struct("choice", F.coalesce("value", F.expr("cast(array() as array<string>)")).alias("value"), text_of(F.col("rationale")).alias("rationale")).alias("_v"))
    asked = F.col("needs_review") & (F.col("scope") == "internal")
    return ledger_.drop("judge").join(v, ["unit", "target", "alternate"], "left").withColumn("judge", F.when(asked, F.col("_v"))).drop("_v")


def page_rows(ledger_: DataFrame, statuses: list[str], scopes: list[str]) -> DataFrame:
    """what a review page shows: rows of the chosen statuses and scopes, a missing scope being internal."""
    return ledger_.where(F.col("status").isin(statuses) & F.coalesce("scope", F.lit("internal")).isin(scopes))


def unit_status_counts(ledger_: DataFrame) -> DataFrame:
    """Rows and rows to review of each unit and status."""
    return ledger_.groupBy("unit", "status").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("to_review"))


def status_counts(ledger_: DataFrame) -> DataFrame:
    """A2: the four counters, zeros included."""
    return ledger_.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def judge_jobs(ledger_: DataFrame) -> DataFrame:
    """Q14, A10: disagreements of each unit, internal only, evidence cut at 300 characters."""
    source = F.when(F.col("status") == "parser_inferred", "parser").otherwise("llm")
    ev = F.substring(F.coalesce("parser.evidence", "llm.evidence", F.lit("")), 1, 300)
    return ledger_.where("needs_review and scope = 'internal'").groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("target", "alternate", source.alias("source"), ev.alias("evidence")))).alias("items"))


def auto_decisions(ledger_: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """Q6: decisions without a reviewer: a judge's verdict where there is one, else the union of finders.

    ``verdicts``: unit, target, alternate, choice, value.  An unjudged parser_inferred row needs no decision.
    """
    key = ["unit", "target", "alternate"]
    open_ = ledger_.where("needs_review")
    if verdicts is None:
        v = open_.withColumn("choice", F.lit(None).cast("string")).withColumn("value", F.lit(None).cast("array<string>"))
    else:
        j = verdicts.select(*key, "choice", "value")
        v = open_.join(j.withColumn("scope", F.lit("internal")), [*key, "scope"], "left")
    choice = F.when(F.col("choice").isin("accept", "reject", "manual"), F.col("choice")).when(F.col("status") == "llm_only", "accept")
    loc = text_of(F.col("locator")) if "locator" in v.columns else F.lit("")
    return v.select("unit", "scope", "target", loc.alias("locator"), text_of(F.col("alternate")).alias("alternate"), "status", choice.alias("choice"), F.when(choice == "manual", F.coalesce("value", F.expr("cast(array() as array<string>)"))).alias("value"), F.lit("auto").alias("by")).where("choice is not null")


def default_choice(status: Column, verdict: Column) -> Column:
    """Q16: what a review page preselects."""
    return F.when(status.isin("corroborated", "parser_explicit", "added"), "accept").otherwise(F.coalesce(verdict, F.lit("")))


def status_rank(status: Column) -> Column:
    """O10."""
    order = ["llm_only", "parser_inferred", "added", "parser_explicit", "corroborated"]
    out = F.lit(len(order))
    for i, s in enumerate(order):
        out = F.when(status == s, i).otherwise(out)
    return out


def paginate(units: DataFrame, part: str, order: list[str], size: int = 12) -> DataFrame:
    """Page numbers of at most ``size`` units that do not cross a part.  A part is a chapter, small by nature."""
    w = Window.partitionBy(part).orderBy(*order)
    return units.withColumn("page", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
