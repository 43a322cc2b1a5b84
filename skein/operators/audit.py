"""Change track, coverage, usage and caches."""

from __future__ import annotations

import json
import re
from contextlib import suppress

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import norm, signature

#: Fragments shorter than this many signature characters are not listed as gaps; they still count as missing.
MIN_FRAGMENT = 4


def spans_in_sections(spans: DataFrame, entries: DataFrame) -> DataFrame:
    """Per span (section, why) whether an entry of its section describes it."""
    e = entries.groupBy("section").agg(F.collect_list("description").alias("_all"))  # one section's own entries
    hit = F.exists("_all", lambda d: d.contains(F.col("why")))
    return spans.join(e, "section", "left").withColumn("ok", F.coalesce(hit, F.lit(False))).drop("_all")


def change_check(checked: DataFrame) -> DataFrame:
    """A12."""
    return checked.agg(F.count_if("ok").alias("ok"), F.count("*").alias("total")).withColumn("verdict", F.when(F.col("ok") == F.col("total"), "OK").otherwise("MISMATCH"))


def positional_zip(left: DataFrame, right: DataFrame, key: list[str], at: str) -> DataFrame:
    """Rows of the two sides with the same key and ordinal; a missing right side is null."""
    return left.join(right, [*key, at], "left")


def containment(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Inner.at within [outer.pre, outer.post] of the same key: an equi-join with a residual condition."""
    return inner.join(outer, key).where("at between pre and post")


def coverage(fragments: DataFrame, outputs: DataFrame) -> DataFrame:
    """Per fragment (unit, at, tag, fragment) its size and whether the unit's output lacks it.

    ``at`` is the fragment's place in its unit.  Units without an output are not checked.
    """
    sig = outputs.select("unit", signature(F.col("text")).alias("_out"))
    f = fragments.withColumn("sig", signature(F.col("fragment"))).where("sig <> ''")
    return f.join(sig, "unit").select("unit", "at", "tag", "fragment", F.char_length("sig").alias("size"), (~F.col("_out").contains(F.col("sig"))).alias("missing"))


#: A missing fragment long enough to be listed.
_DROPPED = "missing and size >= " + str(MIN_FRAGMENT)


def unit_gaps(cov: DataFrame) -> DataFrame:
    """Per unit the characters of its source, those missing, and the fragments dropped."""
    missing = F.coalesce(F.sum(F.when(F.col("missing"), F.col("size"))), F.lit(0))
    return cov.groupBy("unit").agg(F.sum("size").alias("source"), missing.alias("missing"), F.count_if(F.expr(_DROPPED)).alias("dropped"))


def coverage_summary(cov: DataFrame) -> DataFrame:
    """Units checked, characters of source and missing, units with a gap, share covered; 100 % of nothing."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    s = unit_gaps(cov).agg(F.count("*").alias("units"), total("source"), total("missing"), F.count_if(F.col("dropped") > 0).alias("gaps"))
    return s.withColumn("percent", F.when(F.col("source") == 0, 100.0).otherwise(F.bround(100.0 * (1 - F.col("missing") / F.col("source")), 4)))


def dropped_tags(cov: DataFrame) -> DataFrame:
    """Dropped fragments by tag; text behind an element counts for that element."""
    return cov.where(_DROPPED).groupBy(F.regexp_replace("tag", r" \(tail\)$", "").alias("tag")).count().orderBy(F.desc("count"), "tag")


def top_gaps(cov: DataFrame, n: int = 25, shown: int = 4, width: int = 70) -> DataFrame:
    """The units that miss most text among those that dropped a fragment, and the first fragments of each.

    The units are a bounded top-k and travel to the fragments; of a unit's fragments only the first ones, by
    their place, are gathered.
    """
    units = unit_gaps(cov).where("dropped > 0").orderBy(F.desc("missing"), "unit").limit(n).drop("dropped")
    said = F.substring(norm(F.col("fragment")), 1, width).alias("text")
    first = cov.where(_DROPPED).drop("missing").join(F.broadcast(units), "unit").withColumn("_nth", F.row_number().over(Window.partitionBy("unit").orderBy("at"))).where(F.col("_nth") <= shown)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_nth", "tag", said))), lambda x: F.struct(x["tag"].alias("tag"), x["text"].alias("text")))
    return first.groupBy("unit", "source", "missing").agg(listed.alias("examples")).orderBy(F.desc("missing"), "unit")


def usage_rollup(usage: DataFrame) -> DataFrame:
    """A4: calls, reported calls and tokens by stage, and a total row."""
    sums = [F.sum(c).alias(c) for c in ("prompt", "output", "thinking", "total")]
    out = usage.rollup("stage").agg(F.count("*").alias("calls"), F.count_if("reported").alias("reported"), *sums, F.grouping("stage").alias("_g"))
    return out.withColumn("stage", F.when(F.col("_g") == 1, "total").otherwise(F.col("stage"))).drop("_g")


def cost(prompt, output, thinking, per_in: float, per_out: float):  # noqa: ANN001, ANN201
    """A5: thinking is billed as output; rounded half to even at four places."""
    return F.bround((prompt * per_in + (output + thinking) * per_out) / 1_000_000, 4)


def cache_split(units: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of units by name and content hash."""
    c = cache.select("unit", "hash", "response")
    return units.join(c, ["unit", "hash"]), units.join(c, ["unit", "hash"], "left_anti")


def cache_hits(units: Column, calls: Column, canned: bool = False) -> Column:
    """Units that needed no call; none with canned findings."""
    return F.lit(0) if canned else F.greatest(units - calls, F.lit(0))


def json_values(answer: str) -> list[str]:
    """The JSON values in a model's answer, each written out again.

    A fence around the whole answer goes.  What is left is one value, or prose with arrays and objects in it.
    """
    fenced = re.fullmatch(r"\s*```[A-Za-z]*(.*?)(?:```)?\s*", answer, re.S)
    s = (fenced[1] if fenced else answer).strip()
    found: list[object] = []
    with suppress(ValueError, RecursionError):
        found.append(json.loads(s))
    end = len(s) if found else 0
    for m in re.finditer(r"[\[{]", s):
        if m.start() >= end:
            with suppress(ValueError, RecursionError):
                value, end = json.JSONDecoder().raw_decode(s, m.start())
                found.append(value)
    return [json.dumps(v, ensure_ascii=False) for v in found]


def merged_json(values: Column) -> Column:
    """One JSON text of several: arrays become one array; else the first that is not empty, or the first."""
    inner = F.filter(F.transform(values, lambda x: F.substring(x, F.lit(2), F.char_length(x) - 2)), lambda x: x != "")
    full = F.filter(values, lambda x: ~x.isin("[]", "{}", "null", "false", "0", '""'))
    return F.when(F.forall(values, lambda x: x.startswith("[")) & (F.size(values) > 0), F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]"))).otherwise(F.coalesce(F.get(full, F.lit(0)), F.get(values, F.lit(0))))


def parse_answers(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Answers as typed values; Arrow batches find the JSON, the engine merges and parses it."""

    @F.pandas_udf("array<string>")
    def values(s):  # noqa: ANN001, ANN202
        return s.map(lambda x: json_values(x or ""))

    return df.withColumn("_json", values(F.col(col))).withColumn("parsed", F.from_json(merged_json(F.col("_json")), schema)).drop("_json")
