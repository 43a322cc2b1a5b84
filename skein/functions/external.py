"""References to other documents: statutes, codes, orders, circulars, forms, links.

What a recognised form means is data: ``KINDS`` says for each how its target, label and levels are spelt from
the groups of its pattern, and one reader makes the expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import bind, norm, slug, text_of


@dataclass(frozen=True)
class Kind:
    """A form of citation.  In a spelling ``{2}`` is the second group, and a part in brackets falls away if its group is empty."""

    name: str
    pattern: str
    ref_type: str
    target: str
    label: str
    levels: tuple[str, ...]
    locator: int = 0


# The recognised forms, in order of precedence.
KINDS = [
    Kind("usc_chapter", r"(?i)(\d+)\s+U\.S\.C\.\s+chapter\s+(\d+)", "usc", "usc:{1}/ch{2}", "{1} U.S.C. chapter {2}", ("{1}", "chapter", "{2}")),
    Kind("usc", r"(\d+)\s+U\.S\.C\.\s*(\d+[A-Za-z]?)((?:\([A-Za-z0-9]+\))*)", "usc", "usc:{1}/{2}", "{1} U.S.C. {2}", ("{1}", "{2}"), 3),
    Kind("cfr", r"(?i)(\d+)\s+CFR\s+(?:part\s+)?(\d+)(?:\.(\d+))?((?:\([A-Za-z0-9]+\))*)", "cfr", "cfr:{1}/{2}[.{3}]", "{1} CFR {2}[.{3}]", ("{1}", "{2}", "{3}"), 4),
    Kind("eo", r"(?i)(?:E\.O\.|Executive\s+Order)\s+(\d+)", "eo", "eo:{1}", "E.O. {1}", ("{1}",)),
    Kind("public_law", r"(?i)(?:Pub\.\s*L\.|Public\s+Law)\s+(?:No\.?\s*)?(\d+)-(\d+)", "public_law", "publ:{1}-{2}", "Pub. L. {1}-{2}", ("{1}", "{2}")),
    Kind("omb", r"(?i)OMB\s+Circular\s+(?:No\.?\s*)?([A-Z])-(\d+)", "omb", "omb:{1}-{2}", "OMB Circular {1}-{2}", ("{1}", "{2}")),
]
# A government form, and the series that the first letter of its name stands for.
FORM = r"(?i)\b(Standard Form|SF|Optional Form|OF|DD Form|DD)\s*-?\s*(\d+[A-Za-z]?)\b"
SERIES = {"s": "SF", "o": "OF", "d": "DD"}
REF = "struct<ref_type:string,target:string,locator:string,node_label:string,division_levels:array<string>,citation:string>"


def parens(c: Column) -> Column:
    """Contents of the parenthesised groups of a locator."""
    return F.regexp_extract_all(c, F.lit(r"\(([A-Za-z0-9]+)\)"), F.lit(1))


def reference(ref_type: Column | str, target: Column, levels: Column, label: Column, citation: Column, locator: Column | str = "") -> Column:
    """An edge's description, as ``REF``."""
    lit = lambda c: F.lit(c) if isinstance(c, str) else c
    return F.struct(lit(ref_type).alias("ref_type"), target.alias("target"), lit(locator).alias("locator"), label.alias("node_label"), levels.alias("division_levels"), citation.alias("citation"))


def _spelt(spelling: str, group) -> Column:  # noqa: ANN001
    """The text of a spelling: literals, groups, and parts that need their group."""
    out = []
    for part, number, literal in re.findall(r"\[([^\]]*)\]|\{(\d)\}|([^\[{]+)", spelling):
        if part:
            need = group(int(re.search(r"\{(\d)\}", part)[1]))
            out.append(F.when(need != "", _spelt(part, group)).otherwise(F.lit("")))
        else:
            out.append(group(int(number)) if number else F.lit(literal))
    return out[0] if len(out) == 1 else F.concat(*out)


def build(kind: Kind, match: Column, citation: Column) -> Column:
    """The edge of one matched form."""
    group = lambda i: F.regexp_extract(match, kind.pattern, i)
    locator = group(kind.locator) if kind.locator else ""
    levels = F.filter(F.array(*[_spelt(x, group) for x in kind.levels]), lambda x: x != "")
    return reference(kind.ref_type, _spelt(kind.target, group), F.concat(levels, parens(locator)) if kind.locator else levels, _spelt(kind.label, group), citation, locator)


def parse_external(c: Column) -> Column:
    """The first form, in order of precedence, that occurs in the text; null if none does."""
    found = lambda s, k: F.when(s.rlike(k.pattern), bind(F.regexp_extract(s, k.pattern, 0), lambda m: build(k, m, s)))
    return bind(norm(c), lambda s: F.coalesce(*[found(s, k) for k in KINDS]))


def parse_form(c: Column) -> Column:
    """A government form named in the text; null if none is."""
    s, shown = text_of(c), F.trim(text_of(c))
    letters = F.create_map(*[F.lit(x) for kv in SERIES.items() for x in kv])
    series = letters[F.lower(F.substring(F.regexp_extract(s, FORM, 1), 1, 1))]
    number = F.regexp_extract(s, FORM, 2)
    return F.when(s.rlike(FORM), reference("form", F.concat(F.lit("form:"), series, F.lit("-"), number), F.array(series, number), shown, shown))


def build_edge(document: Column, section: Column, fallback: Column) -> Column:
    """An edge from a document and section typed by hand.

    A recognised form in both together, apart, or in the document alone decides, under the section typed;
    an unknown document becomes a slug of its type.
    """
    doc, sec = F.trim(text_of(document)), F.trim(text_of(section))
    kind = F.coalesce(F.nullif(text_of(fallback), F.lit("")), F.lit("other"))
    known = F.coalesce(*[parse_external(x) for x in (F.concat(doc, sec), F.trim(F.concat(doc, F.lit(" "), sec)), doc)])
    named = F.when(kind != "act", F.concat(doc, sec)).when(sec == "", doc).otherwise(F.concat(F.lit("section "), sec, F.lit(" of the "), doc))
    own = reference(kind, F.concat(kind, F.lit(":"), slug(doc)), F.concat(F.array(doc), F.regexp_extract_all(sec, F.lit(r"\d+|[A-Za-z]+"), F.lit(0))), doc, named, sec)
    return F.coalesce(F.when(sec == "", known).otherwise(known.withField("locator", sec)), own)
