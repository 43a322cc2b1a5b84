"""Reference extraction over scopes.

A scope is one chunk's running text and its anchors: ``scope_text STRING`` and
``anchors ARRAY<STRUCT<href, scope, start, end>>`` (code points).  Everything here is a projection of a
row: no join and no shuffle until mentions are grouped, which is per chunk as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.citation import NUMBER, RANGE_CAP, alternate_number, href_to_citation, members_sql
from skein.functions.external import KINDS, REF, Kind, build, parse_external, parse_form
from skein.functions.matches import finditer
from skein.functions.text import bind, bind_sql, norm, text_of, window

# Evidence before and after, qualifier reach, search for a range's base, alternate reach.
BEFORE, AFTER, QUALIFIER, BASE, ALTERNATE = 90, 75, 40, 120, 250
_SEP = r"(?:through|thru|to|–|—|-)"
_LABELS = r"(?:\([A-Za-z0-9]+\))+"
#: Something every range has: a separator behind a label or a digit.
_HINT = rf"(?i)[)\d]\s*{_SEP}\s*[(\d]"
RANGE_PAREN = rf"(?i)(?:{NUMBER})?\s*{_LABELS}\s*{_SEP}\s*(?:{NUMBER})?\s*{_LABELS}"
_PAREN_PARTS = rf"(?i)^({NUMBER})?\s*({_LABELS})\s*{_SEP}\s*({NUMBER})?\s*({_LABELS})$"
RANGE_DASH = r"(?i)(\d+\.\d+)-\d+\s*(?:through|thru|to|–|—|\s-\s)\s*(?:\1-)?\d+(?!\.\d)"
_DASH_PARTS = r"(?i)^(\d+\.\d+)-(\d+)\s*(?:through|thru|to|–|—|\s-\s)\s*(?:\1-)?(\d+)$"
TYPED_DASH = rf"(?i)^(\d+\.\d+)-(\d+)\s*{_SEP}\s*(?:\d+\.\d+-)?(\d+)$"
SELF = r"paragraphs?\s+\([a-z0-9]+\)(?:\([a-z0-9]+\))*\s+of this section"
ALT_OF = r"(?i)\bAlternate\s+([IVXLCDM]+)\s*(?:\([^)]*\)\s*)?of\s*$"
ALT_WITH = r"(?i)\bwith\s+Alternate\s+([IVXLCDM]+)\b"

MENTION = "array<struct<target:string,alternate:string,kind:string,evidence:string>>"


def is_external(anchor: Column) -> Column:
    return (F.coalesce(anchor["scope"], F.lit("")) == "external") | text_of(anchor["href"]).startswith("http")


def _piece(t: Column, a: Column, b: Column) -> Column:
    return F.substring(t, a + 1, F.greatest(b - a, F.lit(0)))


def _around(t: Column, start: Column, end: Column) -> Column:
    return window(t, F.greatest(start - BEFORE, F.lit(0)), F.least(end + AFTER, F.char_length(t)))


def qualifier(t: Column, end: Column) -> Column:
    """R2: label groups right after an anchor, with the white space before them; '' if there are none."""
    return F.regexp_extract(_piece(t, end, end + QUALIFIER), rf"^\s*{_LABELS}", 0)


def alternate_of(t: Column, start: Column, end: Column) -> Column:
    """Arabic number of the alternate that a reference names, before it or after it; '' if none."""
    before = norm(_piece(t, F.greatest(start - ALTERNATE, F.lit(0)), start))
    after = norm(_piece(t, end, end + ALTERNATE))
    own = F.when(F.instr(after, ". ") > 0, F.substring_index(after, ". ", 1)).otherwise(after)
    return F.when(before.rlike(ALT_OF), alternate_number(F.upper(F.regexp_extract(before, ALT_OF, 1)))).otherwise(alternate_number(F.upper(F.regexp_extract(own, ALT_WITH, 1))))


def explicit_mentions(t: Column, anchors: Column, prefix: str) -> Column:
    """A mention for each internal anchor."""

    def one(x: Column) -> Column:
        q = qualifier(t, x["end"])
        end = x["end"] + F.char_length(q)
        a, b = F.greatest(x["start"] - BEFORE, F.lit(0)), F.least(end + AFTER, F.char_length(t))
        shown = F.concat(F.lit('<xref href="'), text_of(x["href"]), F.lit('">'), _piece(t, x["start"], x["end"]), F.lit("</xref>"))
        dots = lambda c: F.when(c, F.lit("…")).otherwise(F.lit(""))
        return F.struct(
            F.concat(href_to_citation(x["href"], prefix), F.trim(F.regexp_replace(q, r"^\s+", ""))).alias("target"),
            alternate_of(t, x["start"], end).alias("alternate"),
            F.when(q != "", "inferred").otherwise("explicit").alias("kind"),
            F.concat(dots(a > 0), norm(F.concat(_piece(t, a, x["start"]), shown, _piece(t, x["end"], b))), dots(b < F.char_length(t))).alias("evidence"),
        )

    return F.transform(F.filter(anchors, lambda x: ~is_external(x)), one)


def _mentions(targets: Column, evidence: Column) -> Column:
    """A mention of each target, all with one evidence; none without targets."""
    one = "struct(y AS target, '' AS alternate, 'inferred' AS kind, r.e AS evidence)"
    return bind_sql(f"transform(r.x, y -> {one})", x=F.coalesce(targets, F.expr("cast(array() as array<string>)")), e=evidence)


def _parts(match: Column, pattern: str, n: int) -> Column:
    """The groups of a match of the whole text, as an array."""
    return F.split(F.regexp_replace(match, pattern, "\x01".join(f"${i + 1}" for i in range(n))), "\x01", -1)


def range_targets(x: Column, base: Column) -> Column:
    """Members of a parenthetical range from its parts (number, labels, number, labels); null if unsafe.

    The labels before the last are a prefix that both ends share.
    """
    labels = r"regexp_extract_all({}, '\\(([A-Za-z0-9]+)\\)', 1)".format
    ends = f"struct({labels('r.x[1]')} AS l, {labels('r.x[3]')} AS r)"
    fixed = lambda side: f"slice({side}, 1, size({side}) - 1)"
    head = f"concat(r.base, array_join(transform({fixed('e.l')}, y -> concat('(', y, ')')), ''))"
    members = members_sql("m.a", "m.b")
    named = f"get(transform(array(struct({head} AS h, element_at(e.l, -1) AS a, element_at(e.r, -1) AS b)), m -> transform({members}, y -> concat(m.h, '(', y, ')'))), 0)"
    return bind_sql(f"get(transform(array({ends}), e -> CASE WHEN size(e.r) = 1 OR {fixed('e.r')} = {fixed('e.l')} THEN {named} END), 0)", x=x, base=base)


def dash_targets(x: Column, least: int) -> Column:
    """Members of a dashed range from its parts (number, first, last); null if too long or falling."""
    ends = "struct(try_cast(r.x[1] AS bigint) AS lo, try_cast(r.x[2] AS bigint) AS hi)"
    return bind_sql(f"get(transform(array({ends}), e -> CASE WHEN e.hi - e.lo BETWEEN {least} AND {RANGE_CAP} THEN transform(sequence(e.lo, e.hi), n -> concat(r.x[0], '-', n)) END), 0)", x=x)


def range_mentions(t: Column, number: Column) -> Column:
    """Every member of every parenthetical or dashed range."""
    none = F.expr(f"cast(array() as {MENTION})")

    def spread(pattern: str, targets):  # noqa: ANN001, ANN202
        return F.flatten(F.transform(finditer(t, pattern), lambda m: _mentions(targets(m), _around(t, m["start"], m["end"]))))

    def paren(m: Column) -> Column:
        before = F.regexp_extract_all(_piece(t, F.greatest(m["start"] - BASE, F.lit(0)), m["start"]), F.lit(f"({NUMBER})"), F.lit(1))
        own = lambda x, i: F.nullif(F.get(x, F.lit(i)), F.lit(""))
        return bind(_parts(m["match"], _PAREN_PARTS, 4), lambda x: range_targets(x, F.coalesce(own(x, 0), own(x, 2), F.try_element_at(before, F.lit(-1)), number)))

    dash = lambda m: bind(_parts(m["match"], _DASH_PARTS, 3), lambda x: dash_targets(x, 1))
    return F.when(t.rlike(_HINT), F.concat(spread(RANGE_PAREN, paren), spread(RANGE_DASH, dash))).otherwise(none)


def expand_typed(raw: Column, base: Column) -> Column:
    """Q15: a typed list of citations and ranges as single citations; what is no range stays as it is.

    ``base`` is the unit that a range without a number belongs to.  Here a dashed range may have one member
    and a bare hyphen between its ends.
    """

    def one(piece: Column) -> Column:
        parens = bind(_parts(piece, _PAREN_PARTS, 4), lambda x: range_targets(x, F.coalesce(F.nullif(F.get(x, F.lit(0)), F.lit("")), F.nullif(F.get(x, F.lit(2)), F.lit("")), base)))
        dashes = bind(_parts(piece, TYPED_DASH, 3), lambda x: dash_targets(x, 0))
        return F.coalesce(F.when(piece.rlike(_PAREN_PARTS), parens).when(piece.rlike(TYPED_DASH), dashes), F.array(piece))

    pieces = F.filter(F.transform(F.split(text_of(raw), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.flatten(F.transform(pieces, one))


def self_mentions(t: Column, number: Column) -> Column:
    """R8: 'paragraph (b)(2) of this section'."""

    def one(m: Column) -> Column:
        group = F.regexp_extract(m["match"], r"(\([a-z0-9]+\)(?:\([a-z0-9]+\))*)", 1)
        return F.struct(F.concat(number, group).alias("target"), F.lit("").alias("alternate"), F.lit("inferred").alias("kind"), _around(t, m["start"], m["end"]).alias("evidence"))

    return F.transform(finditer(t, SELF), one)


def internal_mentions(t: Column, anchors: Column, number: Column, prefix: str) -> Column:
    """All internal mentions of a scope, in order of discovery."""
    return F.concat(explicit_mentions(t, anchors, prefix), range_mentions(t, number), self_mentions(t, number))


def external_mentions(t: Column, anchors: Column) -> Column:
    """Statutory forms in prose, then tagged external links: array<struct<ref, href, kind, evidence>>."""

    def mention(kind: Kind):  # noqa: ANN202
        return lambda m: F.struct(build(kind, m["match"], norm(m["match"])).alias("ref"), F.lit("").alias("href"), F.lit("inferred").alias("kind"), _around(t, m["start"], m["end"]).alias("evidence"))

    prose = [F.transform(finditer(t, k.pattern), mention(k)) for k in KINDS]

    def link(x: Column) -> Column:
        anchor, href = norm(_piece(t, x["start"], x["end"])), text_of(x["href"])
        url = F.regexp_replace(href, "/+$", "")
        shown = F.when(anchor != "", anchor).otherwise(url)
        plain = F.when(href.startswith("http"), F.struct(F.lit("url").alias("ref_type"), url.alias("target"), F.lit("").alias("locator"), shown.alias("node_label"), F.expr("cast(array() as array<string>)").alias("division_levels"), shown.alias("citation")))
        ref = F.coalesce(parse_external(anchor), parse_form(anchor), plain).cast(REF)
        return F.struct(ref.alias("ref"), href.alias("href"), F.lit("explicit").alias("kind"), _around(t, x["start"], x["end"]).alias("evidence"))

    links = F.transform(F.filter(anchors, lambda x: is_external(x) & ~text_of(x["href"]).startswith("mailto")), link)
    return F.concat(*prose, F.filter(links, lambda m: m["ref"].isNotNull()))


def group_internal(mentions: DataFrame, key: list[str]) -> DataFrame:
    """Mentions (key, pos, target, alternate, kind, evidence) to edges, in order of first appearance.

    Mentions are kept as they are, repeats included; an edge is explicit if any of its mentions is.
    """
    edge = mentions.groupBy(*key, "target", "alternate").agg(
        F.min("pos").alias("pos"),
        F.when(F.bool_or(F.col("kind") == "explicit"), "explicit").otherwise("inferred").alias("confidence"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "kind", "evidence"))), lambda x: F.struct(x["kind"].alias("kind"), x["evidence"].alias("evidence"))).alias("mentions"),
    )
    return edge


def group_external(mentions: DataFrame, key: list[str]) -> DataFrame:
    """Mentions (key, pos, ref, href, kind, evidence) to edges by target and locator.

    The first mention's description and the first non-empty link win; evidence counts once.
    """
    m = mentions.withColumn("target", F.col("ref.target")).withColumn("locator", F.col("ref.locator"))
    seen = m.groupBy(*key, "target", "locator").agg(
        F.min("pos").alias("pos"), F.min_by("ref", "pos").alias("ref"), F.min_by(F.col("href"), F.when(F.col("href") != "", F.col("pos"))).alias("href"), F.array_sort(F.collect_list(F.struct("pos", "kind", "evidence"))).alias("all")
    )

    def first_only(acc: Column, x: Column) -> Column:
        fresh = (x["evidence"] != "") & ~F.exists(acc, lambda y: y["evidence"] == x["evidence"])
        return F.when(fresh, F.concat(acc, F.array(F.struct(x["kind"].alias("kind"), x["evidence"].alias("evidence"))))).otherwise(acc)

    none = F.expr("cast(array() as array<struct<kind:string,evidence:string>>)")
    return seen.select(
        *key, "pos", "ref.ref_type", "target", "locator", "ref.node_label", "ref.division_levels", "ref.citation", F.coalesce("href", F.lit("")).alias("href"), F.lit("explicit").alias("confidence"), F.aggregate("all", none, first_only).alias("mentions")
    )


def mention_rows(df: DataFrame, key: list[str], mentions: Column) -> DataFrame:
    """(key, pos, m): a row a mention.  An outer generator: for an inner one the engine would compute the mentions twice."""
    return df.select(*key, F.posexplode_outer(mentions).alias("pos", "m")).where("pos is not null")


def internal_edges(chunks: DataFrame, prefix: str, key: str = "chunk_id") -> DataFrame:
    """Edges of chunks (key, number, scope_text, anchors)."""
    m = mention_rows(chunks, [key], internal_mentions(F.col("scope_text"), F.col("anchors"), F.col("number"), prefix)).select(key, "pos", "m.*")
    return group_internal(m, [key])


def external_edges(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    m = mention_rows(chunks, [key], external_mentions(F.col("scope_text"), F.col("anchors"))).select(key, "pos", "m.*")
    return group_external(m, [key])
