"""Named queries over the driver's tables, each with its SQL twin for DuckDB where SQL can express it.

The tables hold no citations, so queries derive address and citation strings from columns, in both engines
by the same rule.  Every query reads whole tables; limits appear only where a top-k is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import citation as ci
from skein.functions import external as ex
from skein.functions import text as tx
from skein.operators import audit, order, refs
from skein.operators import reconcile as rc
from skein.plans.registry import QUERIES, SQL, dealt, query
from skein.plans.registry import s as _s
from skein.sources import tables, topics

# The white-space class, as SQL text.
_WS = tx.WS
def _norm(column: str) -> str:
    return f"trim(regexp_replace({column}, '{_WS}+', ' ', 'g'))"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ------------------------------------------------------------------ scalar functions
@query("norm_text", f"select doc_id, {_norm('text')} as norm from documents")
def _(t):
    return t("documents").select("doc_id", tx.norm(F.col("text")).alias("norm"))


@query("tok_signature", "select doc_id, regexp_replace(text, '[^A-Za-z0-9]', '', 'g') as tok, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') as sig from documents")
def _(t):
    return t("documents").select("doc_id", tx.tok(F.col("text")).alias("tok"), tx.signature(F.col("text")).alias("sig"))


@query("escape_html", "select page_id, replace(replace(replace(url || ' <a> & b', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as esc from pages")
def _(t):
    return t("pages").select("page_id", tx.escape_html(F.concat("url", F.lit(" <a> & b"))).alias("esc"))


@query("image_tokens", "select page_id, '[IMAGE: ' || case when regexp_extract(url, '([^/]*)$', 1) <> '' then regexp_extract(url, '([^/]*)$', 1) else url end || ']' as token from pages")
def _(t):
    return t("pages").select("page_id", tx.image_token(F.col("url")).alias("token"))


def _number() -> Column:
    """part.section[-sub] out of part keys: 1-53 . 2-4 digits."""
    k = F.col("p_partkey")
    return F.concat(_s(k % 53 + 1), F.lit("."), F.lpad(_s(k % 997 + 1), 3, "0"), F.when(k % 3 == 0, F.concat(F.lit("-"), _s(k % 71 + 1))).otherwise(F.lit("")))


_NUMBER = "cast(p_partkey % 53 + 1 as varchar) || '.' || lpad(cast(p_partkey % 997 + 1 as varchar), 3, '0') || case when p_partkey % 3 = 0 then '-' || cast(p_partkey % 71 + 1 as varchar) else '' end"


@query(
    "href_to_citation",
    """with h as (select p_partkey, case p_partkey % 5 when 0 then 'x.xml#REG_Subpart_' || (p_partkey % 53) || '_' || (p_partkey % 10) when 1 then 'x.xml#REG_Part_' || (p_partkey % 53)
  when 2 then 'x.xml#REG_' || (p_partkey % 53) || '_' || (p_partkey % 997) when 3 then 'x.xml#REG_' || (p_partkey % 53) || '_' || (p_partkey % 997) || '_' || (p_partkey % 71) else 'x.xml#other' || p_partkey end as href from part),
  f as (select p_partkey, regexp_extract(href, '([^#]*)$', 1) as g from h)
  select p_partkey, case when g like 'REG\\_Subpart\\_%' escape '\\' then 'subpart ' || replace(substr(g, 13), '_', '.') when g like 'REG\\_Part\\_%' escape '\\' then 'part ' || substr(g, 10)
  when g like 'REG\\_%' escape '\\' then split_part(substr(g, 5), '_', 1) || '.' || split_part(substr(g, 5), '_', 2) || case when split_part(substr(g, 5), '_', 3) <> '' then '-' || split_part(substr(g, 5), '_', 3) else '' end else g end as target from f""",
)
def _(t):
    k = F.col("p_partkey")
    c = lambda *x: F.concat(*[F.lit(i) if isinstance(i, str) else _s(i) for i in x])
    href = F.when(k % 5 == 0, c("x.xml#REG_Subpart_", k % 53, "_", k % 10)).when(k % 5 == 1, c("x.xml#REG_Part_", k % 53)).when(k % 5 == 2, c("x.xml#REG_", k % 53, "_", k % 997)).when(k % 5 == 3, c("x.xml#REG_", k % 53, "_", k % 997, "_", k % 71)).otherwise(c("x.xml#other", k))
    return t("part").select("p_partkey", ci.href_to_citation(href, "REG").alias("target"))


@query(
    "address_decompose",
    f"""with n as (select p_partkey, {_NUMBER} as num from part), r as (select p_partkey, num, split_part(num, '.', 1) as part, substr(num, instr(num, '.') + 1) as rest from n)
  select p_partkey, part, case when length(split_part(rest, '-', 1)) > 2 then left(split_part(rest, '-', 1), length(split_part(rest, '-', 1)) - 2) else '' end as subpart,
  right(split_part(rest, '-', 1), 2) as section, split_part(rest, '-', 2) as subsection, 'p' || (p_partkey % 9) as paragraph, '' as subparagraph, case when num like '%-%' then 'subsection' else 'section' end as level from r""",
)
def _(t):
    d = ci.decompose(_number(), F.array(F.concat(F.lit("p"), _s(F.col("p_partkey") % 9))), ci.PARAGRAPH_LEVELS[:2])
    return t("part").select("p_partkey", *(v.alias(k) for k, v in d.items()), ci.level_name(_number(), F.lit(0)).alias("level"))


@query("slug_titles", "select p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') as slug from part")
def _(t):
    return t("part").select("p_partkey", tx.slug(F.col("p_name")).alias("slug"))


@query("section_root", f"select p_partkey, regexp_extract({_NUMBER} || '(a)(' || (p_partkey % 7) || ')', '^\\d+\\.\\d+(?:-\\d+)?') as root from part")
def _(t):
    return t("part").select("p_partkey", ci.section_root(F.concat(_number(), F.lit("(a)("), _s(F.col("p_partkey") % 7), F.lit(")"))).alias("root"))


@query("strip_prefix", f"select p_partkey, {_NUMBER} as bare from part")
def _(t):
    return t("part").select("p_partkey", ci.strip_agency(F.concat(F.lit("REG-"), _number())).alias("bare"))


@query(
    "norm_citation",
    f"""with r as (select p_partkey, case p_partkey % 3 when 0 then ' Subpart  ' || (p_partkey % 50) || '.' || (p_partkey % 9) when 1 then 'Parts 1 and ' || (p_partkey % 50) else {_NUMBER} || ' (a) (2) ' end as raw from part),
  s as (select p_partkey, {_norm("raw")} as s from r)
  select p_partkey, case when lower(s) like 'subpart%' then 'subpart ' || split_part(s, ' ', -1) when lower(s) like 'part%' then 'part ' || split_part(s, ' ', -1) else replace(s, ' ', '') end as norm from s""",
)
def _(t):
    k = F.col("p_partkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit(" Subpart  "), _s(k % 50), F.lit("."), _s(k % 9))).when(k % 3 == 1, F.concat(F.lit("Parts 1 and "), _s(k % 50))).otherwise(F.concat(_number(), F.lit(" (a) (2) ")))
    return t("part").select("p_partkey", ci.norm_citation(raw).alias("norm"))


@query(
    "grammar_check",
    f"""with r as (select p_partkey, case p_partkey % 4 when 0 then {_NUMBER} || '(b)' when 1 then 'Subpart ' || (p_partkey % 50) || '.1' when 2 then 'part ' || (p_partkey % 50) else '41 U.S.C. ' || p_partkey end as c from part)
  select p_partkey, regexp_matches(c, '^\\d+\\.\\d+(?:-\\d+)?(?:\\([A-Za-z0-9]+\\))*$') or regexp_matches(c, '(?i)^subpart\\s+\\d+\\.\\d+$') or regexp_matches(c, '(?i)^part\\s+\\d+$') as ok from r""",
)
def _(t):
    k = F.col("p_partkey")
    c = F.when(k % 4 == 0, F.concat(_number(), F.lit("(b)"))).when(k % 4 == 1, F.concat(F.lit("Subpart "), _s(k % 50), F.lit(".1"))).when(k % 4 == 2, F.concat(F.lit("part "), _s(k % 50))).otherwise(F.concat(F.lit("41 U.S.C. "), _s(k)))
    return t("part").select("p_partkey", ci.grammar_ok(c).alias("ok"))


_ROMAN_SQL = "list_extract(['','m','mm','mmm'], n // 1000 + 1) || list_extract(['','c','cc','ccc','cd','d','dc','dcc','dccc','cm'], n // 100 % 10 + 1) || list_extract(['','x','xx','xxx','xl','l','lx','lxx','lxxx','xc'], n // 10 % 10 + 1) || list_extract(['','i','ii','iii','iv','v','vi','vii','viii','ix'], n % 10 + 1)"


@query("arabic_to_roman", f"select p_partkey, {_ROMAN_SQL} as roman from (select p_partkey, cast(p_partkey % 2000 as integer) as n from part)")
def _(t):
    return t("part").select("p_partkey", ci.int_to_roman((F.col("p_partkey") % 2000).cast("int")).alias("roman"))


@query("roman_to_arabic", "select p_partkey, cast(p_partkey % 2000 as integer) as value from part")
def _(t):
    return t("part").select("p_partkey", ci.roman_value(ci.int_to_roman((F.col("p_partkey") % 2000).cast("int"))).alias("value"))


@query(
    "alternate_split",
    f"select p_partkey, {_NUMBER} as base, upper({_ROMAN_SQL}) as roman, case when n = 0 then '' else cast(n as varchar) end as arabic from (select *, cast(p_partkey % 9 as integer) as n from part)",
)
def _(t):
    n = (F.col("p_partkey") % 9).cast("int")
    raw = F.when(n == 0, _number()).otherwise(F.concat(_number(), F.lit(" Alternate "), F.upper(ci.int_to_roman(n))))
    p = ci.split_alternate(raw)
    return t("part").select("p_partkey", p["base"].alias("base"), p["alternate"].alias("roman"), ci.alternate_number(p["alternate"]).alias("arabic"))


# ------------------------------------------------------------------ ranges
@query("range_expand_digits", "select o_orderkey, cast(unnest(range(o_orderkey % 50, o_orderkey % 50 + o_orderkey % 44 + 1)) as varchar) as member from orders where o_orderkey % 44 <= 40")
def _(t):
    a = F.col("o_orderkey") % 50
    return t("orders").select("o_orderkey", F.explode(ci.enumerate_tokens(_s(a), _s(a + F.col("o_orderkey") % 44))).alias("member"))


@query(
    "range_expand_letters",
    """with e as (select o_orderkey, cast(o_orderkey % 26 as integer) as a, cast((o_orderkey // 26) % 26 as integer) as b from orders)
  select o_orderkey, chr(97 + unnest(range(a, b + 1))::integer) as member from e where b >= a and not (contains('ivxlcdm', chr(97 + a)) and contains('ivxlcdm', chr(97 + b)))""",
)
def _(t):
    ch = lambda n: F.char(n + 97)
    a, b = F.col("o_orderkey") % 26, F.floor(F.col("o_orderkey") / 26) % 26
    return t("orders").select("o_orderkey", F.explode(ci.enumerate_tokens(ch(a), ch(b))).alias("member"))


@query(
    "range_expand_roman",
    f"with e as (select o_orderkey, cast(o_orderkey % 60 + 2 as integer) as a, cast(o_orderkey % 60 + 2 + o_orderkey % 7 + 1 as integer) as b from orders), x as (select o_orderkey, a, b, unnest(range(a, b + 1))::integer as n from e) select o_orderkey, {_ROMAN_SQL} as member from x where not (a in (5, 10, 50) and b in (5, 10, 50))",
)
def _(t):
    a = (F.col("o_orderkey") % 60 + 2).cast("int")
    b = (a + F.col("o_orderkey") % 7 + 1).cast("int")
    return t("orders").select("o_orderkey", F.explode(ci.enumerate_tokens(ci.int_to_roman(a), ci.int_to_roman(b))).alias("member"))


@query(
    "range_expand_paren",
    "select o_orderkey, (o_orderkey % 53 + 1) || '.' || (o_orderkey % 900 + 100) || '(a)(' || unnest(range(o_orderkey % 5, o_orderkey % 5 + o_orderkey % 6 + 1)) || ')' as target from orders",
)
def _(t):
    k = F.col("o_orderkey")
    base = F.concat(_s(k % 53 + 1), F.lit("."), _s(k % 900 + 100))
    text = F.concat(F.lit("as required by "), base, F.lit("(a)("), _s(k % 5), F.lit(") through (a)("), _s(k % 5 + k % 6), F.lit(") of this chapter"))
    scopes = dealt(t("orders")).select("o_orderkey", text.alias("scope_text"))
    return refs.mention_rows(scopes, ["o_orderkey"], refs.range_mentions(F.col("scope_text"), F.lit("1.100"))).select("o_orderkey", "m.target")


@query(
    "range_expand_dash",
    "select o_orderkey, (o_orderkey % 53 + 1) || '.' || (o_orderkey % 900 + 100) || '-' || unnest(range(o_orderkey % 5 + 1, o_orderkey % 5 + o_orderkey % 6 + 3)) as target from orders",
)
def _(t):
    k = F.col("o_orderkey")
    base = F.concat(_s(k % 53 + 1), F.lit("."), _s(k % 900 + 100))
    text = F.concat(F.lit("see "), base, F.lit("-"), _s(k % 5 + 1), F.lit(" through "), base, F.lit("-"), _s(k % 5 + k % 6 + 2), F.lit(" here"))
    scopes = dealt(t("orders")).select("o_orderkey", text.alias("scope_text"))
    return refs.mention_rows(scopes, ["o_orderkey"], refs.range_mentions(F.col("scope_text"), F.lit("1.100"))).select("o_orderkey", "m.target")


@query("self_paragraph", "select o_orderkey, '5.201(' || chr(97 + (o_orderkey % 26)::integer) || ')(' || (o_orderkey % 9) || ')' as target from orders")
def _(t):
    k = F.col("o_orderkey")
    text = F.concat(F.lit("under paragraphs ("), F.char(k % 26 + 97), F.lit(")("), _s(k % 9), F.lit(") of this section, Paragraph (x) of this section"))
    scopes = dealt(t("orders")).select("o_orderkey", text.alias("scope_text"))
    return refs.mention_rows(scopes, ["o_orderkey"], refs.self_mentions(F.col("scope_text"), F.lit("5.201"))).select("o_orderkey", "m.target")


# ------------------------------------------------------------------ windows and links
@query(
    "context_window",
    f"""with p as (select doc_id, text, instr(text, ' the ') - 1 as s from documents where contains(text, ' the ')), w as (select doc_id, text, greatest(s - 90, 0) as a, least(s + 5 + 75, length(text)) as b from p)
  select doc_id, case when a > 0 then '…' else '' end || {_norm("substr(text, a + 1, b - a)")} || case when b < length(text) then '…' else '' end as evidence from w""",
)
def _(t):
    s = F.instr("text", " the ") - 1
    return t("documents").where(F.col("text").contains(" the ")).select("doc_id", refs._around(F.col("text"), s, s + 5).alias("evidence"))


_HREF = r'<a href="([^"]*)"'


def _links(t) -> DataFrame:
    return t("pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("pos", "href"))


_LINKS = f"(select page_id, unnest(range(len(h)))::integer as pos, unnest(h) as href from (select page_id, regexp_extract_all(html, '{_HREF}', 1) as h from pages))"


def _scopes(t) -> DataFrame:
    """A scope for each page: every link of it as an anchor 'LINK'; every second one leads outside, every seventh is a form."""
    href = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))
    far = lambda x, i: F.when(i % 2 == 1, F.concat(F.lit("https://host.invalid"), x, F.lit("/"))).otherwise(F.concat(F.lit("t.xml#REG_"), (i + 1).cast("string"), F.lit("_"), F.char_length(x).cast("string")))
    word = lambda i: F.when(i % 7 == 1, F.concat(F.lit("SF "), i.cast("string"))).otherwise(F.lit("LINK"))
    pages = t("pages").select("page_id", F.transform(href, lambda x, i: F.struct(far(x, i).alias("href"), word(i).alias("shown"), F.lpad(i.cast("string"), 4, "0").alias("mark"))).alias("links"))
    none = F.expr("cast(array() as array<struct<href:string,scope:string,start:int,end:int>>)")

    def step(acc, x):  # noqa: ANN001, ANN202
        start = F.char_length(acc["text"]) + 9  # the mark keeps the windows of evidence apart
        one = F.struct(x["href"].alias("href"), F.lit("").alias("scope"), start.alias("start"), (start + F.char_length(x["shown"])).alias("end"))
        return F.struct(F.concat(acc["text"], x["mark"], F.lit(" see "), x["shown"], F.lit("; " + "-" * 180 + " ")).alias("text"), F.concat(acc["anchors"], F.array(one)).alias("anchors"))

    return pages.select("page_id", F.aggregate("links", F.struct(F.lit("").alias("text"), none.alias("anchors")), step).alias("x")).select(F.col("page_id").alias("chunk_id"), F.col("x.text").alias("scope_text"), F.col("x.anchors").alias("anchors"), F.lit("1.100").alias("number"))


@query("link_extract_internal", f"select page_id as chunk_id, pos // 2 as pos, (pos + 1) || '.' || length(href) as target, 'explicit' as kind from {_LINKS} where pos % 2 = 0")
def _(t):
    m = refs.explicit_mentions(F.col("scope_text"), F.col("anchors"), "REG")
    return _scopes(t).select("chunk_id", F.posexplode(m).alias("pos", "m")).select("chunk_id", "pos", "m.target", "m.kind")


_OUTSIDE = f"""(select page_id as chunk_id, pos, 'https://host.invalid' || href || '/' as href, case when pos % 7 = 1 then 'form:SF-' || pos else rtrim('https://host.invalid' || href, '/') end as target,
  case when pos % 7 = 1 then 'form' else 'url' end as ref_type, case when pos % 7 = 1 then 'SF ' || pos else 'LINK' end as label from {_LINKS} where pos % 2 = 1)"""


@query("link_extract_external", f"select chunk_id, pos // 2 as pos, target, ref_type, label, href from {_OUTSIDE}")
def _(t):
    m = refs.external_mentions(F.col("scope_text"), F.col("anchors"))
    return _scopes(t).select("chunk_id", F.posexplode(m).alias("pos", "m")).select("chunk_id", "pos", "m.ref.target", "m.ref.ref_type", F.col("m.ref.node_label").alias("label"), "m.href")


@query("anchor_qualifier", "select p_partkey, '(' || (p_partkey % 9) || ')(' || chr(97 + (p_partkey % 26)::integer) || ')' as q from part")
def _(t):
    k = F.col("p_partkey")
    text = F.concat(F.lit("anchor ("), _s(k % 9), F.lit(")("), F.char(k % 26 + 97), F.lit(") and so on"))
    return t("part").select("p_partkey", F.trim(refs.qualifier(text, F.lit(6))).alias("q"))


@query(
    "alternate_qualifier",
    "select p_partkey, case p_partkey % 3 when 2 then '' else cast(p_partkey % 9 + 1 as varchar) end as alternate from part",
)
def _(t):
    k = F.col("p_partkey")
    r = F.upper(ci.int_to_roman((k % 9 + 1).cast("int")))
    text = F.when(k % 3 == 0, F.concat(F.lit("use Alternate "), r, F.lit(" (Feb 2000) of ANCHOR here."))).when(k % 3 == 1, F.concat(F.lit("insert ANCHOR, with Alternate "), r, F.lit(" as needed."))).otherwise(F.concat(F.lit("insert ANCHOR. Then with Alternate "), r))
    s = F.instr(text, "ANCHOR") - 1
    return t("part").select("p_partkey", refs.alternate_of(text, s, s + 6).alias("alternate"))


@query(
    "statute_patterns",
    """with r as (select p_partkey, p_partkey % 6 as f, p_partkey % 50 + 1 as a, p_partkey % 9000 + 1 as b from part)
  select p_partkey, case f when 0 then 'usc:' || a || '/ch' || b when 1 then 'usc:' || a || '/' || b when 2 then 'cfr:' || a || '/' || b || '.' || a when 3 then 'eo:' || b when 4 then 'publ:' || a || '-' || b else 'omb:A-' || b end as target,
  case f when 1 then '(a)(4)' when 2 then '(b)' else '' end as locator, case f when 0 then a || '|chapter|' || b when 1 then a || '|' || b || '|a|4' when 2 then a || '|' || b || '|' || a || '|b' when 3 then b::varchar when 4 then a || '|' || b else 'A|' || b end as levels from r""",
)
def _(t):
    k = F.col("p_partkey")
    a, b = _s(k % 50 + 1), _s(k % 9000 + 1)
    c = lambda *x: F.concat(*[F.lit(i) if isinstance(i, str) else i for i in x])
    text = F.when(k % 6 == 0, c("by ", a, " U.S.C. chapter ", b)).when(k % 6 == 1, c(a, " U.S.C.  ", b, "(a)(4)")).when(k % 6 == 2, c("see ", a, " CFR part ", b, ".", a, "(b)")).when(k % 6 == 3, c("Executive Order ", b)).when(k % 6 == 4, c("Public Law No. ", a, "-", b)).otherwise(c("omb circular A-", b))
    return t("part").select("p_partkey", ex.parse_external(text).alias("r")).select("p_partkey", "r.target", "r.locator", F.array_join("r.division_levels", "|").alias("levels"))


@query("statute_mentions", "select c_custkey, (c_custkey % 50 + 1) || ' U.S.C. ' || (c_custkey % 900) as citation, 'usc' as ref_type from customer union all select c_custkey, 'E.O. ' || (c_custkey % 9999), 'eo' from customer")
def _(t):
    k = F.col("c_custkey")
    text = F.concat(F.lit("Authority: "), _s(k % 50 + 1), F.lit(" U.S.C. "), _s(k % 900), F.lit("; see also E.O. "), _s(k % 9999), F.lit(" thereon."))
    m = refs.external_mentions(text, F.expr("cast(array() as array<struct<href:string,scope:string,start:int,end:int>>)"))
    return t("customer").select("c_custkey", F.explode_outer(m).alias("m")).where("m is not null").select("c_custkey", "m.ref.citation", "m.ref.ref_type")


@query("form_patterns", "select p_partkey, case p_partkey % 3 when 0 then 'form:SF-' when 1 then 'form:DD-' else 'form:OF-' end || (p_partkey % 400) as target from part")
def _(t):
    k = F.col("p_partkey")
    text = F.concat(F.when(k % 3 == 0, "Standard Form ").when(k % 3 == 1, "DD Form ").otherwise("OF-"), _s(k % 400))
    return t("part").select("p_partkey", ex.parse_form(text)["target"].alias("target"))


# ------------------------------------------------------------------ grouping
@query("group_mentions", f"select page_id, href as target, min(pos) as first_pos, count(*) as mentions, string_agg(cast(pos as varchar), ',' order by pos) as places from {_LINKS} where not starts_with(href, 'http') group by page_id, href")
def _(t):
    m = _links(t).where(~F.col("href").startswith("http")).select("page_id", "pos", F.col("href").alias("target"), F.lit("").alias("alternate"), F.lit("explicit").alias("kind"), _s("pos").alias("evidence"))
    g = refs.group_internal(m, ["page_id"])
    return g.select("page_id", "target", F.col("pos").alias("first_pos"), F.size("mentions").cast("long").alias("mentions"), F.array_join(F.transform("mentions", lambda x: x["evidence"]), ",").alias("places"))


@query("group_external_dedup", f"select chunk_id, target, ref_type, min(pos) // 2 as first_pos, arg_min(label, pos) as label, arg_min(href, pos) as href, count(*) as mentions from {_OUTSIDE} group by chunk_id, target, ref_type")
def _(t):
    g = refs.external_edges(_scopes(t))
    return g.select("chunk_id", "target", "ref_type", F.col("pos").alias("first_pos"), F.col("node_label").alias("label"), "href", F.size("mentions").cast("long").alias("mentions"))


# ------------------------------------------------------------------ reconciliation
def _cite(n: Column) -> Column:
    return F.concat(_s(n % 40 + 1), F.lit("."), _s(n % 300 + 100))


def _cite_sql(n: str) -> str:
    return f"(({n}) % 40 + 1) || '.' || (({n}) % 300 + 100)"


def _sides(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two finders over line items: one reads part keys, the other supplier keys; orders are the units."""
    li = dealt(t("lineitem"))
    unit = F.concat(F.lit("REG-"), _cite(F.col("l_orderkey") % 5000)).alias("unit")
    place = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    p = li.select(unit, place, _cite(F.col("l_partkey")).alias("target"), F.lit("").alias("alternate"), F.when(F.col("l_linenumber") % 2 == 1, "explicit").otherwise("inferred").alias("confidence"), _s("l_partkey").alias("evidence"))
    f = li.select(unit, place, _cite(F.col("l_suppkey") * 7).alias("target"), _s("l_suppkey").alias("evidence"), F.lit("internal").alias("scope"), F.lit(None).cast("string").alias("alternate"))
    a = t("part").select(_cite(F.col("p_partkey") * 3).alias("address")).distinct()
    return p, f, a


def _ledger(t) -> DataFrame:
    p, f, a = _sides(t)
    return rc.reconcile_internal(rc.parser_internal(p), rc.finder_internal(f), a)


_LEDGER = f"""p0 as (select 'REG-' || {_cite_sql("l_orderkey % 5000")} as unit, l_orderkey * 10 + l_linenumber as pos, {_cite_sql("l_partkey")} as target, case when l_linenumber % 2 = 1 then 'explicit' else 'inferred' end as kind from lineitem),
  p as (select unit, target, arg_min(kind, pos) as kind from p0 where unit <> 'REG-' || target group by unit, target),
  f as (select distinct 'REG-' || {_cite_sql("l_orderkey % 5000")} as unit, {_cite_sql("l_suppkey * 7")} as target from lineitem where {_cite_sql("l_orderkey % 5000")} <> {_cite_sql("l_suppkey * 7")}),
  addr as (select distinct {_cite_sql("p_partkey * 3")} as address from part),
  led as (select coalesce(p.unit, f.unit) as unit, coalesce(p.target, f.target) as target, case when p.unit is not null and f.unit is not null then 'corroborated' when kind = 'explicit' then 'parser_explicit' when p.unit is not null then 'parser_inferred' else 'llm_only' end as status
   from p full join f on p.unit = f.unit and p.target = f.target),
  ledger as (select led.*, case when address is not null then 'resolves' else 'not_loaded' end as validation, status in ('parser_inferred', 'llm_only') as needs_review from led left join addr on target = address)"""


@query("reconcile_internal", f"with {_LEDGER} select unit, target, status, validation, needs_review from ledger")
def _(t):
    return _ledger(t).select("unit", "target", "status", "validation", "needs_review")


@query("ledger_status_counts", f"with {_LEDGER} select unit, status, count(*) as n, count(*) filter (needs_review) as to_review from ledger group by unit, status")
def _(t):
    return rc.unit_status_counts(_ledger(t))


@query("status_histogram", f"with {_LEDGER} select " + ", ".join(f"count(*) filter (status = '{s}') as {s}" for s in rc.STATUSES) + " from ledger")
def _(t):
    return rc.status_counts(_ledger(t))


@query("validate_targets", f"with {_LEDGER} select target, validation, count(*) as n from ledger group by target, validation")
def _(t):
    return _ledger(t).groupBy("target", "validation").agg(F.count("*").alias("n"))


@query("self_reference_filter", f"select 'REG-' || {_cite_sql('l_orderkey % 5000')} as unit, count(*) as kept from lineitem where {_cite_sql('l_orderkey % 5000')} <> {_cite_sql('l_partkey')} group by 1")
def _(t):
    return rc.without_self(_sides(t)[0]).groupBy("unit").agg(F.count("*").alias("kept"))


@query("auto_decisions_union", f"with {_LEDGER} select unit, target, status, 'accept' as choice, 'auto' as \"by\" from ledger where status = 'llm_only'")
def _(t):
    return rc.auto_decisions(_ledger(t)).select("unit", "target", "status", "choice", "by")


_VERDICTS = f"v as (select 'REG-' || {_cite_sql('doc_id')} as unit, {_cite_sql('doc_id * 7')} as target, max(case when quality = 0 then 'reject' else 'accept' end) as choice from labels group by 1, 2)"


@query("auto_decisions_judge", f"with {_LEDGER}, {_VERDICTS} select l.unit, l.target, status, coalesce(choice, 'accept') as choice from ledger l left join v on l.unit = v.unit and l.target = v.target where needs_review and (choice is not null or status = 'llm_only')")
def _(t):
    k = F.col("doc_id")
    v = t("labels").groupBy(F.concat(F.lit("REG-"), _cite(k)).alias("unit"), _cite(k * 7).alias("target")).agg(F.max(F.when(F.col("quality") == 0, "reject").otherwise("accept")).alias("choice"))
    v = v.select("*", F.lit("").alias("alternate"), F.lit(None).cast("array<string>").alias("value"))
    return rc.auto_decisions(_ledger(t), v).select("unit", "target", "status", "choice")


@query("judge_jobs", f"with {_LEDGER} select unit, count(*) as items, string_agg(target, '|' order by target) as targets from ledger where needs_review group by unit")
def _(t):
    j = rc.judge_jobs(_ledger(t))
    return j.select("unit", F.size("items").cast("long").alias("items"), F.array_join(F.transform("items", lambda x: x["target"]), "|").alias("targets"))


def _ext_sides(t) -> tuple[DataFrame, DataFrame]:
    li = dealt(t("lineitem"))
    unit = F.concat(F.lit("REG-"), _s(F.col("l_orderkey") % 3000)).alias("unit")
    place = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    usc = lambda n: F.concat(_s(n % 50 + 1), F.lit(" U.S.C. "), _s(n % 90 + 1))
    p = li.select(unit, place, _s("l_partkey").alias("evidence"), F.inline_outer(F.array(ex.parse_external(usc(F.col("l_partkey")))))).withColumn("href", F.lit(""))
    raw = F.when(F.col("l_suppkey") % 4 == 0, "the Acme Act").otherwise(usc(F.col("l_suppkey")))
    f = li.select(unit, place, raw.alias("target"), _s("l_suppkey").alias("evidence"), F.lit("external").alias("scope"), F.lit("").alias("alternate"))
    return p, f


@query(
    "reconcile_external",
    """with p as (select distinct 'REG-' || (l_orderkey % 3000) as unit, 'usc:' || (l_partkey % 50 + 1) || '/' || (l_partkey % 90 + 1) as target from lineitem),
  f as (select distinct 'REG-' || (l_orderkey % 3000) as unit, 'usc:' || (l_suppkey % 50 + 1) || '/' || (l_suppkey % 90 + 1) as target from lineitem where l_suppkey % 4 <> 0)
  select coalesce(p.unit, f.unit) as unit, coalesce(p.target, f.target) as target, case when p.unit is not null and f.unit is not null then 'corroborated' when p.unit is not null then 'parser_explicit' else 'llm_only' end as status, p.unit is null as needs_review
  from p full join f on p.unit = f.unit and p.target = f.target""",
)
def _(t):
    return rc.reconcile_external(*_ext_sides(t)).select("unit", "target", "status", "needs_review")


# ------------------------------------------------------------------ decisions and apply
@query("merge_decisions_last_wins", "select user_id, event_type, max(event_id) as last_id, min(event_id) as first_id from events group by user_id, event_type")
def _(t):
    e = t("events").select("user_id", "event_type", "event_id", F.col("event_id").alias("at"))
    m = rc.last_wins(e, ["user_id", "event_type"], ["at"])
    return m.select("user_id", "event_type", F.col("event_id").alias("last_id"), F.col("first_at.at").alias("first_id"))


def _apply_inputs(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges of units, decisions on them by order key, and the ledger."""
    from skein.operators import apply as ap

    p, _, _ = _sides(t)
    edges = p.groupBy("unit", "target").agg(F.min("pos").alias("pos")).select("unit", "pos", "target", F.lit("").alias("alternate"), F.lit("").alias("row_alternate"))
    k = F.col("o_orderkey")
    d = t("orders").select(F.concat(F.lit("REG-"), _cite(k % 5000)).alias("unit"), F.lit("internal").alias("scope"), _cite(k * 11).alias("target"), F.lit("").alias("locator"), F.lit("").alias("alternate"), F.lit("llm_only").alias("status"),
                           F.when(k % 3 == 0, "reject").otherwise("accept").alias("choice"), F.lit(None).cast("array<string>").alias("value"), F.when(k % 2 == 0, "auto").alias("by"), F.lit(0).alias("file_idx"), k.alias("item_idx"))
    return edges, ap.merge_decisions(d), _ledger(t)


_KEPT = f"""with {_LEDGER}, e as (select distinct unit, target from p0),
  d as (select 'REG-' || {_cite_sql("o_orderkey % 5000")} as unit, {_cite_sql("o_orderkey * 11")} as target, arg_max(case when o_orderkey % 3 = 0 then 'reject' else 'accept' end, o_orderkey) as choice, arg_max(case when o_orderkey % 2 = 0 then 'auto' else '' end, o_orderkey) as who from orders group by 1, 2),
  kept as (select e.unit, e.target, case when l.status = 'corroborated' then 'corroborated' else 'parser_only' end as status from e left join ledger l on e.unit = l.unit and e.target = l.target
   where not exists (select 1 from d where d.unit = e.unit and d.target = e.target and choice = 'reject'))"""


@query("apply_tag_and_drop", _KEPT + " select unit, target, status from kept")
def _(t):
    from skein.operators import apply as ap

    edges, d, book = _apply_inputs(t)
    return ap.tag_and_drop(edges, d, book, "internal").select("unit", "target", "status")


@query("apply_append", _KEPT + " select d.unit, d.target, case when who = 'auto' then 'auto_accepted' else 'human_approved' end as status from d where choice = 'accept' and unit in (select unit from e) and not exists (select 1 from kept k where k.unit = d.unit and k.target = d.target)")
def _(t):
    from skein.operators import apply as ap

    edges, d, book = _apply_inputs(t)
    kept = ap.tag_and_drop(edges, d, book, "internal")
    return ap.additions_internal(d, kept, edges).select("unit", "target", "status")


@query("default_choice", f"with {_LEDGER} select unit, target, case when status in ('corroborated', 'parser_explicit') then 'accept' else '' end as choice from ledger")
def _(t):
    return _ledger(t).select("unit", "target", rc.default_choice(F.col("status"), F.lit(None).cast("string")).alias("choice"))


# ------------------------------------------------------------------ coverage, change track, usage
# A document's lines are the fragments of a unit, and the first half of its text stands for the unit's output.
_SIG = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"
_COVERED = f"""with f as (select doc_id as unit, unnest(range(len(string_split(text, chr(10)))))::integer as nth, unnest(string_split(text, chr(10))) as fragment, {_SIG("substr(text, 1, n_chars // 2)")} as o from documents),
  g as (select unit, nth, fragment, length({_SIG("fragment")}) as size, not contains(o, {_SIG("fragment")}) as missing from f where {_SIG("fragment")} <> ''),
  u as (select unit, sum(size)::bigint as source, coalesce(sum(size) filter (missing), 0)::bigint as missing, count(*) filter (missing and size >= 4) as dropped from g group by unit)"""


def _coverage(t) -> DataFrame:
    d = dealt(t("documents"))
    tag = F.when(F.col("at") % 2 == 1, "p (tail)").otherwise("p")
    f = d.select(F.col("doc_id").alias("unit"), F.posexplode(F.split("text", "\n", -1)).alias("at", "fragment")).withColumn("tag", tag)
    return audit.coverage(f, d.select(F.col("doc_id").alias("unit"), F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_chars") / 2).cast("int")).alias("text")))


@query("coverage_fragments", _COVERED + " select unit, source, missing, dropped from u")
def _(t):
    return audit.unit_gaps(_coverage(t)).select("unit", F.col("source").cast("long").alias("source"), F.col("missing").cast("long").alias("missing"), "dropped")


@query("coverage_summary", _COVERED + " select count(*) as units, sum(source)::bigint as source, sum(missing)::bigint as missing, count(*) filter (dropped > 0) as gaps, round(100.0 * (1 - sum(missing) / sum(source)), 2)::double as percent from u")
def _(t):
    return audit.coverage_summary(_coverage(t)).select("units", F.col("source").cast("long").alias("source"), F.col("missing").cast("long").alias("missing"), "gaps", F.round("percent", 2).alias("percent"))


@query("dropped_census", _COVERED + " select 'p' as tag, count(*) as count from g where missing and size >= 4 having count(*) > 0")
def _(t):
    return audit.dropped_tags(_coverage(t))


@query(
    "topk_gaps",
    _COVERED + f""", k as (select unit, source, missing from u where dropped > 0 order by missing desc, unit limit 25),
  e as (select g.unit, k.source, k.missing, case when nth % 2 = 1 then 'p (tail)' else 'p' end || '=' || substr({_norm("fragment")}, 1, 70) as shown, row_number() over (partition by g.unit order by nth) as n from g join k on g.unit = k.unit where g.missing and size >= 4)
  select unit, source, missing, string_agg(shown, '|' order by n) as examples from e where n <= 4 group by unit, source, missing""",
)
def _(t):
    shown = F.array_join(F.transform("examples", lambda x: F.concat(x["tag"], F.lit("="), x["text"])), "|")
    return audit.top_gaps(_coverage(t)).select("unit", F.col("source").cast("long").alias("source"), F.col("missing").cast("long").alias("missing"), shown.alias("examples"))


@query("change_span_containment", "select item_id, contains(text, substr(text, 5, 20)) and item_id % 3 <> 0 as ok from benchmark")
def _(t):
    b = t("benchmark")
    entries = b.where("item_id % 3 <> 0").select(_s("item_id").alias("section"), F.col("text").alias("description"))
    spans = b.select("item_id", _s("item_id").alias("section"), F.substring("text", 5, 20).alias("why"))
    return audit.spans_in_sections(spans, entries).select("item_id", "ok")


@query("change_check", "select count(*) filter (item_id % 3 <> 0) as ok, count(*) as total, case when count(*) filter (item_id % 3 <> 0) = count(*) then 'OK' else 'MISMATCH' end as verdict from benchmark")
def _(t):
    return audit.change_check(t("benchmark").select((F.col("item_id") % 3 != 0).alias("ok")))


@query(
    "positional_zip",
    "with u as (select conv_id, turn, text, row_number() over (partition by conv_id order by turn) as at from conversations where role = 'user'), a as (select conv_id, text, row_number() over (partition by conv_id order by turn) as at from conversations where role = 'assistant') select u.conv_id, u.at::integer as at, u.turn, coalesce(length(a.text), -1)::integer as answer from u left join a on u.conv_id = a.conv_id and u.at = a.at",
)
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    side = lambda r: t("conversations").where(F.col("role") == r).withColumn("at", F.row_number().over(w))
    z = audit.positional_zip(side("user").select("conv_id", "at", "turn"), side("assistant").select("conv_id", "at", F.col("text").alias("answer")), ["conv_id"], "at")
    return z.select("conv_id", "at", "turn", F.coalesce(F.char_length("answer"), F.lit(-1)).alias("answer"))


@query("interval_containment", "select l_orderkey, l_linenumber, p.pre from lineitem l join (select o_orderkey, o_orderkey % 3 + 1 as pre, o_orderkey % 3 + 3 as post from orders) p on l.l_orderkey = p.o_orderkey and l_linenumber between pre and post")
def _(t):
    inner = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("at"))
    outer = t("orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3 + 1).alias("pre"), (F.col("o_orderkey") % 3 + 3).alias("post"))
    return audit.containment(inner, outer, "k").select(F.col("k").alias("l_orderkey"), F.col("at").alias("l_linenumber"), "pre")


@query(
    "natural_sort_rank",
    "select c, row_number() over (order by a, b, n) as rank from (select distinct (p_partkey % 40 + 1) || '.' || (p_partkey % 300 + 100) || '(a)(' || (p_partkey % 12 + 1) || ')' as c, p_partkey % 40 as a, p_partkey % 300 as b, p_partkey % 12 as n from part)",
)
def _(t):
    k = F.col("p_partkey")
    c = t("part").select(F.concat(_cite(k), F.lit("(a)("), _s(k % 12 + 1), F.lit(")")).alias("c")).distinct()
    return order.ranked(c, F.slice(ci.sort_key(F.col("c")), 1, 3), [ci.sort_key(F.col("c"))])


@query("paginate_units", "select o_orderkey, ((row_number() over (partition by o_custkey order by o_orderkey) - 1) // 12)::integer as page from orders")
def _(t):
    return rc.paginate(t("orders"), "o_custkey", ["o_orderkey"]).select("o_orderkey", "page")


_USAGE = "(select event_type as stage, event_id as prompt, event_id % 97 as output, event_id % 13 as thinking, event_id + event_id % 97 + event_id % 13 as total, event_id % 5 <> 0 as reported from events)"


def _usage(t) -> DataFrame:
    e = F.col("event_id")
    return t("events").select(F.col("event_type").alias("stage"), e.alias("prompt"), (e % 97).alias("output"), (e % 13).alias("thinking"), (e + e % 97 + e % 13).alias("total"), (e % 5 != 0).alias("reported"))


@query("usage_rollup", f"select coalesce(stage, 'total') as stage, count(*) as calls, count(*) filter (reported) as reported, sum(prompt)::bigint as prompt, sum(output)::bigint as output, sum(thinking)::bigint as thinking, sum(total)::bigint as total from {_USAGE} group by rollup(stage)")
def _(t):
    return audit.usage_rollup(_usage(t))


@query("cost_estimate", f"select stage, round((sum(prompt) * 1.25 + (sum(output) + sum(thinking)) * 10.0) / 1000000, 2)::double as usd from {_USAGE} group by stage")
def _(t):
    s = _usage(t).groupBy("stage").agg(*[F.sum(c).alias(c) for c in ("prompt", "output", "thinking")])
    return s.select("stage", F.round(audit.cost(F.col("prompt"), F.col("output"), F.col("thinking"), 1.25, 10.0), 2).alias("usd"))


@query("cache_hits", "select count(*) filter (o.o_orderkey % 3 = 0) as hits, count(*) filter (o.o_orderkey % 3 <> 0) as misses from orders o")
def _(t):
    u = t("orders").select(_s("o_orderkey").alias("unit"), tx.cache_key(F.lit("p"), "1", "audit", _s("o_orderkey")).alias("hash"))
    c = t("orders").where("o_orderkey % 3 = 0").select(_s("o_orderkey").alias("unit"), tx.cache_key(F.lit("p"), "1", "audit", _s("o_orderkey")).alias("hash"), F.lit("x").alias("response"))
    hits, misses = audit.cache_split(u, c)
    both = hits.select(F.lit(1).alias("h")).unionByName(misses.select(F.lit(0).alias("h")))
    return both.agg(F.count_if(F.col("h") == 1).alias("hits"), F.count_if(F.col("h") == 0).alias("misses"))


@query("cache_keys", "select o_orderkey, substr(sha1('m|1|audit|' || o_orderkey), 1, 16) as key from orders")
def _(t):
    return t("orders").select("o_orderkey", tx.cache_key(F.lit("m"), "1", "audit", _s("o_orderkey")).alias("key"))


@query("base_unit_limit", "select o_orderkey, (o_custkey % 40 + 1) || '.' || (o_custkey % 300 + 100) as number from orders order by o_custkey % 40, o_custkey % 300, lpad(cast(o_orderkey as varchar), 12, '0') limit 100")
def _(t):
    none = F.expr("cast(array() as array<string>)")
    chunks = t("orders").select("o_orderkey", _cite(F.col("o_custkey")).alias("number"), F.lpad(_s("o_orderkey"), 12, "0").alias("file"), F.lit(0).alias("emit"), none.alias("tokens"), F.lit("").alias("alternate"), F.lit("section").alias("type"))
    return topics.first_units(chunks, 100).select("o_orderkey", "number")


@query("json_props", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t):
    return t("events").select("event_id", tables.typed(F.col("props"), "k long")["k"].alias("k"))


@query("tolerant_json", "select event_id, 2 * cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t):
    k = F.col("event_id")
    twice = F.concat(F.lit("["), "props", F.lit("] ["), "props", F.lit("]"))
    fenced, inner = F.concat(F.lit("```json\n"), twice, F.lit("\n```")), F.concat(F.lit('[{"k": 1, "a": "use ```json x``` here ["}, '), "props", F.lit("] [{\"k\": -1}, "), "props", F.lit("]"))
    answer = F.when(k % 3 == 0, F.concat(F.lit("Sure [: "), twice, F.lit(" done"))).when(k % 3 == 1, fenced).otherwise(inner)
    p = audit.parse_answers(t("events").select("event_id", answer.alias("answer")), "answer", "array<struct<k:long>>")
    return p.select("event_id", F.aggregate("parsed", F.lit(0).cast("long"), lambda a, x: a + x["k"]).alias("k"))


from skein.plans import topic_catalogue  # noqa: E402, F401 - registers the queries over topics
