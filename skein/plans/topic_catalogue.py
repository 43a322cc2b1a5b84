"""Queries over topics: files are written out of table columns as XML, so that SQL can say what must come back.

Every row of a table becomes one topic file in memory, (path, file, raw); the queries run the shredder and what
follows it over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import citation as ci
from skein.functions import text as tx
from skein.operators import apply as ap
from skein.operators import audit, order, refs
from skein.operators import reconcile as rc
from skein.plans import run
from skein.plans.registry import dealt, query, said
from skein.plans.registry import s as _s
from skein.sources import topics
from skein.sources.topics import ShredConfig

_LONG = "This topic says enough to be kept as a unit of text."


def _files(df: DataFrame, key: str, file: Column, raw: Column) -> DataFrame:
    return dealt(df).select(_s(key).alias("path"), file.alias("file"), raw.alias("raw"))


def _number(k: Column) -> Column:
    return said(k % 53 + 1, ".", F.lpad(_s(k % 997 + 1), 3, "0"), F.when(k % 3 == 0, said("-", k % 71 + 1)).otherwise(F.lit("")))


def _number_sql(k: str) -> str:
    return f"(({k} % 53 + 1) || '.' || lpad(cast({k} % 997 + 1 as varchar), 3, '0') || case when {k} % 3 = 0 then '-' || ({k} % 71 + 1) else '' end)"


# ------------------------------------------------------------------ shredding
def _topic(k: Column, name: Column) -> Column:
    """Eight shapes of a file: broken, without topic or body, near-empty, numbered, of a derived class, a list, odd name."""
    para = lambda label, *body: said(f'<p><ph props="autonumber">({label})</ph>', *body, "</p>")
    deep = said("<ol><li>", para("i", " deepest"), "</li></ol>")
    lists = said("<ol><li>", para("a", " ", name), "<ol><li>", para("1", " one"), deep, "</li></ol></li><li><p>none</p><ol><li>", para("b", " two"), "</li></ol></li></ol>")
    return (
        F.when(k % 8 == 1, F.lit("<concept><title>"))
        .when(k % 8 == 2, F.lit("<note/>"))
        .when(k % 8 == 3, F.lit("<concept><title/></concept>"))
        .when(k % 8 == 4, F.lit("<topic><title/><body><p>tiny</p></body></topic>"))
        .when(k % 8 == 5, said('<!DOCTYPE task PUBLIC "a" "b"><task><title><b><ph props="autonumber"> 9.', k % 900 + 100, "\n</ph></b></title><taskbody><p>", name, " ", _LONG, "</p></taskbody></task>"))
        .when(k % 8 == 6, said('<own class="- topic/topic own/own "><title/><part class="- topic/body own/part "><p>', _LONG, "</p></part></own>"))
        .otherwise(said("<reference><title/><refbody><p>", _LONG, "</p>", lists, "</refbody></reference>"))
    )


def _part_topics(t) -> DataFrame:
    k = F.col("p_partkey")
    return _files(t("part"), "p_partkey", F.when(k % 8 == 0, said("cover", k)).otherwise(_number(k)), _topic(k, tx.escape_html(F.col("p_name"))))


_CFG = ShredConfig(bottom_level="subparagraph", source_version="E1")
_SHAPES = f"""n as (select p_partkey as k, p_partkey % 8 as shape, p_name as name, {_number_sql("p_partkey")} as num from part),
  skips as (select k, case when shape = 0 then 'cover' || k else num end as file, 0 as emit, case shape when 0 then 'non-numeric (part/subpart/cover/matrix/…)' when 3 then 'no body (conbody/taskbody/refbody/body)' when 4 then 'near-empty' else 'no topic (concept/task/reference) / parse error' end as reason from n where shape in (0, 1, 2, 3, 4)),
  lists as (select k, num, unnest([0, 1, 2, 3]) as emit, unnest(['', '(a)', '(a)(1)', '(b)']) as labels, unnest([case when num like '%-%' then 'subsection' else 'section' end, 'paragraph', 'subparagraph', 'paragraph']) as type,
   unnest(['{_LONG}' || chr(10) || '(a) ' || name || ' (1) one (i) deepest' || chr(10) || 'none (b) two', '(a) ' || name || ' (1) one (i) deepest', '(1) one (i) deepest', '(b) two']) as text from n where shape = 7),
  rows as (select k, num as file, emit, num || labels as citation, type, labels, text from lists
   union all select k, num, 0, '9.' || (k % 900 + 100), 'section', '', name || ' {_LONG}' from n where shape = 5
   union all select k, num, 0, num, case when num like '%-%' then 'subsection' else 'section' end, '', '{_LONG}' from n where shape = 6)"""


@query("xml_shred", f"with {_SHAPES} select k as p_partkey, file, emit::integer as emit, '' as reason, 'REG-' || citation as citation, type, labels, text from rows union all select k, file, emit, reason, '', '', '', '' from skips")
def _(t):
    c = topics.shred_topics(_part_topics(t), _CFG)
    empty = lambda x: F.coalesce(x, F.lit("")).alias
    labels = F.array_join(F.transform(F.coalesce("tokens", F.array().cast("array<string>")), lambda x: F.concat(F.lit("("), x, F.lit(")"))), "")
    return c.select(F.col("path").cast("long").alias("p_partkey"), "file", "emit", empty(F.col("skip_reason"))("reason"), empty(F.col("citation"))("citation"), empty(F.col("type"))("type"), labels.alias("labels"), empty(F.col("text"))("text"))


@query("manifest_entries", f"with {_SHAPES} select k as p_partkey, file, 'skipped' as outcome, reason from skips union all select distinct k, file, 'processed', '' from rows")
def _(t):
    c = topics.shred_topics(_part_topics(t), _CFG)
    m = topics.manifest(c.withColumn("file", F.concat_ws("|", "path", "file")))
    return m.select(F.split("file", "\\|")[0].cast("long").alias("p_partkey"), F.split("file", "\\|")[1].alias("file"), "outcome", "reason")


@query("manifest_counts", f"with {_SHAPES} select count(*) as seen, count(*) filter (shape in (5, 6, 7)) as processed, count(*) filter (shape not in (5, 6, 7)) + 2 as skipped from n")
def _(t):
    gone = t("region").where("r_regionkey < 2").select(_s("r_regionkey").alias("file"), F.lit(topics.NOT_FOUND).alias("skip_reason"))
    return topics.manifest_counts(topics.manifest(topics.shred_topics(_part_topics(t), _CFG), gone))


@query("row_types", f"with {_SHAPES} select type, count(*) as rows from rows group by type")
def _(t):
    return topics.row_types(topics.shred_topics(_part_topics(t), _CFG))


@query("failure_sample", "select file, reason from (select lpad(cast(p_partkey as varchar), 9, '0') as file, 'error: E' || p_partkey as reason from part where p_partkey % 9 = 4) order by file limit 5")
def _(t):
    k = F.col("p_partkey")
    m = t("part").select(F.lpad(_s(k), 9, "0").alias("file"), F.lit("skipped").alias("outcome"), F.when(k % 9 == 4, said("error: E", k)).otherwise(F.lit(topics.NEAR_EMPTY)).alias("reason"))
    return topics.failures(m).select("file", "reason")


_OLD = ShredConfig(edition=1)


@query(
    "old_edition_rows",
    f"""select k as p_partkey, emit::integer as emit, 'REG-' || num || labels as citation, type, text from (select p_partkey as k, {_number_sql("p_partkey")} as num, unnest([0, 1]) as emit, unnest(['', '(a)']) as labels,
  unnest([case when {_number_sql("p_partkey")} like '%-%' then 'subsection' else 'section' end, 'paragraph']) as type, unnest(['(a) ' || p_name || ' (1) deep' || chr(10) || 'none (b) two' || chr(10) || '(End of clause)', '(a) ' || p_name || ' (1) deep']) as text from part) where length(text) >= 0""",
)
def _(t):
    k = F.col("p_partkey")
    raw = said('<dita><concept><title/><conbody><ol><li><p><ph props="autonumber">(a)</ph> ', tx.escape_html(F.col("p_name")), '</p><ol><li><p><ph props="autonumber">(1)</ph> deep</p></li></ol></li>',
               '<li><p>none</p><ol><li><p><ph props="autonumber">(b)</ph> two</p></li></ol></li></ol><p outputclass="Endofclause">(End of clause)</p></conbody></concept></dita>')
    c = topics.shred_topics(_files(t("part"), "p_partkey", _number(k), raw), _OLD)
    return c.select(F.col("path").cast("long").alias("p_partkey"), "emit", "citation", "type", "text")


@query(
    "chunk_order",
    f"""with {_SHAPES}, o as (select *, case when citation like '9.%' and labels = '' and file <> citation then citation else replace(citation, labels, '') end as number from rows),
  d as (select k, emit, cast(split_part(number, '.', 1) as integer) as a, split_part(split_part(number, '.', 2), '-', 1) as mid, coalesce(try_cast(split_part(split_part(number, '.', 2), '-', 2) as integer), 0) as d,
   case labels when '' then [] when '(a)' then [1] when '(a)(1)' then [1, 1] else [2] end as l, file from o)
  select k as p_partkey, emit::integer as emit, row_number() over (order by a, coalesce(try_cast(left(mid, length(mid) - 2) as integer), 0), cast(right(mid, 2) as integer), d, l, file, emit) as rank from d""",
)
def _(t):
    c = topics.shred_topics(_part_topics(t), _CFG).where("skip_reason is null")
    keys, k = topics.chunk_order(), F.col("path").cast("long")
    # the SQL leaves open which of the rows of one number, labels and file comes first; here they keep the order in which it lists them
    listed = F.when(k % 8 == 7, 0).when(k % 8 == 5, 1).otherwise(2)
    return order.ranked(c, F.struct(*[x.alias(f"c{i}") for i, x in enumerate(keys[:3])]), [*keys, listed, k]).select(k.alias("p_partkey"), "emit", "rank")


# ------------------------------------------------------------------ flattening
@query(
    "xml_flatten",
    """select c_custkey, '(' || c_custkey || ') ' || c_name || ' leaning [IMAGE: p' || c_custkey || '.png] & tail' || chr(10) || 'fill-in' || chr(10) || 'one' || chr(10) || 'two [IMAGE: q.png]' || chr(10) || '[IMAGE: image]' || chr(10) || '<table></table>' as text,
  'p' || c_custkey || '.png|q.png|image' as images from customer""",
)
def _(t):
    k = F.col("c_custkey")
    raw = said('<concept><title/><conbody><p><ph props="autonumber"> (', k, ')\n</ph> ', tx.escape_html(F.col("c_name")), '  <i>leaning</i><image href="i/p', k, '.png">alt text</image>&amp; tail</p><note><p>not said</p></note><desc>fill-in</desc>',
               '<ul><li><p>one</p></li><li><p>two</p><image href="q.png"/></li></ul><fig><image/><image href="q.png"/></fig><simpletable/></conbody></concept>')
    c = topics.shred_topics(_files(t("customer"), "c_custkey", F.lit("1.100"), raw), _CFG)
    return c.select(F.col("path").cast("long").alias("c_custkey"), "text", F.array_join("images", "|").alias("images"))


@query(
    "scope_spans",
    """with x as (select s_suppkey as k, '(a)  See 5.' || s_suppkey || '(b) now' as head from supplier),
  y as (select k, head || 'inner out inner out ' as scope_text, unnest([0, 1, 2]) as pos, unnest(['5.' || k, 'out', 'out']) as shown, unnest(['f#REG_5_' || k, 'http://x/' || k, 'http://x/' || k]) as href, unnest(['', 'external', 'external']) as scope,
   unnest([9, length(head) + 6, length(head) + 16]) as start from x)
  select k as s_suppkey, pos::integer as pos, scope_text, href, scope, start::integer as start, (start + length(shown))::integer as "end", shown from y""",
)
def _(t):
    k = F.col("s_suppkey")
    raw = said('<concept><title/><conbody><p><ph props="autonumber">(a)</ph> See <xref href="f#REG_5_', k, '">5.<b>', k, '</b></xref>(b) now<p>inner <xref href="http://x/', k, '" scope="external">out</xref></p></p><desc>', _LONG, "</desc></conbody></concept>")
    c = topics.shred_topics(_files(t("supplier"), "s_suppkey", F.lit("1.100"), raw), _CFG)
    a = c.select(F.col("path").cast("long").alias("s_suppkey"), F.posexplode("anchors").alias("pos", "a"), "scope_text")
    return a.select("s_suppkey", "pos", "scope_text", "a.href", "a.scope", "a.start", "a.end", F.substring("scope_text", F.col("a.start") + 1, F.col("a.end") - F.col("a.start")).alias("shown"))


@query(
    "xml_table_html",
    """select s_suppkey, '<table><caption>' || s_name || ' [note &lt; ' || s_suppkey || ']</caption><thead><tr><th>k</th><th colspan="' || (s_suppkey % 3 + 2) || '">v &amp; w</th></tr></thead><tbody><tr><td>' || s_suppkey || '</td><td></td></tr><tr></tr></tbody></table>' as text from supplier""",
)
def _(t):
    k = F.col("s_suppkey")
    raw = said("<concept><title/><conbody><table><title> ", F.col("s_name"), "</title><desc>[note &lt; ", k, ']</desc><tgroup cols="5"><colspec colname="a" colnum="1"/><colspec colname="b"/><colspec colname="e" colnum="', k % 3 + 3, '"/>',
               '<thead><row><entry namest="b" nameend="a">k</entry><entry namest="b" nameend="e">v  &amp; w</entry></row></thead><tbody><row><entry colname="a"><p>', k, '</p></entry><entry namest="b"/></row><row/></tbody></tgroup></table></conbody></concept>')
    c = topics.shred_topics(_files(t("supplier"), "s_suppkey", F.lit("1.100"), raw), _CFG)
    return c.select(F.col("path").cast("long").alias("s_suppkey"), "text")


# ------------------------------------------------------------------ clauses and their alternates
def _clause(k: Column) -> Column:
    """A clause or provision with two alternates; what ends it, and how it is marked, varies with the key."""
    end = F.when(k % 4 == 0, '<p outputclass="Endofclause">(End of  Provision)</p>').when(k % 4 == 1, "<p>(End of clause)</p>").when(k % 4 == 2, '<p outputclass="Endofprovision">* * *</p>').otherwise("")
    opens = F.when(k % 2 == 0, '<section outputclass="Alternate">').otherwise("<section>")
    return said("<concept><title/><conbody><p>As prescribed in 4.", k % 90 + 100, " (a), insert the following clause:</p>", '<p outputclass="SmCaps">Terms (Feb', k % 30 + 1990, ")</p><p>", _LONG, "</p>", end,
                opens, "<?FM MARKER [Alt] Start?><p>gone</p><p><i>Alternate II</i> (Mar 2001). As prescribed in 5.", k % 90 + 100, "(b), add this (May 1999).</p><ul><li><p>more</p></li></ul><note>no block</note><p>alternate IV <ph>(Apr", k % 30 + 1990, ')</ph> other <image href="z.png"/></p></section></conbody></concept>')


def _clauses(t) -> DataFrame:
    k = F.col("c_custkey")
    return _files(t("customer"), "c_custkey", _number(k), _clause(k))


@query(
    "alternates",
    f"""with b as (select c_custkey as k, case c_custkey % 4 when 0 then 'provision' when 2 then 'provision' else 'clause' end as instrument, c_custkey % 30 + 1990 as y, c_custkey % 90 + 100 as p, case c_custkey % 4 when 0 then '(End of provision)' when 1 then '(End of clause)' when 2 then '(End of provision)' else '' end as mark from customer)
  select k as c_custkey, unnest(['', '2', '4']) as alternate, instrument, unnest(['Feb ' || y, 'Mar 2001', 'Apr ' || y]) as date, unnest(['4.' || p || '(a)', '5.' || p || '(b)', '']) as prescribed_by, unnest([mark, '', '']) as end_marker, unnest(['', '', 'z.png']) as images,
  unnest(['As prescribed in 4.' || p || ' (a), insert the following clause:' || chr(10) || 'Terms (Feb' || y || ')' || chr(10) || '{_LONG}', 'Alternate II (Mar 2001). As prescribed in 5.' || p || '(b), add this (May 1999).' || chr(10) || 'more', 'alternate IV (Apr' || y || ') other [IMAGE: z.png]']) as text from b""",
)
def _(t):
    c = topics.shred_topics(_clauses(t), _CFG)
    return c.select(F.col("path").cast("long").alias("c_custkey"), "alternate", "instrument", "date", "prescribed_by", "end_marker", F.array_join("images", "|").alias("images"), "text")


@query("alt_span_sessionise", "with s as (select conv_id, turn, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn) as span from conversations) select conv_id, span::integer as span, count(*) as turns, min(turn)::integer as opens from s where span > 0 group by conv_id, span")
def _(t):
    # a conversation is a section: a user's turn opens an alternate, the others belong to the one before them
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.concat(F.lit("<p>"), F.when(x["role"] == "user", "Alternate I. ").otherwise(""), F.lit("turn "), x["turn"].cast("string"), F.lit("</p>"))), "")
    conv = t("conversations").groupBy("conv_id").agg(body.alias("body"))  # one conversation's turns
    raw = said("<concept><title/><conbody><p>", _LONG, '</p><section outputclass="Alternate">', F.col("body"), "</section></conbody></concept>")
    c = topics.shred_topics(_files(conv, "conv_id", F.lit("1.100"), raw), _CFG).where("alternate <> ''")
    return c.select(F.col("path").cast("long").alias("conv_id"), F.col("emit").alias("span"), F.size(F.split("text", "\n")).cast("long").alias("turns"), F.regexp_extract("text", r"turn (\d+)", 1).cast("int").alias("opens"))


_BARE = "'<concept><title/><conbody><p>As prescribed in 4.' || (c_custkey % 90 + 100) || ' (a), insert the following clause:</p><p outputclass=\"SmCaps\">Terms (Feb' || (c_custkey % 30 + 1990) || ')</p><p>{long}</p>' || case c_custkey % 4 when 0 then '<p outputclass=\"Endofclause\">(End of  Provision)</p>' when 1 then '<p>(End of clause)</p>' when 2 then '<p outputclass=\"Endofprovision\">* * *</p>' else '' end || '</conbody></concept>'".replace("{long}", _LONG)


@query("unit_payloads", f"select c_custkey, 'REG-' || {_number_sql('c_custkey')} as unit, {_BARE} as raw from customer")
def _(t):
    f = _clauses(t)
    p = topics.payloads(topics.shred_topics(f, _CFG).withColumn("citation", F.concat_ws("|", "path", "citation")), f)
    return p.select(F.split("unit", "\\|")[0].cast("long").alias("c_custkey"), F.split("unit", "\\|")[1].alias("unit"), "raw")


# ------------------------------------------------------------------ maps and changes
@query(
    "map_scan",
    """with e as (select c_nationkey as map, c_custkey as k, row_number() over (partition by c_nationkey order by c_custkey) - 1 as pos from customer)
  select 'm' || map as map, 'E' || map as edition, pos::integer as pos, (row_number() over (partition by map order by pos) - 1)::integer as place, k as file from e where k % 5 <> 0
  union all select 'm' || map, '', pos::integer, -1, k from e where k % 5 = 0""",
)
def _(t):
    name = lambda k: F.concat(F.lit("d/"), k.cast("string"), F.lit(".dita"))
    refs_ = F.transform(F.array_sort(F.collect_list("c_custkey")), lambda k: F.concat(F.lit('<topicref href="'), name(k), F.lit('"/><topicref href="x.png"/><topicref href="'), name(k), F.lit('"><topicref/></topicref>')))
    maps = t("customer").groupBy("c_nationkey").agg(F.array_join(refs_, "").alias("refs")).select(said("m", F.col("c_nationkey")).alias("file"), said('<map rev=" E', F.col("c_nationkey"), '">', F.col("refs"), "</map>").alias("raw"))  # one map's own list
    files = t("customer").where("c_custkey % 5 <> 0").select(F.concat(F.lit("file:/in/"), name(F.col("c_custkey"))).alias("path"), _s("c_custkey").alias("file"), F.lit("").alias("raw"))
    found, gone = topics.scan_map(topics.map_entries(maps), files)
    a = topics.ordered(found).select("map", "edition", "pos", "place", F.col("file").cast("long").alias("file"))
    return a.unionByName(gone.select("map", F.lit("").alias("edition"), "pos", F.lit(-1).alias("place"), F.regexp_extract("file", r"(\d+)", 1).cast("long").alias("file")))


@query(
    "changelog_entries",
    """select c_custkey, 'Edition ' || c_custkey as source_version, unnest(['5.' || (c_custkey % 900 + 100), '']) as section, unnest(['REG-5.' || (c_custkey % 900 + 100), '']) as citation, unnest(['(b)(2)|(c)', '']) as paragraphs, unnest(['Did ' || c_name || ' a thing', 'plain text']) as description,
  unnest(['Case ' || c_custkey, 'no link']) as case_number, unnest(['http://fr/' || c_custkey, '']) as url from customer""",
)
def _(t):
    k = F.col("c_custkey")
    rows = said('<row><entry><p><xref/><xref outputclass="fm:ParaNumOnly">5. ', k % 900 + 100, '</xref> <xref>(b) (2)</xref><xref>6.100</xref><xref outputclass="fm:ParaNumOnly">(z)</xref><xref> (c)</xref></p></entry><entry><p>Did ', F.col("c_name"), "</p><p>a\nthing</p></entry><entry><p>x <xref href=\"http://fr/", k, '">Case  ', k, "</xref></p></entry></row>",
                "<row><entry>5.1</entry><entry>two cells</entry></row><row><entry>5.2</entry><entry> plain  text</entry><entry>no link</entry></row>")
    raw = said("<concept><table><title>other</title><tgroup><tbody><row><entry/><entry/><entry/></row></tbody></tgroup></table>", '<table otherprops="LSA"><title>Edition ', k, "</title><tgroup><tbody>", rows, "</tbody></tgroup></table></concept>")
    e = topics.changelog(_files(t("customer"), "c_custkey", F.lit("LSA"), raw), _CFG)
    n = F.regexp_extract("source_version", r"(\d+)", 1).cast("long")
    return e.select(n.alias("c_custkey"), "source_version", "section", "citation", F.array_join("paragraphs", "|").alias("paragraphs"), "description", "case_number", F.col("federal_register_url").alias("url"))


@query(
    "change_markers",
    """with m as (select p_partkey as k, p_name as n from part), u as (select k, n, unnest(['', '(a)']) as labels from m),
  x as (select k, labels, unnest([0, 1]) as pos, unnest(['new ' || n, 'inner']) as text, unnest(['E1', 'E2']) as edition, unnest(['2020-' || k, '2020-' || k]) as case_number, unnest(['better words', '']) as why from u)
  select k as p_partkey, '1.100' || labels as citation, pos::integer as pos, text, edition, case_number, why from x""",
)
def _(t):
    k = F.col("p_partkey")
    raw = said("<concept><title/><conbody><p>", _LONG, '</p><ol><li><p><ph props="autonumber">(a)</ph> <ph rev="E1"><?FM MARKER [CaseNumber] first?>new ', tx.escape_html(F.col("p_name")), "<?FM MARKER [CaseNumber] 2020-", k, "?><?FM MARKER [Why] better\n words?></ph> old</p>",
               '<p><b><ph rev="E2"><?FM MARKER [Other] z?><!-- c -->in<?FM MARKER [CaseNumber]  2020-', k, "?>ner</ph></b></p></li></ol></conbody></concept>")
    c = topics.shred_topics(_files(t("part"), "p_partkey", F.lit("1.100"), raw), _CFG)
    labels = F.array_join(F.transform("tokens", lambda y: F.concat(F.lit("("), y, F.lit(")"))), "")
    x = c.select(F.col("path").cast("long").alias("p_partkey"), F.concat("number", labels).alias("citation"), F.posexplode("changes").alias("pos", "c"))
    return x.select("p_partkey", "citation", "pos", "c.text", "c.edition", "c.case_number", "c.why")


@query(
    "source_coverage",
    f"""with d as (select c_custkey as k, length(regexp_replace(lower(c_name || '{_LONG}'), '[^a-z0-9]', '', 'g')) as n from customer)
  select k as c_custkey, (n + 16)::bigint as source, 16::bigint as missing, 'note=nowhere to be|note (tail)=other' as examples from d where k % 50 = 7 order by k limit 25""",
)
def _(t):
    k = F.col("c_custkey")
    raw = said("<concept><title/><conbody><p>", F.col("c_name"), "</p>", F.when(k % 50 == 7, "<note>nowhere to  be</note>other").otherwise(""), "<p>", _LONG, "</p></conbody></concept>")
    f = _files(t("customer"), "c_custkey", said("1.", k + 100), raw)
    chunks = topics.shred_topics(f, ShredConfig(bottom_level="section")).withColumn("citation", F.col("path"))
    found, out = topics.coverage_inputs(f, chunks)
    shown = F.array_join(F.transform("examples", lambda x: F.concat(x["tag"], F.lit("="), x["text"])), "|")
    gaps = audit.top_gaps(audit.coverage(found, out).withColumn("unit", F.col("unit").cast("long")))
    return gaps.select(F.col("unit").alias("c_custkey"), F.col("source").cast("long").alias("source"), F.col("missing").cast("long").alias("missing"), shown.alias("examples"))


# ------------------------------------------------------------------ small functions and reviews
@query("reserved_flag", "select p_partkey, p_partkey % 3 <> 2 as reserved, 'https://host.invalid/' || p_partkey || '/x' as url, case when p_partkey % 2 = 0 then 'e' || p_partkey else '' end as evidence, case p_partkey % 6 when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 4 else 5 end as rank from part")
def _(t):
    k = F.col("p_partkey")
    text = said(F.col("p_name"), F.when(k % 3 == 0, " [Reserved]..").when(k % 3 == 1, "\n[RESERVED] ").otherwise(" [Reserved] x"))
    none = F.expr("cast(array() as array<struct<kind:string,evidence:string>>)")
    mentions = F.when(k % 2 == 0, F.array(F.struct(F.lit("explicit").alias("kind"), said("e", k).alias("evidence")), F.struct(F.lit("inferred").alias("kind"), F.lit("z").alias("evidence")))).otherwise(none)
    status = F.element_at(F.array(*map(F.lit, ["llm_only", "parser_inferred", "added", "parser_explicit", "corroborated", "?"])), (k % 6 + 1).cast("int"))
    return t("part").select("p_partkey", tx.is_reserved(text).alias("reserved"), tx.url_for(F.lit("https://host.invalid/{num}/x"), _s(k)).alias("url"), tx.first_evidence(mentions).alias("evidence"), rc.status_rank(status).alias("rank"))


@query("address_map", f"select distinct unnest([a, a || '(b)']) as address from (select {_number_sql('p_partkey')} as a, p_partkey from part where p_partkey % 2 = 1) union select distinct {_number_sql('p_partkey')} from part where p_partkey % 2 = 0")
def _(t):
    k = F.col("p_partkey")
    return rc.address_map(t("part").select(said("REG-", _number(k), F.when(k % 2 == 1, " (b)").otherwise("")).alias("citation")))


@query("expand_typed", "select o_orderkey, pos::integer as pos, target from (select o_orderkey, unnest(range(5)) as pos, unnest(['5.202(a)(2)', '7.' || (o_orderkey % 900 + 100) || '(a)(3)', '7.' || (o_orderkey % 900 + 100) || '(a)(4)', '6.302-' || (o_orderkey % 9 + 1), 'see ' || o_orderkey]) as target from orders)")
def _(t):
    k = F.col("o_orderkey")
    raw = said(" 5.202(a)(2) , (a)(3) to (a)(4),,6.302-", k % 9 + 1, "-", k % 9 + 1, ", see ", k)
    return refs.mention_rows(dealt(t("orders")), ["o_orderkey"], refs.expand_typed(raw, said("7.", k % 900 + 100))).withColumnRenamed("m", "target")


@query("range_long_labels", "select o_orderkey, '5.201(' || (99999999999999999990::hugeint + o_orderkey % 9 + unnest(range(0, 3))::hugeint) || ')' as target from orders")
def _(t):
    k = F.col("o_orderkey")
    a = (F.lit("99999999999999999990").cast("decimal(38,0)") + k % 9).cast("decimal(38,0)")
    text = said("5.201(", a, ") through (", (a + 2).cast("decimal(38,0)"), ") and 1.100(", F.lpad(_s(k), 40, "9"), ") to (", F.lpad(_s(k), 41, "9"), ")")
    scopes = dealt(t("orders")).select("o_orderkey", text.alias("scope_text"))
    return refs.mention_rows(scopes, ["o_orderkey"], refs.range_mentions(F.col("scope_text"), F.lit("1.100"))).select("o_orderkey", "m.target")


# ------------------------------------------------------------------ ledgers
def _book(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A parser's edges and a finder's findings over suppliers of a part, targets of every grammar."""
    k, s_ = F.col("l_partkey"), F.col("l_suppkey")
    li = dealt(t("lineitem"))
    unit, pos = said("REG-1.", k % 700 + 100).alias("unit"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    p = li.select(unit, pos, said("2.", s_ % 300 + 100).alias("target"), F.when(s_ % 4 == 0, "II").otherwise("").alias("alternate"), F.lit("explicit").alias("confidence"), F.lit("e").alias("evidence"))
    target = F.when(s_ % 5 == 0, said("see  §", s_)).when(s_ % 5 == 1, said("Subpart 9.", s_ % 7 + 1)).when(s_ % 5 == 2, said("2.", s_ % 300 + 100, "AlternateII")).otherwise(said("2.", s_ % 300 + 100))
    f = li.select(unit, pos, target.alias("target"), F.lit("f").alias("evidence"), F.lit(None).cast("string").alias("scope"), F.lit(None).cast("string").alias("alternate"))
    addresses = t("supplier").where("s_suppkey % 2 = 0").select(said("2.", F.col("s_suppkey") % 300 + 100).alias("address")).distinct()
    return rc.parser_internal(p), rc.finder_internal(f), addresses


_BOOK = """l as (select distinct l_partkey % 700 + 100 as u, l_suppkey as s from lineitem),
  p as (select distinct u, '2.' || (s % 300 + 100) as target, case when s % 4 = 0 then '2' else '' end as alternate from l),
  f as (select distinct u, case s % 5 when 0 then 'see§' || s when 1 then 'subpart 9.' || (s % 7 + 1) else '2.' || (s % 300 + 100) end as target, case when s % 5 = 2 then '2' else '' end as alternate from l),
  addr as (select distinct '2.' || (s_suppkey % 300 + 100) as address from supplier where s_suppkey % 2 = 0),
  led as (select coalesce(p.u, f.u) as u, coalesce(p.target, f.target) as target, coalesce(p.alternate, f.alternate) as alternate, case when p.u is not null and f.u is not null then 'corroborated' when p.u is not null then 'parser_explicit' else 'llm_only' end as status from p full join f on p.u = f.u and p.target = f.target and p.alternate = f.alternate),
  book as (select 'REG-1.' || u as unit, u, led.target, alternate, status, case when target like 'see%' then 'invalid' when target in (select address from addr) then 'resolves' else 'not_loaded' end as validation from led)"""


@query("ledger_validation", f"with {_BOOK} select unit, target, alternate, status, validation from book")
def _(t):
    return rc.reconcile_internal(*_book(t)).select("unit", "target", "alternate", "status", "validation")


@query(
    "ledger_order",
    f"""with {_BOOK}, k as (select *, case when target like '2.%' then 0 else 1 end as a, case when target like '2.%' then cast(substr(target, 3) as integer) when target like 'see%' then cast(substr(target, 5) as integer) else 9 end as b, case when target like 'subpart%' then cast(split_part(target, '.', 2) as integer) else 0 end as c from book)
  select unit, target, alternate, row_number() over (partition by unit order by a, b, c, target, alternate) as place from k""",
)
def _(t):
    b = rc.reconcile_internal(*_book(t)).withColumn("locator", F.lit(None).cast("string"))
    return b.select("unit", "target", "alternate", F.row_number().over(Window.partitionBy("unit").orderBy(*rc.ledger_order(b))).alias("place"))


@query("finder_overlap", f"with {_BOOK} select case status when 'parser_explicit' then 'parser_only' else status end as part, count(*) as n from book group by 1")
def _(t):
    p, f, _ = _book(t)
    out = rc.overlap(p, f, ["unit", "target", "alternate"])
    parts = [d.agg(F.count("*").alias("n")).withColumn("part", F.lit(k)) for k, d in out.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("n > 0")


@query("page_rows", f"with {_BOOK} select unit, target, alternate, status from book where status in ('llm_only', 'corroborated')")
def _(t):
    return rc.page_rows(rc.reconcile_internal(*_book(t)), ["llm_only", "corroborated"], ["internal"]).select("unit", "target", "alternate", "status")


@query("judge_verdicts", f"with {_BOOK}, v as (select 'REG-1.' || (o_orderkey % 700 + 100) as unit, '2.' || (o_orderkey % 300 + 100) as target, max(o_orderkey) as top from orders group by 1, 2) select b.unit, b.target, b.alternate, coalesce('v' || top, '') as choice from book b left join v on b.unit = v.unit and b.target = v.target and b.alternate = '' and status = 'llm_only'")
def _(t):
    k = F.col("o_orderkey")
    v = t("orders").groupBy(said("REG-1.", k % 700 + 100).alias("unit"), said("2.", k % 300 + 100).alias("target")).agg(said("v", F.max(k)).alias("choice"))
    v = v.select("*", F.lit("").alias("alternate"), F.lit(None).cast("array<string>").alias("value"), F.lit(None).cast("string").alias("rationale"))
    return rc.attach_verdicts(rc.reconcile_internal(*_book(t)), v).select("unit", "target", "alternate", F.coalesce("judge.choice", F.lit("")).alias("choice"))


@query("unit_findings", "select c_custkey, count(o_orderkey) as findings from customer left join orders on c_custkey = o_custkey and o_orderkey % 4 = 0 group by c_custkey")
def _(t):
    units = rc.base_units(t("customer").select(_s("c_custkey").alias("citation"), F.lit("section").alias("type"), F.lit("").alias("alternate"))).select(F.col("citation").alias("unit"))
    found = t("orders").where("o_orderkey % 4 = 0").select(_s("o_custkey").alias("unit"), _s("o_orderkey").alias("target"))
    return rc.findings_of(units, found).groupBy(F.col("unit").cast("long").alias("c_custkey")).agg(F.count("target").alias("findings"))


def _ext(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """External edges of units, decisions on them, and their ledger."""
    k, o = F.col("l_partkey"), F.col("o_orderkey")
    none = F.lit(None).cast("string")
    about = [F.lit("usc").alias("ref_type"), F.lit("n").alias("node_label"), F.lit("").alias("href"), F.lit("c").alias("citation"), F.array(F.lit("x")).alias("division_levels")]
    edges = dealt(t("lineitem")).select(said("R", k % 900).alias("unit"), said("usc:1/", k % 40).alias("target"), F.lit("").alias("locator"), F.lit("").alias("row_alternate"), *about).distinct()
    found = t("orders").select(said("R", o % 900).alias("unit"), said("usc:1/", o % 60).alias("target"), F.lit("").alias("locator"), *about).distinct()
    book = found.withColumns({"scope": F.lit("external"), "status": F.lit("llm_only")})
    edit = F.when(o % 3 == 1, F.struct(said("The Act ", o % 10).alias("document"), F.lit("8(a)").alias("section"), F.lit("act").alias("ref_type")))
    d = t("orders").select(said("R", o % 900).alias("unit"), F.lit("external").alias("scope"), said("usc:1/", o % 60).alias("target"), F.lit("").alias("locator"), none.alias("alternate"), F.lit("llm_only").alias("status"),
                           F.when(o % 3 == 0, "accept").when(o % 3 == 1, "manual").otherwise("reject").alias("choice"), F.lit(None).cast("array<string>").alias("value"), edit.alias("edit"), F.when(o % 2 == 0, "auto").alias("by"), F.lit(0).alias("file_idx"), o.alias("item_idx"))
    return edges, ap.merge_decisions(d), book


@query(
    "apply_external",
    """with e as (select distinct 'R' || (l_partkey % 900) as unit, 'usc:1/' || (l_partkey % 40) as target from lineitem),
  d as (select 'R' || (o_orderkey % 900) as unit, 'usc:1/' || (o_orderkey % 60) as target, max(o_orderkey) as o, min(o_orderkey) as first_at from orders group by 1, 2),
  kept as (select * from e where not exists (select 1 from d where d.unit = e.unit and d.target = e.target and o % 3 <> 0)),
  new as (select unit, target, '' as locator, '' as levels, first_at, o from d where o % 3 = 0 and unit in (select unit from e) union all select unit, 'act:the-act-' || (o % 10), '8(a)', 'The Act ' || (o % 10) || '|8|a', first_at, o from d where o % 3 = 1 and unit in (select unit from e)),
  once as (select unit, target, locator, arg_min(levels, first_at) as levels, arg_min(o, first_at) as o from new group by unit, target, locator)
  select unit, target, locator, case when levels = '' then 'x' else levels end as levels, case when o % 2 = 0 then 'auto_accepted' else 'human_approved' end as status from once n where not exists (select 1 from kept k where k.unit = n.unit and k.target = n.target and n.locator = '')
  union all select unit, target, '', 'x', 'parser_only' from kept""",
)
def _(t):
    edges, d, book = _ext(t)
    kept = ap.tag_and_drop(edges, d, book, "external")
    new = ap.additions_external(d, kept, book, edges)
    out = ["unit", "target", "locator", F.array_join("division_levels", "|").alias("levels"), "status"]
    return kept.select(*out).unionByName(new.select(*out))


@query("run_counters", f"with {_BOOK} select count(*) as rows, count(*) filter (status = 'llm_only') as to_review, count(*) filter (status = 'corroborated') as corroborated, (select greatest(count(distinct u) - (select count(*) from nation), 0) from book) as cache_hits from book")
def _(t):
    b = rc.reconcile_internal(*_book(t))
    return run.counters(b, t("nation").count()).select("rows", "to_review", "corroborated", "cache_hits")
