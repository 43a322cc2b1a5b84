"""Hand-derived vectors of the scalar functions and of reference extraction."""

import pytest
from pyspark.sql import functions as F

from skein.functions import citation as ci
from skein.functions import external as ex
from skein.functions import text as tx
from skein.functions.matches import finditer
from skein.operators import audit, refs

L = F.lit


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_text(spark):
    assert one(spark, tx.norm(L("  a \n b \u001c "))) == "a b"
    assert one(spark, tx.norm(L(None))) == ""
    assert one(spark, tx.tok(L("(a)(1)"))) == "a1"
    assert one(spark, tx.window(L("abc  def"), L(1), L(6))) == "…bc d…"
    assert one(spark, tx.is_reserved(L("1.1  [Reserved]. ."))) is False
    assert one(spark, tx.is_reserved(L("1.1  [Reserved]."))) is True
    assert one(spark, tx.image_id(L("a/b.png"))) == "b.png"
    assert one(spark, tx.image_id(L(""))) == "image"


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("a", "f", list("abcdef")), ("1", "42", None), ("3", "1", None), ("ii", "vi", ["ii", "iii", "iv", "v", "vi"]), ("i", "iv", ["i", "ii", "iii", "iv"]), ("i", "v", None), ("c", "d", None), ("A", "D", list("ABCD")), ("a", "D", None), ("1", "a", None), ("a", "a", ["a"]), ("", "a", None)],
)
def test_enumerate(spark, a, b, want):
    assert one(spark, ci.enumerate_tokens(L(a), L(b))) == want


def test_enumerate_cap(spark):
    assert len(one(spark, ci.enumerate_tokens(L("1"), L("41")))) == 41


def test_addresses(spark):
    for s, want in [("52.247-64", ("52", "2", "47", "64")), ("5.202", ("5", "2", "02", "")), ("1.105-2", ("1", "1", "05", "2"))]:
        assert tuple(one(spark, c) for c in ci.components(L(s)).values()) == want
    for h, want in [("5.202.xml#REG_5_202", "5.202"), ("x#REG_Subpart_9_4", "subpart 9.4"), ("x#REG_Part_19", "part 19"), ("x#REG_52_204_8", "52.204-8"), ("x#REG_22_1503/d1", "22.1503/d1"), ("x#zzz", "zzz")]:
        assert one(spark, ci.href_to_citation(L(h), "REG")) == want
    for s, want in [(" 5.202 (a) (2) ", "5.202(a)(2)"), ("Subpart  9.4", "subpart 9.4"), ("Parts 14 and 15", "part 15")]:
        assert one(spark, ci.norm_citation(L(s))) == want
    assert [one(spark, ci.alternate_number(L(x))) for x in ("IV", "1", "")] == ["4", "1", ""]
    assert one(spark, ci.int_to_roman(L(1994))) == "mcmxciv"
    p = ci.split_alternate(L("52.204-30 Alternate II"))
    assert (one(spark, p["base"]), one(spark, p["alternate"])) == ("52.204-30", "II")


def test_order(spark):
    want = ["7.3", "7.103", "7.103(c)(2)(v)", "7.103(c)(2)(ix)", "7.103(c)(10)", "7.103-9", "7.103-12", "12.5", "part 3", "subpart 11.2"]
    df = spark.createDataFrame([(x,) for x in sorted(want)], "t string").orderBy(ci.sort_key(F.col("t")))
    assert [r.t for r in df.collect()] == want


@pytest.mark.parametrize(
    ("s", "want"),
    [("41 U.S.C. 1303(a)(4)", ("usc:41/1303", "(a)(4)", ["41", "1303", "a", "4"])), ("10 U.S.C. chapter 137", ("usc:10/ch137", "", ["10", "chapter", "137"])), ("13 CFR 128.300", ("cfr:13/128.300", "", ["13", "128", "300"])), ("E.O. 11246", ("eo:11246", "", ["11246"])), ("Pub. L. 118-31", ("publ:118-31", "", ["118", "31"])), ("OMB Circular A-76", ("omb:A-76", "", ["A", "76"])), ("41 u.s.c. 1303", None)],
)
def test_external(spark, s, want):
    r = one(spark, ex.parse_external(L(s)))
    assert (r and (r.target, r.locator, r.division_levels)) == want


def test_forms_and_manual_edges(spark):
    assert one(spark, ex.parse_form(L("Standard Form 33"))).target == "form:SF-33"
    assert one(spark, ex.parse_form(L("list of 12"))).target == "form:OF-12"
    r = one(spark, ex.build_edge(L("Small Business Act"), L("8(a)"), L("act")))
    assert (r.target, r.division_levels, r.citation) == ("act:small-business-act", ["Small Business Act", "8", "a"], "section 8(a) of the Small Business Act")


@pytest.mark.parametrize(
    ("t", "want"),
    [("5.203(a) through (d)", ["5.203(a)", "5.203(b)", "5.203(c)", "5.203(d)"]), ("5.202(a)(1), (a)(4) through (a)(9)", [f"5.202(a)({i})" for i in range(4, 10)]), ("(a)(1)-(b)(3)", []), ("6.302-1 through 6.302-5", [f"6.302-{i}" for i in range(1, 6)]), ("6.302-1 through -5", []), ("(a) to (c)", ["5.201(a)", "5.201(b)", "5.201(c)"])],
)
def test_ranges(spark, t, want):
    assert [m.target for m in one(spark, refs.range_mentions(L(t), L("5.201")))] == want


def test_finditer_offsets(spark):
    got = one(spark, finditer(L("é🎉 ab12 x 345"), r"\d+"))
    assert [(m.start, m.end, m.match) for m in got] == [(5, 7, "12"), (10, 13, "345")]


@pytest.mark.parametrize(
    ("answer", "want"),
    [('[] [{"a": 1}]', '[{"a": 1}]'), ('Sure ```json\n[{"a": 2}]\n```', '[{"a": 2}]'), ("no json", None), ("", None), (None, None), ('```json\n[{"a": 3}]\n```', '[{"a": 3}]'), ('[{"a": "use ```json x``` here"}]', '[{"a": "use ```json x``` here"}]'),
     ('[1] [ {"a": 2}, 3', '[1]'), ('{} {"b": 1} {"c": 2}', '{"b": 1}'), ("[[1], [2]] [3]", "[[1], [2],3]"), ("[" * 5000, None), ("{} {}", "{}")],
)
def test_answers(spark, answer, want):
    assert one(spark, audit.merged_json(F.array(*map(L, audit.json_values(answer or ""))).cast("array<string>"))) == want


def test_parsed_answers(spark):
    df = spark.createDataFrame([('x [{"a": 1}] [{"a": 2}]',), ("none",), (None,)], "answer string")
    assert [[x.a for x in r.parsed] if r.parsed else None for r in audit.parse_answers(df, "answer", "array<struct<a:int>>").collect()] == [[1, 2], None, None]


def test_long_labels_never_stop_a_job(spark):
    n = "9999999999999999999"
    for t, want in [(f"5.201({n}8) through ({n}9)", [f"5.201({n}8)", f"5.201({n}9)"]), (f"5.201({n * 2}8) to ({n * 2}9)", []), (f"6.302-{n}8 to 6.302-{n}9", [])]:
        assert [m.target for m in one(spark, refs.range_mentions(L(t), L("5.201")))] == want


def test_gaps(spark):
    rows = [("u", 0, "p", "Zeta  said"), ("u", 1, "note", "lost words"), ("u", 2, "p (tail)", "a b"), ("u", 3, "p", "another"), ("u", 4, "x", "fourth one"), ("u", 5, "x", "fifth"), ("u", 6, "x", "y" * 99), ("v", 0, "p", "a-b"), ("w", 0, "p", "x")]
    frag = spark.createDataFrame(rows, "unit string, at int, tag string, fragment string")
    out = spark.createDataFrame([("u", "zeta SAID"), ("v", "-")], "unit string, text string")
    cov = audit.coverage(frag, out)
    top = audit.top_gaps(cov, shown=3).collect()
    assert [(r.unit, r.missing, [tuple(x) for x in r.examples]) for r in top] == [("u", 131, [("note", "lost words"), ("p", "another"), ("x", "fourth one")])]
    s = audit.coverage_summary(cov).first()
    assert (s.units, s.missing, s.gaps, s.percent) == (2, 133, 1, round(100 * (1 - 133 / 141), 4))
    assert {r.tag: r["count"] for r in audit.dropped_tags(cov).collect()} == {"x": 3, "note": 1, "p": 1}
    assert audit.coverage_summary(cov.limit(0)).first().percent == 100.0


@pytest.mark.parametrize(("raw", "want"), [(" 5.202(a) - (c), 9.1 ,, x", ["5.202(a)", "5.202(b)", "5.202(c)", "9.1", "x"]), ("(a)-(b)", ["1.5(a)", "1.5(b)"]), ("6.302-1-3", ["6.302-1", "6.302-2", "6.302-3"]), ("(a)(1)-(b)(3)", ["(a)(1)-(b)(3)"]), ("6.3-9 to 6.3-1", ["6.3-9 to 6.3-1"]), (None, [])])
def test_typed(spark, raw, want):
    assert one(spark, refs.expand_typed(L(raw).cast("string"), L("1.5"))) == want


def test_alternates_in_targets(spark):
    for s, want in [("52.204-30AlternateII", ("52.204-30", "II")), ("5.1 Alternate iv ", ("5.1", "IV")), ("5.1 Alternate", ("5.1 Alternate", ""))]:
        p = ci.split_alternate(L(s))
        assert (one(spark, p["base"]), one(spark, p["alternate"])) == want


def test_cost(spark):
    assert one(spark, audit.cost(L(1_000_000), L(100_000), L(100_000), 1.25, 10.0)) == 3.25
