"""Authored topics through the whole plan: shred, extract, reconcile, decide, apply."""

import json

import pytest
from pyspark.sql import functions as F

from skein.operators import audit
from skein.operators import reconcile as rc
from skein.plans import run
from skein.sources import tables, topics
from skein.sources.topics import ShredConfig

MAIN = """<?xml version="1.0"?><!DOCTYPE concept PUBLIC "x" "y">
<concept><title><ph props="autonumber">5.201</ph> General.</title><conbody>
<p>See <xref href="5.202.xml#REG_5_202">5.202</xref>(a)(1) and <xref href="6.302.xml#REG_6_302">6.302</xref> under 41 U.S.C. 1303, paragraphs (a) through (c) apply. <ph rev="E1"><?FM MARKER [CaseNumber] 2020-1?>new<?FM MARKER [Why] better  words?></ph></p>
<ol><li><p><ph props="autonumber">(a)</ph> First <image href="i/a.png"/> item.</p>
<ol><li><p><ph props="autonumber">(1)</ph> Deep item, see paragraph (b)(2) of this section.</p></li></ol></li>
<li><p>no label</p><ol><li><p><ph props="autonumber">(b)</ph> Second.</p></li></ol></li></ol>
<table><title>T</title><tgroup cols="2"><colspec colname="c1" colnum="1"/><colspec colname="c2" colnum="2"/><tbody><row><entry namest="c1" nameend="c2">x &lt; y</entry></row></tbody></tgroup></table>
<p>Form <xref href="https://example.invalid/sf33/" scope="external">Standard Form 33</xref> <xref href="mailto:a@b" scope="external">mail</xref></p>
</conbody></concept>"""
CLAUSE = """<concept><title><ph props="autonumber">52.204-8</ph> C</title><conbody>
<p>As prescribed in 4.1202 (a), insert the following provision:</p><p outputclass="SmCaps">Certifications (Feb 2024)</p><p>Text of the basic provision that is long enough.</p>
<p outputclass="Endofclause">(End of provision)</p>
<section outputclass="Alternate"><p>dropped</p><p><i>Alternate II</i> (Mar 2001). As prescribed in 4.1202(b), add this.</p><p>More.</p><p>Alternate IV (Apr 2002). Other.</p></section>
</conbody></concept>"""
FILES = {"5.201": MAIN, "52.204-8": CLAUSE, "5.202": "<topic><title/><body><p>Plain topic body which holds enough characters to be kept.</p></body></topic>", "5.203": "<concept><title/></concept>", "5.204": "<concept><conbody><p>tiny</p></conbody></concept>", "5.205": "<broken", "cover": MAIN, "6.302": "<concept><conbody><p>Another body with more than forty characters in it.</p></conbody></concept>"}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("topics")
    for n, x in FILES.items():
        (d / f"{n}.dita").write_text(x, encoding="utf-8")
    return str(d)


@pytest.fixture(scope="module")
def built(spark, files):
    cfg = ShredConfig(bottom_level="subparagraph")
    f = [("REG-5.201", 0, "5.202", "e", None), ("REG-5.201", 1, "6.302", "e6", "internal"), ("REG-5.201", 2, "Part 9", "p", "internal"), ("REG-5.201", 3, "41 U.S.C. 1303", "s", "external"), ("REG-5.201", 4, "nothing known", "n", "external"), ("REG-5.201", 5, "5.201", "self", "internal"), ("REG-5.201", 6, "5.203(a) Alternate I", "alt", "internal")]
    findings = spark.createDataFrame([(*x[:5], None, None) for x in f], tables.FINDING)
    return run.build(topics.scan_folder(spark, files), cfg, findings)


def test_shred(built):
    rows = {(r.citation, r.alternate): r for r in built.chunks.collect()}
    unit = rows["REG-5.201", ""]
    assert [k for k in sorted(rows) if k[0].startswith("REG-5.201")] == [("REG-5.201", ""), ("REG-5.201(a)", ""), ("REG-5.201(a)(1)", ""), ("REG-5.201(b)", "")]
    assert unit.images == ["a.png"] and unit.changes[0].case_number == "2020-1" and unit.changes[0].why == "better words"
    assert '<table><caption>T</caption><tbody><tr><td colspan="2">x &lt; y</td></tr></tbody></table>' in unit.text
    assert (unit.part, unit.subpart, unit.section) == ("5", "2", "01")
    clause = rows["REG-52.204-8", ""]
    assert (clause.type, clause.instrument, clause.date, clause.prescribed_by, clause.end_marker) == ("subsection", "provision", "Feb 2024", "4.1202(a)", "(End of provision)")
    assert rows["REG-52.204-8", "2"].text.endswith("More.") and rows["REG-52.204-8", "2"].date == "Mar 2001"
    assert "Alternate" not in clause.text and ("REG-52.204-8", "4") in rows


def test_edges(built):
    e = {(r.target, r.confidence) for r in built.internal.where("chunk_id = 'REG-5.201|'").collect()}
    assert e == {("5.202(a)(1)", "inferred"), ("6.302", "explicit"), ("6.302(a)", "inferred"), ("6.302(b)", "inferred"), ("6.302(c)", "inferred"), ("5.201(b)(2)", "inferred")}
    x = {r.target: r for r in built.external.where("chunk_id = 'REG-5.201|'").collect()}
    assert set(x) == {"usc:41/1303", "form:SF-33"} and x["form:SF-33"].href == "https://example.invalid/sf33/"


def test_ledger_and_apply(spark, built):
    got = {(r.scope, r.target, r.alternate): (r.status, r.validation, r.needs_review) for r in built.ledger.where("unit = 'REG-5.201'").collect()}
    assert got["internal", "6.302", ""] == ("corroborated", "resolves", False)
    assert got["internal", "part 9", ""] == ("llm_only", "not_loaded", True)
    assert got["internal", "5.203(a)", "1"][0] == "llm_only"
    assert got["internal", "5.202", ""] == ("llm_only", "resolves", True)
    assert got["external", "usc:41/1303", None][0] == "corroborated"
    assert not any(k[1] == "5.201" for k in got) and not any("nothing" in k[1] for k in got)
    auto = rc.auto_decisions(built.ledger).withColumns({"edit": F.lit(None).cast("struct<document:string,section:string,ref_type:string>"), "file_idx": F.lit(0), "item_idx": F.monotonically_increasing_id()})
    more = auto.where("target = 'part 9'").withColumns({"choice": F.lit("reject"), "file_idx": F.lit(1), "by": F.lit(None).cast("string")})
    internal, _ = run.verified(built, auto.unionByName(more))
    st = {(r.target, r.status) for r in internal.where("unit = 'REG-5.201'").collect()}
    assert ("6.302", "corroborated") in st and ("5.202", "auto_accepted") in st and not any(t == "part 9" for t, _ in st)


def test_manifest_and_missing(spark, files):
    cfg = ShredConfig()
    m = {r.file: r.reason for r in topics.manifest(topics.shred_topics(topics.scan_folder(spark, files), cfg)).collect()}
    assert m["5.203"].startswith("no body") and m["5.204"] == "near-empty" and m["5.205"].startswith("no topic") and m["cover"].startswith("non-numeric") and m["5.201"] == ""
    df, missing = topics.scan_files(spark, files, ["5.201", "9.999"])
    assert df.count() == 1 and missing.collect()[0].file == "9.999"


def test_map_changes_and_sinks(spark, tmp_path):
    assert topics.parse_map('<map rev=" E 1 "><topicref href="a.dita"/><topicref href="a.dita"/><topicref href="b.txt"/></map>') == ("E 1", ["a.dita"])
    lsa = '<concept><table otherprops="LSA"><title>Edition 1</title><tgroup><tbody><row><entry><p><xref outputclass="fm:ParaNumOnly">5.201</xref> <xref>(b) (2)</xref></p></entry><entry><p>Did a</p><p>thing</p></entry><entry><xref href="http://x">Case 1</xref></entry></row><row><entry/><entry/></row></tbody></tgroup></table></concept>'
    e = topics.changelog(spark.createDataFrame([(lsa,), ("<x/>",), ("<broken",), (None,)], "raw string"), ShredConfig()).collect()
    assert len(e) == 1 and (e[0]["section"], e[0]["paragraphs"], e[0]["description"], e[0]["case_number"], e[0]["source_version"]) == ("5.201", ["(b)(2)"], "Did a thing", "Case 1", "Edition 1")
    df = spark.range(2).withColumn("é", F.lit("x"))
    tables.write_json_array(df, str(tmp_path / "o.json"))
    assert json.loads((tmp_path / "o.json").read_text())[1] == {"id": 1, "é": "x"}
    (tmp_path / "f.json").write_text('{"U": [{"target": "t", "evidence": "e"}]}')
    assert tables.read_findings(spark, str(tmp_path / "f.json")).first().target == "t"
    (tmp_path / "d.json").write_text('[{"unit": "U", "choice": "accept"}, {"unit": "V"}]')
    assert tables.read_decisions(spark, [str(tmp_path / "d.json")] * 2).count() == 4


def test_run_and_its_tables(spark, files, built, tmp_path):
    out = str(tmp_path / "out")
    usage = spark.createDataFrame([("audit", "u", 1, 2, 3, 6, True)], tables.USAGE)
    _, missing = topics.scan_files(spark, files, ["9.999"])
    run.write_run(built, out, usage=usage, missing=missing)
    read = lambda n, kind="json": spark.read.format(kind).load(f"{out}/{n}")
    assert read("chunks", "parquet").count() == built.chunks.count() and read("ledger", "parquet").count() == built.ledger.count()
    m = {r.file: r.outcome for r in read("manifest").collect()}
    assert m["9.999"] == "skipped" and m["5.201"] == "processed"
    s = read("summary").first()
    assert s.rows == built.ledger.count() and s.cache_hits == max(0, s.units - 1) and s.to_review == built.ledger.where("needs_review").count()
    d = [("REG-5.201", "internal", "6.302", "", "", "corroborated", "reject", None, None, None, 0, 0), ("REG-5.201", "internal", "9.1", "", "", "added", "accept", None, None, None, 0, 1)]
    run.write_applied(built, spark.createDataFrame(d, tables.DECISION + ", file_idx int, item_idx int"), out)
    a = read("applied").first()
    assert (a.added, a.removed) == (1, 1)
    assert read("verified_internal", "parquet").where("target = '9.1' and status = 'human_approved'").count() == 1
    built.close()


def test_address_cache_follows_the_files(spark, files, tmp_path):
    cfg, path = ShredConfig(), str(tmp_path / "map")
    all_ = topics.scan_folder(spark, files)
    first = {r.address for r in run.cached_addresses(spark, all_, cfg, path).collect()}
    assert "5.201" in first and first == {r.address for r in run.cached_addresses(spark, all_, cfg, path).collect()}
    less = {r.address for r in run.cached_addresses(spark, all_.where("file <> '5.201'"), cfg, path).collect()}
    assert less and not {"5.201", "5.201(a)"} & less
    assert len(list((tmp_path / "map").iterdir())) == 2


def test_config_precedence(tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text('{"a": 2, "b": 2, "c": 2}')
    monkeypatch.setenv("SKEIN_B", "3")
    monkeypatch.setenv("SKEIN_C", "3")
    assert run.load_config({"a": 1, "b": 1, "c": 1, "d": 1}, str(tmp_path / "c.json"), overrides={"c": 4, "d": None}) == {"a": 2, "b": "3", "c": 4, "d": 1}


def test_map_scan(spark):
    maps = spark.createDataFrame([("m", '<map rev=" E "><topicref href="d/b.dita"/><topicref href="a.dita"/><topicref href="d/b.dita"/><topicref href="c.dita"/></map>'), ("broken", "<map>")], "file string, raw string")
    have = spark.createDataFrame([("f:/x/a.dita", "a", "A"), ("f:/x/d/b.dita", "b", "B")], "path string, file string, raw string")
    found, gone = topics.scan_map(topics.map_entries(maps), have)
    assert [(r.edition, r.place, r.raw) for r in topics.ordered(found).orderBy("pos").collect()] == [("E", 0, "B"), ("E", 1, "A")]
    assert [(r.file, r.skip_reason) for r in gone.collect()] == [("c.dita", "not found")]


def test_usage_stream_by_window(spark, tmp_path):
    from skein.streaming.editions import usage_by_window

    rows = spark.createDataFrame([("audit", 5, 0), ("audit", 6, 30), ("judge", 1, 700)], "stage string, total long, sec long").selectExpr("stage", "total", "timestamp_seconds(sec) as at")
    rows.write.parquet(str(tmp_path / "in"))
    q = usage_by_window(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("usage_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.stage, r.calls, r.total) for r in spark.table("usage_windows").collect()} == {("audit", 2, 11), ("judge", 1, 1)}


def test_strip_alternates(spark):
    raw = spark.createDataFrame([(CLAUSE,)], "raw string").select(topics.strip_alternates(F.col("raw")).alias("x")).first().x
    assert "Alternate" not in raw and "basic provision" in raw


def test_stream(spark, files, tmp_path):
    from skein.streaming.editions import stream_topics

    q = stream_topics(spark, files, ShredConfig()).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).where("skip_reason is null").count() > 5


def test_usage_total(spark):
    u = spark.createDataFrame([("audit", "u", 1, 2, 3, 6, True), ("judge", "u", 1, 1, 1, 3, False)], tables.USAGE)
    assert {(r.stage, r.calls, r.total) for r in audit.usage_rollup(u).collect()} == {("audit", 1, 6), ("judge", 1, 3), ("total", 2, 9)}
