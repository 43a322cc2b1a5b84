"""The pipeline end to end, against its stages' definitions."""

from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, cols = docs.count(), docs.columns
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == cols, name
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept and ids
        kept = set(ids)
    assert len(kept) < n
    packed = cp.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_stay_once(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    text = {k: " ".join(f"{k}{i * i}" for i in range(120)) for k in "abcd"}
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b"), (3, "c"), (4, "c"), (None, "d"), (None, "d"), (5, ""), (5, ""), (6, None), (6, None)]
    few = spark.createDataFrame([(i, text.get(k, k)) for i, k in rows], "doc_id long, text string").repartition(3)
    docs = d.unionByName(few, allowMissingColumns=True)
    once = cp.keep_one_near_duplicate(spark, docs, SF)
    want = sorted([(1, text["a"]), (3, text["b"]), (3, text["c"]), (None, text["d"]), (5, ""), (6, None)], key=str)
    assert sorted(((r.doc_id, r.text) for r in once.collect()), key=str) == want
    assert sorted(((r.doc_id, r.text) for r in cp.cut_repeats(spark, once, SF).collect()), key=str) == want


def test_cut_repeats_tells_rows_of_one_id_apart(spark):
    from skein.llm import substring_dedup

    part, own = "p" + "xyz " * 20 + "".join(f"{i} " for i in range(90)), {k: " ".join(f"{k}{i * i}" for i in range(40)) for k in "abc"}
    df = spark.createDataFrame([(1, own["a"] + part), (1, own["b"]), (None, part + own["c"])], "doc_id long, text string").repartition(2)
    got = sorted(((r.doc_id, r.text) for r in substring_dedup.without_repeats(df).collect()), key=str)
    assert got == sorted([(1, own["a"]), (1, own["b"]), (None, own["c"])], key=str)


CLASH = ("score", "found", "base", "class_id", "kept", "row", "sha", "runs", "whole", "_text", "_id", "_score", "_had", "_order", "_sha", "h", "words")


def test_stages_with_odd_rows_and_clashing_columns(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    long = " ".join(f"w{i * i % 9973} {i}" for i in range(60_000))
    odd = [(9001, None), (9002, ""), (9003, " \n "), (9004, long), (None, "A null id with enough words to be a text of its own."), (9005, "token = ABCDEFGHIJKLMNOP12 é🎉 end")]
    docs = d.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True).withColumns({c: F.lit("kept") for c in CLASH}).repartition(3)
    docs.cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    cols = docs.columns
    kept = lambda out: all(r[c] == "kept" for r in out for c in CLASH)

    good = cp.keep_quality(spark, docs, SF)
    one = cp.keep_one_near_duplicate(spark, docs, SF)
    cut = cp.cut_repeats(spark, docs, SF)
    masked = cp.mask_secrets(spark, docs, SF)
    for out in (good, one, cut, masked):
        assert out.columns == cols and kept(out.collect())
    assert all(r.text == texts[r.doc_id] for r in good.unionByName(one).collect())
    assert {None, 9001, 9002, 9003, 9004, 9005} <= {r.doc_id for r in one.collect()}
    after = {r.doc_id: r for r in cut.collect()}
    assert {None, 9001, 9002, 9003, 9004, 9005} <= set(after) and after[9001].text is None and after[9004].text == long
    hidden = {r.doc_id: r for r in masked.collect()}
    assert set(hidden) == set(texts) and hidden[9001].text is None and hidden[9002].text == ""
    assert hidden[9005].text == "[SECRET] é🎉 end" and hidden[9005].n_chars == len(hidden[9005].text) and hidden[9004].text == long
    packed = cp.pack_sequences(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(texts) and sum(r.length for r in packed if r.doc_id in (9001, 9002)) == 2
    docs.unpersist()
