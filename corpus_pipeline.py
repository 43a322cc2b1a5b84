"""The corpus pipeline: five stages over ``documents``, each calling one training-data operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``.  All but the last return the columns of ``documents``, whatever other columns those
are: names of the stages' own begin with ``_skein_``, which no input column may.  A null id, an empty or null
text, a very long text and an empty table are rows like any other in every stage; each stage says what becomes
of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import minhash, packing, quality, secrets, substring_dedup
from skein.llm.common import materialize
from skein.llm.queries import crc_mod, table, vocabulary

#: Documents whose quality score is below this go.
MIN_QUALITY = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: train on the labelled rows of the training fold, keep what scores high enough.

    Null texts score as empty ones, and repeated rows each get the same score.  Without labels of both kinds
    nothing but the kind that is there is known: all texts stay or go alike, and with no labels at all they stay.
    """
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2)
    model = quality.train(docs, labels)
    return quality.score(docs, model, out_col="_skein_score").where(F.col("_skein_score") >= MIN_QUALITY).select(*docs.columns)


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each class of near duplicates the document with the smallest id stays, null ids last.

    Rows are told apart by a number of their own: of repeated rows one stays, and rows of one id with
    different texts are judged each by its text.
    """
    row, order, sha, cls = "_skein_row", "_skein_order", "_skein_sha", "_skein_class"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    classes = minhash.near_duplicates(rows.select(row, "text"), id_col=row).select(row, F.col("class_id").alias(cls))
    same = [c for c in docs.columns if c != "text"]
    ids = rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row).alias(order), F.sha2("text", 256).alias(sha), *same)
    of = materialize(ids.join(classes, row), "classes")
    least = lambda *by: of.groupBy(*by).agg(F.min(order)[row].alias(row)).select(row)
    # texts without words link with nothing, so whole rows that repeat are found by their columns
    stay = least(cls).join(least(sha, *same), row, "left_semi")
    gone = materialize(of.select(row).join(stay, row, "left_anti"), "gone")
    few = gone.count() <= minhash.BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: repeated 200-byte strings are cut out; a document that they filled goes.

    Texts that were null or empty before stay as they are, and rows of one id are judged each by its text.
    """
    had = docs.withColumn("_skein_had", F.length("text") > 0)
    out = substring_dedup.without_repeats(had).where(~F.coalesce("_skein_had", F.lit(False)) | (F.length("text") > 0))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every span found, base or added, is replaced by a mask; a null text stays null."""
    texts = docs.select("text", F.struct(*docs.columns).alias("_skein_doc"))
    found = secrets.scan(texts, secrets.train(texts))
    masked = F.when(F.col("text").isNotNull(), secrets.redacted(F.col("_text"), F.col("found")))
    new = found.select("_skein_doc", masked.alias("_skein_text"))
    own = {"text": F.col("_skein_text"), "n_chars": F.char_length("_skein_text").cast("long")}
    return new.select(*[own.get(c, F.col("_skein_doc")[c]).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: all remaining documents in sequences of 2048 tokens; a null or empty text is its end mark."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", keep_one_near_duplicate),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: SQL expresses none of the learnt stages; the tests hold run() against its stages one by one, and with cases of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
