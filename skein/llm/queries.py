"""The thin ``opN_*`` queries: production parameters, whole tables, digests where a contract asks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARIES = "/opt/tokenizers"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file: the installed package's, else the documented folder's."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{VOCABULARIES}/{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, m: int) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm import quality

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2)
    model = quality.train(docs, labels)
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm import language_model

    docs = table(spark, sf_dir, "documents")
    out = language_model.score(docs, "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2")
    return out.withColumn("held_out", crc_mod("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm import secrets

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.render(F.col("base")), 256).alias("base_sha256"),
        secrets.render(F.col("found")).alias("spans"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.substring_dedup import digests

    return digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_bpe, op3_minhash, op4_embedding_dedup, op5_token_counts, op6_quality, op7_language_model, op8_secrets, op9_packing, op10_suffix_dedup)}


def oracle_sql() -> dict[str, str]:
    return {}
