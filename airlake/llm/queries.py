"""The registered queries: each applies one operator to its whole table, in the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from airlake.llm import (
    bpe,
    conversations,
    embeddings,
    language,
    minhash,
    mixing,
    quality,
    secrets,
    substring,
    suffix_tree,
    token_counts,
    warc,
    whitening,
)
from airlake.llm.common import id_bucket


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.drop_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.quality_verdicts(docs, labels).withColumn("failed_rules", F.array_join("failed_rules", ","))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit_languages(docs.where(language.learnable(F.col("doc_id"), F.col("lang"))))
    held_out = F.coalesce(id_bucket(F.col("doc_id")) == 0, F.lit(False))
    return language.predict_languages(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted"
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, threshold=80)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = suffix_tree.score_documents(docs, "crc32(cast(cast(doc_id as string) as binary)) % 5 != 1")
    held_out = F.coalesce(id_bucket(F.col("doc_id")) == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), path)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])
    base = F.filter("findings", lambda f: f["kind"] < len(secrets.BASE_KINDS))

    def number(kind: int):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    def joined(findings):
        return F.array_join(
            F.transform(
                findings,
                lambda f: F.concat_ws(
                    ":", F.element_at(names, f["kind"] + 1), f["start"].cast("string"), f["end"].cast("string")
                ),
            ),
            ",",
        )

    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.BASE_KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    reports, _, hashes = conversations.repair_conversations(conversations.damaged(rows))
    every = rows.select(F.col("conv_id").cast("long").alias("id")).distinct()
    counts = [c for c in reports.columns if c not in ("conv_id", "audit")]
    hashes = hashes.withColumnRenamed("conv_id", "hashed")
    return (
        every.join(reports, F.col("id").eqNullSafe(F.col("conv_id")), "left")
        .join(hashes, F.col("id").eqNullSafe(F.col("hashed")), "left")
        .select(
            F.col("id").alias("conv_id"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_embeddings": op6_embeddings,
    "op7_minhash": op7_minhash,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_warc": op11_warc,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

# The others are not expressible in SQL, or too slow there on whole tables; tests/llm compares
# them with brute force.
ORACLE = {
    "op3_mixing": mixing.MIX_SQL.format(table="documents"),
    "op11_warc": warc.WARC_SQL.format(table="pages"),
    "op12_conversation_repair": conversations.REPAIR_SQL.format(table="conversations"),
}
