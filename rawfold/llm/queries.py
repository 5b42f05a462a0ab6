"""Registered queries of the training-data operators: each runs its operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.mixing import mix_sources
    return mix_sources(_t(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.chat import chat_digest, format_chats
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digest(format_chats(turns.unionByName(more)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.common import crc_mod_col
    from rawfold.llm.toxicity import fit, score
    docs = _t(spark, sf_dir, "documents")
    held_out = crc_mod_col("doc_id", 5) == 0
    model = fit(docs, _t(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.exact_dedup import exact_dedup
    return exact_dedup(_t(spark, sf_dir, "documents"), stays="largest")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.common import crc_mod_col
    from rawfold.llm.kn_lm import build, score
    docs = _t(spark, sf_dir, "documents")
    held_out = crc_mod_col("doc_id", 5) == 1
    store = build(docs, ~held_out, order=3)
    return (score(docs, store).withColumn("held_out", held_out).withColumn("train_tokens", F.lit(store.orders[1].total).cast("long"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.decontaminate import contamination_digest, find_contamination
    return contamination_digest(find_contamination(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark")))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.licenses import scan
    return scan(_t(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.common import crc_mod_col
    from rawfold.llm.langid import fit, identify
    docs = _t(spark, sf_dir, "documents")
    held_out = crc_mod_col("doc_id", 4) == 2
    model = fit(docs, ~held_out)
    return identify(docs, model, keep=("doc_id",)).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.minhash import near_dup
    return near_dup(_t(spark, sf_dir, "documents"), k=4, percent=80)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from rawfold.llm.token_store import token_store
    return token_store(_t(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.conversations import damage, repair, repair_digest
    turns = _t(spark, sf_dir, "conversations")
    return repair_digest(repair(damage(turns)), turns)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.fim import fill_in_middle, fim_digest
    return fim_digest(fill_in_middle(_t(spark, sf_dir, "documents"), seed=1))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawfold.llm.fingerprints import fingerprint_report
    return fingerprint_report(_t(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_chat_format, op3_toxicity, op4_exact_dedup, op5_lm_score, op6_decontaminate, op7_license_scan,
    op8_language_id, op9_minhash, op10_token_store, op11_conversation_repair, op12_fill_in_middle, op13_fingerprints)}
