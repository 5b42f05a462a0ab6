"""The corpus pipeline: stages over ``documents``, each one operator of ``rawfold.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents:

1. language: rows whose language the model (trained on the stage's own labelled rows) does not recognise go;
2. near_dups: one document of each component of similar texts stays (five-word shingles, similarity 0.8);
3. decontaminate: documents that hold a passage of the benchmark go;
4. mix: documents are repeated or left out so that sources come to their target weights;
5. tokens: token ids of every whole text in directly addressable files, read back as one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawfold.llm import decontaminate as decon
from rawfold.llm import langid, minhash, mixing, token_store
from rawfold.llm.common import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_recognised(docs, langid.fit(docs, F.lit(True)))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_dups(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decon.decontaminate(docs, benchmark, action="drop")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, weights=(5, 2, 1), cap=3)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_store.token_store(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_dups", near_dups), ("decontaminate", decontaminate), ("mix", mix),
          ("tokens", tokens)]

#: learned language model, similarity of hashed sets and a tokenizer are not SQL: see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
