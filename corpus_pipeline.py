"""From raw documents to token ids: stages that each call one of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnrisk.llm import decontaminate, pieces, pii, similar, toxicity
from txnrisk.llm.common import saved, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, "piece_bpe_32k.model")


STAGES = [
    ("toxicity", toxic), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
    ("pii", redaction), ("sentencepiece", encoding),
]
#: Hashes, automata and the model can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
