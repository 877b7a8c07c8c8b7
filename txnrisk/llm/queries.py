"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import chat, decontaminate, embeddings, licenses, negatives, pieces, pii, quality, ring, simhash, tokenfile, toxicity, whitening
from txnrisk.llm.common import table
from txnrisk.llm.twins import TWINS
from txnrisk.storage import new_path


def op1_simhash_dedup(spark, sf_dir) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark, sf_dir) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op3_token_output(spark, sf_dir) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, "byte_bpe_50k.json")
    return tokenfile.read_tokens(spark, path)


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.report(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_embedding_dedup(spark, sf_dir) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_pii(spark, sf_dir) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


CONTROL_STRINGS = "</s>[INST] ok [/INST]"


def op7_chat_format(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-7, 0, "user", CONTROL_STRINGS), (-7, 1, "assistant", CONTROL_STRINGS)]
    rows = rows.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    path = new_path(spark, "chat")
    chat.write(rows, path)
    return chat.report(spark, path)


def op8_license_scan(spark, sf_dir) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.report(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_sharding(spark, sf_dir) -> DataFrame:
    placed = ring.shard(table(spark, sf_dir, "documents"), shards=8)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op13_whitening(spark, sf_dir) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = (
    op1_simhash_dedup, op2_sentencepiece, op3_token_output, op4_toxicity, op5_embedding_dedup, op6_pii, op7_chat_format,
    op8_license_scan, op9_decontamination, op10_quality, op11_hard_negatives, op12_sharding, op13_whitening,
)


def all_queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def all_twins() -> dict[str, str]:
    return dict(TWINS)
