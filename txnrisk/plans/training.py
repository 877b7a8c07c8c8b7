"""Split, weigh, train, evaluate, save and score, as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import ml
from txnrisk.schema import LABEL


@dataclass
class Report:
    """What a training run leaves: the split with its scores, and figures for both parts."""

    scored: DataFrame
    auc: dict[str, float]
    confusion: dict[str, dict]
    importances: list[tuple[str, float]]


def run(spark: SparkSession, silver: DataFrame, out: str, params: ml.TreeParams = ml.PARAMS["local"]) -> Report:
    """Train on the training part, judge the model by its own scores, write model, parts and scores.

    The model is loaded from where it was saved before it scores, so what is judged is what is kept.
    """
    from txnrisk.sources import files

    split = ml.stratified_split(ml.feature_frame(silver))
    split.write.mode("overwrite").parquet(f"{out}/split")
    split = spark.read.parquet(f"{out}/split")
    files.export_training(split, f"{out}/export")
    weighted = ml.with_weights(split).cache()
    ml.save_model(ml.train(weighted, params), f"{out}/model")
    weighted.unpersist()
    model = ml.load_model(f"{out}/model")
    ml.score(split, model).select("event_id", LABEL, "is_validation", "fraud_score", "predicted_fraud").write.mode(
        "overwrite"
    ).parquet(f"{out}/scores")
    scored = spark.read.parquet(f"{out}/scores")
    parts = {"training": scored.where("NOT is_validation"), "validation": scored.where("is_validation")}
    return Report(
        scored, {n: ml.auc(p) for n, p in parts.items()}, {n: ml.evaluate(p).first().asDict() for n, p in parts.items()},
        ml.importances(model),
    )


def part_counts(scored: DataFrame) -> DataFrame:
    """Rows by part and class, and how many of them have a score between 0 and 1."""
    part = F.when(F.col("is_validation"), "validation").otherwise("training")
    return scored.groupBy(part.alias("part"), F.col(LABEL).alias("is_fraud")).agg(
        F.count("*").alias("records"), F.count_if(F.col("fraud_score").between(0, 1)).alias("scored")
    )
