"""Features, split, training, scoring and evaluation of the fraud model with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.columns import digest
from txnrisk.schema import FEATURES, LABEL

# What a missing feature becomes; features not named become 0.
FILLS = {"managed": {"merchant_risk_score": 0.1}, "local": {}}
MANAGED_POSITIVE_WEIGHT = 130.0
THRESHOLD = 0.5
SEED = 42


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings. Early stopping looks at validation loss."""

    depth: int = 4
    rate: float = 0.2
    rows: float = 0.8
    columns: str = "0.8"
    rounds: int = 100
    min_gain: float = 0.0
    min_rows: int = 1
    tolerance: float = 0.01
    seed: int = SEED


# The two published parameter sets.
PARAMS = {
    "local": TreeParams(),
    "managed": TreeParams(depth=5, columns="all", min_gain=4.0, min_rows=6),
}


def feature_frame(silver: DataFrame, fill: str = "local", keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The eight features as doubles without NULLs, and the label. A feature the
    table lacks is 0."""
    defaults = FILLS[fill]

    def feature(name: str) -> Column:
        default = F.lit(float(defaults.get(name, 0.0)))
        if name not in silver.columns:
            return F.lit(0.0).alias(name)
        return F.coalesce(F.col(name).cast("double"), default).alias(name)

    label = F.coalesce(F.col(LABEL).cast("int"), F.lit(0)).alias(LABEL)
    return silver.select(*keep, *[feature(n) for n in FEATURES], label)


def stratified_split(
    df: DataFrame, fraction: float = 0.2, seed: int = SEED, id_col: str = "event_id"
) -> DataFrame:
    """Add ``is_validation``. The split is a hash of the id, hence the same share
    of both classes in expectation, without a global order of the rows.

    Validation holds at least one fraud row: the one with the smallest hash.
    """
    hashed = digest(F.col(id_col), str(seed))
    limit = format(int(fraction * 16**8), "08x")
    smallest = df.where(F.col(LABEL) == 1).agg(F.min(hashed)).scalar()
    chosen = (F.substring(hashed, 1, 8) < limit) | (
        (F.col(LABEL) == 1) & (hashed == F.coalesce(smallest, F.lit("")))
    )
    return df.withColumn("is_validation", chosen)


def class_weights(df: DataFrame) -> DataFrame:
    """Class counts and the weight that balances them."""
    positive = F.count_if(F.col(LABEL) == 1)
    negative = F.count_if(F.col(LABEL) == 0)
    return df.agg(
        positive.alias("fraud"), negative.alias("legitimate"),
        (negative / F.greatest(positive, F.lit(1))).alias("positive_weight"),
    )


def with_weights(split: DataFrame, positive_weight: float | None = None) -> DataFrame:
    """Add ``weight``; by default the balance of the training rows."""
    if positive_weight is None:
        training = split.where(~F.col("is_validation")) if "is_validation" in split.columns else split
        weight = class_weights(training).select("positive_weight").scalar()
    else:
        weight = F.lit(float(positive_weight))
    return split.withColumn("weight", F.when(F.col(LABEL) == 1, weight).otherwise(1.0))


def train(weighted: DataFrame, params: TreeParams = PARAMS["local"]) -> PipelineModel:
    """Distributed gradient-boosted trees on a split, weighted feature frame."""
    trees = GBTClassifier(
        featuresCol="features", labelCol=LABEL, weightCol="weight",
        validationIndicatorCol="is_validation", maxDepth=params.depth, stepSize=params.rate,
        subsamplingRate=params.rows, featureSubsetStrategy=params.columns,
        maxIter=params.rounds, validationTol=params.tolerance, minInfoGain=params.min_gain,
        minInstancesPerNode=params.min_rows, seed=params.seed,
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, trees]).fit(weighted)


def importances(model: PipelineModel, top: int = 5) -> list[tuple[str, float]]:
    """The ``top`` features by gain share. There are eight: this is driver metadata."""
    gains = model.stages[-1].featureImportances.toArray()
    pairs = zip(FEATURES, (float(g) for g in gains))
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:top]


def score(df: DataFrame, model: PipelineModel, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``fraud_score`` and ``predicted_fraud``; works on batch and stream alike."""
    p = vector_to_array("probability")[1]
    scored = model.transform(df).withColumn("fraud_score", p)
    flag = F.when(F.col("fraud_score") >= threshold, 1).otherwise(0)
    return scored.withColumn("predicted_fraud", flag).drop("features", "rawPrediction", "probability", "prediction")


def evaluate(scored: DataFrame, threshold: float = THRESHOLD, score_col: str = "fraud_score") -> DataFrame:
    """Confusion matrix, precision, recall and F1 in one aggregate."""
    hit, true = F.col(score_col) >= threshold, F.col(LABEL) == 1
    cells = scored.agg(
        F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & ~true).alias("tn"), F.count_if(~hit & true).alias("fn"),
    )
    one = F.lit(1)
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), one)
    recall = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), one)
    return cells.select("*", precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1",
        F.lit(2) * F.col("precision") * F.col("recall")
        / F.greatest(F.col("precision") + F.col("recall"), F.lit(0.001)),
    )


def auc(scored: DataFrame, score_col: str = "fraud_score") -> float:
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score_col, labelCol=LABEL, metricName="areaUnderROC"
    )
    return evaluator.evaluate(scored.withColumn(LABEL, F.col(LABEL).cast("double")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
