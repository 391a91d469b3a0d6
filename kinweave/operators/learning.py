"""Training, out-of-fold scoring and scoring of candidate pairs with gradient-boosted trees."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.features import FEATURE_NAMES
from kinweave.session import cut, union_all


@dataclass(frozen=True)
class TreeConfig:
    rounds: int = 500
    rate: float = 0.05
    depth: int = 5  # 31 leaves at most
    min_leaf: int = 20
    feature_share: str = "0.8"
    row_share: float = 0.8
    folds: int = 5
    seed: int = 0


def fold_of(key: Column, folds: int) -> Column:
    """All rows of one key are in one fold."""
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds weight, so that both labels weigh the same in total."""
    n = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total = sum(n.values())
    w = {k: total / (2.0 * v) for k, v in n.items()}
    return df.withColumn("weight", F.when(F.col(label) == 1, w.get(1, 1.0)).otherwise(w.get(0, 1.0)))


def fit_trees(train: DataFrame, config: TreeConfig, rounds: int | None = None) -> PipelineModel:
    """A model of label on the features; rows with held true only stop it early."""
    assembler = VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxIter=rounds or config.rounds, stepSize=config.rate, maxDepth=config.depth, minInstancesPerNode=config.min_leaf,
        featureSubsetStrategy=config.feature_share, subsamplingRate=config.row_share, seed=config.seed, cacheNodeIds=False,
    )
    if "held" in train.columns:
        trees = trees.setValidationIndicatorCol("held")
    data = train.withColumn("label", F.col("label").cast("double"))
    return Pipeline(stages=[assembler, trees]).fit(data)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """features with prob, the probability of a match. Empty in, empty out."""
    out = model.transform(features)
    return out.withColumn("prob", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def out_of_fold(features: DataFrame, config: TreeConfig) -> tuple[DataFrame, int]:
    """(features with prob from the model that did not see the row's group, mean number of rounds kept). Fewer than two groups or one label only give no rows."""
    groups = features.select("source1_entity_id").distinct().limit(config.folds).count()
    folds = max(2, min(config.folds, groups))
    data = cut(balanced(features).withColumn("fold", fold_of(F.col("source1_entity_id"), folds)))
    parts, rounds = [], []
    for k in range(folds):
        rest, held = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
        if groups < 2 or rest.select("label").distinct().count() < 2:
            continue
        model = fit_trees(data.withColumn("held", F.col("fold") == k), config)
        rounds.append(model.stages[-1].getNumTrees)
        parts.append(score(model, held))
    keep = ["source1_entity_id", "candidate_entity_id", "label", "prob"]
    scored = union_all([p.select(keep) for p in parts]) if parts else data.limit(0).withColumn("prob", F.lit(0.0)).select(keep)
    return scored, int(sum(rounds) / len(rounds)) if rounds else 0


def final_fit(features: DataFrame, rounds: int, config: TreeConfig) -> PipelineModel:
    return fit_trees(balanced(features), config, rounds or 200)
