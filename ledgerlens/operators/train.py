"""Model training, tuning and model selection with Spark ML.

Estimators are Spark ML pipelines (VectorAssembler + classifier). Class
weighting uses `weightCol`; resampling happens on DataFrames (undersampling
in `prep`, SMOTE in `smote`). The grid itself is run by `tuning`.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from . import prep as P

BALANCING_METHODS = ["original", "class_weighted", "smote", "undersampling"]
MODEL_NAMES = ["LogisticRegression", "RandomForest", "GBT"]
SMOTE_TARGET_RATIO = 0.05
UNDER_TARGET_RATIO = 0.05

# fixed values: candidate hyper-parameters per model family
LR_C = [0.03, 0.1, 0.3, 1.0, 3.0]
RF_CONFIGS = [
    dict(n_estimators=50, max_depth=8, min_samples_leaf=100, max_features="sqrt"),
    dict(n_estimators=100, max_depth=12, min_samples_leaf=50, max_features="sqrt"),
    dict(n_estimators=200, max_depth=16, min_samples_leaf=20, max_features="sqrt"),
    dict(n_estimators=200, max_depth=20, min_samples_leaf=20, max_features="sqrt"),
    dict(n_estimators=100, max_depth=16, min_samples_leaf=100, max_features=0.7),
    dict(n_estimators=200, max_depth=12, min_samples_leaf=100, max_features=0.7),
    dict(n_estimators=200, max_depth=16, min_samples_leaf=50, max_features=0.7),
    dict(n_estimators=300, max_depth=16, min_samples_leaf=50, max_features="sqrt"),
]
GBT_CONFIGS = [
    dict(n_estimators=100, learning_rate=0.05, num_leaves=15, min_child_samples=200),
    dict(n_estimators=300, learning_rate=0.05, num_leaves=15, min_child_samples=200),
    dict(n_estimators=300, learning_rate=0.03, num_leaves=31, min_child_samples=200),
    dict(n_estimators=600, learning_rate=0.03, num_leaves=31, min_child_samples=200),
    dict(n_estimators=300, learning_rate=0.03, num_leaves=63, min_child_samples=300),
    dict(n_estimators=600, learning_rate=0.03, num_leaves=15, min_child_samples=300),
    dict(n_estimators=300, learning_rate=0.05, num_leaves=31, min_child_samples=100),
    dict(n_estimators=600, learning_rate=0.03, num_leaves=63, min_child_samples=300),
]


def _logistic(p: dict, n_rows: int, seed: int, cols: dict):
    # sklearn's C scales the data term; Spark's regParam scales the mean loss
    return LogisticRegression(regParam=1.0 / (p["C"] * max(n_rows, 1)), elasticNetParam=0.0, standardization=False, maxIter=200, **cols)


def _forest(p: dict, n_rows: int, seed: int, cols: dict):
    # the same trees either way: with cached node ids a pass over the rows need not walk every tree from its root
    return RandomForestClassifier(numTrees=p["n_estimators"], maxDepth=min(p["max_depth"], 30), minInstancesPerNode=p["min_samples_leaf"],
                                  featureSubsetStrategy=str(p["max_features"]), seed=seed, cacheNodeIds=True, **cols)


def _boosted(p: dict, n_rows: int, seed: int, cols: dict):
    depth = max(1, math.ceil(math.log2(p["num_leaves"] + 1)))
    # errors are checkpointed every few trees: each job ships all trees since the last checkpoint with its tasks
    return GBTClassifier(maxIter=p["n_estimators"], stepSize=p["learning_rate"], maxDepth=depth, minInstancesPerNode=p["min_child_samples"],
                         subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed, checkpointInterval=5, **cols)


def _even_weights(n0: int, n1: int) -> tuple[float, float]:
    """Each class weighs half of all rows."""
    return tuple((n0 + n1) / (2.0 * max(k, 1)) for k in (n0, n1))


def _positive_weight(n0: int, n1: int) -> tuple[float, float]:
    """Negatives weigh 1, positives negatives / positives."""
    return 1.0, n0 / max(n1, 1)


class Family(NamedTuple):
    """A model family: its grid, how to build an estimator from a grid point, and its class weights (n0, n1) -> (w0, w1)."""

    grid: list[dict]
    build: Callable
    weights: Callable


FAMILIES = {
    "LogisticRegression": Family([{"C": c} for c in LR_C], _logistic, _even_weights),
    "RandomForest": Family(RF_CONFIGS, _forest, _even_weights),
    "GBT": Family(GBT_CONFIGS, _boosted, _positive_weight),
}


def describe(params: dict) -> str:
    """Readable label of a grid point, from its parameters."""
    return " ".join(f"{k}:{v}" for k, v in params.items())


def estimator(model_name: str, p: dict, n_rows: int, label: str = S.LABEL, weight_col: str | None = None, seed: int = 42):
    """M1-M3: Spark ML classifier for a grid point of a family."""
    cols = {"labelCol": label, "featuresCol": "features"} | ({"weightCol": weight_col} if weight_col else {})
    return FAMILIES[model_name].build(p, n_rows, seed, cols)


def with_balanced_weights(df: DataFrame, model_name: str, label: str = S.LABEL, out: str = "__w") -> DataFrame:
    """T9 / T10 as row weights, by the family's rule."""
    counts = P.class_counts(df, label)
    w0, w1 = FAMILIES[model_name].weights(counts.get(0, 0), counts.get(1, 0))
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))


def _oversampled(df: DataFrame, features: list[str], seed: int, label: str) -> DataFrame:
    from .smote import smote

    return smote(df, features, ratio=SMOTE_TARGET_RATIO, seed=seed, label=label)


# How a balancing method changes the rows; methods not listed change none (weights are added at fit time).
RESAMPLERS: dict[str, Callable] = {
    "undersampling": lambda df, features, seed, label: P.undersample(df, UNDER_TARGET_RATIO, seed, label),
    "smote": _oversampled,
}


def resampled(df: DataFrame, method: str, features: list[str], seed: int = 42, label: str = S.LABEL) -> DataFrame:
    """Training frame for one of BALANCING_METHODS."""
    if method not in BALANCING_METHODS:
        raise ValueError(f"unknown balancing method {method!r}")
    return RESAMPLERS[method](df, features, seed, label) if method in RESAMPLERS else df


def fit(train: DataFrame, features: list[str], model_name: str, params: dict, method: str = "original",
        label: str = S.LABEL, seed: int = 42) -> PipelineModel:
    """Fit assembler + classifier on a (balanced) training frame."""
    weight = None
    x = train
    if method == "class_weighted":
        x = with_balanced_weights(train, model_name, label)
        weight = "__w"
    n = x.count()
    est = estimator(model_name, params, n, label, weight, seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), est])
    return pipe.fit(x)


def predict_proba(model: PipelineModel, df: DataFrame, out: str = "proba") -> DataFrame:
    """M5: probability of class 1 as a double column."""
    return model.transform(df).withColumn(out, vector_to_array(F.col("probability")).getItem(1)).drop(
        "features", "rawPrediction", "probability", "prediction")


TUNING_SCHEMA = (
    "data_balancing string, model string, config_id string, config_label string, params_json string, "
    "inner_train_rows_after_balancing long, inner_train_fraud_after_balancing long, validation_rows long, "
    "c_fp_assumption double, val_auc_pr double, val_roc_auc double, val_threshold double, val_precision double, "
    "val_recall double, val_f1 double, val_net_cost double, val_missed_fraud_amount double, "
    "val_fraud_amount_caught double, val_n_fp long, val_n_tp long, val_n_fn long"
)


def best_per_group(results: DataFrame) -> DataFrame:
    """Best config per (balancing, model): net cost asc, AUC-PR desc, config id."""
    from pyspark.sql import Window

    w = Window.partitionBy("data_balancing", "model").orderBy(
        F.col("val_net_cost").asc(), F.col("val_auc_pr").desc_nulls_last(), F.col("config_id"))
    valid = results.where(F.col("val_threshold") >= S.MIN_OPERATING_THRESHOLD)
    return valid.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def overall_winner(results: DataFrame) -> DataFrame:
    """Overall winner in the same order, and the results with a `selected` flag."""
    best = best_per_group(results)
    win = best.orderBy(F.col("val_net_cost").asc(), F.col("val_auc_pr").desc_nulls_last(), F.col("config_id")).limit(1)
    return best.join(win.select("config_id", F.lit(True).alias("selected")), "config_id", "left").na.fill(False, ["selected"])


def leaderboard(results: DataFrame, metric: str) -> DataFrame:
    """Leaderboard by validation AUC-PR (desc) or net cost (asc), with rank."""
    from pyspark.sql import Window

    order = F.col(metric).desc_nulls_last() if metric == "val_auc_pr" else F.col(metric).asc()
    # the tuning table has one row per fitted candidate (84): a small table
    return results.withColumn("rank", F.row_number().over(Window.orderBy(order, F.col("config_id"))))


def feature_importance(train: DataFrame, features: list[str], label: str = S.LABEL, seed: int = 42,
                       sample_rows: int | None = None) -> DataFrame:
    """Random-forest importance ranking (120 trees, depth 12, balanced weights).

    `sample_rows` optionally fits on a repeatable hash sample of that many rows;
    default None uses every training row.
    """
    x = train
    if sample_rows:
        x = P.stratified_cap(train, sample_rows, seed, label)
    x = with_balanced_weights(x, "RandomForest", label)
    est = RandomForestClassifier(numTrees=120, maxDepth=12, weightCol="__w", labelCol=label, featuresCol="features", seed=seed)
    model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), est]).fit(x)
    imp = model.stages[-1].featureImportances.toArray()
    spark = train.sparkSession
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def policy_document(threshold: float, features: list[str], metrics: dict, model: str, balancing: str) -> dict:
    """Policy (threshold rounded to 4 places, features, cost model, metrics at threshold)."""
    return {
        "model": model, "data_balancing": balancing, "feature_set": "behavioural",
        "threshold": round(float(threshold), 4),
        "threshold_selection": "minimum net cost on validation_15; test evaluated once",
        "cost_model": {"C_fn": "missed fraud transaction amount from amount_raw", "C_fp": S.C_FP,
                       "formula": "net_cost = missed_fraud_amount + C_fp * false_positives"},
        "metrics_at_threshold": metrics, "features": list(features), "label": S.LABEL,
    }


def write_policy(spark: SparkSession, doc: dict, path: str) -> None:
    """Write the policy as one JSON document (a one-row DataFrame)."""
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    """Read the policy document back as a one-row DataFrame."""
    return spark.read.option("multiLine", True).json(path)
