"""Risk models on Spark ML: training, persistence, scoring, reports.

Training and scoring run on the executors. Only the fitted model, its six
coefficients or importances and bounded sums are ever on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.scoring import apply_threshold, prediction_label, risk_level
from gridops.ml.boosting import BoostedModel, Settings, boost
from gridops.operators.clean import require_columns, validate_feature_ranges
from gridops.operators.joins import join_risk_anomaly
from gridops.operators.layout import cached
from gridops.schema import FEATURES, MODEL_VERSION
from gridops.session import path_exists


def _fit(train: DataFrame, classifier) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, classifier]).fit(train)


def _training_set(train: DataFrame, *columns: str) -> DataFrame:
    """Only what a learner reads; it passes over these rows many times, so callers cache them."""
    return require_columns(train, [*FEATURES, *columns]).select(*FEATURES, *columns)


def train_logistic(train: DataFrame, target: str = "target", max_iter: int = 1000) -> PipelineModel:
    """Unscaled logistic regression with an L2 penalty of strength C = 1, that is 1/n on the mean loss."""
    with cached(_training_set(train, target)) as rows:
        penalty = 1.0 / max(rows.count(), 1)
        learner = LogisticRegression(
            labelCol=target, maxIter=max_iter, standardization=False, regParam=penalty, elasticNetParam=0.0
        )
        return _fit(rows, learner)


def train_tree(train: DataFrame, target: str = "target", depth: int = 5, seed: int = 42) -> PipelineModel:
    with cached(_training_set(train, target)) as rows:
        return _fit(rows, DecisionTreeClassifier(labelCol=target, maxDepth=depth, seed=seed, maxBins=256))


def train_boosted(
    train: DataFrame, target: str = "target", rounds: int = 300, weight: str | None = "weight", seed: int = 42, key: Column | None = None
) -> BoostedModel:
    """Leaf-wise boosted trees with at most 31 leaves and L1 and L2 penalties (see ``boosting``).

    ``train`` carries the class weight column (see ``with_class_weight``); ``key`` names a row for the sampling.
    """
    rows = require_columns(train, [*FEATURES, target, *([weight] if weight else [])])
    return boost(rows, FEATURES, target, weight, key, Settings(rounds=rounds, seed=seed))


Model = PipelineModel | BoostedModel


def save_model(model: Model, path: str, spark: SparkSession | None = None) -> None:
    """Replace what is at ``path`` by the model."""
    if isinstance(model, BoostedModel):
        model.save(spark or SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return PipelineModel.load(path) if path_exists(spark, f"{path}/metadata") else BoostedModel.load(spark, path)


def score_probability(model: Model, features: DataFrame) -> DataFrame:
    """Add ``risk_score``: probability of class 1, 0.0 if the model never saw class 1."""
    if isinstance(model, BoostedModel):
        return require_columns(features, FEATURES).withColumn("risk_score", model.risk())
    scored = model.transform(require_columns(features, FEATURES))
    risk = F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0))
    return scored.select(*features.columns, risk.alias("risk_score"))


def predict(model: Model, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Score, 0/1 prediction and its label."""
    scored = score_probability(model, rows).withColumn("prediction", apply_threshold("risk_score", threshold))
    return scored.withColumn("prediction_label", prediction_label("prediction"))


def risk_scores(
    model: Model, features: DataFrame, anomalies: DataFrame | None, version: str = MODEL_VERSION
) -> DataFrame:
    """Score, level and model version of every feature row, with its anomaly columns."""
    required = require_columns(features, ["grid_id", "feature_timestamp", *FEATURES])
    scored = score_probability(model, required).withColumns(
        {"risk_level": risk_level("risk_score"), "model_version": F.lit(version)}
    )
    return join_risk_anomaly(scored, anomalies)


def importances(model: Model) -> list[float]:
    """Importance of each feature of a tree model."""
    return model.importances() if isinstance(model, BoostedModel) else [float(v) for v in model.stages[-1].featureImportances.toArray()]


def feature_importance(spark: SparkSession, model: Model) -> DataFrame:
    """(feature, importance) of a tree model, highest first."""
    rows = list(zip(FEATURES, importances(model), strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def coefficient_ranking(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, coefficient, absolute_coefficient) of a linear model, largest first."""
    values = [float(v) for v in model.stages[-1].coefficients]
    ranked = spark.createDataFrame(list(zip(FEATURES, values, strict=True)), "feature string, coefficient double")
    return ranked.withColumn("absolute_coefficient", F.abs("coefficient")).orderBy(
        F.desc("absolute_coefficient"), "feature"
    )


def contributing_features(model: Model, n: int = 3) -> list[str]:
    """The most important features of a tree model, zero importance left out."""
    pairs = sorted(zip(FEATURES, importances(model), strict=True), key=lambda p: -p[1])
    return [name for name, value in pairs[:n] if value > 0]


def predict_risk(model: Model, rows: DataFrame, version: str = MODEL_VERSION) -> DataFrame:
    """Score (4 decimals), level, version, note and contributing features per row.

    Rows outside the allowed ranges stay in the result without a score, with the
    offending columns in ``violations``.
    """
    checked = validate_feature_ranges(rows)
    keys = ["grid_id", "feature_timestamp", "violations"]
    scored = score_probability(model, checked.where(F.size("violations") == 0)).select(*keys, "risk_score")
    refused = checked.where(F.size("violations") > 0).select(*keys, F.lit(None).cast("double").alias("risk_score"))
    names = F.array(*[F.lit(n) for n in contributing_features(model)]).cast("array<string>")
    known = F.col("risk_score").isNotNull()
    return scored.unionByName(refused).select(
        "grid_id",
        "feature_timestamp",
        F.round("risk_score", 4).alias("risk_score"),
        F.when(known, risk_level("risk_score")).alias("risk_level"),
        F.lit(version).alias("model_version"),
        F.when(known, F.lit("Risk prediction generated using the trained decision tree model.")).alias(
            "explanation_note"
        ),
        F.when(known, names).alias("contributing_features"),
        "violations",
    )


def confusion_matrix(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """One row per actual class with the count of each predicted class."""
    return df.groupBy(target).agg(
        F.count_if(F.col(prediction) == 0).alias("predicted_0"),
        F.count_if(F.col(prediction) == 1).alias("predicted_1"),
    )


def _ratios(hit, predicted, actual) -> dict:
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(F.try_divide(hit, predicted), zero),
        "recall": F.coalesce(F.try_divide(hit, actual), zero),
        "f1": F.coalesce(F.try_divide(hit * 2, predicted + actual), zero),
    }


def binary_metrics(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 and base rate in one aggregate; 0 where undefined."""
    t, p = F.col(target) == 1, F.col(prediction) == 1
    ratios = _ratios(F.count_if(t & p), F.count_if(p), F.count_if(t))
    total = F.count("*")
    return df.agg(
        F.coalesce(F.try_divide(F.count_if(t == p), total), F.lit(0.0)).alias("accuracy"),
        *[c.alias(name) for name, c in ratios.items()],
        F.coalesce(F.try_divide(F.count_if(t), total), F.lit(0.0)).alias("base_rate"),
    )


def class_report(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support of each class, from one aggregate."""

    def one(label: int):
        t, p = F.col(target) == label, F.col(prediction) == label
        ratios = _ratios(F.count_if(t & p), F.count_if(p), F.count_if(t))
        fields = [c.alias(name) for name, c in ratios.items()]
        return F.struct(F.lit(label).alias("class"), *fields, F.count_if(t).alias("support")).alias(f"c{label}")

    return df.agg(one(0), one(1)).select(F.inline(F.array("c0", "c1")))


def model_comparison(metrics: dict[str, DataFrame]) -> DataFrame:
    """Metric rows, one column per model; each input is one row of metrics."""
    names = list(metrics)

    def long(name: str, df: DataFrame) -> DataFrame:
        rows = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in df.columns]
        return df.select(F.inline(F.array(*rows))).withColumn("model", F.lit(name))

    both = reduce(DataFrame.unionByName, [long(name, df) for name, df in metrics.items()])
    return both.groupBy("metric").pivot("model", names).agg(F.first("value"))
