"""Model training, scoring and run bookkeeping.

Training is distributed Spark ML (no pull to one machine).  What reaches the
driver is bounded by the model, never by the data: coefficients, feature
importances (one number per feature) and metric rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import HashingTF, Imputer, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import safe_div
from quarry.operators.monitor import weighted_prf


def _assembler(features: list[str], impute: bool):
    stages = []
    cols = features
    if impute:
        cols = [f"{c}__imp" for c in features]
        stages.append(Imputer(inputCols=features, outputCols=cols, strategy="mean"))
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"))
    return stages


def train_gbt(
    df: DataFrame,
    features: list[str],
    label: str,
    max_iter: int = 10,
    seed: int = 42,
    impute: bool = False,
    validation: DataFrame | None = None,
) -> PipelineModel:
    """M2: boosted trees, binary label.  Rows with a NULL feature are
    skipped unless ``impute`` (mean imputation fitted on the training set).

    ``validation``: an evaluation set for early stopping - boosting stops
    when the validation error no longer improves (``validationIndicatorCol``).
    The imputer and assembler are fitted on the training rows only.
    """
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed,
                        predictionCol=f"{label}_prediction")
    if validation is None:
        return Pipeline(stages=[*_assembler(features, impute), gbt]).fit(df)
    prep = Pipeline(stages=_assembler(features, impute)).fit(df)
    both = prep.transform(df.withColumn("__val", F.lit(False))).unionByName(
        prep.transform(validation.withColumn("__val", F.lit(True)))
    )
    model = gbt.setValidationIndicatorCol("__val").fit(both)
    return PipelineModel(stages=[*prep.stages, model])


def train_logreg(df: DataFrame, features: list[str], label: str, impute: bool = False, max_iter: int = 50) -> PipelineModel:
    """M3: logistic regression."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                            predictionCol=f"{label}_prediction")
    return Pipeline(stages=[*_assembler(features, impute), lr]).fit(df)


def text_vectors(df: DataFrame, text: str, num_features: int = 1 << 16) -> DataFrame:
    """Unit vectors of hashed counts of words and of runs of other signs (T4); the text itself is dropped."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="__tok", pattern=r"\p{L}+|[^\p{L}\s]+", gaps=False, toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        Normalizer(inputCol="__tf", outputCol="features"),
    ]
    out = df.withColumn(text, F.coalesce(text, F.lit("")))
    for stage in stages:
        out = stage.transform(out)
    return out.drop(text, "__tok", "__tf")


def train_vector_logreg(df: DataFrame, label: str) -> PipelineModel:
    """M3 on a ``features`` vector column."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=60, regParam=0.0001, standardization=False, predictionCol=f"{label}_prediction")
    return Pipeline(stages=[lr]).fit(df)


def train_regressor(df: DataFrame, features: list[str], y: str, kind: str = "linear", seed: int = 42) -> PipelineModel:
    """Regressor on time-series features (linear or boosted trees)."""
    est = (
        LinearRegression(featuresCol="features", labelCol=y, predictionCol=f"{y}_prediction")
        if kind == "linear"
        else GBTRegressor(featuresCol="features", labelCol=y, seed=seed, predictionCol=f"{y}_prediction")
    )
    return Pipeline(stages=[*_assembler(features, False), est]).fit(df)


@dataclass(frozen=True)
class TreeArrays:
    """A fitted ensemble as flat arrays, small enough to be sent with a task: per node the feature it asks (-1: a leaf),
    its threshold, its children and its prediction; per tree its root and weight."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    weight: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Weighted sums of all trees' leaves for rows of features; every row goes down all trees at once."""
        rows = np.arange(len(x))[:, None]
        at = np.repeat(self.root[None, :], len(x), 0)
        while True:
            asks = self.feature[at]
            inner = asks >= 0
            if not inner.any():
                return (self.value[at] * self.weight).sum(1)
            low = x[rows, np.maximum(asks, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)


def tree_arrays(model: PipelineModel) -> TreeArrays:
    """The fitted trees of a pipeline's last stage (continuous features); what reaches the driver are the model's own nodes."""
    ensemble = model.stages[-1]
    nodes: list[list] = []

    def add(node) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[number][:2] = [split.featureIndex(), split.threshold()]
            nodes[number][2:4] = [add(node.leftChild()), add(node.rightChild())]
        return number

    root = [add(tree._java_obj.rootNode()) for tree in ensemble.trees]
    feature, threshold, left, right, value = zip(*nodes)
    whole = [np.array(x, np.int64) for x in (feature, left, right, root)]
    return TreeArrays(whole[0], np.array(threshold, float), whole[1], whole[2], np.array(value, float), whole[3], np.array(ensemble.treeWeights, float))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def score(df: DataFrame, model_or_path) -> DataFrame:
    """Batch scoring with a saved model version (path) or a model."""
    model = PipelineModel.load(model_or_path) if isinstance(model_or_path, str) else model_or_path
    out = model.transform(df)
    drop = [c for c in out.columns if c in ("features", "rawPrediction", "probability") or c.endswith("__imp") or c == "__tok"]
    return out.drop(*drop)


def importances(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame:
    """M5: feature importances (tree models) or |coefficients|, sorted."""
    last = model.stages[-1]
    vals = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(names, vals)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def log_run(spark: SparkSession, run: str, params: dict, metrics: dict) -> DataFrame:
    """M6: one row per param/metric: ``(run, kind, key, value)``."""
    rows = [(run, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, "metric", k, str(float(v))) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run string, kind string, key string, value string")


def improvement(runs: DataFrame, a: str, b: str, metric: str, lower_is_better: bool = True) -> DataFrame:
    """M7: relative improvement of run ``b`` over run ``a`` on ``metric`` (%)."""
    m = runs.filter((F.col("kind") == "metric") & (F.col("key") == metric))
    va = F.max(F.when(F.col("run") == a, F.col("value").cast("double")))
    vb = F.max(F.when(F.col("run") == b, F.col("value").cast("double")))
    sign = 1.0 if lower_is_better else -1.0
    return m.agg(va.alias("a"), vb.alias("b")).select(
        F.lit(metric).alias("metric"),
        "a",
        "b",
        (safe_div((F.col("a") - F.col("b")) * sign, F.col("a")) * 100).alias("improvement_pct"),
    )


def evaluate_classifier(pred: DataFrame, label: str) -> DataFrame:
    """M4 on a scored frame."""
    return weighted_prf(pred, label, f"{label}_prediction")


def linear_coefficients(model: PipelineModel, names: list[str]) -> dict:
    lr = model.stages[-1]
    coef = {"intercept": float(lr.intercept)}
    coef.update({n: float(c) for n, c in zip(names, lr.coefficients.toArray())})
    return coef
