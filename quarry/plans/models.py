"""Model training / scoring / comparison queries.  Fitted models have no SQL
form; ``tests/test_models.py`` bounds what each of them must reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.features import split_by_date
from quarry.operators.ml import (
    evaluate_classifier,
    improvement,
    importances,
    linear_coefficients,
    log_run,
    save_model,
    score,
    text_vectors,
    train_gbt,
    train_logreg,
    train_regressor,
    train_vector_logreg,
    tree_arrays,
)
from quarry.operators.timeseries import forecast, forecast_errors, future_stubs, ts_features
from quarry.plans.capacity import CUTOFFS, EXOG, FIRST_SCORED, H, daily_series
from quarry.plans.maintenance import LAG_COLS, bq9_training_dataset
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources.sinks import materialize, snapshot
from quarry.sources.tables import load

LABEL = "fails_next_day"
# Training and validation windows of model versions 1 and 2
# (validation stops the boosting) and the test window, which only scores.
RANGES = {
    "train_v1": ("2024-01-04", "2024-01-13"),
    "valid_v1": ("2024-01-14", "2024-01-16"),
    "train_v2": ("2024-01-04", "2024-01-19"),
    "valid_v2": ("2024-01-20", "2024-01-22"),
    "test": ("2024-01-23", "2024-01-30"),
}


def _metrics(pred: DataFrame, label: str) -> dict:
    r = evaluate_classifier(pred, label).first()  # one row: bounded
    return {"precision": r.precision, "recall": r.recall, "f1": r.f1, "n": r.n}


@query("failure_model_runs")
def failure_model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train boosted trees on two cutoffs (and a logistic
    regression), save, reload and score the same test window, compare.

    Returns the run log ``(run, kind, key, value)`` plus feature importances
    and the v2-over-v1 F1 improvement as rows.
    """
    # F7 + S14: the training dataset is an immutable versioned snapshot (with
    # a manifest of rows, columns and sources) under the shared folder; the
    # model fits scan it many times, and the written table cuts the lineage.
    ds = bq9_training_dataset(spark, sf_dir)
    ds = snapshot(ds, scratch_path(spark, "datasets"), "failure_dataset", "v1", sources=["events"])
    parts = split_by_date(ds, "date", RANGES)
    runs = []
    models = {}
    for version in ("v1", "v2"):
        name = f"gbt_{version}"
        # 10 rounds at most, stopped early on the validation window
        m = train_gbt(parts[f"train_{version}"], LAG_COLS, LABEL, max_iter=10, seed=42, impute=True, validation=parts[f"valid_{version}"])
        path = save_model(m, scratch_path(spark, f"model-{name}"))
        models[name] = m
        pred = score(parts["test"], path)
        runs.append(log_run(spark, name, {"model": "gbt", "max_iter": 10, "impute": "mean", "early_stopping": "validation", "train_to": RANGES[f"train_{version}"][1]}, _metrics(pred, LABEL)))
    lr = train_logreg(parts["train_v2"], LAG_COLS, LABEL, impute=True)
    runs.append(log_run(spark, "logreg_v2", {"model": "logreg", "impute": "mean"}, _metrics(score(parts["test"], lr), LABEL)))
    log = runs[0]
    for r in runs[1:]:
        log = log.unionByName(r)
    imp = importances(spark, models["gbt_v2"], LAG_COLS).select(
        F.lit("gbt_v2").alias("run"), F.lit("importance").alias("kind"), F.col("feature").alias("key"),
        F.col("importance").cast("string").alias("value"),
    )
    cmp = improvement(log, "gbt_v1", "gbt_v2", "f1", lower_is_better=False).select(
        F.lit("gbt_v2_vs_gbt_v1").alias("run"), F.lit("improvement_pct").alias("kind"), F.col("metric").alias("key"),
        F.col("improvement_pct").cast("string").alias("value"),
    )
    return log.unionByName(imp).unionByName(cmp)


@query("doc_quality_model")
def doc_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 trained alternative + M3/M4: hashed words and signs -> logistic
    regression predicting `labels.quality`, split 80/20 by a hash of doc_id.
    The vectors, not the texts, are written for the fit and the scoring."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    d = materialize(text_vectors(docs.join(lab, "doc_id"), "text"), scratch_path(spark, "quality-dataset"))
    is_test = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    m = train_vector_logreg(d.filter(~is_test), "quality")
    pred = score(d.filter(is_test), m)
    met = _metrics(pred, "quality")
    return log_run(spark, "doc_quality_logreg", {"features": "hashed words and signs 2^16"}, met)


# What the recursive model learns from: lags, a rolling and an expanding mean,
# the weekday and the carried exogenous features.
RECURSIVE = ["y_lag_1", "y_lag_7", "y_lag7_roll7_mean", "y_expanding_mean", "day_of_week", *EXOG]
# The direct model may only use what is known H <= 7 days ahead.
DIRECT = ["y_lag_7", "y_lag7_roll7_mean", "day_of_week", *EXOG]


def _complete(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols).withColumn("y", F.col("y").cast("double"))


@query("forecast_recursive")
def forecast_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M15 + M16: linear model on all features of the daily series,
    then an H-step recursive forecast per series (applyInPandas)."""
    d = materialize(daily_series(spark, sf_dir), scratch_path(spark, "daily-series"))
    train = _complete(ts_features(d, "series", "ds", "y"), RECURSIVE)
    m = train_regressor(train, RECURSIVE, "y", kind="linear")
    coef = linear_coefficients(m, RECURSIVE)  # one number per feature
    return forecast(future_stubs(d, "series", "ds", "y", H, EXOG), "series", "ds", "y", coef, exog=tuple(EXOG))


@query("forecast_recursive_trees")
def forecast_recursive_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M16: boosted trees on all features of the daily series, recursed H
    steps ahead per series; every prediction feeds the lags of the next."""
    d = materialize(daily_series(spark, sf_dir), scratch_path(spark, "daily-series"))
    m = train_regressor(_complete(ts_features(d, "series", "ds", "y"), RECURSIVE), RECURSIVE, "y", kind="trees")
    ahead = future_stubs(d, "series", "ds", "y", H, EXOG)
    return forecast(ahead, "series", "ds", "y", exog=tuple(EXOG), model=tree_arrays(m), model_features=tuple(RECURSIVE))


@query("forecast_direct_trees")
def forecast_direct_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M10: boosted trees on features known a week ahead score all H days at once."""
    d = materialize(daily_series(spark, sf_dir), scratch_path(spark, "daily-series"))
    m = train_regressor(_complete(ts_features(d, "series", "ds", "y"), DIRECT), DIRECT, "y", kind="trees")
    ahead = ts_features(future_stubs(d, "series", "ds", "y", H, EXOG), "series", "ds", "y").filter("y IS NULL")
    return score(ahead.select("series", "ds", *DIRECT).dropna(), m).select("series", "ds", F.col("y_prediction").alias("forecast"))


@query("forecast_retrain")
def forecast_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M22 for the forecast: trees trained up to two cutoffs score the same
    last days; errors per version and the improvement of the later one."""
    d = materialize(daily_series(spark, sf_dir), scratch_path(spark, "daily-series"))
    f = materialize(_complete(ts_features(d, "series", "ds", "y"), DIRECT), scratch_path(spark, "daily-features"))
    test = f.filter(F.col("ds") >= F.lit(FIRST_SCORED).cast("date"))
    log = None
    for version, cutoff in CUTOFFS.items():
        m = train_regressor(f.filter(F.col("ds") <= F.lit(cutoff).cast("date")), DIRECT, "y", kind="trees")
        e = forecast_errors(score(test, m), "series", "y", "y_prediction")[1].first()  # one row
        run = log_run(spark, f"trees_{version}", {"train_to": cutoff}, {"rmse": e["rmse"], "smape": e["smape"]})
        log = run if log is None else log.unionByName(run)
    better = improvement(log, "trees_v1", "trees_v2", "rmse").select(
        F.lit("trees_v2_vs_trees_v1").alias("run"), F.lit("improvement_pct").alias("kind"), F.col("metric").alias("key"), F.col("improvement_pct").cast("string").alias("value")
    )
    return log.unionByName(better)
