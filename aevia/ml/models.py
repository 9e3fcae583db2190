"""Seriousness models, run records and model selection (ML6-ML8,
ML13-ML19).

Training runs on executors with ``pyspark.ml``. Each training run appends
one row to a ``model_runs`` table (id, name, status, start time, params and
metrics as maps); the best run and the side-by-side comparison are queries
over that table. Models are saved with the Spark ML writer.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.ml.features import prepare_features, train_test_split
from aevia.ml.metrics import classification_metrics, roc_auc
from aevia.schemas import FEATURE_COLS, MODEL_RUNS, RANDOM_STATE

log = logging.getLogger(__name__)

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]

# The model settings of the reference experiment.
LR_PARAMS = {"C": 1.0, "max_iter": 300, "solver": "lbfgs", "random_state": RANDOM_STATE}
RF_PARAMS = {"n_estimators": 100, "max_depth": 6, "random_state": RANDOM_STATE}


def logistic_regression(n_train: int, params: dict = LR_PARAMS) -> LogisticRegression:
    """ML6: L2-penalised logistic regression. The penalty C * sum(loss) +
    |w|^2 / 2 becomes Spark's mean-loss form with regParam = 1 / (C * n);
    no standardization, intercept not penalised."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=int(params["max_iter"]),
        regParam=1.0 / (float(params["C"]) * max(n_train, 1)),
        elasticNetParam=0.0,
        standardization=False,
        family="binomial",
    )


def random_forest(params: dict = RF_PARAMS) -> RandomForestClassifier:
    """ML7: 100 trees of depth 6, sqrt(features) per split, seeded."""
    return RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        numTrees=int(params["n_estimators"]),
        maxDepth=int(params["max_depth"]),
        featureSubsetStrategy="sqrt",
        seed=int(params["random_state"]),
    )


def predict(model, df: DataFrame) -> DataFrame:
    """ML8: predicted label and P(class 1) per report."""
    return model.transform(df).select(
        "safety_report_id",
        "label",
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def evaluate(scored: DataFrame) -> dict[str, float | None]:
    m = classification_metrics(scored).first().asDict()
    m["roc_auc"] = roc_auc(scored).first()["roc_auc"]
    return m


def evaluator_auc(model_output: DataFrame) -> float:
    """Spark's exact evaluator (no binning), for cross-checks."""
    ev = BinaryClassificationEvaluator(
        rawPredictionCol="rawPrediction", labelCol="label", metricName="areaUnderROC", numBins=0
    )
    return ev.evaluate(model_output)


def run_record(spark: SparkSession, name: str, params: dict, metrics: dict, status: str = "FINISHED",
               start_ms: int | None = None) -> DataFrame:
    """One ``model_runs`` row (a record of one training run); the start
    time is kept as epoch milliseconds and converted with
    ``timestamp_millis``."""
    start_ms = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000) if start_ms is None else int(start_ms)
    row = (
        uuid.uuid4().hex,
        name,
        status,
        start_ms,
        {k: str(v) for k, v in params.items()},
        {k: (None if v is None else float(v)) for k, v in metrics.items()},
    )
    raw = spark.createDataFrame(
        [row],
        "run_id string, run_name string, status string, start_ms long, "
        "params map<string,string>, metrics map<string,double>",
    )
    out = raw.select(
        "run_id", "run_name", "status", F.timestamp_millis("start_ms").alias("start_time"), "params", "metrics"
    )
    assert [f.name for f in out.schema] == [f.name for f in MODEL_RUNS.fields]
    return out


def train_and_log(spark: SparkSession, estimator, name: str, params: dict, train: DataFrame, test: DataFrame,
                  runs_path: str | None = None, model_path: str | None = None) -> tuple[dict, object, DataFrame]:
    """ML14: fit, score on test, record params + sizes + metrics, save."""
    model = estimator.fit(train)
    scored = predict(model, test).cache()
    try:
        metrics = evaluate(scored)
    finally:
        scored.unpersist()
    n_train, n_test = train.count(), test.count()
    p = {**params, "model_type": name, "train_size": n_train, "test_size": n_test, "features": FEATURE_COLS}
    rec = run_record(spark, name, p, metrics)
    if runs_path:
        rec.write.mode("append").parquet(runs_path)
    if model_path:
        model.write().overwrite().save(f"{model_path.rstrip('/')}/{name}")
    log.info("%s: %s", name, metrics)
    return metrics, model, rec


MODELS = ("LogisticRegression", "RandomForest")


def prepared_split(features: DataFrame, fit_on: str = "all") -> tuple[DataFrame, DataFrame]:
    """Training and test rows. ``fit_on="train"`` fits encoders and medians
    on the training split only."""
    fitted = train_test_split(features)[0] if fit_on == "train" else None
    return train_test_split(prepare_features(features, fit_on=fitted)[0])


def estimator_for(name: str, train: DataFrame, n_train: int | None = None):
    """One of ``MODELS``, unfitted; trees get a bin for every value that an
    encoded category or a count takes."""
    if name == "LogisticRegression":
        return logistic_regression(train.count() if n_train is None else n_train)
    levels = train.agg(*[F.count_distinct(c).alias(c) for c in FEATURE_COLS]).first()
    return random_forest().setMaxBins(max(32, *[int(n) for n in levels]))


def fit_model(name: str, train: DataFrame):
    return estimator_for(name, train).fit(train)


def run_training(spark: SparkSession, features: DataFrame, runs_path: str | None = None,
                 model_path: str | None = None, fit_on: str = "all") -> dict:
    """ML15: prepare, split, train both models, return their metrics (and
    the run rows). ``fit_on="train"`` fits encoders and medians on the
    training split only."""
    train, test = (df.cache() for df in prepared_split(features, fit_on))
    out, runs = {}, []
    try:
        n_train = train.count()
        for name, params in zip(MODELS, (LR_PARAMS, RF_PARAMS)):
            metrics, model, rec = train_and_log(
                spark, estimator_for(name, train, n_train), name, params, train, test, runs_path, model_path)
            out[name] = {"metrics": metrics, "model": model}
            runs.append(rec)
    finally:
        train.unpersist()
        test.unpersist()
    out["runs"] = runs[0].unionByName(runs[1])
    return out


def best_run(runs: DataFrame) -> DataFrame:
    """ML16 / TOP9: the run with the highest ROC-AUC (run id breaks ties);
    an empty run table is an error."""
    if runs.isEmpty():
        raise ValueError("no runs found")
    return (
        runs.select(
            "run_id", F.col("params")["model_type"].alias("model_type"),
            *[F.col("metrics")[m].alias(m) for m in METRICS],
        )
        .orderBy(F.desc_nulls_last("roc_auc"), "run_id")
        .limit(1)
    )


def flatten_runs(runs: DataFrame) -> DataFrame:
    """ML17 / SNK7: params and metrics maps spread into one column per key
    (the union of keys over all runs; a run without a key gets null)."""
    pkeys = sorted(r[0] for r in runs.select(F.explode(F.map_keys("params"))).distinct().collect())
    mkeys = sorted(r[0] for r in runs.select(F.explode(F.map_keys("metrics"))).distinct().collect())
    return runs.select(
        "run_id", "run_name", "status", "start_time",
        *[F.col("params")[k].alias(k) for k in pkeys],
        *[F.col("metrics")[k].alias(k) for k in mkeys if k not in pkeys],
    )


def export_runs(runs: DataFrame, path: str) -> str:
    """SNK7: write the flattened runs; an empty table is only a warning."""
    if runs.isEmpty():
        log.warning("no runs to export")
        return ""
    flatten_runs(runs).write.mode("overwrite").parquet(path)
    return path


def compare_runs(runs: DataFrame) -> DataFrame:
    """REP12 / RSH1: long form (model_type, Metric, Score)."""
    wide = runs.select(
        F.col("params")["model_type"].alias("model_type"), *[F.col("metrics")[m].alias(m) for m in METRICS]
    )
    return wide.unpivot("model_type", METRICS, "Metric", "Score")


def run_history(runs: DataFrame) -> DataFrame:
    """REP13 / SRT4 / ML18: runs side by side, best ROC-AUC first."""
    return runs.select(
        "run_name", F.col("params")["model_type"].alias("model_type"), "start_time",
        *[F.col("metrics")[m].alias(m) for m in METRICS],
    ).orderBy(F.desc_nulls_last("roc_auc"), "run_name")


def feature_importances(spark: SparkSession, forest_model) -> DataFrame:
    """ML13: (feature, importance), highest first."""
    imp = forest_model.featureImportances.toArray().tolist()
    return spark.createDataFrame(
        [(f, float(v)) for f, v in zip(FEATURE_COLS, imp)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
