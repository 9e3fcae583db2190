"""Training on a written feature matrix, with a registry of runs.

* The prepared and split rows are written once (``write_matrix``); counts,
  bins and every pass of a fit scan that table, never the chain that made it.
* A run is named by a hash of its model, its parameters and the content of
  its matrix. Training the same again finds the run and does nothing; a run
  that failed half-way is replaced whole, its row last.
* Models are saved by the Spark ML writer and read back before they are used;
  predictions are written and read back, so what is returned is a scan.
* A saved logistic regression is applied as a column expression of its
  coefficients, inside generated code.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.ml import models as M
from aevia.ml.features import ID, prepare_features, train_test_split, with_split
from aevia.schemas import FEATURE_COLS
from aevia.sources import storage as T

PARAMS = {"LogisticRegression": M.LR_PARAMS, "RandomForest": M.RF_PARAMS}
LOADERS = {"LogisticRegression": LogisticRegressionModel, "RandomForest": RandomForestClassificationModel}
THRESHOLD = 0.5


def write_matrix(features: DataFrame, root: str, fit_on: str = "all") -> str:
    """ML1-ML5: (id, feature columns, label, is_test) of a feature table,
    written once. The features are written first, as fit and split each
    read them. ``fit_on="train"`` fits encoders and medians on training rows."""
    spark = features.sparkSession
    features.write.mode("overwrite").parquet(f"{root}/features")
    rows = spark.read.schema(features.schema).parquet(f"{root}/features")
    prepared, _ = prepare_features(rows, fit_on=train_test_split(rows)[0] if fit_on == "train" else None)
    with_split(prepared.drop("features")).write.mode("overwrite").parquet(f"{root}/matrix")
    return f"{root}/matrix"


def read_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a written matrix, features assembled."""
    rows = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features").transform(spark.read.parquet(path))
    return rows.where(~F.col("is_test")).drop("is_test"), rows.where("is_test").drop("is_test")


def snapshot(matrix: DataFrame) -> str:
    """A fingerprint of a matrix: its rows, in whatever order and files."""
    n, bits, total = matrix.select(F.xxhash64(*sorted(matrix.columns)).alias("h")).agg(
        F.count("h"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n}:{bits}:{total}"


def run_id(name: str, params: dict, content: str) -> str:
    said = "\n".join([name, *(f"{k}={params[k]}" for k in sorted(params)), content])
    return hashlib.md5(said.encode()).hexdigest()


def logistic_score(rows: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """ML8 for a logistic regression given by its coefficients: (id, label,
    prediction, score), plain columns."""
    z = F.lit(float(intercept))
    for c in FEATURE_COLS:
        z = z + F.lit(float(weights[c])) * F.col(c)
    score = 1 / (1 + F.exp(-z))
    return rows.select(ID, "label", (score > THRESHOLD).cast("int").alias("prediction"), score.alias("score"))


def apply_model(model, rows: DataFrame) -> DataFrame:
    """ML8: predicted label and P(class 1) per report."""
    if isinstance(model, LogisticRegressionModel):
        return logistic_score(rows, dict(zip(FEATURE_COLS, model.coefficients.toArray().tolist())), model.intercept)
    return M.predict(model, rows)


class Registry:
    """Runs, models and predictions under one folder of the lake."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def runs(self) -> DataFrame:
        """The rows of all runs (ML16-ML18 read them)."""
        return T.read_or_empty(self.spark, f"{self.root}/runs", M.MODEL_RUNS).select(*M.MODEL_RUNS.fieldNames())

    def model(self, run: str, name: str):
        return LOADERS[name].load(f"{self.root}/models/{run}")

    def predictions(self, run: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/predictions/{run}")

    def train(self, name: str, matrix_path: str, params: dict | None = None) -> str:
        """ML14: the run of a model, its parameters and a matrix: found, or
        trained, saved, read back, scored on the test rows and logged. Gives
        the run's id."""
        params = PARAMS[name] if params is None else params
        matrix = self.spark.read.parquet(matrix_path)
        run = run_id(name, params, snapshot(matrix))
        if T.has_parquet_files(self.spark, f"{self.root}/runs/run={run}"):
            return run
        train, test = read_matrix(self.spark, matrix_path)
        sizes = {r["is_test"]: r["count"] for r in matrix.groupBy("is_test").count().collect()}
        fitted = self._estimator(name, params, matrix, sizes.get(False, 0)).fit(train)
        fitted.write().overwrite().save(f"{self.root}/models/{run}")
        scored = apply_model(self.model(run, name), test)
        scored.write.mode("overwrite").parquet(f"{self.root}/predictions/{run}")
        said = {**params, "model_type": name, "train_size": sizes.get(False, 0), "test_size": sizes.get(True, 0), "features": FEATURE_COLS}
        record = M.run_record(self.spark, name, said, M.evaluate(self.predictions(run)))
        record.withColumn("run_id", F.lit(run)).write.mode("overwrite").parquet(f"{self.root}/runs/run={run}")
        return run

    def _estimator(self, name: str, params: dict, matrix: DataFrame, n_train: int):
        if name == "LogisticRegression":
            return M.logistic_regression(n_train, params)
        levels = matrix.where(~F.col("is_test")).agg(*[F.count_distinct(c).alias(c) for c in FEATURE_COLS]).first()
        return M.random_forest(params).setMaxBins(max(32, *[int(n) for n in levels]))

    def audit(self, matrix_path: str) -> DataFrame:
        """ML19: every run's saved model read back and applied to the test
        rows anew: (model_type, train_size, test_size, runs, same_metrics),
        the last whether the logged metrics come out again."""
        _, test = read_matrix(self.spark, matrix_path)
        rows = []
        for r in self.runs().collect():  # one row a run
            name = r["params"]["model_type"]
            again = M.evaluate(apply_model(self.model(r["run_id"], name), test))
            rows.append((name, int(r["params"]["train_size"]), int(r["params"]["test_size"]), again == r["metrics"]))
        found = self.spark.createDataFrame(rows, "model_type string, train_size long, test_size long, same boolean")
        return found.groupBy("model_type", "train_size", "test_size").agg(
            F.count(F.lit(1)).alias("runs"), F.bool_and("same").alias("same_metrics"))


def train_models(spark: SparkSession, features: DataFrame, root: str, fit_on: str = "all") -> dict[str, str]:
    """ML15: the runs of both models on a feature table, by name."""
    matrix = write_matrix(features, root, fit_on)
    registry = Registry(spark, root)
    return {name: registry.train(name, matrix) for name in M.MODELS}
