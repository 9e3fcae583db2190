"""Training on a written matrix, and the registry of runs."""

import numpy as np
from pyspark.sql import functions as F

from aevia.ml import models as M
from aevia.ml import registry as R
from aevia.schemas import FEATURE_COLS
from aevia.sources import storage as T


def features(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        drugs, felt, suspect = int(rng.integers(1, 6)), int(rng.integers(0, 4)), int(rng.integers(0, 2))
        serious = int(rng.random() < 1 / (1 + np.exp(-(drugs - 3 + suspect))))
        rows.append((str(i), None if i % 9 == 0 else int(rng.integers(1, 90)), ["Male", "Female", None][i % 3], ["FR", "US", None][i % 3],
                     drugs, felt, suspect, None if i % 17 == 0 else serious))
    return spark.createDataFrame(rows, "safety_report_id string, patient_age int, patient_sex string, country string, "
                                       "num_drugs long, num_reactions long, has_suspect_drug int, is_serious int")


def newton(x, y, penalty, steps=60):
    """Weights of mean log loss plus penalty * |w|^2 / 2, intercept free."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) / len(x) + ridge, a.T @ (p - y) / len(x) + ridge @ w)
    return w


def test_runs_models_and_predictions(spark, scratch):
    registry = R.Registry(spark, scratch)
    assert registry.runs().count() == 0
    runs = R.train_models(spark, features(spark), scratch)
    assert R.train_models(spark, features(spark).repartition(5), scratch) == runs  # the same rows, other files
    assert sorted(r.run_id for r in registry.runs().collect()) == sorted(runs.values())
    audit = {r.model_type: r for r in registry.audit(f"{scratch}/matrix").collect()}
    assert set(audit) == set(M.MODELS) and all(r.runs == 1 and r.same_metrics for r in audit.values())
    # the returned frames are scans: no model, no user function, one stage
    for run in runs.values():
        plan = registry.predictions(run)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" in plan and "UDF" not in plan and "Exchange" not in plan
        assert registry.predictions(run).count() == audit["RandomForest"].test_size
    # other rows, or other parameters, are other runs
    other = registry.train("RandomForest", f"{scratch}/matrix", {**M.RF_PARAMS, "n_estimators": 3})
    assert other not in runs.values() and registry.runs().count() == 3
    assert R.snapshot(spark.read.parquet(f"{scratch}/matrix")) != R.snapshot(spark.read.parquet(f"{scratch}/matrix").limit(100))
    # coefficients by a plain Newton solve
    train, test = R.read_matrix(spark, f"{scratch}/matrix")
    rows = train.select(*FEATURE_COLS, "label").collect()
    x, y = np.array([r[:-1] for r in rows], float), np.array([r[-1] for r in rows], float)
    model = registry.model(runs["LogisticRegression"], "LogisticRegression")
    w = newton(x, y, 1.0 / len(x))
    assert np.allclose(np.append(model.coefficients.toArray(), model.intercept), w, rtol=1e-3, atol=1e-4)
    # the column expression and the library's own scores
    ours = {r[0]: r for r in R.apply_model(model, test).collect()}
    for r in M.predict(model, test).collect():
        assert ours[r[0]].prediction == r.prediction and abs(ours[r[0]].score - r.score) < 1e-12


def test_half_written_run_is_replaced(spark, scratch):
    """A run without its row (the last thing written) is trained again."""
    matrix = R.write_matrix(features(spark, 80), scratch, fit_on="train")
    registry = R.Registry(spark, scratch)
    run = R.run_id("LogisticRegression", M.LR_PARAMS, R.snapshot(spark.read.parquet(matrix)))
    spark.range(3).write.parquet(f"{scratch}/predictions/{run}")
    assert registry.train("LogisticRegression", matrix) == run
    assert "score" in registry.predictions(run).columns and registry.runs().count() == 1
    assert T.path_exists(spark, f"{scratch}/models/{run}")


def test_matrix_is_whole(spark, scratch):
    path = R.write_matrix(features(spark), scratch)
    m = spark.read.parquet(path)
    assert m.count() == 400 and m.where(F.col("label").isNull()).count() == 0
    sizes = {r.label: (r.n, r.t) for r in m.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert all(t == round(0.2 * n) for n, t in sizes.values())
