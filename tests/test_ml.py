"""Metrics on fixed vectors, feature preparation, split and a training smoke run."""

import pytest
from pyspark.sql import functions as F

from aevia.ml import metrics as ME


def frame(spark, y, pred=None, prob=None):
    pred = pred or [0] * len(y)
    prob = prob or [0.0] * len(y)
    return spark.createDataFrame(list(zip(y, pred, prob)), "label int, prediction int, score double")


def test_perfect_scores(spark):
    df = frame(spark, [0, 1, 1, 0], [0, 1, 1, 0], [0.1, 0.9, 0.8, 0.2])
    m = ME.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 1.0, 1.0, 1.0)
    assert ME.roc_auc(df).first().roc_auc == 1.0


def test_no_positive_prediction_and_one_class(spark):
    df = frame(spark, [1, 0, 1, 0, 0, 1], [0] * 6, [0.3, 0.2, 0.4, 0.1, 0.5, 0.6])
    m = ME.classification_metrics(df).first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)
    assert m.accuracy == 0.5
    one = frame(spark, [1, 1, 1], [1, 1, 1], [0.2, 0.5, 0.9])
    assert ME.roc_auc(one).first().roc_auc is None


def test_auc_ties_count_half(spark):
    df = frame(spark, [0, 1, 0, 1, 1, 0, 1, 0], None, [0.5, 0.5, 0.1, 0.9, 0.3, 0.3, 0.7, 0.2])
    # brute force over all positive/negative pairs
    pos = [0.5, 0.9, 0.3, 0.7]
    neg = [0.5, 0.1, 0.3, 0.2]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 16
    assert ME.roc_auc(df).first().roc_auc == round(want, 4)


def test_auc_many_ranges_equals_brute_force(spark):
    import random

    rnd = random.Random(7)
    y = [rnd.randint(0, 1) for _ in range(400)]
    s = [round(rnd.random(), 2) for _ in range(400)]  # many ties
    df = frame(spark, y, None, s)
    pos = [x for x, t in zip(s, y) if t == 1]
    neg = [x for x, t in zip(s, y) if t == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    cum = ME.cumulative_by_score(ME.score_counts(df), max_ranges=8)
    assert cum.agg(F.max("cum_pos")).first()[0] == len(pos)
    assert ME.roc_auc(df).first().roc_auc == round(want, 4)


def test_roc_points_and_class_report(spark):
    df = frame(spark, [0, 1, 1, 0], [0, 1, 0, 0], [0.1, 0.9, 0.4, 0.4])
    pts = sorted((r.fpr, r.tpr) for r in ME.roc_points(df).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    rep = {r["class"]: r for r in ME.class_report(df).collect()}
    assert rep[1].support == 2 and rep[1].precision == 1.0 and rep[1].recall == 0.5
    assert rep[0].support == 2


def test_prepare_features_and_split(spark):
    from aevia.ml.features import prepare_features, train_test_split

    rows = [(str(i), 30 + i % 50 if i % 7 else None, ["Male", "Female", None][i % 3], ["FR", "US", None][i % 3],
             1 + i % 4, 1 + i % 3, i % 2, None if i % 11 == 0 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "safety_report_id string, patient_age int, patient_sex string, country string, "
                                     "num_drugs long, num_reactions long, has_suspect_drug int, is_serious int")
    prep, fitted = prepare_features(df)
    nulls = prep.select([F.count_if(F.col(c).isNull()).alias(c) for c in prep.columns if c != "features"]).first()
    assert all(v == 0 for v in nulls.asDict().values())
    sexes = {r.patient_sex for r in prep.select("patient_sex").distinct().collect()}
    assert sexes == {0.0, 1.0, 2.0}  # Female, Male, Unknown in alphabetical order
    train, test = train_test_split(prep)
    assert train.count() + test.count() == 200
    sizes = {r.label: r["count"] for r in prep.groupBy("label").count().collect()}
    taken = {r.label: r["count"] for r in test.groupBy("label").count().collect()}
    assert taken == {y: round(0.2 * n) for y, n in sizes.items()}  # exact in each class
    again = {r.safety_report_id for r in train_test_split(prep)[1].collect()}
    assert again == {r.safety_report_id for r in test.collect()}


def test_training_smoke(spark, scratch):
    from aevia.ml import models as M
    from aevia.plans.queries import Ctx
    from conftest import SF_SMALL

    feats = Ctx(spark, SF_SMALL).gold["ml_features"]
    out = M.run_training(spark, feats, runs_path=f"{scratch}/runs", model_path=f"{scratch}/models")
    for name in ("LogisticRegression", "RandomForest"):
        m = out[name]["metrics"]
        assert set(m) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
        assert all(v is None or 0.0 <= v <= 1.0 for v in m.values())
    runs = spark.read.parquet(f"{scratch}/runs")
    assert runs.count() == 2
    best = M.best_run(runs).first()
    assert best.model_type in ("LogisticRegression", "RandomForest")
    flat = M.flatten_runs(runs)
    assert {"model_type", "roc_auc", "C", "n_estimators"} <= set(flat.columns)
    assert M.compare_runs(runs).count() == 10
    assert M.feature_importances(spark, out["RandomForest"]["model"]).count() == 6
    with pytest.raises(ValueError):
        M.best_run(runs.where(F.lit(False)))


def test_run_records_and_export(spark, scratch):
    from aevia.ml import models as M

    a = M.run_record(spark, "LogisticRegression", {"C": 1.0, "model_type": "LogisticRegression"},
                     {"roc_auc": 0.7, "f1": 0.5}, start_ms=1_700_000_000_000)
    b = M.run_record(spark, "RandomForest", {"n_estimators": 100, "model_type": "RandomForest"},
                     {"roc_auc": 0.8, "accuracy": 0.9})
    runs = a.unionByName(b)
    assert str(a.first().start_time).startswith("2023-11-14 22:13:20")
    path = M.export_runs(runs, f"{scratch}/runs_flat")
    flat = spark.read.parquet(path)
    assert {"C", "n_estimators", "roc_auc", "accuracy", "f1"} <= set(flat.columns)
    assert M.best_run(runs).first().model_type == "RandomForest"
    assert M.export_runs(runs.where(F.lit(False)), f"{scratch}/none") == ""


def test_auc_equals_spark_evaluator(spark):
    from aevia.ml import models as M
    from aevia.ml.features import prepare_features, train_test_split
    from aevia.plans.queries import Ctx
    from conftest import SF_SMALL

    prep, _ = prepare_features(Ctx(spark, SF_SMALL).gold["ml_features"])
    train, test = train_test_split(prep)
    model = M.logistic_regression(train.count()).fit(train)
    out = model.transform(test)
    ours = ME.roc_auc(M.predict(model, test)).first().roc_auc
    assert ours == round(M.evaluator_auc(out), 4)


def test_training_fit_on_train_split(spark):
    from aevia.ml import models as M
    from aevia.plans.queries import Ctx
    from conftest import SF_SMALL

    out = M.run_training(spark, Ctx(spark, SF_SMALL).gold["ml_features"], fit_on="train")
    assert out["runs"].count() == 2
    assert all(0.0 <= v <= 1.0 for v in out["RandomForest"]["metrics"].values() if v is not None)


def test_shared_folder_is_asked_for(spark, monkeypatch):
    from aevia import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, key, default):
            return default

        _jsc = type("J", (), {"sc": lambda self: type("S", (), {
            "getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(type("Session", (), {"sparkContext": Context()})())
