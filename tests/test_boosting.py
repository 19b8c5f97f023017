"""Boosting on many rows is MLlib's, told by histograms between tasks."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import boosting, forest
from tidemark.operators import ml as ML
from tidemark.operators.registry import Registry, load
from tidemark.operators.scoring import raw_score
from tidemark.spec import VIDEO_STREAMING as U


def _rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 40, (n, len(U.features))).astype(float)  # so few values that cuts are between all of them
    y = np.sin(x[:, 0] / 5) + x[:, 1] * x[:, 2] / 400 + rng.normal(0, 0.1, n)
    return x, y


def _table(spark, x, y):
    return spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], ", ".join(["id long", *(f"{f} double" for f in (*U.features, U.target))]))


@pytest.mark.parametrize("least", [1, 40])
def test_it_is_the_ensemble_of_mllib(spark, monkeypatch, tmp_dir, least):
    x, y = _rows()
    data = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"])
    est = ML.make_model("GradientBoostingRegressor", {"n_estimators": 20, "learning_rate": 0.05, "max_depth": 4, "random_state": 42}).setMinInstancesPerNode(least)
    monkeypatch.setattr(boosting, "TASK_ROWS", 700)  # four tasks
    model = boosting.fit(data, est, f"{tmp_dir}/b", len(y))
    table = _table(spark, x, y)
    ours = {r.id: r.p for r in model.score(table, U.features, "p").collect()}
    theirs = {r.id: r.p for r in raw_score(table, U, est.fit(data), out="p").collect()}
    assert max(abs(ours[i] - theirs[i]) for i in ours) < 1e-9 and len(ours) == len(y)
    assert model.trees().count() == 20


def test_many_rows_are_boosted_between_tasks(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(boosting, "MANY_ROWS", 1000)
    x, y = _rows()
    table = _table(spark, x, y)
    params = {"n_estimators": 5, "learning_rate": 0.05, "max_depth": 3, "random_state": 42}
    fitted, _ = ML.fit_all(table, U, [("b", "GradientBoostingRegressor", params)], strict=True)
    model = fitted["b"]
    assert isinstance(model, forest.BoostedTrees)
    reg = Registry(spark, f"{tmp_dir}/r")
    reg.register(U.name, "a", "b", model)
    found = reg.candidates(U.name).first()
    again = load(found["kind"], found["path"])
    assert isinstance(again, forest.BoostedTrees)
    both = raw_score(raw_score(table, U, model, out="p"), U, again, out="q")
    assert both.where(F.col("p") != F.col("q")).count() == 0
    few, _ = ML.fit_all(table.limit(900), U, [("b", "GradientBoostingRegressor", params)], strict=True)
    assert not isinstance(few["b"], forest.GrownForest)


def test_other_configurations_are_left_to_mllib(spark):
    est = ML.make_model("GradientBoostingRegressor", {"max_depth": 4})
    assert boosting.many_rows(est, 10**6, spark) and not boosting.many_rows(est, 10**5, spark)
    assert not boosting.many_rows(ML.make_model("GradientBoostingRegressor", {"subsample": 0.5}), 10**6, spark)
    assert not boosting.many_rows(ML.make_model("GradientBoostingRegressor", {"max_depth": 12}), 10**6, spark)


def test_equal_labels_give_one_leaf(spark, tmp_dir):
    data = spark.createDataFrame([(Vectors.dense([float(i), 1.0]), 2.5) for i in range(50)], ["features", "label"])
    model = boosting.fit(data, ML.make_model("GradientBoostingRegressor", {"n_estimators": 3}), f"{tmp_dir}/b", 50)
    assert [(list(r.feature), [round(v, 12) for v in r.value]) for r in model.trees().orderBy("tree").collect()] == [([-1], [2.5]), ([-1], [0.0]), ([-1], [0.0])]
