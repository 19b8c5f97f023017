"""Split, weights, scaling, model factory, folding, metrics."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml as ML
from tidemark.operators.scoring import fold_linear, raw_score
from tidemark.sources.fixtures import training_frame
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("rank_rows", [2_000_000, 50])
def test_exact_split_size_disjoint_and_stable(spark, rank_rows):
    df = spark.range(0, 3001).withColumnRenamed("id", "id")
    train, test = ML.train_test_split(df, rank_rows=rank_rows)
    tr, te = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert len(te) == math.ceil(0.2 * 3001)
    assert not tr & te and len(tr | te) == 3001
    _, test2 = ML.train_test_split(df.repartition(7), rank_rows=rank_rows)
    assert {r.id for r in test2.collect()} == te


def test_split_refinement_equals_direct_rank(spark):
    df = spark.range(0, 2000)
    _, coarse = ML.train_test_split(df, rank_rows=10**9)
    _, fine = ML.train_test_split(df, rank_rows=20, buckets=16)
    assert {r.id for r in coarse.collect()} == {r.id for r in fine.collect()}


def test_global_rank_spans_partitions(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 997)
    r = ML._global_rank(df, ["k", "id"], rows=5000, rows_per_task=300)
    got = [(x.k, x.id, x._r) for x in r.collect()]
    want = sorted((k, i) for k, i, _ in got)
    assert sorted(got, key=lambda t: t[2]) == [(k, i, n + 1) for n, (k, i) in enumerate(want)]


def test_split_with_a_hot_key(spark):
    # a third of the rows share one split key: the boundary range cannot be
    # refined further and is ranked across partitions
    df = spark.range(0, 3000)
    key = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") * 7 % 1000)
    train, test = ML.train_test_split(df, key=key, rank_rows=100, buckets=8)
    te = {r.id for r in test.collect()}
    assert len(te) == 600 and train.count() == 2400
    rows = sorted((5 if i % 3 == 0 else i * 7 % 1000, i) for i in range(3000))
    assert te == {i for _, i in rows[:600]}


def test_training_parts():
    # by the number of rows, whatever the cluster: a bagged model depends on the partitions
    assert ML.training_parts(8_000) == 8
    assert ML.training_parts(500_000) == 64
    assert ML.training_parts(10**10) == 10_000
    assert ML.training_parts(0) == 1


def test_balanced_weights_sum_to_n(spark):
    df = spark.createDataFrame([(i, float(1 + i % 3 + (0.5 if i % 7 == 0 else 0))) for i in range(300)], "id long, y double")
    w = ML.balanced_weights(df, "y")
    total = w.agg(F.sum("w")).first()[0]
    assert abs(total - 300) < 1e-9


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    vals = [r.x for r in ML.standardize(df, ["x"]).collect()]
    assert abs(sum(vals)) < 1e-12 and abs(sum(v * v for v in vals) / 4 - 1) < 1e-12


@pytest.mark.parametrize("name,mtype,params", ML.DEFAULT_MODELS)
def test_model_types_construct(name, mtype, params):
    assert ML.make_model(mtype, params) is not None


def test_unknown_model_type_raises():
    with pytest.raises(ValueError):
        ML.make_model("SVR", {})


def test_unmapped_param_raises():
    with pytest.raises(ValueError):
        ML.make_model("ElasticNet", {"positive": True})


def test_linear_fit_folds_to_expression_and_recovers_fixture(spark):
    u = CLOUD_GAMING
    df = training_frame(spark, SF_SMALL, u)
    fitted, rep = ML.fit_all(df, u, [ML.DEFAULT_MODELS[0]])
    assert [r.status for r in rep.collect()] == ["ok"]
    model = fitted["linreg"]
    folded = fold_linear(model, u.features)
    a = raw_score(df, u, folded, out="p").select("id", "p")
    b = model.transform(ML.assemble(df, u)).select("id", F.col("prediction").alias("q"))
    diff = a.join(b, "id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert diff < 1e-9
    # latency coefficient of the fixture scorer is -0.012
    coef = dict((f, c) for f, c, _ in folded.terms)
    assert abs(coef["Latency_ms"] + 0.012) < 0.002


def test_metrics_against_python(spark):
    u = VIDEO_STREAMING
    rows = [(1, 3.0, 2.5), (2, 4.6, 4.4), (3, 1.0, 2.2), (4, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, y double, p double")
    m = ML.metrics(df, "y", "p", u).first()
    e = [y - p for _, y, p in rows]
    ys = [y for _, y, _ in rows]
    mean = sum(ys) / 4
    assert abs(m.mae - sum(abs(x) for x in e) / 4) < 1e-12
    assert abs(m.rmse - math.sqrt(sum(x * x for x in e) / 4)) < 1e-12
    assert abs(m.r2 - (1 - sum(x * x for x in e) / sum((y - mean) ** 2 for y in ys))) < 1e-12
    assert m.class_accuracy == 0.25  # Fair|Poor, Excellent|Good, Bad|Poor differ; Poor|Poor same


def test_leaderboard_promotes_lowest_rmse(spark):
    df = spark.createDataFrame(
        [("d", "b", 0.1, 0.5, 0.9, 0.8), ("d", "a", 0.1, 0.5, 0.9, 0.8), ("d", "c", 0.1, 0.3, 0.9, 0.8)],
        "dataset string, model string, mae double, rmse double, r2 double, class_accuracy double",
    )
    b = {r.model: (r.rank, r.promoted) for r in ML.leaderboard(df).collect()}
    assert b == {"c": (1, True), "a": (2, False), "b": (3, False)}
