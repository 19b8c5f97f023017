"""Validation, quarantine and scoring of single records and edge rows."""

from pyspark.sql import functions as F

from tidemark.operators.quality import is_valid, quarantine
from tidemark.operators.scoring import LinearScorer, fixed_scorer, score
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING

CLOUD = "id long, CPU_usage int, GPU_usage int, Bandwidth_MBps double, Latency_ms int, FrameRate_fps int, Jitter_ms int"
VIDEO = "id long, throughput double, avg_bitrate double, delay_qos double, jitter double, packet_loss double"
INF = float("inf")


def test_api_payloads_are_valid(spark):
    c = spark.createDataFrame([(1, 50, 40, 25.5, 35, 60, 3)], CLOUD)
    v = spark.createDataFrame([(1, 2000.0, 1500.0, 50.0, 5.0, 0.0)], VIDEO)
    assert c.filter(is_valid(CLOUD_GAMING)).count() == 1
    assert v.filter(is_valid(VIDEO_STREAMING)).count() == 1


def test_cloud_edge_rows(spark):
    rows = [
        (1, -1, 40, 25.5, 35, 60, 3),
        (2, 101, 40, 25.5, 35, 60, 3),
        (3, 50, 40, float("nan"), 35, 60, 3),
        (4, 50, 40, INF, 35, 60, 3),
        (5, 50, 40, 25.5, None, 60, 3),
        (6, 0, 100, 0.0, 0, 0, 0),
        (7, 100, 0, 1e9, 10**6, 500, 1000),
    ]
    df = spark.createDataFrame(rows, CLOUD)
    ok, bad = quarantine(df, CLOUD_GAMING)
    assert sorted(r.id for r in ok.collect()) == [6, 7]
    reasons = {r.id: r.reasons for r in bad.collect()}
    assert reasons == {
        1: "CPU_usage:below_min",
        2: "CPU_usage:above_max",
        3: "Bandwidth_MBps:nan",
        4: "Bandwidth_MBps:infinite",
        5: "Latency_ms:missing",
    }


def test_video_edge_rows_and_several_reasons(spark):
    rows = [
        (1, -1.0, 1.0, 1.0, 1.0, 1.0),
        (2, float("-inf"), None, float("nan"), 1.0, -0.5),
        (3, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    ok, bad = quarantine(spark.createDataFrame(rows, VIDEO), VIDEO_STREAMING)
    assert [r.id for r in ok.collect()] == [3]
    reasons = {r.id: r.reasons for r in bad.collect()}
    assert reasons[2] == "throughput:infinite;avg_bitrate:missing;delay_qos:nan;packet_loss:below_min"


def test_score_skips_invalid_and_classifies(spark):
    df = spark.createDataFrame([(1, 50, 40, 25.5, 35, 60, 3), (2, -1, 40, 25.5, 35, 60, 3)], CLOUD)
    out = score(df, CLOUD_GAMING, fixed_scorer(CLOUD_GAMING)).collect()
    assert [r.id for r in out] == [1]
    s = 5.6 - 0.012 * 35 - 0.04 * 3 + 0.012 * (60 - 60) + 0.008 * (25.5 - 55) - 0.012 * (50 - 50) - 0.008 * (40 - 40)
    assert abs(out[0].predicted_qoe - round(s, 2)) < 1e-12
    assert out[0].qoe_class == "Excellent"


def test_linear_scorer_is_one_codegen_expression(spark):
    df = spark.createDataFrame([(1, 50, 40, 25.5, 35, 60, 3)], CLOUD)
    sc = LinearScorer(1.0, (("CPU_usage", 0.5, None), ("GPU_usage", -0.25, 40)))
    plan = score(df, CLOUD_GAMING, sc)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert score(df, CLOUD_GAMING, sc).first().predicted_qoe == 26.0


def test_project_and_cast(spark):
    from tidemark.operators.quality import cast_double, project_kpi

    df = spark.createDataFrame([(1, 50, 40, 25.5, 35, 60, 3)], CLOUD)
    out = project_kpi(cast_double(df, ["CPU_usage"]), CLOUD_GAMING)
    assert out.columns == list(CLOUD_GAMING.features)
    assert dict(out.dtypes)["CPU_usage"] == "double"
    assert out.select(F.col("GPU_usage")).dtypes[0][1] == "int"
