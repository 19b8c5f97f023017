"""Class boundaries, rounding, clamping and lookups (ported boundary facts)."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING


def _eval(spark, values, fn, typ="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_cloud_class_boundaries(spark):
    got = _eval(spark, [1.99, 2.0, 2.99, 3.0, 3.99, 4.0], lambda c: S.classify(c, CLOUD_GAMING))
    assert got == ["Poor", "Fair", "Fair", "Good", "Good", "Excellent"]


def test_video_class_boundaries(spark):
    got = _eval(spark, [1.99, 2.0, 2.99, 3.0, 3.99, 4.0, 4.49, 4.5], lambda c: S.classify(c, VIDEO_STREAMING))
    assert got == ["Bad", "Poor", "Poor", "Fair", "Fair", "Good", "Good", "Excellent"]


def test_stub_payload_scores(spark):
    # the stub model answers 3.7 (cloud) and 4.6 (video)
    assert _eval(spark, [3.7], lambda c: S.classify(c, CLOUD_GAMING)) == ["Good"]
    assert _eval(spark, [4.6], lambda c: S.classify(c, VIDEO_STREAMING)) == ["Excellent"]


def test_nan_and_null_scores_are_unknown(spark):
    got = _eval(spark, [float("nan"), None], lambda c: S.classify(c, CLOUD_GAMING))
    assert got == ["Unknown", "Unknown"]


def test_class_uses_unrounded_score(spark):
    df = spark.createDataFrame([(3.996,)], "s double")
    r = df.select(S.round2("s").alias("r"), S.classify(F.col("s"), CLOUD_GAMING).alias("c")).first()
    assert r["r"] == 4.0 and r["c"] == "Good"


def test_round2_half_even_like_numpy(spark):
    import numpy as np

    vals = [0.125, 0.135, 2.675, 1.005, -0.125, 3.14159, 2.5, 1e-9]
    got = _eval(spark, vals, S.round2)
    want = [float(np.round(v, 2)) for v in vals]
    assert got == want


def test_round_class_half_even(spark):
    assert _eval(spark, [0.5, 1.5, 2.5, 3.49, 4.51], S.round_class) == [0, 2, 2, 3, 5]


def test_clamp(spark):
    got = _eval(spark, [0.2, 1.0, 3.3, 5.0, 7.1, float("nan"), None], S.clamp)
    assert got[:5] == [1.0, 1.0, 3.3, 5.0, 5.0]
    assert got[5] is None and got[6] is None


def test_severity_band(spark):
    got = _eval(spark, [1.99, 2.0, 2.99, 3.0, 3.99, 4.0], S.severity_band)
    assert got == ["red", "amber", "amber", "blue", "blue", "green"]


def test_class_rank_and_colors(spark):
    df = spark.createDataFrame([("Poor",), ("Bad",), ("Fair",), ("Good",), ("Excellent",), ("Zeta",), ("Alpha",)], "c string")
    rows = df.select("c", S.class_rank(F.col("c")).alias("r"), S.class_color(F.col("c")).alias("bg")).orderBy("r", "c").collect()
    assert [r["c"] for r in rows] == ["Poor", "Bad", "Fair", "Good", "Excellent", "Alpha", "Zeta"]
    colors = {r["c"]: r["bg"] for r in rows}
    assert colors["Bad"] == colors["Poor"]
    assert colors["Zeta"] == S.DEFAULT_COLOR


def test_time_formats(spark):
    df = spark.createDataFrame([("2024-01-15 10:20:30.7",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    r = df.select(S.ts_text("t"), S.iso_utc("t"), S.yyyymm("t"), S.clock_label("t")).first()
    assert tuple(r) == ("2024-01-15 10:20:30", "2024-01-15T10:20:30+00:00", 202401, "10:20:30")


def test_parse_ts_falls_back(spark):
    df = spark.createDataFrame([("2024-01-15T10:20:30Z",), ("not a time",)], "s string")
    r = df.select(S.parse_ts(F.col("s"), F.lit("2000-01-01 00:00:00").cast("timestamp")).alias("t")).collect()
    assert str(r[0]["t"]).startswith("2024-01-15") and str(r[1]["t"]).startswith("2000-01-01")


def test_fixed2_and_to_count(spark):
    assert _eval(spark, [2.456, 3.0], S.fixed2) == ["2.46", "3.00"]
    df = spark.createDataFrame([("7",), ("",), (None,), ("x",)], "x string")
    assert [r[0] for r in df.select(S.to_count("x")).collect()] == [7, 0, 0, 0]
    assert _eval(spark, [2.675, 1.005, 0.125, -2.675], S.fixed2) == ["2.67", "1.00", "0.13", "-2.67"]


@pytest.mark.parametrize("u", [CLOUD_GAMING, VIDEO_STREAMING])
def test_spec_is_consistent(u):
    assert len(u.labels) == len(u.cuts) + 1
    assert list(u.cuts) == sorted(u.cuts)
    assert set(u.bounds) == set(u.features)
    assert not math.isnan(u.alert_low)
