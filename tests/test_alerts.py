"""Alert hysteresis: the chunked window form equals a sequential loop."""

import random

import pytest

from tidemark.operators.alerts import alert_messages, alert_states, alert_states_loop

SCHEMA = "id long, k long, sec long, q double"


def _series(seed, n=600, keys=3, span=200):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # values cluster around the thresholds so every transition occurs
        q = rnd.choice([1.5, 2.4, 2.5, 2.7, 2.99, 3.0, 3.5, 4.2, rnd.uniform(1, 5)])
        rows.append((i, rnd.randrange(keys), rnd.randrange(span), q))
    return rows


@pytest.mark.parametrize("seed,chunk", [(1, 7), (2, 1), (3, 60), (4, 13), (5, 1000)])
def test_window_form_equals_loop(spark, seed, chunk):
    rows = _series(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r.state for r in alert_states(df, chunk=chunk).collect()}
    assert got == alert_states_loop(rows)


def test_fixture_state_counts(spark):
    from tests.conftest import SF_MED
    from tidemark.sources.fixtures import alert_series

    out = alert_states(alert_series(spark, SF_MED))
    counts = {r.state: r["count"] for r in out.groupBy("state").count().collect()}
    assert counts == {"degraded": 4182, "recovering": 4325, "normal": 1493}


def test_hold_expires_and_new_episode(spark):
    rows = [(1, 0, 0, 2.0), (2, 0, 1, 3.2), (3, 0, 2, 2.8), (4, 0, 4, 2.8), (5, 0, 5, 3.1), (6, 0, 6, 2.0), (7, 0, 7, 2.7)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r.state for r in alert_states(df, chunk=3).collect()}
    assert got == {1: "degraded", 2: "recovering", 3: "recovering", 4: "normal", 5: "normal", 6: "degraded", 7: "degraded"}


def test_messages(spark):
    rows = [(1, 0, 0, 1.5), (2, 0, 1, 2.3), (3, 0, 2, 4.1), (4, 0, 3, 3.2), (5, 0, 9, 3.5)]
    msgs = alert_messages(alert_states(spark.createDataFrame(rows, SCHEMA))).orderBy("id").collect()
    assert [(m.id, m.title, m.description, m.value_text) for m in msgs] == [
        (1, "QoE Degradation Detected", "Quality has dropped to Poor level", "1.50"),
        (2, "QoE Degradation Detected", "Quality has dropped to Fair level", "2.30"),
        (3, "QoE Recovered", "Quality has improved to Excellent level", "4.10"),
        (4, "QoE Recovered", "Quality has improved to Good level", "3.20"),
    ]
