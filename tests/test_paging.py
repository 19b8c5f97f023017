"""Reader options of a message topic, and pages to the end with a stored cursor."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dashboard import Pager
from tidemark.sources.tables import kafka_options


def test_kafka_options():
    assert kafka_options("kpi", "a:9092,b:9092") == {"subscribe": "kpi", "startingOffsets": "latest", "failOnDataLoss": "false", "kafka.bootstrap.servers": "a:9092,b:9092"}
    got = kafka_options("kpi", "a:9092", maxOffsetsPerTrigger=500, failOnDataLoss=True, startingOffsets="earliest")
    assert got["maxOffsetsPerTrigger"] == "500" and got["failOnDataLoss"] == "true" and got["startingOffsets"] == "earliest"
    assert kafka_options("kpi", **{"kafka.bootstrap.servers": "a:1"})["kafka.bootstrap.servers"] == "a:1"
    for topic, servers in ((None, "a:1"), (" ", "a:1"), ("kpi", None)):
        with pytest.raises(ValueError):
            kafka_options(topic, servers)


def _points(spark, n=23):
    return spark.range(n).select("id", F.timestamp_seconds(1704067200 + F.floor(F.col("id") / 4)).alias("ingestion_timestamp"), F.lit(3.0).alias("predicted_qoe"))


def test_pages_go_on_where_they_were(spark, tmp_dir):
    points, start, seen = _points(spark), "2024-01-01 00:00:00", []
    for _ in range(20):
        pager = Pager(points, f"{tmp_dir}/c", "feed", limit=5, settle=0)  # a reader that starts again each time
        page = pager.next_page(start, "2024-01-01 00:01:00").persist()
        seen.append(sorted(r.id for r in page.collect()))
        if not pager.keep(page):
            break
    # the first second is not after the cursor; no row of a second is skipped at a page's end
    assert seen[-1] == [] and [i for s in seen for i in s] == list(range(4, 23))
    assert Pager(points, f"{tmp_dir}/c", "other").cursor(start) == (start, None, 0)


def test_unsettled_points_wait(spark, tmp_dir):
    pager = Pager(_points(spark), f"{tmp_dir}/c", "feed", limit=100, settle=2)
    first = pager.next_page("2023-12-31 00:00:00", "2024-01-01 00:00:04")
    assert sorted(r.id for r in first.collect()) == list(range(12)) and pager.keep(first) == 12
    assert pager.keep(pager.next_page("2023-12-31 00:00:00", "2024-01-01 00:00:04")) == 0
    later = pager.next_page("2023-12-31 00:00:00", "2024-01-01 00:00:30")
    assert sorted(r.id for r in later.collect()) == list(range(12, 23)) and later.first().page == 2
