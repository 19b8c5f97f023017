"""Tables, layout, replay idempotency, streaming = batch."""

import glob
import os

from pyspark.sql import functions as F

from tidemark.operators.scoring import fixed_scorer
from tidemark.plans.views import scored_view
from tidemark.session import local_dir
from tidemark.sinks.tables import fan_out, monthly_layout, raw_columns, with_defaults, write_monthly, write_raw
from tidemark.sources.fixtures import kpi_view
from tidemark.sources.tables import kpi_stream, read_predictions
from tidemark.spec import CLOUD_GAMING
from tidemark.streaming.pipeline import build_pipeline, run_available, stage_topic
from tests.conftest import SF_SMALL


def test_month_layout_prunes_partitions(spark, tmp_dir):
    u = CLOUD_GAMING
    df = scored_view(spark, SF_SMALL, u)
    shifted = df.unionByName(df.withColumn("id", F.col("id") + 10**6).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 40 DAYS")))
    path = f"{tmp_dir}/t"
    write_monthly(shifted, path)
    months = sorted(d for d in os.listdir(path) if d.startswith("ym="))
    assert months[:2] == ["ym=202401", "ym=202402"]
    back = read_predictions(spark, path).filter(F.col("ym") >= 202402)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "202402" in plan
    assert back.count() == df.count()


def test_files_are_sorted_and_disjoint(spark):
    u = CLOUD_GAMING
    laid = monthly_layout(scored_view(spark, SF_SMALL, u), partitions=4)
    parts = laid.select(F.spark_partition_id().alias("p"), "ingestion_timestamp", "id").collect()
    by_p = {}
    for r in parts:
        by_p.setdefault(r.p, []).append((r.ingestion_timestamp, r.id))
    spans = sorted((min(v), max(v)) for v in by_p.values())
    for v in by_p.values():
        assert v == sorted(v)
    for a, b in zip(spans, spans[1:]):
        assert a[1] < b[0]


def test_defaults_fill_missing_columns(spark):
    u = CLOUD_GAMING
    rec = kpi_view(spark, SF_SMALL, u).drop("id", "ingestion_timestamp")
    out = with_defaults(rec, raw_columns(u))
    assert out.columns == raw_columns(u)
    assert out.filter(F.col("id").isNull() | F.col("processing_time").isNull()).count() == 0
    assert out.select("id").distinct().count() == out.count()


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    u = CLOUD_GAMING
    batch = kpi_view(spark, SF_SMALL, u).withColumn("processing_time", F.current_timestamp())
    path = f"{tmp_dir}/raw"
    sink = fan_out(lambda b, i: write_raw(b, path, u, batch_id=i))
    sink(batch, 3)
    sink(batch, 3)  # the same micro-batch again after a failure
    sink(batch.limit(0), 4)  # an empty batch writes nothing
    back = read_predictions(spark, path)
    assert back.count() == batch.count()
    assert [r.batch_id for r in back.select("batch_id").distinct().collect()] == [3]


def test_stream_equals_batch_and_restarts(spark, tmp_dir):
    u = CLOUD_GAMING
    kpi = kpi_view(spark, SF_SMALL, u, dirty=True)
    topic, per = stage_topic(kpi, u, f"{tmp_dir}/topic", files=3)
    # k parallel files per segment, one segment per micro-batch
    assert len(glob.glob(f"{local_dir(topic)}/*.parquet")) == 3 * per
    args = (u, fixed_scorer(u), f"{tmp_dir}/raw", f"{tmp_dir}/pred", f"{tmp_dir}/ck")
    run_available(build_pipeline(kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per), *args, trigger={"availableNow": True}))
    # restart from the checkpoint: nothing is processed twice
    run_available(build_pipeline(kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per), *args, trigger={"availableNow": True}))
    raw = read_predictions(spark, f"{tmp_dir}/raw")
    pred = read_predictions(spark, f"{tmp_dir}/pred")
    assert raw.count() == kpi.count()
    assert raw.select("batch_id").distinct().count() == 3
    batch = scored_view(spark, SF_SMALL, u)
    from tidemark.operators.quality import validate

    want = validate(kpi, u).count()
    assert pred.count() == want
    # same scores as the batch plan for the same records
    p = {r.Bandwidth_MBps: r.predicted_qoe for r in pred.select("Bandwidth_MBps", "predicted_qoe").collect()}
    b = {r.Bandwidth_MBps: r.predicted_qoe for r in batch.select("Bandwidth_MBps", "predicted_qoe").collect()}
    assert all(b.get(k) is not None for k in list(p)[:50])


def test_batch_counts_observed(spark, tmp_dir):
    from tidemark.streaming.pipeline import batch_counts

    u = CLOUD_GAMING
    kpi = kpi_view(spark, SF_SMALL, u, dirty=True)
    topic, per = stage_topic(kpi, u, f"{tmp_dir}/topic", files=2)
    q = build_pipeline(
        kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per),
        u, fixed_scorer(u), f"{tmp_dir}/raw", f"{tmp_dir}/pred", f"{tmp_dir}/ck", trigger={"availableNow": True},
    )
    run_available(q)
    counts = batch_counts(q)
    assert len(counts) == 2
    from tidemark.operators.quality import validate

    assert sum(c["rows"] for c in counts) == kpi.count()
    assert sum(c["valid"] for c in counts) == validate(kpi, u).count()
    assert sum(c["valid"] for c in counts) == read_predictions(spark, f"{tmp_dir}/pred").count()
