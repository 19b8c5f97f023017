"""Split paths of ordered computations on small data with small bounds, and the merge of small files."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.alerts import alert_states, alert_states_loop, latest_by_second, segmented
from tidemark.operators.dashboard import cumulative_class_counts, tick_points
from tidemark.session import local_dir
from tidemark.sinks.commits import by_month, commit_sink, read_committed
from tidemark.sinks.compaction import compact, merges, read_merged

POINT = "id long, k long, sec long, q double"


def _busy(seed, n=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sec = 50 if i % 3 == 0 else rng.randrange(200)  # a third of all rows in one second of one key
        rows.append((i, 0 if i % 3 == 0 else rng.randrange(4), sec, rng.choice([1.5, 2.4, 2.5, 2.7, 3.0, 3.5, 4.2])))
    return rows


@pytest.mark.parametrize("segment_rows", [1, 20, 10**6])
def test_alerts_of_busy_seconds(spark, segment_rows):
    rows = _busy(segment_rows)
    df = spark.createDataFrame(rows, POINT)
    got = {r.id: r.state for r in alert_states(df, chunk=25, segment_rows=segment_rows).collect()}
    assert got == alert_states_loop(rows)
    if segment_rows == 20:
        most = segmented(df, "k", "sec", "id", 25, 20).groupBy("k", "_c").count().agg(F.max("count")).first()[0]
        assert most <= 2 * 20


def test_alerts_of_text_ids_and_missing_keys(spark):
    df = spark.createDataFrame([("a", None, 1, 2.0), ("b", None, 1, 3.2), ("c", None, None, 2.0), ("d", 1, 1, None)], "id string, k long, sec long, q double")
    got = {r.id: r.state for r in alert_states(df, chunk=10, segment_rows=1).collect()}
    assert got["d"] == "normal" and set(got) == {"a", "b", "c", "d"}


def test_points_of_a_busy_tick(spark):
    rng = random.Random(3)
    rows = [(i, 30 if i % 3 else rng.randrange(60), float(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, s long, predicted_qoe double").withColumn("ingestion_timestamp", F.timestamp_seconds("s"))
    for tick in ("minute", "second"):
        got = tick_points(df, tick, limit=4).collect()
        by = {}
        for r in got:
            by.setdefault(r.tick, []).append((r.pos, r.ingestion_timestamp, r.id))
            assert r.page == (r.pos - 1) // 4
        assert len(got) == len(rows)
        for v in by.values():
            assert [p for p, *_ in sorted(v)] == list(range(1, len(v) + 1))
            assert [x[1:] for x in sorted(v)] == sorted(x[1:] for x in v)
    text = tick_points(df.withColumn("id", F.col("id").cast("string")), "second", limit=4)
    assert text.count() == len(rows)


def test_running_totals_over_chunks(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(500)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "qoe_class string, s long").withColumn("ingestion_timestamp", F.timestamp_seconds("s"))
    want = {}
    for c in ("a", "b", None):
        total = 0
        for s in sorted({s for k, s in rows if k == c}, key=lambda s: -1 if s is None else s):
            total += sum(1 for k, t in rows if k == c and t == s)
            want[c, s] = total
    for chunk in (1, 7, 10**6):
        got = {(r.qoe_class, None if r.tick is None else int(r.tick.timestamp())): r.total for r in cumulative_class_counts(df, "second", chunk=chunk).collect()}
        assert got == want


def test_latest_value_of_each_second(spark):
    df = spark.createDataFrame([(1, 5, 0.2), (2, 5, 7.0), (3, 6, 2.5), (4, None, 1.0)], "id long, s long, predicted_qoe double").withColumn("ingestion_timestamp", F.timestamp_seconds("s"))
    assert sorted(map(tuple, latest_by_second(df).collect())) == [(2, 0, 5, 5.0), (3, 0, 6, 2.5)]


def _stored(spark, tmp_dir, batches=4):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("id"), (F.timestamp_seconds(1704067200 + F.col("id") * 1000)).alias("ingestion_timestamp"))
    sink = commit_sink(tmp_dir, {"raw": lambda b: by_month(b)})
    for n in range(batches):
        sink(rows.where(F.col("id") % 5 == n), n)
    return rows, sink


def test_a_closed_month_is_merged_by_bytes(spark, tmp_dir):
    rows, sink = _stored(spark, tmp_dir)
    now = lambda: sorted(r.id for r in read_merged(spark, tmp_dir, "raw", rows.schema).collect())
    want = sorted(r.id for r in rows.where("id % 5 < 4").collect())
    assert now() == want
    small = len(glob.glob(f"{local_dir(tmp_dir)}/raw/batch_id=*/ym=202401/*.parquet"))
    m = compact(spark, tmp_dir, "raw", rows.schema, 202401)
    assert small == 4 and m["files"] == 1 == len(glob.glob(f"{m['path']}/*.parquet")) and m["version"] == 1 and m["upto"] == 3
    assert now() == want
    assert compact(spark, tmp_dir, "raw", rows.schema, 202401) == m  # nothing new
    ids = [r.id for r in spark.read.parquet(m["path"]).collect()]
    assert ids == [r.id for r in spark.read.parquet(m["path"]).orderBy("ingestion_timestamp", "id").collect()]
    sink(rows.where("id % 5 == 4"), 4)  # late rows of a merged month
    assert now() == sorted(r.id for r in rows.collect())
    with pytest.raises(OSError):
        compact(spark, tmp_dir, "raw", rows.schema, 202401, fail=OSError("lost"))
    assert merges(spark, tmp_dir, "raw")[202401]["version"] == 1 and now() == sorted(r.id for r in rows.collect())
    assert compact(spark, tmp_dir, "raw", rows.schema, 202401)["version"] == 2
    assert now() == sorted(r.id for r in rows.collect())
    assert compact(spark, tmp_dir, "raw", rows.schema, 209901) == {}


def test_reads_prune_months_and_files(spark, tmp_dir):
    rows, _ = _stored(spark, tmp_dir)
    compact(spark, tmp_dir, "raw", rows.schema, 202401)
    one = read_merged(spark, tmp_dir, "raw", rows.schema, (202402,)).where("ingestion_timestamp > '2024-02-10'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingestion_timestamp), GreaterThan(ingestion_timestamp" in plan and "ym=202401" not in plan
    assert one.count() == rows.where("id % 5 < 4 and ingestion_timestamp > '2024-02-10'").count() > 0
    assert read_committed(spark, tmp_dir, "raw", rows.schema).count() == 3200
