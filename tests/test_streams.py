"""Streams with a clock: ticks, alerts that end by themselves, trailing views, committed batches, the batch log."""

import glob
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators.alerts import alert_states_loop
from tidemark.operators.scoring import fixed_scorer
from tidemark.sinks.commits import commit_sink, read_committed
from tidemark.sources.fixtures import kpi_view
from tidemark.sources.tables import kpi_stream
from tidemark.spec import CLOUD_GAMING
from tidemark.streaming import monitor, stateful, ticks
from tidemark.streaming.pipeline import build_committed, decode_messages, run_available, stage_topic, table_schemas
from tests.conftest import SF_SMALL

T0 = 1704067200


@pytest.fixture(autouse=True)
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.ROCKSDB)


def staged(spark, path, batches, schema):
    """A stream of one file a batch, in the order given."""
    import time

    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are read by age
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def clocked(spark, path, batches):
    return staged(spark, path, [[(x,) for x in b] for b in batches], "second long").select(F.timestamp_seconds("second").alias("timestamp"))


def result(stream, path, mode="append"):
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/ck").foreachBatch(ticks.publish(path)).trigger(availableNow=True).start()
    run_available(q)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/documents")


REC = "id long, ingestion_timestamp timestamp, qoe_class string, predicted_qoe double"


def _records(rows):
    import datetime as dt

    return [(i, None if s is None else dt.datetime.fromtimestamp(T0 + s, dt.timezone.utc), c, q) for i, s, c, q in rows]


def test_every_tick_has_a_document(spark, tmp_dir):
    batches = [[(1, 0, "Good", 3.5), (2, 0, "Poor", 1.5), (3, 3, None, None)], [(4, 4, "Good", 3.0), (5, 2, "Good", 3.25), (9, None, "Good", 3.0)], [(6, 9, "Good", 3.0)]]
    recs = staged(spark, f"{tmp_dir}/r", [_records(b) for b in batches], REC)
    clock = clocked(spark, f"{tmp_dir}/c", [range(T0, T0 + 4), range(T0 + 4, T0 + 8), range(T0 + 8, T0 + 16)])
    docs = result(ticks.tick_documents(recs, clock, delay="5 seconds"), f"{tmp_dir}/d").orderBy("tick").collect()
    assert [d.rows for d in docs] == [2, 0, 1, 1, 1, 0, 0, 0, 0, 1]
    first, second = json.loads(docs[0].payload), json.loads(docs[1].payload)
    assert first == {"ts": "2024-01-01T00:00:00+00:00", "delta_counts": {"Good": 1, "Poor": 1}, "points": []}
    assert second["delta_counts"] == {} and json.loads(docs[3].payload)["delta_counts"] == {"Unknown": 1}


def test_tick_points_come_once_and_in_order(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(i, rng.randrange(12), rng.choice(["Good", "Poor"]), float(i % 5)) for i in range(200)] + [(900, 5, "Good", None)]
    rng.shuffle(rows)
    recs = staged(spark, f"{tmp_dir}/r", [_records(rows[:90]), _records(rows[90:])], REC)
    clock = clocked(spark, f"{tmp_dir}/c", [range(T0, T0 + 12), range(T0 + 12, T0 + 30)])
    pages = result(ticks.tick_pages(recs, clock, delay="15 seconds", page=7, parts=3), f"{tmp_dir}/d").orderBy("tick", "part", "page").collect()
    assert sum(p.points for p in pages) == len(rows)
    assert all(p.points <= 7 for p in pages)
    by_tick = {}
    for p in pages:
        doc = json.loads(p.payload)
        assert sum(doc["delta_counts"].values()) == len(doc["points"]) == p.points
        by_tick.setdefault(p.tick, []).extend(x.get("qoe") for x in doc["points"])
    empty = [p for p in pages if not p.points]
    assert empty and all(p.part == 0 for p in empty)  # part 0 of a second always has a document
    assert sorted((q for v in by_tick.values() for q in v), key=str) == sorted((r[3] for r in rows), key=str)


def test_a_failing_tick_leaves_an_error_and_is_tried_again(spark, tmp_dir):
    calls = []

    def make(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise OSError("no table")
        return batch

    sink = ticks.publish(f"{tmp_dir}/p", make)
    sink(spark.range(3), 7)
    assert spark.read.parquet(f"{tmp_dir}/p/documents/batch_id=7").count() == 3
    error = json.loads(spark.read.parquet(f"{tmp_dir}/p/errors/batch_id=7").first().payload)
    assert error["error"] == "no table" and error["delta_counts"] == {} and error["points"] == []
    with pytest.raises(ZeroDivisionError):
        ticks.publish(f"{tmp_dir}/q", lambda b, i: 1 / 0, attempts=2)(spark.range(3), 1)
    assert spark.read.parquet(f"{tmp_dir}/q/errors/batch_id=1").count() == 2


POINT = "id long, k long, sec long, q double"


def _alerts(spark, tmp_dir, batches, until, **kw):
    points = staged(spark, f"{tmp_dir}/p", batches, POINT)
    clock = clocked(spark, f"{tmp_dir}/c", [range(T0, T0 + 1)] * (len(batches) - 1) + [range(T0, T0 + until)])
    return result(stateful.stream_alerts(points, clock, origin=T0, **kw), f"{tmp_dir}/out").collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_do_not_depend_on_the_batches(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), rng.randrange(150), rng.choice([1.5, 2.4, 2.5, 2.7, 3.0, 3.5, 4.2])) for i in range(500)]
    cut = sorted(rng.sample(range(500), 2))
    shuffled = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 8))  # late by less than the delay
    out = _alerts(spark, tmp_dir, [shuffled[: cut[0]], shuffled[cut[0] : cut[1]], shuffled[cut[1] :]], 200)
    assert {r.id: r.state for r in out if r.id is not None} == alert_states_loop(rows)
    ends = sorted((r.k, r.sec) for r in out if r.id is None)
    want = []
    for k in range(3):
        visible, rec = False, None
        for _, _, sec, q in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])):
            if visible and rec is not None and sec >= rec + 3:
                want.append((k, rec + 3))
                visible, rec = False, None
            if q < 2.5:
                visible, rec = True, None
            elif q >= 3 and visible and rec is None:
                rec = sec
        if visible and rec is not None:
            want.append((k, rec + 3))
    assert ends == sorted(want)


def test_an_alert_ends_without_further_rows(spark, tmp_dir):
    out = _alerts(spark, tmp_dir, [[(1, 0, 5, 2.0), (2, 0, 6, 3.5), (3, None, 6, 1.0), (4, 0, None, 1.0), (5, 1, 6, None)]], 40)
    assert sorted((r.id, r.k, r.sec, r.signal, r.state) for r in out if r.id is not None) == [(1, 0, 5, "D", "degraded"), (2, 0, 6, "R", "recovering"), (3, None, 6, "D", "degraded"), (5, 1, 6, None, "normal")]
    assert [(r.k, r.sec, r.state) for r in out if r.id is None] == [(0, 9, "normal")]


def test_a_hot_series_goes_through_second_by_second(spark, tmp_dir):
    n, span = 60_000, 3_000
    spark.range(n).selectExpr("id", "0L as k", f"id % {span} as sec", "1.0 + (id * 7919 % 401) / 100.0 as q").selectExpr("id", "k", "sec", "cast(q as double) as q").repartition(4).write.parquet(f"{tmp_dir}/p")
    points = spark.readStream.schema(POINT).parquet(f"{tmp_dir}/p")
    clock = clocked(spark, f"{tmp_dir}/c", [range(T0 + span + 20, T0 + span + 21)])
    out = result(stateful.stream_alerts(points, clock, origin=T0), f"{tmp_dir}/out")
    assert out.where("id is not null").count() == n
    from tidemark.operators.alerts import alert_states

    want = alert_states(spark.read.parquet(f"{tmp_dir}/p")).groupBy("state").count().collect()
    assert {r["state"]: r["count"] for r in out.where("id is not null").groupBy("state").count().collect()} == {r["state"]: r["count"] for r in want}


def test_trailing_views_by_panes(spark, tmp_dir):
    rows = [(i, s, "Good", 3.0) for i, s in enumerate([0, 0, 1, 7, 40, 41, 41, 90])]
    recs = staged(spark, f"{tmp_dir}/r", [_records(rows[:4]), _records(rows[4:])], REC)
    clock = clocked(spark, f"{tmp_dir}/c", [range(T0, T0 + 20), [T0 + 50, T0 + 70, *range(T0 + 80, T0 + 140)]])  # seconds that the clock leaves out, too
    stream = stateful.trailing_window_counts(recs, clock, width=30, delay="10 seconds", key="qoe_class")
    got = {(r.feed, int(r.window_start.timestamp()) - T0): r.n for r in result(stream, f"{tmp_dir}/d").collect()}
    want = {}
    for ws in range(-29, 91):
        n = sum(ws <= s < ws + 30 for _, s, _, _ in rows)
        if n:
            want[ws] = n
    assert {ws: n for (feed, ws), n in got.items() if feed == "Good"} == want


def _messages(spark, tmp_dir, files=2):
    u = CLOUD_GAMING
    kpi = kpi_view(spark, SF_SMALL, u, dirty=True)
    topic, per = stage_topic(kpi, u, f"{tmp_dir}/topic", files=files)
    return u, kpi, lambda: kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per)


def test_three_tables_commit_together(spark, tmp_dir):
    u, kpi, messages = _messages(spark, tmp_dir)
    run_available(build_committed(messages(), u, fixed_scorer(u), f"{tmp_dir}/t", f"{tmp_dir}/ck", {"availableNow": True}))
    read = {n: read_committed(spark, f"{tmp_dir}/t", n, s) for n, s in table_schemas(u).items()}
    assert read["raw"].count() == kpi.count() == read["predictions"].count() + read["rejected"].count()
    assert read["rejected"].where("reasons = 'malformed'").where("original is not null").count() == 0
    assert {r.batch_id for r in read["raw"].select("batch_id").distinct().collect()} == {0, 1}
    assert len(glob.glob(f"{tmp_dir}/t/raw/batch_id=0/ym=*/*.parquet")) == 1  # by bytes, not by shuffle partitions


def test_a_crash_between_sinks_shows_nothing(spark, tmp_dir):
    u, kpi, _ = _messages(spark, tmp_dir)
    rows = kpi.withColumn("id", F.col("id").cast("string")).withColumn("ym", F.lit(202401)).select("id", "ym")
    ok = commit_sink(f"{tmp_dir}/t", {"raw": lambda b: b, "predictions": lambda b: b})
    bad = commit_sink(f"{tmp_dir}/t", {"raw": lambda b: b, "predictions": lambda b: b.select(F.raise_error(F.lit("lost")).alias("id"), "ym")})
    ok(rows, 0)
    with pytest.raises(Exception, match="lost"):
        bad(rows, 1)
    seen = lambda t: read_committed(spark, f"{tmp_dir}/t", t, rows.schema).select("batch_id").distinct().count()
    assert seen("raw") == seen("predictions") == 1
    ok(rows, 1)  # the batch again, twice
    ok(rows, 1)
    assert seen("raw") == 2 and read_committed(spark, f"{tmp_dir}/t", "raw", rows.schema).count() == 2 * rows.count()
    ok(rows.limit(0), 2)
    assert read_committed(spark, f"{tmp_dir}/t", "raw", rows.schema).count() == 2 * rows.count()


def test_the_log_keeps_every_batch_and_finds_late_rows(spark, tmp_dir):
    recs = staged(spark, f"{tmp_dir}/r", [_records([(i, s, "Good", 3.0)]) for i, s in enumerate([0, 100, 200, 5])], REC)
    counted = recs.observe("m", F.count(F.lit(1)).alias("n")).withWatermark("ingestion_timestamp", "10 seconds").groupBy(F.window("ingestion_timestamp", "1 second")).count()
    with monitor.watched(spark, f"{tmp_dir}/log", ("late_test",)):
        run_available(counted.writeStream.queryName("late_test").outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck").format("noop").trigger(availableNow=True).start())
    log = monitor.batch_table(spark, f"{tmp_dir}/log", "m", "n bigint")
    assert [r.n for r in log.where("input_rows > 0").orderBy("batch_id").collect()] == [1, 1, 1, 1]
    assert log.agg(F.sum("late_rows")).first()[0] == 1
    with pytest.raises(RuntimeError, match="late_test batch 3: 1"):
        monitor.require_none_late(log)
    assert monitor.require_none_late(log.where("batch_id < 3")).count() == 3


def test_ticker_makes_ticks_by_itself(spark, tmp_dir):
    """The production clock: the rate source, by a 1 s trigger."""
    import time

    marks = ticks.ticker(spark)
    q = marks.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck").foreachBatch(ticks.publish(f"{tmp_dir}/t")).trigger(processingTime="1 second").start()
    time.sleep(4)
    q.stop()
    times = sorted(r.timestamp for r in spark.read.schema(marks.schema).parquet(f"{tmp_dir}/t/documents").collect())
    assert len(times) >= 2 and all((b - a).total_seconds() == 1 for a, b in zip(times, times[1:]))


def test_original_bytes_stay(spark, tmp_dir):
    u, kpi, messages = _messages(spark, tmp_dir, files=1)
    stream = decode_messages(messages(), u, original="original").select("id", "original")
    out = result(stream, f"{tmp_dir}/d")
    assert out.count() == kpi.count() and out.where("original is null").count() == kpi.where(" or ".join(f"{f} is null" for f in u.features)).count()


def test_streams_of_an_empty_table(spark, tmp_dir):
    from tidemark.plans import stream_catalog

    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    counts = {n: q(spark, tmp_dir).count() for n, q in stream_catalog.stream_queries().items()}
    # the clock's one second has an empty document
    assert counts == {"stream_ticks": 1, "stream_tick_points": 1, "stream_alerts": 0, "stream_trailing": 0}


class _Store:
    """A state variable in memory that counts its calls, as each is a round trip to the state store."""

    calls = 0

    def __init__(self):
        self.kept = {}

    def __getattribute__(self, name):
        if name not in ("kept", "__class__") and not name.startswith("_"):
            _Store.calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return bool(self.kept)

    def get(self):
        return self.kept.get("", ())

    def update(self, value):
        self.kept[""] = value

    def appendValue(self, value):
        self.kept[""] = [*self.kept.get("", ()), value]

    def appendList(self, values):
        self.kept[""] = [*self.kept.get("", ()), *values]

    def clear(self):
        self.kept.clear()

    def containsKey(self, key):
        return key in self.kept

    def getValue(self, key):
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.kept[key] = value

    def removeKey(self, key):
        self.kept.pop(key, None)

    def keys(self):
        return list(self.kept)


class _Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return _Store()

    getValueState = getListState = getMapState

    def registerTimer(self, at):
        self.timers.append(at)


class _Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_alerts_call_the_state_store_by_runs_of_rows():
    rng = random.Random(4)
    rows = [(i, 0, rng.randrange(6_000), rng.choice([1.5, 2.4, 2.5, 3.0, 4.2])) for i in range(12_000)]
    feed = [Row(id=i, sec=sec, q=q) for i, _, sec, q in rows]
    alerts, handle, _Store.calls = stateful._Alerts(2.5, 3.0, 3, 0), _Handle(), 0
    alerts.init(handle)
    alerts.handleInputRows((0,), iter(feed[:7_000]), None)
    alerts.handleInputRows((0,), iter(feed[7_000:]), None)
    runs = []
    for until in (2_500, 2_501, 7_000):  # seconds that are over: a piece is left open, one second follows, then the rest
        runs += alerts.handleExpiredTimer((0,), _Now(until * 1000), None)
        assert until == 7_000 or handle.timers[-1] == min(r[2] for r in rows if r[2] >= until) * 1000 + 1000
    got = [r for run in runs for r in zip(run.id, run.sec, run.state)]
    assert {i: state for i, _, state in got if i is not None} == alert_states_loop(rows)
    assert [(s, i) for i, s, _ in got if i is not None] == sorted((r[2], r[0]) for r in rows)
    assert _Store.calls < len(rows) / 10 and len(runs) < 10


def test_pages_leave_the_processor_as_runs():
    pages, n, _Store.calls = ticks._Pages(1, 2, "string"), 25_001, 0
    pages.init(_Handle())
    pages.handleInputRows((T0, 1), iter([Row(id=str(i), us=i % 7, label="Good", value=1.0, is_clock=False) for i in range(n)] + [Row(id=None, us=None, label="", value=None, is_clock=True)]), None)
    runs = list(pages.handleExpiredTimer((T0, 1), _Now(0), None))
    assert [(r.first, len(r.us)) for r in runs] == [(0, 10_000), (5_000, 10_000), (10_000, 5_001)]
    assert [u for r in runs for u in r.us] == sorted(i % 7 for i in range(n)) and _Store.calls < 10
    assert [len(r.us) for r in pages.handleExpiredTimer((T0, 1), _Now(0), None)] == [0]  # an empty tick has its document
