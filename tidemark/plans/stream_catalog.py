"""Named streaming queries over a replay of ``events`` with a clock: ticks, alerts that end by themselves,
trailing views, committed batches. The SQL twins are written out, without the engine's text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import iso_utc
from tidemark.operators.scoring import fixed_scorer, score
from tidemark.session import work_path
from tidemark.sources.fixtures import alert_series, kpi_view
from tidemark.sources.tables import kpi_stream
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase
from tidemark.streaming import stateful, ticks
from tidemark.streaming.pipeline import decode_messages, stage_topic, write_ordered

ORIGIN = 1704067200  # 2024-01-01T00:00:00Z, the first day of events
SPEED = 600  # the replay's second is ten minutes of events
DELAY = 10
SEGMENTS = 4
EACH_SECOND = {"processingTime": "1 second"}


def replayed(kpi: DataFrame, speed: int = SPEED) -> DataFrame:
    """KPI records with the time they have in a replay ``speed`` times as fast."""
    second = ORIGIN + F.floor((F.unix_seconds(F.col("ingestion_timestamp").cast("timestamp")) - ORIGIN) / speed)
    return kpi.withColumn("ingestion_timestamp", F.timestamp_seconds(second))


def stage_clock(spark: SparkSession, path: str, first: int, last: int, files: int = SEGMENTS, after: int = 2) -> int:
    """The replay's clock: one row for each second, also for ``DELAY + after`` ones behind the last record that close what is open."""
    seconds = spark.range(first, last + DELAY + after).select(F.timestamp_seconds("id").alias("timestamp"), F.least("id", F.lit(last)).alias("second"))
    return write_ordered(seconds, path, "second", files, bounds=(first, last))


def replay(spark: SparkSession, sf_dir: str, u: UseCase, root: str, dirty: bool = False, after: int = 2) -> tuple[DataFrame, DataFrame]:
    """(messages, clock) as streams, staged in segments of the same spans of time."""
    kpi = replayed(kpi_view(spark, sf_dir, u, dirty=dirty))
    t = F.unix_seconds("ingestion_timestamp")
    first, last = kpi.agg(F.coalesce(F.min(t), F.lit(ORIGIN)), F.coalesce(F.max(t), F.lit(ORIGIN))).first()
    topic, per = stage_topic(kpi, u, f"{root}/topic", files=SEGMENTS, seconds=(first, last))
    clock = read_clock(spark, f"{root}/clock", stage_clock(spark, f"{root}/clock", first, last, after=after))
    return kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per), clock


def read_clock(spark: SparkSession, path: str, files: int) -> DataFrame:
    return spark.readStream.schema("timestamp timestamp").option("maxFilesPerTrigger", files).parquet(path)


def drain(query) -> None:
    """Let a timed query work off what there is, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _published(stream: DataFrame, root: str, trigger: dict) -> DataFrame:
    w = stream.writeStream.outputMode("append").option("checkpointLocation", f"{root}/_checkpoint").foreachBatch(ticks.publish(root)).trigger(**trigger)
    drain(w.start())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/documents").select(*stream.columns)


def _scored(spark, sf_dir, u: UseCase, root: str) -> tuple[DataFrame, DataFrame]:
    messages, clock = replay(spark, sf_dir, u, root)
    return score(decode_messages(messages, u), u, fixed_scorer(u)), clock


def stream_ticks(spark, sf_dir):
    """A document of counts for every second of the replay, by a 1 s trigger, empty ones included."""
    root = work_path(spark, "stream_ticks")
    records, clock = _scored(spark, sf_dir, CLOUD_GAMING, root)
    out = _published(ticks.tick_documents(records, clock, delay=f"{DELAY} seconds"), root, EACH_SECOND)
    return out.select(iso_utc(F.col("tick")).alias("tick"), "rows", "payload")


def stream_tick_points(spark, sf_dir):
    """The points of every second in pages of two, by state and event-time timers; an empty page for an empty second."""
    root = work_path(spark, "stream_tick_points")
    records, clock = _scored(spark, sf_dir, CLOUD_GAMING, root)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.ROCKSDB)
    out = _published(ticks.tick_pages(records, clock, delay=f"{DELAY} seconds", page=2, parts=2), root, EACH_SECOND)
    return out.select(iso_utc(F.col("tick")).alias("tick"), "part", "page", "points", "payload")


def stream_alerts(spark, sf_dir):
    """The alert of every series, with a row for each end of an alert that no record marks."""
    u = CLOUD_GAMING
    root = work_path(spark, "stream_alerts")
    points = alert_series(spark, sf_dir)
    first, last = points.agg(F.coalesce(F.min("sec"), F.lit(0)), F.coalesce(F.max("sec"), F.lit(0))).first()
    per = write_ordered(points, f"{root}/points", "sec", files=SEGMENTS, bounds=(first, last))
    clock = read_clock(spark, f"{root}/clock", stage_clock(spark, f"{root}/clock", ORIGIN + first, ORIGIN + last, after=2 + u.alert_hold_seconds))
    rows = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", per).parquet(f"{root}/points")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.ROCKSDB)
    states = stateful.stream_alerts(rows, clock, u.alert_low, u.alert_high, u.alert_hold_seconds, f"{DELAY} seconds", ORIGIN)
    return _published(states, root, EACH_SECOND)


def stream_trailing(spark, sf_dir):
    """The records of the last 30 s at every second of the replay."""
    u = VIDEO_STREAMING
    root = work_path(spark, "stream_trailing")
    messages, clock = replay(spark, sf_dir, u, root, after=2 + u.window_seconds)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.ROCKSDB)
    out = _published(stateful.trailing_window_counts(decode_messages(messages, u), clock, width=u.window_seconds, delay=f"{DELAY} seconds"), root, EACH_SECOND)
    return out.select(iso_utc(F.col("window_start")).alias("window_start"), iso_utc(F.col("window_end")).alias("window_end"), "n")


def stream_queries() -> dict:
    return {"stream_ticks": stream_ticks, "stream_tick_points": stream_tick_points, "stream_alerts": stream_alerts, "stream_trailing": stream_trailing}


# ------------------------------------------------------------- SQL twins

# the fixture records and their scores come from sources.fixtures and plans.oracle; all that the streams add is written out here
_SECOND = "(1704067200 + CAST(floor((epoch(ingestion_timestamp) - 1704067200) / 600) AS BIGINT))"


def _iso(second: str) -> str:
    return f"strftime(make_timestamp(({second}) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')"


def stream_oracle() -> dict[str, str]:
    from tidemark.plans import oracle as O

    cloud = f"(SELECT qoe_class, predicted_qoe, {_SECOND} AS s, sha256('cloud_gaming_kpi:0:' || CAST(id AS VARCHAR)) AS rid FROM {O.scored(CLOUD_GAMING)} p)"
    seconds = f"(SELECT unnest(generate_series((SELECT min(s) FROM {cloud} a), (SELECT max(s) FROM {cloud} b))) AS s)"
    doc = """'{"ts":"' || %s || '","delta_counts":{' || coalesce(%s, '') || '},"points":[' || coalesce(%s, '') || ']}'"""
    return {
        "stream_ticks": f"""
WITH c AS (SELECT s, qoe_class, count(*) AS n FROM {cloud} x GROUP BY 1, 2),
d AS (SELECT s, CAST(sum(n) AS BIGINT) AS rows, string_agg('"' || qoe_class || '":' || n, ',' ORDER BY qoe_class) AS counts FROM c GROUP BY 1)
SELECT {_iso('t.s')} AS tick, coalesce(rows, 0) AS rows, {doc % (_iso('t.s'), 'counts', 'NULL')} AS payload FROM {seconds} t LEFT JOIN d ON t.s = d.s""",
        "stream_tick_points": f"""
WITH x AS (SELECT *, CAST(('0x' || substr(md5(rid), 1, 8))::BIGINT % 2 AS INTEGER) AS part FROM {cloud} y),
r AS (SELECT *, CAST((row_number() OVER (PARTITION BY s, part ORDER BY rid) - 1) // 2 AS INTEGER) AS page FROM x),
c AS (SELECT s, part, page, qoe_class, count(*) AS n FROM r GROUP BY ALL),
k AS (SELECT s, part, page, string_agg('"' || qoe_class || '":' || n, ',' ORDER BY qoe_class) AS counts FROM c GROUP BY ALL),
p AS (SELECT s, part, page, count(*) AS points, string_agg('{{"ts":"' || {_iso('s')} || '","qoe":' || CAST(predicted_qoe AS VARCHAR) || '}}', ',' ORDER BY rid) AS texts FROM r GROUP BY ALL),
d AS (SELECT p.*, counts FROM p JOIN k USING (s, part, page) UNION ALL SELECT s, 0, 0, 0, NULL, NULL FROM {seconds} z WHERE s NOT IN (SELECT s FROM p WHERE part = 0))
SELECT {_iso('s')} AS tick, part, page, points, {doc % (_iso('s'), 'counts', 'texts')} AS payload FROM d""",
        "stream_alerts": f"""
WITH st AS (SELECT event_id AS id, user_id % 20 AS k, CAST(floor(event_id / 20) AS BIGINT) AS sec,
  CAST(100 + (((event_id % 401) * 7919) % 401) AS DOUBLE) / CAST(100 AS DOUBLE) AS q FROM events),
g AS (SELECT *, CASE WHEN q < 2.5 THEN 'D' WHEN q >= 3 THEN 'R' END AS signal FROM st),
e AS (SELECT *, CAST(sum(CASE WHEN signal = 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY sec, id) AS BIGINT) AS ep FROM g),
f AS (SELECT *, min(CASE WHEN signal = 'R' THEN sec END) OVER (PARTITION BY k, ep ORDER BY sec, id) AS rec FROM e),
ends AS (SELECT k, ep, min(rec) AS rec, min(CASE WHEN signal = 'D' THEN sec END) AS began FROM f WHERE ep > 0 GROUP BY k, ep)
SELECT id, k, sec, q, signal, CASE WHEN signal = 'D' THEN 'degraded' WHEN ep = 0 OR sec >= rec + 3 THEN 'normal' WHEN rec IS NULL THEN 'degraded' ELSE 'recovering' END AS state FROM f
UNION ALL
SELECT NULL, a.k, a.rec + 3, NULL, NULL, 'normal' FROM ends a LEFT JOIN ends b ON b.k = a.k AND b.ep = a.ep + 1 WHERE a.rec IS NOT NULL AND (b.began IS NULL OR b.began >= a.rec + 3)""",
        "stream_trailing": f"""
WITH x AS (SELECT {_SECOND} AS s FROM (SELECT date_trunc('second', ts) AS ingestion_timestamp FROM events) e),
c AS (SELECT s, count(*) AS n FROM x GROUP BY s),
w AS (SELECT unnest(generate_series((SELECT min(s) FROM c) - 29, (SELECT max(s) FROM c))) AS ws)
SELECT {_iso('ws')} AS window_start, {_iso('ws + 30')} AS window_end, CAST(sum(n) AS BIGINT) AS n FROM w JOIN c ON c.s >= ws AND c.s < ws + 30 GROUP BY ws""",
    }
