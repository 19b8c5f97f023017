"""Dashboard ticks as streams (K9, K10, B8): what came in since the last tick, every second, also when nothing did.

A tick is a span of event time (one second). Records are united with a *clock*: a stream with one
row for each tick, which carries nothing but its time. The clock does two things that grouping the records alone cannot:
a tick without records has a row to come out with (an empty document), and the watermark
moves on while no record comes, so ticks close on time. In production the clock is Spark's rate
source (``ticker``); a replay brings the times of its own.

``tick_documents``  counts per class and tick, as chained window aggregations: JVM only, partial sums
                    before each shuffle, one document a tick.
``tick_pages``      the points of a tick in (time, id) order, in documents of at most ``page`` points with the counts
                    of just these points, so that the documents of a tick add up to it. State is keyed by (tick, part):
                    ``parts`` spreads a busy tick over as many tasks. Rows wait in the state store until the
                    event-time timer at the tick's end fires.
``publish``         foreachBatch sink of documents, at one directory a batch; a failing tick leaves an ``error`` document.

Rows later than ``delay`` are dropped by the watermark, and counted (``monitor.py``). Records
without a time belong to no tick. A class of null is counted as ``Unknown``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.scalars import iso_utc

TS = "ingestion_timestamp"
CHUNK = 10_000  # rows that a processor takes, keeps and yields together
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ticker(spark: SparkSession, seconds: int = 1) -> DataFrame:
    """The clock of a running dashboard: one row each ``seconds`` (rate source)."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.unix_seconds("timestamp") % seconds == 0).select("timestamp")


def with_clock(records: DataFrame, clock: DataFrame, ts: str = TS, delay: str = "10 seconds") -> DataFrame:
    """``records`` and a row for each row of ``clock`` (its first column is the time), all with the event time ``event_time``
    under a watermark; ``is_clock`` marks the latter."""
    marks = clock.select(F.col(clock.columns[0]).cast("timestamp").alias("event_time"), F.lit(True).alias("is_clock"))
    rows = records.withColumn("event_time", F.col(ts).cast("timestamp")).withColumn("is_clock", F.lit(False))
    # one watermark for both: the later of them moves it
    return rows.unionByName(marks, allowMissingColumns=True).withWatermark("event_time", delay)


def _document(tick: Column, counts: Column, points: Column) -> Column:
    return F.to_json(F.struct(iso_utc(tick).alias("ts"), counts.alias("delta_counts"), points.alias("points")))


NO_POINTS = "array<struct<ts:string,qoe:double>>"


def tick_documents(records: DataFrame, clock: DataFrame, tick: str = "1 second", delay: str = "10 seconds", klass: str = "qoe_class", ts: str = TS) -> DataFrame:
    """(tick, rows, payload) of every tick that the clock names or a record falls in; use append mode."""
    rows = with_clock(records.select(ts, F.coalesce(F.col(klass), F.lit("Unknown")).alias("label")), clock, ts, delay)
    rows = rows.withColumn("label", F.coalesce("label", F.lit("")))  # the clock's own group
    per_class = rows.groupBy(F.window("event_time", tick).alias("w"), "label").agg(F.sum(F.when(F.col("is_clock"), 0).otherwise(1)).alias("n"))
    found = F.when(F.col("n") > 0, F.struct(F.col("label"), F.col("n")))
    per_tick = per_class.groupBy(F.window(F.window_time("w"), tick).alias("w")).agg(F.array_sort(F.collect_list(found)).alias("found"), F.sum("n").alias("rows"))
    start = F.col("w.start")
    return per_tick.select(start.alias("tick"), "rows", _document(start, F.map_from_entries("found"), F.array().cast(NO_POINTS)).alias("payload"))


class _Pages(StatefulProcessor):
    """Rows of one (tick, part) wait in list state, a chunk in one entry; the timer at the tick's end puts them in order.

    They leave as runs of whole pages, since a row that Python reads, keeps or yields costs far more than
    what is in it; ``tick_pages`` cuts the runs into pages."""

    def __init__(self, width: int, page: int, id_type: str):
        self.width, self.page, self.id_type = width, page, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("chunks", f"id array<{self.id_type}>, us array<bigint>, label array<string>, value array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        while chunk := list(islice(rows, CHUNK)):
            if held := [(r.id, r.us, r.label, r.value) for r in chunk if not r.is_clock]:
                self.rows.appendValue(tuple(list(c) for c in zip(*held)))
        self.handle.registerTimer((key[0] + self.width) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        chunks = self.rows.get() if self.rows.exists() else []
        rows = sorted((r for c in chunks for r in zip(*c)), key=lambda r: (r[1], r[0] is not None, r[0]))
        run = self.page * max(1, CHUNK // self.page)
        for at in range(0, max(1, len(rows)), run):
            _, us, label, value = zip(*rows[at : at + run]) if rows else ((),) * 4
            yield Row(tick_s=key[0], part=key[1], first=at // self.page, us=us, label=label, value=value)
        self.rows.clear()


def _pages_of(runs: DataFrame, page: int) -> DataFrame:
    """(tick_s, part, page, classes, points): the pages of runs of points, with the count of each class; a run without points is an empty page."""
    start = F.sequence(F.lit(0), F.greatest(F.size("us") - 1, F.lit(0)), F.lit(page))
    cut = lambda c, at: F.slice(c, at + 1, page)
    pages = F.transform(start, lambda at: F.struct((F.col("first") + (at / page).cast("int")).alias("page"), cut("label", at).alias("label"), F.arrays_zip(cut("us", at).alias("us"), cut("value", at).alias("qoe")).alias("points")))
    each = runs.select("tick_s", "part", F.explode(pages).alias("p"))
    label = F.col("p.label")
    classes = F.transform(F.array_sort(F.array_distinct(label)), lambda c: F.struct(c.alias("c"), F.size(F.filter(label, lambda x: x == c)).cast("long").alias("n")))
    return each.select("tick_s", "part", F.col("p.page").alias("page"), classes.alias("classes"), F.col("p.points").alias("points"))


def tick_pages(records: DataFrame, clock: DataFrame, width: int = 1, delay: str = "10 seconds", page: int = 500, parts: int = 1, klass: str = "qoe_class", value: str = "predicted_qoe", ts: str = TS, id_col: str = "id") -> DataFrame:
    """B8/H1 as a stream: (tick, part, page, points, payload), the points of every tick; part 0 of an empty tick has an empty document.

    Needs the RocksDB state store (``ROCKSDB``), as all state of this kind.
    """
    id_type = records.schema[id_col].dataType.simpleString()
    rows = records.select(
        ts,
        F.col(id_col).alias("id"),
        F.coalesce(F.col(klass), F.lit("Unknown")).alias("label"),
        F.col(value).cast("double").alias("value"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
        (F.conv(F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % parts).cast("int").alias("part"),
    )
    rows = with_clock(rows, clock, ts, delay).where("event_time is not null")
    second = F.floor(F.unix_seconds("event_time") / width) * width
    rows = rows.withColumn("tick_s", second.cast("long")).withColumn("part", F.coalesce("part", F.lit(0)))
    rows = rows.drop(ts) if ts != "event_time" else rows  # ``us`` has it
    runs = rows.groupBy("tick_s", "part").transformWithState(
        statefulProcessor=_Pages(width, page, id_type),
        outputStructType="tick_s long, part int, first int, us array<bigint>, label array<string>, value array<double>",
        outputMode="append",
        timeMode="EventTime",
    )
    pages = _pages_of(runs, page)
    tick = F.timestamp_seconds("tick_s")
    points = F.transform("points", lambda p: F.struct(iso_utc(F.timestamp_micros(p["us"])).alias("ts"), p["qoe"].alias("qoe")))
    return pages.select(tick.alias("tick"), "part", "page", F.size("points").cast("long").alias("points"), _document(tick, F.map_from_entries("classes"), points).alias("payload"))


def publish(path: str, make=None, attempts: int = 3):
    """foreachBatch sink of documents: batch N to ``path/documents/batch_id=N``, overwritten by a replay.

    ``make`` turns the batch into its documents. If that or the write fails, an ``error`` document without counts and points
    goes to ``path/errors/batch_id=N`` and the batch is tried again; the last failure is raised, so nothing is
    passed over. What was tried in vain leaves no document.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(attempts):
            try:
                (make(batch, batch_id) if make else batch).write.mode("overwrite").parquet(f"{path}/documents/batch_id={int(batch_id)}")
                return
            except Exception as e:
                spark = batch.sparkSession
                now = iso_utc(F.current_timestamp())
                text = F.lit(str(e)[:2000])
                empty = F.struct(now.alias("ts"), text.alias("error"), F.create_map().cast("map<string,bigint>").alias("delta_counts"), F.array().cast(NO_POINTS).alias("points"))
                spark.range(1).select(F.lit(attempt).alias("attempt"), F.to_json(empty).alias("payload")).write.mode("append").parquet(f"{path}/errors/batch_id={int(batch_id)}")
                if attempt + 1 == attempts:
                    raise

    return run
