"""Dashboard queries over a predictions table.

All are plain DataFrame plans: partial/final hash aggregates, top-k through
``TakeOrderedAndProject`` / window group limits, and pre-aggregated counts
before any ordered window, so no group of raw rows is gathered in one task.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.scalars import class_rank, clamp, iso_utc, severity_band

TS = "ingestion_timestamp"


def _ts_lit(since):
    if isinstance(since, (_dt.datetime, str)):
        return F.lit(since).cast("timestamp")
    return since


def read_since(df: DataFrame, since, until=None, ts: str = TS, month_col: str = "ym", inclusive: bool = False) -> DataFrame:
    """Rows with ``ts > since`` (``>=`` if ``inclusive``; and ``ts <= until``); adds a month-partition
    predicate ``ym >= yyyymm(since)`` when the table is month-partitioned, so
    whole month directories are pruned at planning time.
    """
    since_c = _ts_lit(since)
    out = df.filter(F.col(ts) >= since_c if inclusive else F.col(ts) > since_c)
    if until is not None:
        out = out.filter(F.col(ts) <= _ts_lit(until))
    if month_col in df.columns:
        lower = (F.year(since_c) * 100 + F.month(since_c)).cast("int")
        out = out.filter(F.col(month_col) >= lower)
        if until is not None:
            u = _ts_lit(until)
            out = out.filter(F.col(month_col) <= (F.year(u) * 100 + F.month(u)).cast("int"))
    return out


def class_counts(df: DataFrame, klass: str = "qoe_class", ts: str = TS) -> DataFrame:
    """Count and newest timestamp per class (E1/E2), with display rank (H2)."""
    return df.groupBy(klass).agg(F.count(F.lit(1)).alias("c"), F.max(ts).alias("max_ts")).withColumn(
        "class_rank", class_rank(F.col(klass))
    )


def next_cursor(counts: DataFrame, since) -> DataFrame:
    """The cursor moves to the overall max only when it is larger."""
    since_c = _ts_lit(since)
    m = counts.agg(F.max("max_ts").alias("m"))
    return m.select(F.when(F.col("m") > since_c, F.col("m")).otherwise(since_c).alias("cursor"))


def points_since(df: DataFrame, since, limit: int = 500, ts: str = TS, value: str = "predicted_qoe", id_col: str = "id") -> DataFrame:
    """H1, reference mode: new points ordered by time, first ``limit``.

    ``id`` breaks ties, so the page is deterministic. Planned as a per-partition
    top-k plus a final merge (``TakeOrderedAndProject``), never a full sort.
    """
    return (
        read_since(df, since, ts=ts)
        .select(id_col, ts, value)
        .orderBy(F.col(ts), F.col(id_col))
        .limit(limit)
    )


def points_page(df: DataFrame, since_ts, since_id=None, limit: int = 500, until=None, ts: str = TS, value: str = "predicted_qoe", id_col: str = "id") -> DataFrame:
    """H1, paged mode: compound ``(ts, id)`` cursor; the next cursor is the
    last row returned, so rows in the same second are never skipped and a
    surplus beyond ``limit`` comes in the next page. ``until`` is the settle
    bound (rows newer than it may still be arriving).
    """
    t = F.col(ts)
    s = _ts_lit(since_ts)
    if since_id is None:
        out = read_since(df, since_ts, until, ts=ts)
    else:
        # the conjunct on time alone reaches the scan; the cursor's tie rule is what remains
        out = read_since(df, since_ts, until, ts=ts, inclusive=True)
        out = out.filter((t > s) | ((t == s) & (F.col(id_col) > F.lit(since_id))))
    return out.select(id_col, ts, value).orderBy(t, F.col(id_col)).limit(limit)


@dataclass
class Pager:
    """H1 to the end: pages of ``limit`` points after a cursor that is kept in a table, up to a settle lag behind ``now``.

    The cursor is the (time, id) of the last point of the last page; ``keep`` adds it to the table at ``path`` under the feed's name, one row a page,
    so a reader that starts again goes on where it was. Points newer than ``now`` less ``settle`` seconds may still have
    company on the way, so they wait.
    """

    points: DataFrame
    path: str
    feed: str
    limit: int = 500
    settle: int = 2
    ts: str = TS
    value: str = "predicted_qoe"
    id_col: str = "id"

    def cursor(self, start) -> tuple:
        """(time, id, number of pages so far) that this feed has come to."""
        spark = self.points.sparkSession
        file = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
            return start, None, 0
        last = spark.read.parquet(self.path).where(F.col("feed") == self.feed).orderBy(F.col("page").desc()).first()
        return (last["ts"], last["id"], last["page"]) if last else (start, None, 0)

    def next_page(self, start, now) -> DataFrame:
        since, last_id, page = self.cursor(start)
        until = _ts_lit(now) - F.expr(f"INTERVAL {int(self.settle)} SECONDS")
        return points_page(self.points, since, last_id, self.limit, until, self.ts, self.value, self.id_col).withColumn("page", F.lit(page + 1))

    def keep(self, page: DataFrame) -> int:
        """Store the cursor behind a page; returns its number of points (at most ``limit``), 0 at the end."""
        last = page.agg(F.max_by(F.struct(F.col(self.ts).alias("ts"), F.col(self.id_col).alias("id"), "page"), F.struct(self.ts, self.id_col)).alias("c"), F.count(F.lit(1)).alias("n"))
        last = last.select(F.lit(self.feed).alias("feed"), "c.ts", "c.id", "c.page", "n").where("n > 0").persist()
        try:
            row = last.first()
            if row is None:
                return 0
            last.drop("n").coalesce(1).write.mode("append").parquet(self.path)
            return row["n"]
        finally:
            last.unpersist()


def chart_points(points: DataFrame, ts: str = TS, value: str = "predicted_qoe") -> DataFrame:
    """Points as the chart plots them: ISO time, raw and clamped value, band."""
    return points.select(
        "id",
        iso_utc(F.col(ts)).alias("ts"),
        F.col(value).cast("double").alias("qoe"),
        clamp(F.col(value)).alias("plotted"),
        severity_band(clamp(F.col(value))).alias("band"),
    )


#: Seconds of a chunk of ticks: some thousand ticks each.
TICK_CHUNK = {"second": 3_600, "minute": 172_800, "hour": 7_776_000, "day": 315_360_000}


def cumulative_class_counts(df: DataFrame, tick: str = "day", klass: str = "qoe_class", ts: str = TS, chunk: int | None = None) -> DataFrame:
    """Running total per class over ticks, as a prefix sum in two levels.

    Deltas per (class, tick) are aggregated first. They are summed by (class, chunk of time); the running total over the
    chunks, one row each, is what a chunk begins with; inside a chunk a window adds up at most ``chunk`` seconds of ticks. So no
    task holds a class's ticks. Rows without a time are the first chunk.
    """
    size = int(chunk or TICK_CHUNK.get(tick, 315_360_000))
    deltas = df.groupBy(F.date_trunc(tick, F.col(ts)).alias("tick"), F.col(klass)).agg(F.count(F.lit(1)).alias("delta"))
    deltas = deltas.withColumn("_c", F.floor(F.unix_seconds(F.col("tick").cast("timestamp")) / F.lit(size)))
    chunks = deltas.groupBy(F.col(klass).alias("_k"), F.col("_c").alias("_chunk")).agg(F.sum("delta").alias("_n"))
    before = Window.partitionBy("_k").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_k", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = deltas.join(chunks, F.col(klass).eqNullSafe(F.col("_k")) & F.col("_c").eqNullSafe(F.col("_chunk")))
    inside = Window.partitionBy(klass, "_c").orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select("tick", klass, "delta", (F.col("_before") + F.sum("delta").over(inside)).cast("bigint").alias("total"))


def latest_per_series(df: DataFrame, key: str, value: str, ts: str = TS, id_col: str = "id") -> DataFrame:
    """Value of the newest row per key (ties: larger id). ``max_by`` is a
    partial aggregate, so a hot key is reduced map-side before the shuffle.
    """
    order = F.struct(F.col(ts), F.col(id_col))
    return df.groupBy(key).agg(
        F.max_by(F.col(value), order).alias(value),
        F.max(F.col(ts)).alias("latest_ts"),
        F.max_by(F.col(id_col), order).alias("latest_id"),
    )


def trailing_points(df: DataFrame, as_of, seconds: int = 30, ts: str = TS) -> DataFrame:
    """G1 as-of form: points in ``[as_of - seconds, as_of]``."""
    a = _ts_lit(as_of)
    return read_since(df, a - F.expr(f"INTERVAL {int(seconds)} SECONDS"), a, ts=ts, inclusive=True)


def trailing_count(df: DataFrame, key: str, seconds: int = 30, ts: str = TS, id_col: str = "id", chunk: int | None = None) -> DataFrame:
    """G1 per-row form: rows of the same key in ``[ts - seconds, ts]``.

    Equal to a RANGE window over each key, but skew-safe and compact: rows are
    first counted per (key, second); the per-second counts are cut into
    (key, time chunk) partitions of ``chunk`` seconds, and each count whose
    second lies in the last ``seconds`` of its chunk is also copied into the
    next chunk as context (at most ``seconds / chunk`` extra rows). A RANGE
    window inside each (key, chunk) then sees every second it needs, so one
    key's history is spread over many tasks and each task holds at most
    ``chunk + seconds`` rows. Rows join back on (key, second).
    """
    s = int(seconds)
    c = int(chunk or max(60, 4 * s))
    if c < s:
        raise ValueError("chunk must cover the window")
    sec = F.unix_seconds(F.col(ts).cast("timestamp"))
    rows = df.select(id_col, key, ts, sec.alias("_sec"))
    per_sec = rows.groupBy(key, "_sec").agg(F.count(F.lit(1)).alias("_n"))
    own = F.floor(F.col("_sec") / F.lit(c))
    is_tail = F.col("_sec") - own * F.lit(c) >= F.lit(c - s)
    placed = per_sec.select(
        key,
        "_sec",
        "_n",
        F.explode(
            F.when(is_tail, F.array(F.struct(own.alias("c"), F.lit(True).alias("own")), F.struct((own + 1).alias("c"), F.lit(False).alias("own"))))
            .otherwise(F.array(F.struct(own.alias("c"), F.lit(True).alias("own"))))
        ).alias("_p"),
    )
    w = Window.partitionBy(key, F.col("_p.c")).orderBy("_sec").rangeBetween(-s, 0)
    window_counts = placed.withColumn("n_window", F.sum("_n").over(w)).filter(F.col("_p.own")).select(key, "_sec", "n_window")
    # rows without a key are a group of their own; a row without a time has no window, and null as its count
    counts = window_counts.select(F.col(key).alias("_key"), F.col("_sec").alias("_s"), "n_window")
    joined = rows.join(counts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_sec") == F.col("_s")), "left")
    return joined.select(id_col, key, ts, F.col("n_window").cast("bigint"))


def tick_counts(df: DataFrame, tick: str = "second", klass: str = "qoe_class", ts: str = TS) -> DataFrame:
    """Rows per (tick, class): what the documents carry as ``delta_counts``."""
    return df.groupBy(F.date_trunc(tick, F.col(ts)).alias("tick"), F.col(klass)).agg(F.count(F.lit(1)).alias("c"))


def id_cuts(rows: DataFrame, busy: DataFrame, keys: list[str], id_col: str, parts: int) -> DataFrame:
    """For the ``busy`` groups alone, ``parts`` - 1 approximate quantiles of their ids as ``_cuts``; the keys come with a leading ``_``. Ids that are no numbers have none."""
    named = busy.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    found = rows.join(named, same, "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
    if not isinstance(rows.schema[id_col].dataType, NumericType):
        return found.agg(F.lit(None).cast("array<double>").alias("_cuts"))
    return found.agg(F.percentile_approx(id_col, F.lit([i / parts for i in range(1, parts)]), 10_000).alias("_cuts"))


def id_part(cuts: str, id_col: str) -> Column:
    """How many cuts are below the id; 0 without cuts."""
    return F.coalesce(F.when(F.col(cuts).isNotNull(), F.size(F.filter(cuts, lambda c: c < F.col(id_col)))), F.lit(0))


def tick_points(df: DataFrame, tick: str = "second", limit: int = 500, ts: str = TS, value: str = "predicted_qoe", id_col: str = "id", slices: int = 4096) -> DataFrame:
    """Points of each tick in (time, id) order with their position and page.

    A page has ``limit`` points; a busy tick has as many pages as it needs, so
    the points of all pages are the rows of the tick. Positions are counted in two levels: a tick's time is cut into
    ``slices`` and, where many rows share one, its ids by ``slices`` quantiles; rows are counted per slice, and a slice begins where those before it end. So
    a tick's rows are never in one task.
    """
    rows = df.select(F.date_trunc(tick, F.col(ts)).alias("tick"), ts, id_col, value)
    width = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}.get(tick, 86400 * 31) * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("tick").cast("timestamp"))
    rows = rows.withColumn("_s", F.floor(micros * slices / F.lit(width)).cast("int"))
    busy = rows.groupBy("tick", "_s").count().where(F.col("count") > 50 * limit)
    cuts = id_cuts(rows, busy, ["tick", "_s"], id_col, 64)
    rows = rows.join(cuts, F.col("tick").eqNullSafe(F.col("_tick")) & F.col("_s").eqNullSafe(F.col("__s")), "left")
    rows = rows.select("tick", ts, id_col, value, F.struct(F.col("_s").alias("s"), id_part("_cuts", id_col).alias("c")).alias("_slice"))
    sizes = rows.groupBy(F.col("tick").alias("_t"), F.col("_slice").alias("_sl")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_t").orderBy("_sl").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_t", "_sl", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.join(sizes, F.col("tick").eqNullSafe(F.col("_t")) & F.col("_slice").eqNullSafe(F.col("_sl")))
    inside = Window.partitionBy("tick", "_slice").orderBy(F.col(ts), F.col(id_col))
    pts = rows.select("tick", ts, id_col, value, (F.col("_before") + F.row_number().over(inside)).cast("int").alias("pos"))
    return pts.withColumn("page", F.floor((F.col("pos") - 1) / limit).cast("int"))


def tick_payload(df: DataFrame, tick: str = "second", limit: int = 500, klass: str = "qoe_class", ts: str = TS, value: str = "predicted_qoe", id_col: str = "id") -> DataFrame:
    """JSON documents ``{ts, delta_counts, points}`` per tick, ``limit`` points each.

    The first document of a tick (page 0) has its counts; the points beyond
    ``limit`` come in follow-up documents with empty counts.
    """
    counts = (
        tick_counts(df, tick, klass, ts)
        .groupBy("tick")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(klass).cast("string"), F.col("c"))))).alias("delta_counts"))
        .withColumn("page", F.lit(0))
    )
    pts = (
        tick_points(df, tick, limit, ts, value, id_col)
        .groupBy("tick", "page")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), iso_utc(F.col(ts)).alias("ts"), F.col(value).cast("double").alias("qoe")))).alias("_pts"))
        .select("tick", "page", F.transform("_pts", lambda p: F.struct(p["ts"].alias("ts"), p["qoe"].alias("qoe"))).alias("points"))
    )
    doc = counts.join(pts, ["tick", "page"], "full_outer")
    return doc.select(
        iso_utc(F.col("tick")).alias("tick"),
        "page",
        F.to_json(
            F.struct(
                iso_utc(F.col("tick")).alias("ts"),
                F.coalesce(F.col("delta_counts"), F.create_map().cast("map<string,bigint>")).alias("delta_counts"),
                F.coalesce(F.col("points"), F.array().cast("array<struct<ts:string,qoe:double>>")).alias("points"),
            )
        ).alias("payload"),
    )


PAYLOAD_SCHEMA = "ts string, delta_counts map<string,bigint>, points array<struct<ts:string,qoe:double>>"


def decode_payload(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """JSON tick document back to its page and struct."""
    return payloads.select("page", F.from_json(F.col(col), PAYLOAD_SCHEMA).alias("p")).select("page", "p.*")
