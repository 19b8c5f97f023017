"""Stateful streaming operators.

K11 running class counts: ``groupBy(class).count()`` in update mode.
K12 keyed alerts: state by key, event-time timers. Rows wait in the state store, in pieces ordered by time,
    until the watermark has passed their second, and then go through the state machine in (time, id) order, as the pieces are
    merged: the result does not depend on how rows are spread over micro-batches. A task holds the rows of one second of one
    key and a piece of each chunk that came in, not the key's history; its results of one timer leave together. An alert that recovers ends by itself: a ``normal`` row without id and value comes out at
    ``recovery + hold``, by a timer if no row of the key does it. With these rows left out the result
    is that of ``operators.alerts.alert_states``.
K13 trailing windows: rows are counted in panes of one slide (partial aggregation), and a second
    stateful operator adds up the last panes. A row is shuffled once and a pane once, however wide the window.

Rows later than ``delay`` are dropped by the watermark, and counted (``monitor.py``); rows without a
time are left out. A clock (``ticks.with_clock``) closes what no later record closes.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.ticks import CHUNK, with_clock

ALERT_RUN = {"id": "bigint", "sec": "bigint", "q": "double", "signal": "string", "state": "string"}
PIECE = 256  # rows of an entry of the state store


def alert_step(machine: tuple[bool, int | None], sec: int, q: float | None, low: float, high: float, hold: int) -> tuple[tuple[bool, int | None], str | None, str]:
    """Next (visible, first recovery), the row's signal and state; the hold time has been looked after before."""
    visible, rec = machine
    if q is not None and q < low:
        return (True, None), "D", "degraded"
    signal = "R" if q is not None and q >= high else None
    if visible and signal and rec is None:
        rec = sec
    return (visible, rec), signal, "normal" if not visible else ("degraded" if rec is None else "recovering")


class _Alerts(StatefulProcessor):
    """``pieces``: rows in the order of their seconds, ``PIECE`` in one entry. ``count``: the entries so far, which number them.
    ``machine``: is the alert shown, and since when does it recover. Times are seconds from ``origin``.

    A call of the state store, and a row that Python yields, costs as much as many records, so both take runs of them."""

    def __init__(self, low: float, high: float, hold: int, origin: int):
        self.low, self.high, self.hold, self.origin = low, high, hold, origin

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState("pieces", "first long, number long", "sec array<bigint>, id array<bigint>, q array<double>")
        self.count = handle.getValueState("count", "number long")
        self.machine = handle.getValueState("machine", "visible boolean, rec long")

    def _at(self, sec: int) -> int:
        return (sec + self.origin) * 1000

    def _wait(self, rows: list[tuple]) -> None:
        number = self.count.get()[0] if self.count.exists() else 0
        for at in range(0, len(rows), PIECE):
            self.pieces.updateValue((rows[at][0], number), tuple(list(c) for c in zip(*rows[at : at + PIECE])))
            number += 1
        self.count.update((number,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        while chunk := sorted(((r.sec, r.id, r.q) for r in islice(rows, CHUNK)), key=lambda r: r[0]):
            self._wait(chunk)
            first = chunk[0][0] if first is None else min(first, chunk[0][0])
        if first is not None:
            self.handle.registerTimer(self._at(first + 1))
        return iter(())

    def _over(self, now: int, late: list[int]) -> Iterator[tuple]:
        """(sec, id, q) of the seconds that are over, in the order of time and id; the first other second is put into ``late``.

        The pieces are merged: one is read when its first second comes, so few rows are held beside those of a second."""
        keys = sorted(tuple(k) for k in self.pieces.keys())
        held: list[tuple] = []  # a heap of the rows that have been read and are not through
        for read, piece in enumerate([*keys, None]):
            # the pieces from here on have nothing earlier than the first second of this one
            while held and (piece is None or held[0][0] < piece[0]) and self._at(held[0][0] + 1) <= now:
                sec, has_id, i, _, q = heappop(held)
                yield sec, i if has_id else None, q
            if piece is None or self._at(piece[0] + 1) > now:
                late.extend(([piece[0]] if piece else []) + [r[0] for r in held[:1]])
                break
            for n, (sec, i, q) in enumerate(zip(*self.pieces.getValue(piece))):
                heappush(held, (sec, i is not None, 0 if i is None else i, (read, n), q))
            self.pieces.removeKey(piece)
        if held:
            self._wait([(sec, i if has_id else None, q) for sec, has_id, i, _, q in sorted(held)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        machine = tuple(self.machine.get()) if self.machine.exists() else (False, None)
        late: list[int] = []
        out: list[tuple] = []
        for sec, i, q in self._over(now, late):
            if machine[0] and machine[1] is not None and sec >= machine[1] + self.hold:
                out.append(self._ended(machine[1]))
                machine = (False, None)
            machine, signal, state = alert_step(machine, sec, q, self.low, self.high, self.hold)
            out.append((i, sec, q, signal, state))
            if len(out) >= CHUNK:
                yield self._run(key, out)
                out = []
        if machine[0] and machine[1] is not None and not any(sec < machine[1] + self.hold for sec in late):
            if self._at(machine[1] + self.hold) <= now:
                out.append(self._ended(machine[1]))
                machine = (False, None)
            else:
                self.handle.registerTimer(self._at(machine[1] + self.hold))
        if out:
            yield self._run(key, out)
        if late:
            self.handle.registerTimer(self._at(min(late) + 1))
        if machine[0]:
            self.machine.update(machine)
        elif self.machine.exists():
            self.machine.clear()

    def _ended(self, rec: int) -> tuple:
        return (None, rec + self.hold, None, None, "normal")

    def _run(self, key, rows: list[tuple]) -> Row:
        return Row(k=key[0], **dict(zip(ALERT_RUN, zip(*rows), strict=True)))


def stream_alerts(points: DataFrame, clock: DataFrame, low: float = 2.5, high: float = 3.0, hold: int = 3, delay: str = "10 seconds", origin: int = 0) -> DataFrame:
    """K12 over a stream of (id, k, sec, q). ``sec`` counts seconds from
    ``origin`` (epoch seconds); event time and watermark are ``origin + sec``. Needs the RocksDB state store."""
    rows = points.where("sec is not null").withColumn("at", F.timestamp_seconds(F.col("sec") + F.lit(int(origin))))
    # the condition names the event time, so that it stays above the watermark, which the clock's rows move
    rows = with_clock(rows, clock, "at", delay).where("not is_clock or event_time is null")
    kinds = ", ".join(f"{c} array<{t}>" for c, t in ALERT_RUN.items())
    runs = rows.drop("at").groupBy("k").transformWithState(
        statefulProcessor=_Alerts(low, high, hold, int(origin)), outputStructType=f"k long, {kinds}", outputMode="append", timeMode="EventTime"
    )
    return runs.select("k", F.inline(F.arrays_zip(*ALERT_RUN))).select("id", "k", "sec", "q", "signal", "state")


def running_class_counts(scored: DataFrame, klass: str = "qoe_class") -> DataFrame:
    """Cumulative count per class (emit with update or complete mode)."""
    return scored.groupBy(klass).agg(F.count(F.lit(1)).alias("c"))


class _Trailing(StatefulProcessor):
    """The last panes of a key, oldest first: (second of the pane, rows). While one of them has rows, an event-time timer brings the next window."""

    def __init__(self, width: int, slide: int):
        self.width, self.slide = width, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getValueState("panes", "at array<bigint>, n array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, n = self._held()
        for t, new in sorted((r.at, r.n) for r in rows):  # the panes that this batch closed: at most one for each slide of its time
            yield from self._filled(key, at, n, t)
            yield from self._add(key, at, n, t, new)
        self._keep(at, n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, n = self._held()
        yield from self._filled(key, at, n, timerValues.getCurrentWatermarkInMs() // 1000)
        self._keep(at, n)

    def _held(self) -> tuple[list, list]:
        return tuple(list(x) for x in self.panes.get()) if self.panes.exists() else ([], [])

    def _keep(self, at: list, n: list) -> None:
        if at:
            self.panes.update((at, n))
            self.handle.registerTimer((at[-1] + 2 * self.slide) * 1000)  # the end of the next pane
        elif self.panes.exists():
            self.panes.clear()

    def _filled(self, key, at: list, n: list, until: int) -> Iterator[Row]:
        """Panes without rows that end by ``until``, as long as a window sees a row."""
        while at and at[-1] + 2 * self.slide <= until:
            yield from self._add(key, at, n, at[-1] + self.slide, 0)

    def _add(self, key, at: list, n: list, t: int, new: int) -> Iterator[Row]:
        at.append(t)
        n.append(new)
        while at[0] <= t - self.width:
            del at[0], n[0]
        if sum(n):
            yield Row(feed=key[0], end=t + self.slide, n=sum(n))
        else:
            at.clear()
            n.clear()


def trailing_window_counts(records: DataFrame, clock: DataFrame, ts: str = "ingestion_timestamp", width: int = 30, slide: int = 1, delay: str = "30 seconds", key: str | None = None) -> DataFrame:
    """Rows of the last ``width`` seconds at every ``slide``: (feed, window_start, window_end, n) where there are any.

    ``key``: a column whose values are feeds of their own (by default all rows are one); rows without a key are the feed ''.
    Use append mode; needs the RocksDB state store.
    """
    feed = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit("")
    rows = with_clock(records.select(ts, feed.alias("feed")), clock, ts, delay).where("not is_clock or event_time is null")
    panes = rows.groupBy(F.window("event_time", f"{int(slide)} seconds").alias("w"), "feed").agg(F.count(F.lit(1)).alias("n"))
    panes = panes.select("feed", F.window_time("w").alias("event_time"), F.unix_seconds("w.start").alias("at"), "n")
    sums = panes.groupBy("feed").transformWithState(statefulProcessor=_Trailing(int(width), int(slide)), outputStructType="feed string, end long, n long", outputMode="append", timeMode="EventTime")
    return sums.select("feed", F.timestamp_seconds(F.col("end") - int(width)).alias("window_start"), F.timestamp_seconds("end").alias("window_end"), "n")


def keep_latest(updates: DataFrame, keys, order: str = "batch_id") -> DataFrame:
    """Collapse update-mode outputs written per batch to the final value per key."""
    vals = [c for c in updates.columns if c not in list(keys) + [order]]
    agg = F.max_by(F.struct(*vals), F.col(order)).alias("_v")
    return updates.groupBy(*keys).agg(agg).select(*keys, "_v.*")
