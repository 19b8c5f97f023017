"""What every micro-batch did, as a table.

``BatchLog`` is a query listener: each finished micro-batch of a watched query adds one row to a Parquet table:
its number, rows read, the counts that ``Dataset.observe`` took on the way, and the rows that the watermark dropped as late. Unlike a query's
``recentProgress``, the table forgets nothing; a batch run again after a failure adds a row of its
own, and ``batch_table`` keeps each batch's last one.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, batch_id long, reported timestamp, input_rows long, late_rows long, observed string"


class BatchLog(StreamingQueryListener):
    """Appends a row for each micro-batch of the queries named in ``names`` (all, if none are) to ``path``."""

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = (), every: int = 50):
        self.spark, self.path, self.names, self.every = spark, path, names, every
        self.rows: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names and p.name not in self.names:
            return
        observed = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        with self.lock:
            self.rows.append((p.name or str(p.id), p.batchId, p.numInputRows, late, json.dumps(observed, sort_keys=True, default=str)))
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write the rows that wait (at most ``every``) as one file."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            df = self.spark.createDataFrame(rows, "query string, batch_id long, input_rows long, late_rows long, observed string")
            df.coalesce(1).withColumn("reported", F.current_timestamp()).select("query", "batch_id", "reported", "input_rows", "late_rows", "observed").write.mode("append").parquet(self.path)


def watched(spark: SparkSession, path: str, names: tuple[str, ...] = ()):
    """Context manager: log the batches of the named queries while it is open."""
    return _Watch(spark, BatchLog(spark, path, names))


class _Watch:
    def __init__(self, spark: SparkSession, log: BatchLog):
        self.spark, self.log = spark, log

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self.log)
        return self.log

    def __exit__(self, *_) -> None:
        # reports come through a queue: what has been asked for before is through when it is empty
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self.log)
        self.log.flush()


def batch_table(spark: SparkSession, path: str, metric: str, fields: str) -> DataFrame:
    """(query, batch_id, input_rows, late_rows) and the ``fields`` (DDL) of the observed ``metric`` for every micro-batch."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    last = rows.groupBy("query", "batch_id").agg(F.max_by(F.struct("input_rows", "late_rows", "observed"), "reported").alias("v"))
    parsed = F.from_json("v.observed", f"`{metric}` struct<{', '.join(f.strip().replace(' ', ':', 1) for f in fields.split(','))}>")
    return last.select("query", "batch_id", "v.input_rows", "v.late_rows", parsed.getField(metric).alias("m")).select("query", "batch_id", "input_rows", "late_rows", "m.*")


def require_none_late(batches: DataFrame) -> DataFrame:
    """``batches`` if the watermark has dropped no row; else an error that names the first batches that lost some."""
    bad = batches.where("late_rows > 0").orderBy("batch_id").limit(5).collect()
    if bad:
        raise RuntimeError("late rows were dropped: " + ", ".join(f"{r['query']} batch {r['batch_id']}: {r['late_rows']}" for r in bad))
    return batches
