"""Structured Streaming pipeline (K1-K10, B7): messages -> raw + predictions.

    source (value: binary) -> strip frame -> decode Avro -> flatten
      -> stamp processing time (one value per micro-batch, kept in the offset
         log, so a replay reuses it) -> foreachBatch:
           persist; raw table; validate + score + classify; predictions; unpersist

Writes go to ``batch_id=N`` directories in overwrite mode, so a micro-batch
replayed after a failure replaces its own output: the effect is exactly once.
Row ids derive from (topic, partition, offset), so replays keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import second_now
from tidemark.operators.quality import is_valid, reasons
from tidemark.operators.scoring import score
from tidemark.sinks.commits import by_month, commit_sink
from tidemark.sinks.tables import fan_out, prediction_columns, raw_columns, with_defaults, write_predictions, write_raw
from tidemark.sources.framing import decode_avro, encode_avro, flatten
from tidemark.spec import UseCase


def decode_messages(messages: DataFrame, u: UseCase, framed: bool = True, original: str | None = None) -> DataFrame:
    """A2-A4 + K8: Kafka-shaped messages -> KPI records with a stable id and
    the message time (to the second) as ingestion timestamp. ``original``: a
    column that keeps the bytes of the message."""
    keep = ["topic", "partition", "offset", "timestamp"]
    if original:
        messages, keep = messages.withColumn(original, F.col("value")), [*keep, original]
    dec = flatten(decode_avro(messages, u, "value", framed=framed, keep=keep))
    rid = F.sha2(F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")), 256)
    return dec.select(
        rid.alias("id"),
        *u.features,
        F.date_trunc("second", F.col("timestamp")).alias("ingestion_timestamp"),
        "offset",
        "_malformed",
        *([original] if original else []),
    )


def stamp(records: DataFrame) -> DataFrame:
    """Processing time of the micro-batch (second precision)."""
    return records.withColumn("processing_time", second_now()).withColumn("prediction_timestamp", F.col("processing_time"))


def pipeline_sink(u: UseCase, model, raw_path: str, pred_path: str):
    """foreachBatch callable writing raw then predictions."""

    def raw(batch, batch_id):
        write_raw(batch, raw_path, u, batch_id=batch_id)

    def predictions(batch, batch_id):
        write_predictions(score(batch, u, model), pred_path, u, batch_id=batch_id)

    return fan_out(raw, predictions)


REJECTED = ["id", "reasons", "original", "processing_time", "ingestion_timestamp"]


def rejected(records: DataFrame, u: UseCase) -> DataFrame:
    """The records that no scorer takes, with what is wrong and the bytes they came in; those that cannot be decoded are ``malformed``."""
    why = F.when(F.col("_malformed"), F.lit("malformed")).otherwise(F.array_join(reasons(u), ";"))
    return records.withColumn("reasons", why).where("reasons <> ''").select(*REJECTED)


def build_committed(messages: DataFrame, u: UseCase, model, root: str, checkpoint: str, trigger: dict | None = None, query_name: str | None = None):
    """Start the scoring stream into the tables ``raw``, ``predictions`` and ``rejected`` of ``root``, which
    readers see batch by batch (``sinks.commits``): every record in raw, and in one of the other two."""
    records = observe_batch(stamp(decode_messages(messages, u, original="original")), u)
    tables = {
        "raw": lambda b: by_month(with_defaults(b, raw_columns(u))),
        "predictions": lambda b: by_month(with_defaults(score(b, u, model), prediction_columns(u))),
        "rejected": lambda b: by_month(rejected(b, u)),
    }
    w = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(commit_sink(root, tables))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def table_schemas(u: UseCase) -> dict[str, T.StructType]:
    """Columns of the tables that ``build_committed`` writes."""
    kinds = {f: u.spark_type(f) for f in u.features} | {"predicted_qoe": T.DoubleType(), "original": T.BinaryType()}
    kind = lambda c: kinds.get(c) or (T.TimestampType() if c.endswith(("_time", "_timestamp")) else T.StringType())
    columns = {"raw": raw_columns(u), "predictions": prediction_columns(u), "rejected": REJECTED}
    return {name: T.StructType([T.StructField(c, kind(c)) for c in cs]) for name, cs in columns.items()}


BATCH_METRICS = "kpi_batch"


def observe_batch(records: DataFrame, u: UseCase) -> DataFrame:
    """Per micro-batch counts, computed while the batch is processed (no
    extra pass): records, malformed messages, and valid records (= the
    predictions written). Read them with ``batch_counts(query)``."""
    return records.observe(
        BATCH_METRICS,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("_malformed").cast("long")), F.lit(0)).alias("malformed"),
        F.coalesce(F.sum(is_valid(u).cast("long")), F.lit(0)).alias("valid"),
    )


def batch_counts(query) -> list[dict]:
    """``{batch_id, rows, malformed, valid}`` of each recent micro-batch."""
    out = []
    for p in query.recentProgress:
        m = (p.get("observedMetrics") or {}).get(BATCH_METRICS)
        if m is not None:
            out.append({"batch_id": p["batchId"], "rows": m["rows"], "malformed": m["malformed"], "valid": m["valid"]})
    return out


def build_pipeline(messages: DataFrame, u: UseCase, model, raw_path: str, pred_path: str, checkpoint: str, trigger: dict | None = None, query_name: str | None = None):
    """Start the scoring stream (append mode, default or given trigger)."""
    records = observe_batch(stamp(decode_messages(messages, u)), u)
    w = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(pipeline_sink(u, model, raw_path, pred_path))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stage_topic(kpi: DataFrame, u: UseCase, path: str, files: int = 4, sid: int = 1, seconds: tuple[int, int] | None = None) -> tuple[str, int]:
    """Write KPI records as a Kafka-shaped topic (framed Avro values, offsets
    in id order) in ``files`` consecutive offset ranges for a file-source
    replay. ``kpi`` needs ``id`` (becomes the offset) and
    ``ingestion_timestamp``. Returns (path, files per trigger). With ``seconds`` (first
    and last, since the epoch) the ranges are equal spans of time instead.
    """
    msgs = encode_avro(kpi.select("id", "ingestion_timestamp", *u.features), u, sid, keep=["id", "ingestion_timestamp"])
    out = msgs.select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        F.lit(f"{u.name}_kpi").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").cast("bigint").alias("offset"),
        F.col("ingestion_timestamp").cast("timestamp").alias("timestamp"),
    )
    if seconds:
        return path, write_ordered(out.withColumn("second", F.unix_seconds("timestamp")), path, "second", files, bounds=seconds)
    return path, write_ordered(out, path, "offset", files)


def write_ordered(df: DataFrame, path: str, order: str, files: int = 4, tasks: int | None = None, bounds: tuple[int, int] | None = None) -> int:
    """Write ``df`` as ``files`` segments holding consecutive ranges of
    ``order``, written one after another: a file source lists files by
    modification time, so a replay reads the segments in order (as a consumer
    reads one partition of a topic).

    Each segment is written by ``k`` parallel tasks (round-robin, so exactly
    ``k`` files, each sorted on ``order``); a reader taking ``k`` files per
    trigger sees one segment per micro-batch, read by ``k`` parallel tasks.
    ``k`` defaults to the cluster's cores (or the shuffle partitions spread
    over the segments, if more) and never exceeds the rows of the smallest
    segment. Returns ``k``. Range bounds and segment sizes come from
    one small aggregate; the input is cached for the sequential writes. Tables written with
    the same ``bounds`` of ``order`` have segments of the same ranges.
    """
    df = df.persist()
    try:
        lo, hi = bounds or df.agg(F.min(order), F.max(order)).first()
        if lo is None:
            df.limit(0).write.mode("overwrite").parquet(path)
            return 1
        lo, hi = int(lo), int(hi)
        step = (hi - lo) // files + 1
        seg = F.floor((F.col(order) - F.lit(lo)) / F.lit(step)).cast("int")
        sizes = {r["s"]: r["n"] for r in df.groupBy(seg.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            df.limit(0).write.mode("overwrite").parquet(path)
            return 1
        if tasks is None:
            spark = df.sparkSession
            tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // files)
        k = max(1, min([tasks, *sizes.values()]))
        first = True
        for i in range(files):
            if not sizes.get(i):
                continue
            part = df.filter((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
            part.repartition(k).sortWithinPartitions(order).write.mode("overwrite" if first else "append").parquet(path)
            first = False
    finally:
        df.unpersist()
    return k


def run_available(query) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
