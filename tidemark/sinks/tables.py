"""Table sinks (B2-B7): month-partitioned, sorted Parquet tables, headerless
CSV, column defaults, and an idempotent micro-batch fan-out.

Layout (B6): ``ym`` = toYYYYMM(ingestion_timestamp) as the partition
directory; rows are range-partitioned on (ym, ts, id) and sorted inside each
task, so every file covers a narrow, non-overlapping key range (good min/max
statistics for skipping) and one busy month is spread over many tasks instead
of landing in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import second_now, yyyymm
from tidemark.spec import UseCase

TS = "ingestion_timestamp"


def raw_columns(u: UseCase) -> list[str]:
    return ["id", *u.features, "processing_time", TS]


def prediction_columns(u: UseCase) -> list[str]:
    return ["id", *u.features, "predicted_qoe", "qoe_class", "prediction_timestamp", TS]


def with_defaults(df: DataFrame, columns: list[str], id_mode: str = "uuid", id_source=None) -> DataFrame:
    """Fill absent columns with their defaults, then select in table order.

    id: ``uuid()`` (random, like the reference) or, with ``id_mode="stable"``, a
    SHA-256 of ``id_source`` columns so a replay reproduces the same ids.
    Timestamps default to now at second precision.
    """
    out = df
    for c in columns:
        if c in out.columns:
            continue
        if c == "id":
            if id_mode == "stable":
                src = [F.col(s).cast("string") for s in (id_source or [])]
                out = out.withColumn("id", F.sha2(F.concat_ws(":", *src), 256))
            else:
                out = out.withColumn("id", F.expr("uuid()"))
        elif c.endswith("_time") or c.endswith("_timestamp"):
            out = out.withColumn(c, second_now())
        else:
            raise ValueError(f"no default for column {c}")
    return out.select(*columns)


def monthly_layout(df: DataFrame, ts: str = TS, sort=(TS, "id"), partitions: int | None = None) -> DataFrame:
    """Add ``ym`` and arrange rows for a month-partitioned, sorted write."""
    out = df.withColumn("ym", yyyymm(F.col(ts)))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, F.col("ym"), *[F.col(c) for c in sort]).sortWithinPartitions("ym", *sort)


def write_monthly(df: DataFrame, path: str, ts: str = TS, sort=(TS, "id"), batch_id: int | None = None, mode: str = "append") -> str:
    """B6 (+B2/B3): write month-partitioned Parquet.

    With ``batch_id`` the rows go to ``path/batch_id=N`` in overwrite mode: a
    replayed micro-batch replaces exactly its own output (idempotent), and
    readers of ``path`` see ``batch_id`` and ``ym`` as partition columns.
    """
    laid = monthly_layout(df, ts, sort)
    target, m = (f"{path.rstrip('/')}/batch_id={int(batch_id)}", "overwrite") if batch_id is not None else (path, mode)
    laid.write.mode(m).partitionBy("ym").parquet(target)
    return target


def write_raw(df: DataFrame, path: str, u: UseCase, batch_id: int | None = None) -> str:
    """B2: all records (valid or not) with processing time, table column order."""
    return write_monthly(with_defaults(df, raw_columns(u)), path, batch_id=batch_id)


def write_predictions(df: DataFrame, path: str, u: UseCase, batch_id: int | None = None) -> str | None:
    """Scored records; an empty batch writes nothing."""
    if df.isEmpty():
        return None
    return write_monthly(with_defaults(df, prediction_columns(u)), path, batch_id=batch_id)


def to_headerless_csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> str:
    """Positional CSV, no header (column order is the contract)."""
    df.select(*columns).write.mode(mode).option("header", False).csv(path)
    return path


def fan_out(*sinks):
    """One micro-batch -> several sinks in order, reading the batch once.

    Returns a ``foreachBatch`` callable. The batch is persisted for the sinks
    and released afterwards; an empty batch writes nothing; a failing sink
    raises, so the batch is retried instead of silently lost.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run
