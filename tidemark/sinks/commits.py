"""Several tables written by one stream as one commit.

Every sink of a micro-batch writes its rows to ``<root>/<table>/batch_id=N`` in overwrite mode. When all sinks
of batch N have returned, one file that names it is added to ``<root>/commits``; a file
appears at once or not at all. Readers see a batch only if it is named there, so a crash between two sinks shows
nothing of it, and the batch run again replaces what was left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tidemark.functions.scalars import yyyymm

TS = "ingestion_timestamp"


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id) of every batch that all sinks have written."""
    return spark.read.schema("batch_id long, at timestamp").parquet(f"{root.rstrip('/')}/commits").select("batch_id").distinct()


def by_month(rows: DataFrame, ts: str = TS, sort: tuple[str, ...] = (TS, "id")) -> DataFrame:
    """``rows`` with ``ym``, arranged for a small append: files of a month follow its bytes, not the number of
    shuffle partitions (Spark's rebalance hint), and no sampling pass ranges over the batch. Ranges over files are made when the month is closed (``compaction.py``)."""
    return rows.withColumn("ym", yyyymm(F.col(ts))).hint("rebalance", "ym").sortWithinPartitions("ym", *sort)


def commit_sink(root: str, tables: dict):
    """foreachBatch callable: ``tables`` maps a table's name to a function of a batch that gives its rows, with the month ``ym``.

    The batch is read once. A sink that fails raises, so the batch is tried again and nothing of it is shown meanwhile.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in tables.items():
                rows(batch).write.mode("overwrite").partitionBy("ym").parquet(f"{root.rstrip('/')}/{name}/batch_id={int(batch_id)}")
            mark = batch.sparkSession.range(1).select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.current_timestamp().alias("at"))
            mark.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/commits")
        finally:
            batch.unpersist()

    return run


def read_committed(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches of a table with these columns, and ``batch_id`` and ``ym``.

    Rows of other batches (at most the one that is being written, or tried again) do not get through the join with the list of
    batches, which is one row a batch. A table of which no batch had a row is empty, not missing.
    """
    path = f"{root.rstrip('/')}/{table}"
    full = StructType([f for f in schema.fields if f.name not in ("batch_id", "ym")]).add("batch_id", LongType()).add("ym", IntegerType())
    return spark.read.schema(full).option("basePath", path).parquet(path).join(committed_batches(spark, root), "batch_id", "left_semi")
