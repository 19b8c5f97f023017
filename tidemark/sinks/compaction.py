"""Months of a committed table merged into sorted files.

A stream appends small files: one or more for each batch and month. ``compact`` rewrites the committed rows of one month,
ranged over (time, id), as files of about ``file_mb`` each, under a version of their own, and then adds one row to ``<root>/merges``:
table, month, version, the last batch it covers and where it is. That row is the swap: readers take the newest
version of every month and, from the batches, what no version covers. Rows that come late for a merged month
are in later batches, so they are seen at once; a further merge takes them in. A merge that fails leaves files that no row names.

The manifest has one row a merge, of which the newest of each month comes to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sinks.commits import TS, read_committed

MERGES = "table string, ym int, version long, upto long, path string, files long"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/merges"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], MERGES)
    return spark.read.schema(MERGES).parquet(path)


def merges(spark: SparkSession, root: str, table: str) -> dict[int, dict]:
    """The newest merge of every month of a table."""
    rows = _manifest(spark, root).where(F.col("table") == table)
    newest = rows.groupBy("ym").agg(F.max_by(F.struct("version", "upto", "path", "files"), "version").alias("m")).select("ym", "m.*")
    return {r["ym"]: r.asDict() for r in newest.collect()}


def read_merged(spark: SparkSession, root: str, table: str, schema: StructType, months: tuple[int, ...] | None = None) -> DataFrame:
    """All committed rows of a table, once: merged months from their sorted files, the rest from the batches.

    Months that are not asked for are not even opened; inside a month, a bound on the time prunes files and row groups.
    """
    found = {ym: m for ym, m in merges(spark, root, table).items() if months is None or ym in months}
    rows = read_committed(spark, root, table, schema)
    if months is not None:
        rows = rows.where(F.col("ym").isin(*months))
    covered = F.lit(False)
    for ym, m in found.items():
        covered = covered | ((F.col("ym") == ym) & (F.col("batch_id") <= m["upto"]))
    out = rows.where(~covered)
    full = rows.schema
    for ym, m in found.items():
        plain = StructType([f for f in full.fields if f.name != "ym"])
        out = out.unionByName(spark.read.schema(plain).parquet(m["path"]).withColumn("ym", F.lit(ym)))
    return out


def compact(spark: SparkSession, root: str, table: str, schema: StructType, ym: int, file_mb: int = 128, sort: tuple[str, ...] = (TS, "id"), fail: Exception | None = None) -> dict:
    """Merge one month; a month that has not grown since its last merge is left as it is. Returns its merge. ``fail`` is raised before the swap (for tests)."""
    before = merges(spark, root, table).get(ym)
    rows = read_merged(spark, root, table, schema, (ym,))
    stats = rows.agg(F.max("batch_id").alias("upto"), F.count(F.lit(1)).alias("n")).first()
    if not stats["n"] or before and before["upto"] >= stats["upto"]:
        return before or {}
    size = _stored_bytes(spark, root, table, ym) + (_bytes(spark, before["path"]) if before else 0)
    files = max(1, -(-size // (file_mb << 20)))
    version = (before["version"] if before else 0) + 1
    path = f"{root.rstrip('/')}/merged/{table}/ym={ym}/{version}-{uuid.uuid4().hex[:8]}"
    order = [F.col(c) for c in sort]
    rows.drop("ym").repartitionByRange(int(files), *order).sortWithinPartitions(*order).write.parquet(path)
    if fail is not None:
        raise fail
    row = (table, ym, version, stats["upto"], path, int(files))
    spark.createDataFrame([row], MERGES).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/merges")
    return dict(zip(("ym", "version", "upto", "path", "files"), row[1:], strict=True))


def _bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def _stored_bytes(spark: SparkSession, root: str, table: str, ym: int) -> int:
    """Bytes of a month over all batches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}/batch_id=*/ym={ym}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(int(fs.getContentSummary(s.getPath()).getLength()) for s in fs.globStatus(p))
