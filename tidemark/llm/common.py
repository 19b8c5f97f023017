"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidemark.session import configure, work_path


def ready(spark: SparkSession) -> None:
    """Settings of the corpus jobs: texts may be long, so Arrow batches have few rows; a worker holds one or two at a time."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read by Spark only (the path may be a remote store)."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder, in files of one value of ``by`` if given, and read it back.

    Cuts lineage and survives a lost executor: the rows are in shared storage,
    not in an executor's memory or disk.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.options(**options).parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def shared(files: str | list[str]):
    """The Arrow data set of one or more files that ``saved`` has written, for tasks that read parts of it themselves."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    some = [files] if isinstance(files, str) else files
    where, _ = fs.FileSystem.from_uri(some[0]) if ":" in some[0] else (fs.LocalFileSystem(), None)
    paths = [fs.FileSystem.from_uri(f)[1] if ":" in f else f for f in some]
    return ds.dataset(paths, filesystem=where, format="parquet")


def files_by(df: DataFrame, by: str) -> dict[int, list[str]]:
    """The files of each value of ``by``, a whole number by which ``df`` was saved."""
    out: dict[int, list[str]] = {}
    for f in df.inputFiles():
        out.setdefault(int(re.search(rf"/{by}=(-?\d+)/", f)[1]), []).append(f)
    return out


def extended(df: DataFrame, names: list[str], **fields: DataType | str) -> StructType:
    """Schema of the named columns of ``df`` and further fields (types as objects or DDL)."""
    more = [StructField(k, DataType.fromDDL(t) if isinstance(t, str) else t) for k, t in fields.items()]
    return StructType([*(StructField(c, df.schema[c].dataType) for c in names), *more])


def held_out(doc_id: Column) -> Column:
    """crc32 of the decimal id, divisible by 5: rows no model learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a, b), as (node, comp).

    Alternating large-star / small-star contraction: each round links every
    node to the smallest neighbour, on both ends, until the edge set is a set of
    stars. All steps are shuffles on a node id; a round's edges are written to the
    shared folder, so nothing of the graph is on the driver.
    """
    cur = saved(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
        f"{name}-edges",
    )
    while True:
        both = cur.select(F.col("b").alias("u"), F.col("a").alias("v")).union(cur.select(F.col("a").alias("u"), F.col("b").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        # small star: a node's smaller neighbours and itself go to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        nxt = large.join(least, "b")
        nxt = nxt.select(F.col("m").alias("a"), F.col("a").alias("b")).union(nxt.select(F.col("m").alias("a"), "b")).where("a < b").distinct()
        nxt = saved(nxt, f"{name}-star")
        # a set of stars: every larger end has one edge, and no centre is a larger end
        ends = nxt.select(F.col("b").alias("n"), F.lit(1).alias("e"), F.lit(0).alias("c")).union(
            nxt.select(F.col("a").alias("n"), F.lit(0), F.lit(1)).distinct()
        )
        open_ = ends.groupBy("n").agg(F.sum("e").alias("e"), F.max("c").alias("c")).where("e > 1 or (e > 0 and c > 0)")
        cur = nxt
        if open_.isEmpty():
            return cur.select(F.col("b").alias("node"), F.col("a").alias("comp"))
