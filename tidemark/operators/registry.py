"""A model registry as tables (B9, B10, C9, F10): stored candidates are listed, loaded, scored, ranked and promoted.

``<root>/candidates/<dataset>/<run>/<model>``   artifacts, written before they are named anywhere
``<root>/entries``                              a row for each artifact and event: registered, retired
``<root>/finals``                               a row for each promotion, with a version; the pointer is the greatest one
``<root>/final/<dataset>/<version>``            the promoted artifacts, never overwritten

Both tables only grow, by one file at a time, which appears as a whole. So the final model of a dataset changes
in one step: its artifact is written first, under a version of its own, and readers go on seeing the
version before until the row that names the new one is there. A write that fails leaves an artifact that no row names, and the
next promotion takes another version. Losers are deleted after that, and only what a row says is a candidate of the same run.

Rows are few (one for each artifact), so they may come to the driver; records and scores never do.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.forest import BoostedTrees, GrownForest
from tidemark.operators.ml import leaderboard, metrics_of
from tidemark.operators.scoring import SCORE, raw_score
from tidemark.spec import UseCase

ENTRIES = "dataset string, run string, model string, event string, kind string, path string, at timestamp"
FINALS = "dataset string, version long, run string, model string, kind string, path string, rmse double, at timestamp"
METRICS = "model string, mae double, rmse double, r2 double, class_accuracy double, error string"


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    root: str

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{name}"
        if not self._fs(path).exists(self._path(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        fields = [f for f in T.StructType.fromDDL(schema).fields if f.name != "at"]
        df = self.spark.createDataFrame(rows, T.StructType(fields)).withColumn("at", F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/{name}")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # ---------------------------------------------------------- candidates

    def register(self, dataset: str, run: str, model: str, fitted) -> str:
        """Store a fitted model as a candidate of ``run`` and name it, with the class that loads it."""
        path = f"{self.root.rstrip('/')}/candidates/{dataset}/{run}/{model}-{uuid.uuid4().hex[:8]}"
        fitted.write().save(path)
        self._append("entries", [(dataset, run, model, "registered", _kind(fitted), path)], ENTRIES)
        return path

    def candidates(self, dataset: str, run: str | None = None) -> DataFrame:
        """(dataset, run, model, kind, path) of the stored artifacts that have not been retired."""
        rows = self._table("entries", ENTRIES).where(F.col("dataset") == dataset)
        if run is not None:
            rows = rows.where(F.col("run") == run)
        kept = rows.groupBy("dataset", "run", "model", "path").agg(F.max("kind").alias("kind"), F.bool_or(F.col("event") == "retired").alias("gone"))
        return kept.where("not gone").drop("gone")

    def evaluate(self, test: DataFrame, u: UseCase, run: str | None = None) -> DataFrame:
        """every stored candidate of the dataset loaded and scored on ``test``, in one pass for all that load: the leaderboard, with the error of each that does not."""
        found = self.candidates(u.name, run).orderBy("model", "path").collect()  # a row for each artifact
        scored, failed, names = test, [], []
        for r in found:
            try:
                scored = raw_score(scored, u, load(r["kind"], r["path"]), out=f"{SCORE}{len(names)}")
                names.append(r["model"])
            except Exception as e:  # reported with the others
                failed.append((r["model"], None, None, None, None, str(e)[:500]))
        board = self.spark.createDataFrame(failed, METRICS)
        if names:
            ok = metrics_of(scored, u.target, {n: F.col(f"{SCORE}{i}") for i, n in enumerate(names)}, u)
            board = ok.withColumn("error", F.lit(None).cast("string")).unionByName(board)
        return leaderboard(board.withColumn("dataset", F.lit(u.name)))

    # ----------------------------------------------------------- promotion

    def final(self, dataset: str) -> DataFrame:
        """The row of the dataset's present final model (none before the first promotion)."""
        rows = self._table("finals", FINALS).where(F.col("dataset") == dataset)
        return rows.orderBy(F.col("version").desc(), F.col("at").desc()).limit(1)

    def load_final(self, dataset: str):
        """The present final model."""
        row = self.final(dataset).first()
        if row is None:
            raise LookupError(f"no final model of {dataset}")
        return load(row["kind"], row["path"])

    def promote(self, board: DataFrame, dataset: str, run: str, writer=None) -> int:
        """The first of ``board`` becomes the final model under a new version; the run's other candidates, and its own copy, are deleted.

        ``writer(model, path)`` stores the final artifact (MLlib's own by default). Returns the version.
        """
        best = board.where("rmse is not null").orderBy("rank").select("model", "rmse").first()
        if best is None:
            raise LookupError(f"no candidate of {dataset} could be evaluated")
        mine = {r["model"]: r for r in self.candidates(dataset, run).collect()}
        row, now = mine[best["model"]], self.final(dataset).first()
        version = (now["version"] if now else 0) + 1
        path = f"{self.root.rstrip('/')}/final/{dataset}/{version}-{uuid.uuid4().hex[:8]}"
        model = load(row["kind"], row["path"])
        (writer or (lambda m, p: m.write().save(p)))(model, path)
        self._append("finals", [(dataset, version, run, best["model"], row["kind"], path, best["rmse"])], FINALS)
        self._append("entries", [(dataset, run, r["model"], "retired", r["kind"], r["path"]) for r in mine.values()], ENTRIES)
        for r in mine.values():
            self._fs(r["path"]).delete(self._path(r["path"]), True)
        return version

    def stored(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._path(path)))


def _kind(model) -> str:
    cls = model if isinstance(model, type) else type(model)
    return f"{cls.__module__}.{cls.__name__}"


def load(kind: str, path: str):
    """A stored model, by the class that it was registered with. Only MLlib's own classes and the grown forest are loaded."""
    import importlib

    module, _, name = kind.rpartition(".")
    for own in (GrownForest, BoostedTrees):
        if kind == _kind(own):
            return own.load(path)
    if not module.startswith("pyspark.ml"):
        raise ValueError(f"not a model class: {kind}")
    return getattr(importlib.import_module(module), name).load(path)
