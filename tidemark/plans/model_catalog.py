"""Named queries over stored models: the registry, and ensembles scored from their node tables. The SQL twins fit and score by themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.registry import Registry
from tidemark.operators.trees import score_nodes
from tidemark.session import work_path
from tidemark.sources.fixtures import kpi_view, training_frame
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING

#: Two rounds of training: rows whose id leaves this remainder by 5 are the round's test rows.
ROUNDS = {"first": 0, "second": 1}


def promoted_registry(spark, sf_dir):
    """One candidate for each feature is stored, then evaluated from its artifact, and the best one promoted; twice, with a
    promotion in between whose write fails. Returns every promotion, the candidates left, and whether it is the present one and its artifact there."""
    u = VIDEO_STREAMING
    registry = Registry(spark, work_path(spark, "registry"))
    rows = training_frame(spark, sf_dir, u)
    boards = []

    def broken(model, path):
        raise OSError("the write is lost")

    for run, rest in ROUNDS.items():
        train, test = rows.where(F.col("id") % 5 != rest), rows.where(F.col("id") % 5 == rest)
        for f in u.features:
            line = LinearRegression(featuresCol="x", labelCol=u.target, regParam=0.0, solver="normal")
            registry.register(u.name, run, f, Pipeline(stages=[VectorAssembler(inputCols=[f], outputCol="x"), line]).fit(train))
        board = registry.evaluate(test, u, run)
        board = spark.createDataFrame(board.collect(), board.schema)  # a row for each candidate
        boards.append(board.select(F.lit(run).alias("run"), "model", "rmse", "r2", "class_accuracy", "rank"))
        try:
            registry.promote(board, u.name, run, writer=broken)
        except OSError:
            pass
        registry.promote(board, u.name, run)
    left = registry.candidates(u.name).count()
    now = registry.final(u.name).first()
    finals = registry._table("finals", "dataset string, version long, run string, model string, path string")
    there = {r["path"]: registry.stored(r["path"]) for r in finals.collect()}
    marks = spark.createDataFrame([(p, s, p == now["path"]) for p, s in there.items()], "path string, stored boolean, present boolean")
    out = reduce(DataFrame.unionByName, boards).join(finals.join(marks, "path"), ["run", "model"], "left")
    six = lambda c: F.round(c, 6).alias(c)
    return out.select("run", "model", six("rmse"), six("r2"), six("class_accuracy"), "rank", "version", "stored", "present", F.lit(left).cast("long").alias("candidates_left"))


# Fixed shape of the two ensembles: trees, levels, weight of all trees but the first. They stand in for trained ones, as the fixed linear scorers do.
SHAPES = {"tree_scores_rf": (7, 5, 1.0), "tree_scores_gbt": (9, 3, 0.1)}
# Fixed ranges of the features, from which thresholds are taken.
RANGES = {"CPU_usage": (50, 100), "GPU_usage": (40, 100), "Bandwidth_MBps": (10, 100), "Latency_ms": (20, 200), "FrameRate_fps": (24, 120), "Jitter_ms": (0, 30)}


def ensemble(spark: SparkSession, trees: int, depth: int, weight: float) -> DataFrame:
    """Node table of complete trees: node n has the children 2 n + 1 and 2 n + 2, features, thresholds and values are residues."""
    inner = F.col("node") < 2**depth - 1
    low, high = (F.array(*[F.lit(float(r[i])) for r in RANGES.values()]) for i in (0, 1))
    feature = ((F.col("tree") * 7919 + F.col("node") * 104729) % len(RANGES)).cast("int")
    share = ((F.col("tree") * 31 + F.col("node") * 17) % 97) / F.lit(97.0)
    nodes = spark.range(trees * (2 ** (depth + 1) - 1)).select((F.col("id") % trees).cast("int").alias("tree"), F.floor(F.col("id") / trees).cast("int").alias("node"))
    nodes = nodes.withColumn("weight", F.when(F.col("tree") == 0, 1.0).otherwise(weight)).withColumn("f", feature)
    return nodes.select(
        "tree",
        "weight",
        "node",
        F.when(inner, F.col("f")).alias("feature"),
        F.when(inner, F.get(low, "f") + share * (F.get(high, "f") - F.get(low, "f"))).alias("threshold"),
        F.when(inner, 2 * F.col("node") + 1).alias("left_child"),
        F.when(inner, 2 * F.col("node") + 2).alias("right_child"),
        (((F.col("tree") * 13 + F.col("node") * 29) % 401) / F.lit(100.0) + 1).alias("value"),
    )


def q_tree_scores(name: str):
    """Every record scored by an ensemble's node table, level by level."""

    def run(spark, sf_dir):
        trees, depth, weight = SHAPES[name]
        combine = "mean" if name.endswith("rf") else "sum"
        scored = score_nodes(kpi_view(spark, sf_dir, CLOUD_GAMING, dirty=True), ensemble(spark, trees, depth, weight), CLOUD_GAMING.features, "id", combine)
        return scored.select("id", F.round("score", 6).alias("score"))

    return run


def model_queries() -> dict:
    return {"promoted_registry": promoted_registry, **{n: q_tree_scores(n) for n in SHAPES}}


# ------------------------------------------------------------- SQL twins


def _tree_sql(name: str) -> str:
    from tidemark.plans.oracle import kpi_sql

    trees, depth, weight = SHAPES[name]
    total = "avg(value)" if name.endswith("rf") else "sum(weight * value)"
    feature = "CASE (tree * 7919 + node * 104729) % 6 WHEN 0 THEN CAST(CPU_usage AS DOUBLE) WHEN 1 THEN GPU_usage WHEN 2 THEN Bandwidth_MBps WHEN 3 THEN Latency_ms WHEN 4 THEN FrameRate_fps ELSE Jitter_ms END"
    return f"""
WITH RECURSIVE nodes AS (
  SELECT t AS tree, n AS node, CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE {weight}::DOUBLE END AS weight, (t * 7919 + n * 104729) % 6 AS f,
    ((t * 31 + n * 17) % 97) / 97.0::DOUBLE AS share, ((t * 13 + n * 29) % 401) / 100.0::DOUBLE + 1 AS value
  FROM range({trees}) a(t), range({2 ** (depth + 1) - 1}) b(n)
), spans(f, low, high) AS (VALUES (0, 50.0::DOUBLE, 100.0::DOUBLE), (1, 40.0, 100.0), (2, 10.0, 100.0), (3, 20.0, 200.0), (4, 24.0, 120.0), (5, 0.0, 30.0)
), cuts AS (
  SELECT tree, node, low + share * (high - low) AS threshold FROM nodes JOIN spans USING (f) WHERE node < {2 ** depth - 1}
), kpi AS ({kpi_sql(CLOUD_GAMING, dirty=True)}),
walk AS (
  SELECT id, t AS tree, CAST(0 AS BIGINT) AS node FROM kpi, range({trees}) r(t)
  UNION ALL
  SELECT w.id, w.tree, CASE WHEN x IS NOT NULL AND NOT isnan(x) AND x <= threshold THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END
  FROM (SELECT walk.id, tree, node, {feature} AS x FROM walk JOIN kpi ON walk.id = kpi.id) w JOIN cuts ON cuts.tree = w.tree AND cuts.node = w.node
)
SELECT id, round({total}, 6) AS score FROM walk JOIN nodes USING (tree, node) WHERE node >= {2 ** depth - 1} GROUP BY id"""


def _registry_sql() -> str:
    from tidemark.plans.oracle import classify, training

    u = VIDEO_STREAMING
    parts = []
    for run, rest in ROUNDS.items():
        for f in u.features:
            y, p = u.target, f"(b + a * {f})"
            parts.append(
                f"SELECT '{run}' AS run, '{f}' AS model, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse, 1 - sum(({y} - {p}) * ({y} - {p})) / (count(*) * var_pop({y})) AS r2, "
                f"avg(CASE WHEN ({classify(y, u)}) = ({classify(p, u)}) THEN 1.0 ELSE 0.0 END) AS class_accuracy FROM t, "
                f"(SELECT regr_slope({y}, {f}) AS a, regr_intercept({y}, {f}) AS b FROM t WHERE id % 5 <> {rest}) m WHERE id % 5 = {rest}"
            )
    return f"""
WITH t AS {training(u)}, m AS ({" UNION ALL ".join(parts)}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY run ORDER BY rmse, model) AS INTEGER) AS rank FROM m)
SELECT run, model, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(class_accuracy, 6) AS class_accuracy, rank,
  CASE WHEN rank = 1 THEN CASE run WHEN 'first' THEN CAST(1 AS BIGINT) ELSE 2 END END AS version,
  CASE WHEN rank = 1 THEN TRUE END AS stored, CASE WHEN rank = 1 THEN run = 'second' END AS present, CAST(0 AS BIGINT) AS candidates_left FROM r"""


def model_oracle() -> dict[str, str]:
    return {"promoted_registry": _registry_sql(), **{n: _tree_sql(n) for n in SHAPES}}
