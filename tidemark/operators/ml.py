"""Training and evaluation as Spark jobs (C3, E5-E10, F1-F10); stored models are in ``registry.py``.

Everything runs on executors: the split is a hash order refined by small
histograms, class weights and scaling statistics are tiny aggregates, models are
MLlib estimators, metrics are one aggregate over the scored test set.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import classify, round_class
from tidemark.session import work_path
from tidemark.spec import UseCase

# ---------------------------------------------------------------- features


def assemble(df: DataFrame, u: UseCase, out: str = "features") -> DataFrame:
    """Feature columns (as double) into one MLlib vector column."""
    from pyspark.ml.feature import VectorAssembler

    cast = df.select(*[F.col(c).cast("double").alias(c) if c in u.features else F.col(c) for c in df.columns])
    return VectorAssembler(inputCols=list(u.features), outputCol=out, handleInvalid="error").transform(cast)


# ------------------------------------------------------------------- split


def hash_key(id_col: str = "id", seed: int = 42) -> Column:
    """Default split key: 63-bit non-negative xxhash64 of the row id."""
    return F.xxhash64(F.col(id_col), F.lit(seed)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def portable_key(id_col: str = "id", prime: int = 1000003, mult: int = 7919) -> Column:
    """Split key any SQL engine can compute (used by the oracle twin)."""
    return ((F.col(id_col) % F.lit(prime)) * F.lit(mult)) % F.lit(prime)


def train_test_split(
    df: DataFrame,
    id_col: str = "id",
    test_size: float = 0.2,
    seed: int = 42,
    key: Column | None = None,
    mode: str = "exact",
    buckets: int = 1024,
    rank_rows: int = 2_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Shuffled split, stable under repartitioning (depends only on the key).

    ``exact``: the test set is exactly the ``ceil(test_size * n)`` rows with the
    smallest (key, id). Found with histograms over key ranges (each a small
    aggregate of at most ``buckets`` rows), refined until the boundary range
    holds at most ``rank_rows`` rows; only that range is ranked.
    ``threshold``: key below a fixed cut (one pass, size ~ test_size * n).
    """
    # total: a row without a key has a place in the order too
    k = F.coalesce(key, F.lit(-1)) if key is not None else hash_key(id_col, seed)
    keyed = df.withColumn("_split_key", k)
    if mode == "threshold":
        cut = int(test_size * (2**63 - 1)) if key is None else None
        if cut is None:
            raise ValueError("threshold mode needs the default hash key")
        is_test = F.col("_split_key") < F.lit(cut)
        return (keyed.filter(~is_test).drop("_split_key"), keyed.filter(is_test).drop("_split_key"))

    stats = keyed.agg(F.count(F.lit(1)).alias("n"), F.min("_split_key").alias("lo"), F.max("_split_key").alias("hi")).first()
    n = int(stats["n"])
    target = int(math.ceil(test_size * n))
    if n == 0 or target == 0:
        return keyed.drop("_split_key"), keyed.limit(0).drop("_split_key")
    lo, hi = int(stats["lo"]), int(stats["hi"])
    taken = 0  # rows with key < lo that are already in the test set
    span_rows = n
    while span_rows > rank_rows and hi > lo:
        width = (hi - lo) / float(buckets)
        in_range = keyed.filter((F.col("_split_key") >= lo) & (F.col("_split_key") <= hi))
        b = F.least(F.floor((F.col("_split_key") - F.lit(lo)).cast("double") / F.lit(width)), F.lit(buckets - 1)).cast("int")
        hist = (
            in_range.groupBy(b.alias("b"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("_split_key").alias("lo"), F.max("_split_key").alias("hi"))
            .orderBy("b")
            .collect()
        )
        cum = taken
        for row in hist:
            if cum + row["c"] >= target:
                lo, hi, span_rows = int(row["lo"]), int(row["hi"]), int(row["c"])
                taken = cum
                break
            cum += row["c"]
    # rows below the boundary range are test, above are train; rank inside it
    need = target - taken
    below = F.col("_split_key") < F.lit(lo)
    above = F.col("_split_key") > F.lit(hi)
    inside = keyed.filter(~below & ~above)
    ranked = _global_rank(inside, ["_split_key", id_col], span_rows)
    boundary_test = ranked.filter(F.col("_r") <= need).drop("_r")
    boundary_train = ranked.filter(F.col("_r") > need).drop("_r")
    test = keyed.filter(below).unionByName(boundary_test).drop("_split_key")
    train = keyed.filter(above).unionByName(boundary_train).drop("_split_key")
    return train, test


def _global_rank(df: DataFrame, order: list[str], rows: int, rows_per_task: int = 1_000_000) -> DataFrame:
    """1-based rank of every row by ``order`` without gathering rows in one
    task: range-partition on ``order``, number rows inside each partition,
    then add the row count of all earlier partitions (one small aggregate of
    at most ``parts`` rows, applied as a literal map)."""
    from pyspark.sql import Window

    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task)))
    from tidemark.session import work_path

    cols = [F.col(c) for c in order]
    # written: the range bounds are sampled once, so counts and ranks agree, whatever executor is lost
    path = work_path(df.sparkSession, "ranked")
    parted = df.repartitionByRange(parts, *cols).withColumn("_p", F.spark_partition_id())
    parted.write.parquet(path)
    parted = df.sparkSession.read.schema(parted.schema).parquet(path)
    sizes = sorted((r["_p"], r["n"]) for r in parted.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for p, n in sizes:
        offsets += [F.lit(p), F.lit(acc)]
        acc += n
    base = F.element_at(F.create_map(*offsets), F.col("_p")) if offsets else F.lit(0)
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*cols))
    return parted.withColumn("_r", (local + base).cast("bigint")).drop("_p")


# ----------------------------------------------------------- weights, scale


def balanced_weights(df: DataFrame, y: str, out: str = "w", max_broadcast_classes: int = 10_000) -> DataFrame:
    """w(c) = n / (k * n_c), c = round-half-even(y) as int.

    The per-class table has one row per class. It is broadcast only after its
    row count is checked; otherwise it is a regular shuffle join.
    """
    cls = round_class(F.col(y))
    counts = df.groupBy(cls.alias("_cls")).agg(F.count(F.lit(1)).alias("_nc"))
    few = counts.limit(max_broadcast_classes + 1).collect()  # one row per class
    if len(few) <= max_broadcast_classes:
        k, n = len(few), sum(r["_nc"] for r in few)
        rows = [(r["_cls"], n / (k * r["_nc"])) for r in few]
        weights = F.broadcast(df.sparkSession.createDataFrame(rows, f"_cls int, `{out}` double"))
    else:
        total = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("_nc").alias("n")).first()
        weights = counts.select("_cls", (F.lit(float(total["n"])) / (F.lit(total["k"]) * F.col("_nc"))).alias(out))
    return df.withColumn("_cls", cls).join(weights, "_cls", "left").drop("_cls")


def feature_stats(df: DataFrame, cols) -> dict:
    """Population mean and std of each column: one aggregate, one small row."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, cols, stats: dict | None = None) -> DataFrame:
    """(x - mean) / std_pop per feature; the statistics are literals in
    the plan (a constant-size result), so no join or window is needed.
    A zero std maps the feature to 0.
    """
    stats = stats or feature_stats(df, cols)
    out = df
    for c in cols:
        m, s = stats[c]
        out = out.withColumn(c, F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s))
    return out


# ------------------------------------------------------------------ models

MODEL_TYPES = ("LinearRegression", "ElasticNet", "RandomForestRegressor", "GradientBoostingRegressor")

# The configured models of each use case (name, type, params).
DEFAULT_MODELS = (
    ("linreg", "LinearRegression", {}),
    ("elasticnet", "ElasticNet", {"alpha": 0.1, "l1_ratio": 0.5}),
    (
        "random_forest",
        "RandomForestRegressor",
        {"n_estimators": 300, "max_depth": 15, "min_samples_leaf": 5, "random_state": 42, "n_jobs": -1},
    ),
    (
        "gradient_boosting",
        "GradientBoostingRegressor",
        {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4, "random_state": 42},
    ),
)

_PARAM_MAP = {
    "ElasticNet": {"alpha": "regParam", "l1_ratio": "elasticNetParam", "max_iter": "maxIter", "tol": "tol"},
    "LinearRegression": {"fit_intercept": "fitIntercept"},
    "RandomForestRegressor": {
        "n_estimators": "numTrees",
        "max_depth": "maxDepth",
        "min_samples_leaf": "minInstancesPerNode",
        "random_state": "seed",
        "n_jobs": None,
    },
    "GradientBoostingRegressor": {
        "n_estimators": "maxIter",
        "learning_rate": "stepSize",
        "max_depth": "maxDepth",
        "random_state": "seed",
        "subsample": "subsamplingRate",
    },
}

# model types trained with the balanced sample weights
WEIGHTED = {"LinearRegression", "ElasticNet", "RandomForestRegressor"}


def _memory_mb(text: str | None, default: float) -> float:
    if not text:
        return default
    m = text.strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    num = "".join(ch for ch in m if ch.isdigit() or ch == ".")
    unit = next((units[ch] for ch in m if ch in units), 1 / (1024 * 1024))
    return float(num) * unit if num else default


def node_stats_budget_mb(spark: SparkSession | None = None) -> int:
    """Memory for the tree-node histograms each training task builds per data
    pass (MLlib ``maxMemoryInMB``, allocated by every concurrent task): a quarter
    of one executor's heap split over its task slots, bounded to [64, 2048]
    MB; as much again is in flight while the histograms of a pass are merged. Executor heap = ``spark.executor.memory`` (Spark's 1g default when
    unset); in local mode the driver JVM's heap, which is the executor. More
    memory = more nodes split per pass = fewer passes."""
    if spark is None:
        return 256
    sc = spark.sparkContext
    if (sc.master or "").startswith("local"):
        heap = sc._jvm.java.lang.Runtime.getRuntime().maxMemory() / (1024 * 1024)
        slots = sc.defaultParallelism
    else:
        heap = _memory_mb(spark.conf.get("spark.executor.memory", None), 1024.0)
        slots = int(spark.conf.get("spark.executor.cores", "1")) // max(1, int(spark.conf.get("spark.task.cpus", "1")))
    return int(min(2048, max(64, heap / 4 / max(1, slots))))


def make_model(model_type: str, params: dict | None = None, features_col: str = "features", label: str = "label", weight: str | None = "w", spark: SparkSession | None = None, label_std: float = 1.0):
    """estimator for a model type; unknown type or parameter -> ValueError.

    Linear models get a scaler stage (MLlib's, by the sample standard deviation); trees see
    raw features. ``label_std`` is the (weighted) standard deviation of the label: MLlib
    divides the L2 part of an elastic net by it, which the parameters here undo, so that
    the fit minimises ``alpha * (l1_ratio * |b| + (1 - l1_ratio) / 2 * |b|^2)`` as configured.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    if model_type not in MODEL_TYPES:
        raise ValueError(f"Unknown model type: {model_type}")
    params = dict(params or {})
    kw = {}
    mapping = _PARAM_MAP[model_type]
    for p, v in params.items():
        if p not in mapping:
            raise ValueError(f"parameter {p!r} has no mapping for {model_type}")
        if mapping[p] is not None:
            kw[mapping[p]] = v
    use_w = weight if model_type in WEIGHTED else None
    if model_type in ("LinearRegression", "ElasticNet"):
        if model_type == "LinearRegression":
            kw.setdefault("regParam", 0.0)
            kw.setdefault("solver", "normal")
        if model_type == "ElasticNet":
            a, r = float(kw.get("regParam", 1.0)), float(kw.get("elasticNetParam", 0.5))
            kw["regParam"] = a * r + a * (1 - r) * label_std
            kw["elasticNetParam"] = a * r / kw["regParam"] if kw["regParam"] else 0.0
        lin = LinearRegression(featuresCol="_scaled", labelCol=label, standardization=False, **kw)
        if use_w:
            lin.setWeightCol(use_w)
        scaler = StandardScaler(inputCol=features_col, outputCol="_scaled", withMean=True, withStd=True)
        return Pipeline(stages=[scaler, lin])
    if model_type == "RandomForestRegressor":
        kw.setdefault("featureSubsetStrategy", "all")
        kw.setdefault("maxBins", 128)
        kw.setdefault("maxMemoryInMB", node_stats_budget_mb(spark))  # deep forests: as many nodes a pass as memory allows
        est = RandomForestRegressor(featuresCol=features_col, labelCol=label, **kw)
        if use_w:
            est.setWeightCol(use_w)
        return est
    kw.setdefault("maxBins", 128)
    return GBTRegressor(featuresCol=features_col, labelCol=label, **kw)


def prepare_training(df: DataFrame, u: UseCase) -> DataFrame:
    """Features vector, label and balanced weights of a training frame."""
    weighted = balanced_weights(df, u.target, out="w")
    return assemble(weighted, u).withColumn("label", F.col(u.target).cast("double"))


def training_parts(rows: int, least: int = 1_000, most: int = 1_000_000, some: int = 64) -> int:
    """Partitions for a fit: of ``least`` rows up to ``some`` of them, then of at most ``most`` rows.

    MLlib bags and samples per partition, so a model depends on the partitioning;
    this one depends on the number of rows alone, not on the cluster."""
    return int(max(1, min(some, -(-rows // least)), -(-rows // most)))


def tree_parts(rows: int) -> int:
    """Partitions for an ensemble of trees: 8, until they have a million rows each.

    Every partition builds the histograms of all nodes of a pass, which are then merged: for deep trees that, not the rows, is
    the work, and it grows with the partitions."""
    return training_parts(rows, some=8)


def training_rows(train: DataFrame, u: UseCase, id_col: str = "id", parts=training_parts) -> DataFrame:
    """Features, label and weight, dealt by a hash of the row and sorted inside partitions: the same
    rows give the same partitions on any cluster."""
    keys = [c for c in (id_col, *u.features, u.target) if c in train.columns]
    rows = prepare_training(train, u).withColumn("_k", F.xxhash64(*keys))
    return rows.repartition(parts(train.count()), "_k").sortWithinPartitions("_k", *keys).select("features", "label", "w")


def fit_all(train: DataFrame, u: UseCase, models=DEFAULT_MODELS, parallel: int = 4, strict: bool = False):
    """fit each configured model; a failure is reported, not raised, unless no model fits or ``strict`` is set.

    The training frame (features, label, weight) is cached once and the models are
    fitted on it side by side. A forest of more leaves than MLlib's is good for is grown by ``forest.py``, boosting on
    many rows is done by ``boosting.py``.

    Returns ({name: fitted model}, report DataFrame(dataset, model, status, error)).
    """
    from multiprocessing.pool import ThreadPool

    from tidemark.operators import boosting, forest

    spark = train.sparkSession
    owned = not train.is_cached  # a frame that the caller has cached stays so
    train = train.cache()
    data = training_rows(train, u).cache()
    grown = training_rows(train, u, parts=tree_parts).cache()  # materialised only if a model of trees is fitted
    try:
        mean, count = data.agg((F.sum(F.col("w") * F.col("label")) / F.sum("w")).alias("m"), F.count(F.lit(1)).alias("n")).first()
        std = data.agg(F.sqrt(F.sum(F.col("w") * (F.col("label") - F.lit(mean)) ** 2) / F.sum("w")).alias("s")).first()["s"] if mean is not None else None

        def fit(model):
            name, mtype, params = model
            try:
                est = make_model(mtype, params, spark=spark, label_std=std or 1.0)
                if mtype == "RandomForestRegressor" and forest.many_leaves(est, count):
                    return name, forest.fit(data, est, work_path(spark, "forest")), None
                if mtype == "GradientBoostingRegressor" and boosting.many_rows(est, count, spark):
                    return name, boosting.fit(data, est, work_path(spark, "boosting"), count), None
                return name, est.fit(data if mtype in ("LinearRegression", "ElasticNet") else grown), None
            except Exception as e:  # reported per model
                return name, None, str(e)

        with ThreadPool(max(1, min(parallel, len(models)))) as pool:
            done = pool.map(fit, models, chunksize=1)
    finally:
        data.unpersist()
        grown.unpersist()
        if owned:
            train.unpersist()
    fitted = {name: m for name, m, _ in done if m is not None}
    if models and (not fitted or strict and len(fitted) < len(done)):
        raise RuntimeError("models that could not be fitted: " + "; ".join(f"{name}: {e}" for name, m, e in done if m is None))
    report = [(u.name, name, "ok" if m is not None else "failed", e) for name, m, e in done]
    return fitted, spark.createDataFrame(report, "dataset string, model string, status string, error string")


# ----------------------------------------------------------------- metrics


def metrics(df: DataFrame, y: str, p: str, u: UseCase) -> DataFrame:
    """E5-E8 in one aggregate: MAE, RMSE, R^2 (= 1 - SSE/SST), class accuracy."""
    err = F.col(y) - F.col(p)
    same = (classify(F.col(y), u) == classify(F.col(p), u)).cast("double")
    agg = df.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        (F.count(F.lit(1)) * F.var_pop(F.col(y))).alias("_sst"),
        F.avg(same).alias("class_accuracy"),
    )
    return agg.select("mae", "rmse", (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"), "class_accuracy")


def metrics_of(df: DataFrame, y: str, predictions: dict[str, Column], u: UseCase) -> DataFrame:
    """``metrics`` of several prediction columns in one aggregate: one row (model, mae, ...) for each."""
    aggs = []
    for i, p in enumerate(predictions.values()):
        err = F.col(y) - p
        same = (classify(F.col(y), u) == classify(p, u)).cast("double")
        aggs += [F.avg(F.abs(err)).alias(f"a{i}"), F.avg(err * err).alias(f"q{i}"), F.sum(err * err).alias(f"s{i}"), F.avg(same).alias(f"c{i}")]
    one = df.agg((F.count(F.lit(1)) * F.var_pop(F.col(y))).alias("t"), *aggs)
    rows = [
        F.struct(F.lit(name).alias("model"), F.col(f"a{i}").alias("mae"), F.sqrt(f"q{i}").alias("rmse"), (F.lit(1.0) - F.col(f"s{i}") / F.col("t")).alias("r2"), F.col(f"c{i}").alias("class_accuracy"))
        for i, name in enumerate(predictions)
    ]
    return one.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def evaluate(model, test: DataFrame, u: UseCase, name: str) -> DataFrame:
    """metrics of one model on the test rows."""
    from tidemark.operators.scoring import raw_score

    scored = raw_score(test, u, model, out="_p")
    return metrics(scored, u.target, "_p", u).select(F.lit(u.name).alias("dataset"), F.lit(name).alias("model"), "*")


def leaderboard(results: DataFrame) -> DataFrame:
    """Order by RMSE (name breaks ties); rank 1 is the winner.

    The metric table has one row per model, so a global window is bounded.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("dataset").orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))
    return results.withColumn("rank", F.row_number().over(w)).withColumn("promoted", F.col("rank") == 1)


def evaluate_all(fitted: dict, test: DataFrame, u: UseCase) -> DataFrame:
    owned = not test.is_cached
    test = test.cache()
    try:
        rows = []
        for name, model in fitted.items():
            try:
                rows.append(evaluate(model, test, u, name).first())
            except Exception as e:  # skipped (and reported), like the reference
                import sys

                print(f"evaluation of {u.name}/{name} failed: {e}", file=sys.stderr)
    finally:
        if owned:
            test.unpersist()
    spark = test.sparkSession
    schema = "dataset string, model string, mae double, rmse double, r2 double, class_accuracy double"
    return leaderboard(spark.createDataFrame([tuple(r) for r in rows], schema))
