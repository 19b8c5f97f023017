"""Named queries that write and read back: table layout, CSV, defaults, Avro
framing, the streaming pipeline and stateful streams, and model training.

Each writes under the shared folder named by ``spark.checkpoint.dir`` (a fresh
sub-directory per call) and returns the read-back DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import ts_text
from tidemark.operators import ml as ML
from tidemark.operators.dashboard import Pager, read_since
from tidemark.operators.registry import Registry
from tidemark.operators.scoring import fixed_scorer, fold_linear, score
from tidemark.plans import oracle as O
from tidemark.plans.views import SINCE, scored_view, ts_out
from tidemark.session import work_path
from tidemark.sinks.commits import by_month, commit_sink, read_committed
from tidemark.sinks.compaction import compact, read_merged
from tidemark.sinks.tables import raw_columns, to_headerless_csv, with_defaults, write_monthly
from tidemark.sources.fixtures import alert_sql, kpi_sql, kpi_view, training_frame
from tidemark.sources.framing import decode_avro, encode_avro, flatten, frame, schema_id, strip_frame
from tidemark.sources.tables import TOPIC_SCHEMA, kpi_stream, read_predictions, read_training_csv
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase
from tidemark.streaming import stateful as ST
from tidemark.streaming.monitor import batch_table, require_none_late, watched
from tidemark.streaming.pipeline import BATCH_METRICS, build_committed, decode_messages, observe_batch, run_available, stage_topic, table_schemas

SID = 1
AVAILABLE = {"availableNow": True}


# ------------------------------------------------------------ tables, CSV


def month_layout(spark, sf_dir):
    """B6 + A6 + A7: month-partitioned sorted table, read back with the cursor
    predicate (pruned to ``ym >= 202401`` as a partition filter)."""
    u = CLOUD_GAMING
    path = work_path(spark, "month_layout")
    write_monthly(scored_view(spark, sf_dir, u), path)
    back = read_since(read_predictions(spark, path), SINCE)
    return ts_out(back.select("id", *u.features, "predicted_qoe", "qoe_class", "ingestion_timestamp", "ym"))


#: The records of odd ids come in the month after.
LATER_DAYS = 40


def merged_months(spark, sf_dir):
    """Two months written in four batches, the first merged into sorted files, a late batch for it, and all read back once from a cursor on."""
    u = CLOUD_GAMING
    root = work_path(spark, "merged")
    days = F.when(F.col("id") % 2 == 1, F.make_dt_interval(F.lit(LATER_DAYS))).otherwise(F.make_dt_interval(F.lit(0)))
    kpi = kpi_view(spark, sf_dir, u).withColumn("ingestion_timestamp", (F.col("ingestion_timestamp") + days).cast("timestamp")).withColumn("processing_time", F.lit(None).cast("timestamp"))
    schema = kpi.select(*raw_columns(u)).schema
    sink = commit_sink(root, {"raw": lambda b: by_month(b.select(*raw_columns(u)))})
    for n in range(4):
        sink(kpi.where(F.col("id") % 5 == n), n)
    compact(spark, root, "raw", schema, 202401)
    sink(kpi.where(F.col("id") % 5 == 4), 4)  # rows of the merged month that come late
    back = read_since(read_merged(spark, root, "raw", schema), SINCE)
    return ts_out(back.select("id", *u.features, "ingestion_timestamp", "ym"))


def paged_to_the_end(spark, sf_dir):
    """H1: all points since the cursor by pages of a fifth, each written as it comes, with the cursor stored between them."""
    u = VIDEO_STREAMING
    root = work_path(spark, "paged")
    points = scored_view(spark, sf_dir, u)
    n = read_since(points, SINCE).count()
    pager = Pager(points, f"{root}/cursors", u.name, limit=max(1, -(-n // 5)))
    end = points.agg((F.max("ingestion_timestamp") + F.expr("INTERVAL 2 SECONDS")).alias("t")).first()["t"]
    while pager.keep(page := pager.next_page(SINCE, end)):
        page.write.mode("append").parquet(f"{root}/pages")
    return ts_out(spark.read.schema(page.schema).parquet(f"{root}/pages"))


def csv_roundtrip(spark, sf_dir):
    """A5: training data as CSV with header, read back with the declared schema."""
    u = VIDEO_STREAMING
    path = work_path(spark, "training_csv")
    training_frame(spark, sf_dir, u).drop("id").write.option("header", True).csv(path)
    return read_training_csv(spark, path, u)


def headerless_csv(spark, sf_dir):
    """Positional CSV without header; read back by position."""
    u = CLOUD_GAMING
    path = work_path(spark, "headerless_csv")
    cols = ["id", *u.features, "predicted_qoe", "qoe_class"]
    scored = scored_view(spark, sf_dir, u)
    to_headerless_csv(scored, path, cols)
    schema = scored.select(*cols).schema
    return spark.read.schema(schema).option("header", False).csv(path)


def insert_defaults(spark, sf_dir):
    """B5 + J13/J14: records without id and times get uuid() and now()."""
    u = CLOUD_GAMING
    rec = kpi_view(spark, sf_dir, u).drop("id", "ingestion_timestamp")
    full = with_defaults(rec, raw_columns(u))
    return full.select(
        "id", *u.features, ts_text(F.col("processing_time")).alias("processing_time"), ts_text(F.col("ingestion_timestamp")).alias("ingestion_time")
    )


def insert_facts(spark, sf_dir):
    """B5 + J13/J14 as facts: one id for each record, all of the uuid form, one time stamp, and that a recent one."""
    full = with_defaults(kpi_view(spark, sf_dir, CLOUD_GAMING).drop("id", "ingestion_timestamp"), raw_columns(CLOUD_GAMING))
    uuid = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("processing_time")
    return full.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("ids"),
        F.bool_and(F.col("id").rlike(uuid)).alias("all_uuid"),
        F.count_distinct("processing_time", "ingestion_timestamp").alias("times"),
        F.bool_and(age.between(0, 3600) & (F.col("processing_time") == F.date_trunc("second", "processing_time"))).alias("recent"),
    )


def frame_strip(spark, sf_dir):
    """A2 as an expression: frame a body, read its schema id, strip the frame."""
    body = F.col("id").cast("string").cast("binary")
    framed = kpi_view(spark, sf_dir, CLOUD_GAMING).select("id", frame(body, SID).alias("value"))
    return framed.select("id", F.hex(F.substring("value", 1, 5)).alias("header"), schema_id("value").alias("schema_id"), strip_frame("value").cast("string").alias("body"))


# ------------------------------------------------------------------ Avro


def q_avro_roundtrip(u: UseCase):
    """B1 -> A2 -> A3 -> A4 on the dirty records: encode, read the frame's
    schema id, decode, flatten. Records with a null field travel as a null
    value and come back malformed with null fields."""

    def run(spark, sf_dir):
        kpi = kpi_view(spark, sf_dir, u, dirty=True)
        msgs = encode_avro(kpi, u, SID, keep=["id"]).withColumn("schema_id", schema_id("value"))
        dec = flatten(decode_avro(msgs, u, "value", keep=["id", "schema_id"]))
        return dec.select("id", *u.features, "schema_id", F.col("_malformed").alias("malformed"))

    return run


def _any_null(u: UseCase) -> str:
    return "(" + " OR ".join(f"{f} IS NULL" for f in u.features) + ")"


def _avro_oracle(u: UseCase) -> str:
    feats = ", ".join(f"CASE WHEN {_any_null(u)} THEN NULL ELSE {f} END AS {f}" for f in u.features)
    return (
        f"SELECT id, {feats}, CASE WHEN {_any_null(u)} THEN NULL ELSE {SID} END AS schema_id, "
        f"{_any_null(u)} AS malformed FROM ({kpi_sql(u, dirty=True)}) k"
    )


# ------------------------------------------------------------- streaming


def _run_pipeline(spark, sf_dir, u: UseCase, dirty: bool):
    root = work_path(spark, f"pipeline_{u.name}")
    topic, per = stage_topic(kpi_view(spark, sf_dir, u, dirty=dirty), u, f"{root}/topic", files=4, sid=SID)
    msgs = kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per)
    run_available(build_committed(msgs, u, fixed_scorer(u), root, f"{root}/_checkpoint", AVAILABLE))
    return lambda name: read_committed(spark, root, name, table_schemas(u)[name])


def stream_raw(spark, sf_dir):
    """K1-K8 + B2/B7: the raw table written by the stream (all records)."""
    u = CLOUD_GAMING
    raw = _run_pipeline(spark, sf_dir, u, dirty=True)("raw")
    return ts_out(raw.select("id", *u.features, "ingestion_timestamp"))


def stream_predictions(spark, sf_dir):
    """K1-K8 + B3/B7: the predictions table written by the stream."""
    u = VIDEO_STREAMING
    pred = _run_pipeline(spark, sf_dir, u, dirty=True)("predictions")
    return ts_out(pred.select("id", *u.features, "predicted_qoe", "qoe_class", "ingestion_timestamp"))


def stream_rejected(spark, sf_dir):
    """C5 + B7: the table of rejected records, with their reasons and the record as decoded from the bytes that were kept."""
    u = CLOUD_GAMING
    table = _run_pipeline(spark, sf_dir, u, dirty=True)("rejected")
    back = flatten(decode_avro(table, u, "original", keep=["id", "reasons", "ingestion_timestamp"]))
    return ts_out(back.select("id", "reasons", *u.features, "ingestion_timestamp"))


def stream_stamps(spark, sf_dir):
    """The batch's one processing time on all its rows of all tables, and the number of rows in each table that bear it."""
    u = CLOUD_GAMING
    table = _run_pipeline(spark, sf_dir, u, dirty=True)
    times = [table(t).select("batch_id", F.lit(t).alias("table"), F.col(c).alias("stamp")) for t, c in (("raw", "processing_time"), ("predictions", "prediction_timestamp"), ("rejected", "processing_time"))]
    rows = times[0].unionByName(times[1]).unionByName(times[2])
    per = rows.groupBy("batch_id").agg(F.count_distinct("stamp").alias("stamps"), *[F.count_if(F.col("table") == t).alias(t) for t in ("raw", "predictions", "rejected")])
    return per.drop("batch_id")


BATCHES = 120


def stream_batches(spark, sf_dir):
    """The log of 120 micro-batches: rows, malformed and valid ones, and none lost to the watermark."""
    u = CLOUD_GAMING
    root = work_path(spark, "stream_batches")
    kpi = kpi_view(spark, sf_dir, u, dirty=True)
    msgs = encode_avro(kpi, u, SID, keep=["id", "ingestion_timestamp"])
    part = F.pmod(F.col("id"), F.lit(BATCHES)).cast("int").alias("part")
    topic = msgs.select(F.lit(None).cast("binary").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("ingestion_timestamp").cast("timestamp").alias("timestamp"), part)
    topic.repartition(BATCHES, "part").write.partitionBy("part").parquet(f"{root}/topic")  # a file for each batch
    records = observe_batch(decode_messages(kpi_stream(spark, "parquet", f"{root}/topic", maxFilesPerTrigger=1), u), u).withWatermark("ingestion_timestamp", "30 days")
    with watched(spark, f"{root}/batches", ("stream_batches",)):
        run_available(records.groupBy().count().writeStream.queryName("stream_batches").outputMode("complete").option("checkpointLocation", f"{root}/_checkpoint").format("noop").trigger(**AVAILABLE).start())
    log = require_none_late(batch_table(spark, f"{root}/batches", BATCH_METRICS, "rows bigint, malformed bigint, valid bigint"))
    return log.where("input_rows > 0").select("rows", "malformed", "valid", "late_rows")


def _stream_id(u: UseCase, col: str = "id") -> str:
    return f"sha256('{u.name}_kpi:0:' || CAST({col} AS VARCHAR))"


def _rejected_oracle(u: UseCase) -> str:
    feats = ", ".join(f"CASE WHEN {_any_null(u)} THEN NULL ELSE {f} END AS {f}" for f in u.features)
    why = ", ".join(O.reason(u, f) for f in u.features)
    return (
        f"SELECT {_stream_id(u)} AS id, CASE WHEN {_any_null(u)} THEN 'malformed' ELSE concat_ws(';', {why}) END AS reasons, {feats}, "
        f"{O.ts_text('ingestion_timestamp')} AS ingestion_time FROM ({kpi_sql(u, dirty=True)}) k WHERE NOT ({O.valid(u)})"
    )


def _batch_sink(path: str):
    def sink(batch, batch_id):
        batch.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")

    return sink


def stream_class_counts(spark, sf_dir):
    """Running class counts in update mode; the last update per class
    is the cumulative count."""
    u = CLOUD_GAMING
    root = work_path(spark, "stream_counts")
    topic, per = stage_topic(kpi_view(spark, sf_dir, u), u, f"{root}/topic", files=4, sid=SID)
    scored = score(decode_messages(kpi_stream(spark, "parquet", topic, maxFilesPerTrigger=per), u), u, fixed_scorer(u))
    counts = ST.running_class_counts(scored)
    q = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", f"{root}/_checkpoint")
        .foreachBatch(_batch_sink(f"{root}/out"))
        .trigger(**AVAILABLE)
        .start()
    )
    run_available(q)
    return ST.keep_latest(spark.read.parquet(f"{root}/out"), ["qoe_class"])


# ------------------------------------------------------------------ models


def q_train(model_name: str, u: UseCase = CLOUD_GAMING):
    """F1-F9 for one configured model: exact hash split, balanced weights,
    MLlib fit, metrics on the test rows."""

    def run(spark, sf_dir):
        df = training_frame(spark, sf_dir, u)
        train, test = ML.train_test_split(df, seed=u.seed, test_size=u.test_size)
        models = [m for m in ML.DEFAULT_MODELS if m[0] == model_name]
        fitted, _ = ML.fit_all(train, u, models, strict=True)
        return ML.evaluate_all(fitted, test, u)

    return run


def linear_facts(spark, sf_dir):
    """F4, F5 as facts: the fitted linear models meet the optimality conditions of the configured objectives.

    With the weighted residual r and the scaled feature z, the gradient sum(w r z) / sum(w) is 0 for each
    feature of the regression; for the elastic net it is alpha (l1 sign(b) + (1 - l1) b) where the
    coefficient b is not 0, and at most alpha l1 where it is; and the mean residual is 0.
    """
    u = CLOUD_GAMING
    train, _ = ML.train_test_split(training_frame(spark, sf_dir, u), seed=u.seed, test_size=u.test_size)
    models = [m for m in ML.DEFAULT_MODELS if m[0] in ("linreg", "elasticnet")]
    fitted, _ = ML.fit_all(train, u, models)
    rows = ML.balanced_weights(train, u.target, out="w").withColumn("y", F.col(u.target))
    out = []
    for name, mtype, params in models:
        scaler, lin = fitted[name].stages
        z = [(F.col(f).cast("double") - F.lit(float(m))) / F.lit(float(s)) for f, m, s in zip(u.features, scaler.mean, scaler.std)]
        r = F.col("y") - F.lit(float(lin.intercept)) - sum(F.lit(float(b)) * x for b, x in zip(lin.coefficients, z))
        means = [F.sum(F.col("w") * r * x) / F.sum("w") for x in [F.lit(1.0), *z]]
        grad = rows.agg(*[m.alias(f"g{i}") for i, m in enumerate(means)]).first()
        alpha, l1 = (params.get("alpha", 0.0), params.get("l1_ratio", 0.0))
        for i, (f, b) in enumerate(zip(("intercept", *u.features), (0.0, *lin.coefficients))):
            if f == "intercept" or mtype == "LinearRegression":
                ok = abs(grad[i]) < 1e-4
            elif b:
                ok = abs(grad[i] - alpha * (l1 * (1 if b > 0 else -1) + (1 - l1) * b)) < 1e-3
            else:
                ok = abs(grad[i]) <= alpha * l1 + 1e-3
            out.append((u.name, name, f, bool(ok)))
    return spark.createDataFrame(out, "dataset string, model string, feature string, optimal boolean")


def linear_fit(spark, sf_dir):
    """Intercept and coefficients of the weighted, scaled regression on all rows, folded to raw features."""
    u = CLOUD_GAMING
    fitted, _ = ML.fit_all(training_frame(spark, sf_dir, u), u, [m for m in ML.DEFAULT_MODELS if m[0] == "linreg"], strict=True)
    line = fold_linear(fitted["linreg"], u.features)
    return spark.createDataFrame([("intercept", float(line.intercept)), *((f, float(c)) for f, c, _ in line.terms)], "term string, value double").withColumn("value", F.round("value", 6))


def _linear_fit_sql(u: UseCase) -> str:
    """The weighted normal equations, solved by taking out one feature after another and substituting back."""
    x = [f"x{i}" for i in range(len(u.features))]
    cols = ", ".join(f"CAST({f} AS DOUBLE) AS {v}" for f, v in zip(u.features, x, strict=True))
    parts = [
        f"t AS (SELECT {cols}, {u.target} AS y, CAST(round_even({u.target}, 0) AS INTEGER) AS c FROM {O.training(u)} r)",
        "k AS (SELECT c, count(*) AS n FROM t GROUP BY c)",
        "w AS (SELECT t.*, CAST((SELECT sum(n) FROM k) AS DOUBLE) / ((SELECT count(*) FROM k) * n) AS w FROM t JOIN k USING (c))",
        "m AS (SELECT " + ", ".join(f"sum(w * {v}) / sum(w) AS m_{v}" for v in [*x, "y"]) + " FROM w)",
        "s0 AS (SELECT w, " + ", ".join(f"{v} - m_{v} AS {v}" for v in [*x, "y"]) + " FROM w, m)",
    ]
    for i, v in enumerate(x):
        later = [*x[i + 1 :], "y"]
        parts.append(f"r{i} AS (SELECT " + ", ".join(f"sum(w * {v} * {z}) / sum(w * {v} * {v}) AS r_{z}" for z in later) + f" FROM s{i})")
        parts.append(f"s{i + 1} AS (SELECT w, " + ", ".join(f"{z} - r_{z} * {v} AS {z}" for z in later) + f" FROM s{i}, r{i})")
    last = len(x) - 1
    parts.append(f"b{last} AS (SELECT r_y AS b{last} FROM r{last})")
    for i in range(last - 1, -1, -1):
        rest = " - ".join(["r_y", *(f"r_{x[j]} * b{j}" for j in range(i + 1, len(x)))])
        parts.append(f"b{i} AS (SELECT b{i + 1}.*, {rest} AS b{i} FROM r{i}, b{i + 1})")
    rows = ["SELECT 'intercept' AS term, round(m_y - (" + " + ".join(f"b{i} * m_{v}" for i, v in enumerate(x)) + "), 6) AS value FROM b0, m"]
    rows += [f"SELECT '{f}', round(b{i}, 6) FROM b0" for i, f in enumerate(u.features)]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


def best_model_scores(spark, sf_dir):
    """Train all configured models, store them, promote the one of lowest
    RMSE from the stored artifacts, load the promoted one and score the KPI records with it."""
    u = VIDEO_STREAMING
    registry = Registry(spark, work_path(spark, "models"))
    df = training_frame(spark, sf_dir, u)
    train, test = ML.train_test_split(df, seed=u.seed, test_size=u.test_size)
    fitted, _ = ML.fit_all(train, u, strict=True)
    for name, model in fitted.items():
        registry.register(u.name, "all", name, model)
    registry.promote(registry.evaluate(test, u, "all"), u.name, "all")
    scored = score(kpi_view(spark, sf_dir, u), u, registry.load_final(u.name))
    return scored.groupBy("qoe_class").agg(F.count(F.lit(1)).alias("c"))


# --------------------------------------------------------------- registry


def io_queries() -> dict:
    return {
        "month_layout": month_layout,
        "merged_months": merged_months,
        "paged_to_the_end": paged_to_the_end,
        "csv_roundtrip": csv_roundtrip,
        "headerless_csv": headerless_csv,
        "insert_defaults": insert_defaults,
        "insert_facts": insert_facts,
        "frame_strip": frame_strip,
        "avro_roundtrip_cloud": q_avro_roundtrip(CLOUD_GAMING),
        "avro_roundtrip_video": q_avro_roundtrip(VIDEO_STREAMING),
        "stream_raw": stream_raw,
        "stream_predictions": stream_predictions,
        "stream_rejected": stream_rejected,
        "stream_stamps": stream_stamps,
        "stream_batches": stream_batches,
        "stream_class_counts": stream_class_counts,
        "train_linreg": q_train("linreg"),
        "linear_facts": linear_facts,
        "linear_fit": linear_fit,
        "train_elasticnet": q_train("elasticnet"),
        "train_rf": q_train("random_forest"),
        "train_gbt": q_train("gradient_boosting"),
        "best_model_scores": best_model_scores,
    }


def io_oracle() -> dict[str, str]:
    cg, vs = CLOUD_GAMING, VIDEO_STREAMING
    feats_c = ", ".join(cg.features)
    feats_v = ", ".join(vs.features)
    ym = "CAST(year(ingestion_timestamp) * 100 + month(ingestion_timestamp) AS INTEGER)"
    raw_feats = ", ".join(f"CASE WHEN {_any_null(cg)} THEN NULL ELSE {f} END AS {f}" for f in cg.features)
    return {
        "month_layout": (
            f"SELECT id, {feats_c}, predicted_qoe, qoe_class, {O.ts_text('ingestion_timestamp')} AS ingestion_time, {ym} AS ym "
            f"FROM {O.scored(cg)} p WHERE ingestion_timestamp > TIMESTAMP '{SINCE}'"
        ),
        "paged_to_the_end": (
            f"SELECT id, {O.ts_text('ingestion_timestamp')} AS ingestion_time, predicted_qoe, CAST(floor((row_number() OVER (ORDER BY ingestion_timestamp, id) - 1) / ceil(count(*) OVER () / 5)) AS INTEGER) + 1 AS page "
            f"FROM {O.scored(vs)} p WHERE ingestion_timestamp > TIMESTAMP '{SINCE}'"
        ),
        "merged_months": (
            f"SELECT id, {feats_c}, {O.ts_text('t')} AS ingestion_time, CAST(strftime(t, '%Y%m') AS INTEGER) AS ym FROM "
            f"(SELECT *, ingestion_timestamp + to_days(CAST(CASE WHEN id % 2 = 1 THEN 40 ELSE 0 END AS INTEGER)) AS t FROM ({kpi_sql(cg)}) k) x WHERE t > TIMESTAMP '{SINCE}'"
        ),
        "csv_roundtrip": f"SELECT {feats_v}, {vs.target} FROM {O.training(vs)} t",
        "headerless_csv": f"SELECT id, {feats_c}, predicted_qoe, qoe_class FROM {O.scored(cg)} p",
        "insert_facts": "SELECT count(*) AS n, count(*) AS ids, TRUE AS all_uuid, CAST(1 AS BIGINT) AS times, TRUE AS recent FROM events",
        "frame_strip": "SELECT event_id AS id, '0000000001' AS header, 1 AS schema_id, CAST(event_id AS VARCHAR) AS body FROM events",
        "linear_facts": " UNION ALL ".join(
            f"SELECT '{cg.name}' AS dataset, '{m}' AS model, '{f}' AS feature, TRUE AS optimal" for m in ("linreg", "elasticnet") for f in ("intercept", *cg.features)
        ),
        "linear_fit": _linear_fit_sql(cg),
        "avro_roundtrip_cloud": _avro_oracle(cg),
        "avro_roundtrip_video": _avro_oracle(vs),
        "stream_raw": (
            f"SELECT {_stream_id(cg)} AS id, {raw_feats}, {O.ts_text('ingestion_timestamp')} AS ingestion_time "
            f"FROM ({kpi_sql(cg, dirty=True)}) k"
        ),
        "stream_predictions": (
            f"SELECT {_stream_id(vs)} AS id, {feats_v}, predicted_qoe, qoe_class, {O.ts_text('ingestion_timestamp')} AS ingestion_time "
            f"FROM {O.scored(vs, dirty=True)} p"
        ),
        "stream_rejected": _rejected_oracle(cg),
        "stream_stamps": (
            f"SELECT CAST(1 AS BIGINT) AS stamps, count(*) AS raw, CAST(count(*) FILTER (WHERE {O.valid(cg)}) AS BIGINT) AS predictions, "
            f"CAST(count(*) FILTER (WHERE NOT ({O.valid(cg)})) AS BIGINT) AS rejected FROM "
            f"(SELECT *, (id - min(id) OVER ()) // ((max(id) OVER () - min(id) OVER ()) // 4 + 1) AS batch FROM ({kpi_sql(cg, dirty=True)}) k) x GROUP BY batch"
        ),
        "stream_batches": (
            f"SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE {_any_null(cg)}) AS BIGINT) AS malformed, "
            f"CAST(count(*) FILTER (WHERE {O.valid(cg)}) AS BIGINT) AS valid, CAST(0 AS BIGINT) AS late_rows FROM ({kpi_sql(cg, dirty=True)}) k GROUP BY id % 120"
        ),
        "stream_class_counts": f"SELECT qoe_class, count(*) AS c FROM {O.scored(cg)} p GROUP BY qoe_class",
    }


__all__ = ["io_queries", "io_oracle", "alert_sql", "TOPIC_SCHEMA"]
