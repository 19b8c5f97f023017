"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
driver's tables (or data Spark derives from them). ``oracle.py`` holds the
DuckDB twin of every SQL-expressible one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    class_color,
    clamp,
    iso_utc,
    round_class,
    severity_band,
    ts_text,
)
from tidemark.operators import alerts as AL
from tidemark.operators import dashboard as DB
from tidemark.operators import ml as ML
from tidemark.functions import scalars as SC
from tidemark.operators.quality import cast_double, features_target, project_kpi, quarantine, skip_empty, validate
from tidemark.plans.views import PAGE_SINCE_ID, SINCE, scored_view, ts_out
from tidemark.sources.fixtures import alert_series, kpi_view, training_frame
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 6


# ------------------------------------------------------------ C: records


def q_project(u: UseCase) -> Query:
    def run(spark, sf_dir):
        kpi = kpi_view(spark, sf_dir, u)
        doubles = [f for f in u.features if u.spark_type(f).typeName() == "double"]
        out = project_kpi(cast_double(kpi, doubles), u, "id", "ingestion_timestamp")
        return ts_out(out.select("id", *u.features, "ingestion_timestamp"))

    return run


def q_accept(u: UseCase) -> Query:
    def run(spark, sf_dir):
        ok = validate(kpi_view(spark, sf_dir, u, dirty=True), u)
        return ts_out(ok)

    return run


def q_quarantine(u: UseCase) -> Query:
    def run(spark, sf_dir):
        _, rejected = quarantine(kpi_view(spark, sf_dir, u, dirty=True), u)
        return rejected.select("id", "reasons")

    return run


def q_score(u: UseCase) -> Query:
    def run(spark, sf_dir):
        return ts_out(scored_view(spark, sf_dir, u))

    return run


def q_class_counts(u: UseCase) -> Query:
    def run(spark, sf_dir):
        c = DB.class_counts(scored_view(spark, sf_dir, u))
        return c.select("qoe_class", "c", ts_text(F.col("max_ts")).alias("max_ts"), "class_rank")

    return run


# ---------------------------------------------------------- E/H: dashboard


def cumulative_class_counts(spark, sf_dir):
    cum = DB.cumulative_class_counts(scored_view(spark, sf_dir, CLOUD_GAMING), tick="day")
    return cum.select(ts_text(F.col("tick")).alias("tick"), "qoe_class", "delta", "total")


def cumulative_seconds(spark, sf_dir):
    """E3 at second ticks: running totals as a prefix sum over chunks of time."""
    cum = DB.cumulative_class_counts(scored_view(spark, sf_dir, VIDEO_STREAMING), tick="second")
    return ts_out(cum, "tick", "tick")


def series_alerts(spark, sf_dir):
    """The alert of the one unkeyed series, fed with the last clamped value of every second."""
    states = AL.alert_states(AL.latest_by_second(scored_view(spark, sf_dir, CLOUD_GAMING)), chunk=3600)
    texts = AL.alert_messages(states).select("id", "title", "description", "value_text")
    return states.select("id", "sec", "q", "signal", "state").join(texts, "id", "left")


def delta_since(spark, sf_dir):
    delta = DB.read_since(scored_view(spark, sf_dir, CLOUD_GAMING, since=SINCE), SINCE)
    c = DB.class_counts(delta)
    return c.select("qoe_class", "c", ts_text(F.col("max_ts")).alias("max_ts"), "class_rank")


def next_cursor(spark, sf_dir):
    delta = DB.read_since(scored_view(spark, sf_dir, CLOUD_GAMING, since=SINCE), SINCE)
    return DB.next_cursor(DB.class_counts(delta), SINCE).select(ts_text(F.col("cursor")).alias("cursor"))


def points_since(spark, sf_dir):
    return DB.chart_points(DB.points_since(scored_view(spark, sf_dir, CLOUD_GAMING, since=SINCE), SINCE, limit=CLOUD_GAMING.point_limit))


def points_paged(spark, sf_dir):
    page = DB.points_page(scored_view(spark, sf_dir, VIDEO_STREAMING, since=SINCE), SINCE, PAGE_SINCE_ID, limit=VIDEO_STREAMING.point_limit)
    return DB.chart_points(page)


def trailing_points(spark, sf_dir):
    """Points of the last 30 s before the newest row (the dashboard's 'now')."""
    seconds = CLOUD_GAMING.window_seconds
    newest = scored_view(spark, sf_dir, CLOUD_GAMING).agg(F.max("ingestion_timestamp").alias("m"))
    first = newest.select((F.col("m") - F.expr(f"INTERVAL {seconds} SECONDS")).alias("since"), "m").first()
    scored = scored_view(spark, sf_dir, CLOUD_GAMING, since=first["since"])
    return DB.chart_points(DB.trailing_points(scored, first["m"], seconds))


def trailing_count(spark, sf_dir):
    kpi = kpi_view(spark, sf_dir, CLOUD_GAMING, keyed=True)
    out = DB.trailing_count(kpi, "user_id", CLOUD_GAMING.window_seconds)
    return ts_out(out)


def latest_per_user(spark, sf_dir):
    scored = scored_view(spark, sf_dir, CLOUD_GAMING, keyed=True)
    latest = DB.latest_per_series(scored, "user_id", "predicted_qoe")
    return latest.select(
        "user_id",
        "latest_id",
        ts_text(F.col("latest_ts")).alias("latest_ts"),
        "predicted_qoe",
        severity_band(clamp(F.col("predicted_qoe"))).alias("band"),
    )


def severity_bands(spark, sf_dir):
    scored = scored_view(spark, sf_dir, VIDEO_STREAMING)
    return scored.select(
        "id",
        "predicted_qoe",
        "qoe_class",
        clamp(F.col("predicted_qoe")).alias("plotted"),
        severity_band(clamp(F.col("predicted_qoe"))).alias("band"),
        class_color(F.col("qoe_class"), "bg").alias("color"),
        class_color(F.col("qoe_class"), "border").alias("border_color"),
    )


def alert_states(spark, sf_dir):
    u = CLOUD_GAMING
    return AL.alert_states(alert_series(spark, sf_dir), low=u.alert_low, high=u.alert_high, hold=u.alert_hold_seconds)


def alert_messages(spark, sf_dir):
    return AL.alert_messages(alert_states(spark, sf_dir)).drop("signal")


def tick_payload(spark, sf_dir):
    """One-second ticks, as the dashboard polls."""
    return DB.tick_payload(scored_view(spark, sf_dir, CLOUD_GAMING), limit=CLOUD_GAMING.point_limit)


def tick_points(spark, sf_dir):
    """The points of all documents of a tick, decoded: every row of the table."""
    limit = CLOUD_GAMING.point_limit
    doc = DB.decode_payload(tick_payload(spark, sf_dir))
    return doc.select("page", F.col("ts").alias("tick"), F.posexplode("points").alias("pos", "p")).select(
        "tick", (F.col("page") * limit + F.col("pos") + 1).alias("pos"), F.col("p.ts").alias("ts"), F.col("p.qoe").alias("qoe")
    )


def day_points(spark, sf_dir):
    """Day ticks, whose points fill many pages: still every row."""
    limit = CLOUD_GAMING.point_limit
    doc = DB.decode_payload(DB.tick_payload(scored_view(spark, sf_dir, CLOUD_GAMING), tick="day", limit=limit))
    return doc.select(F.col("ts").alias("tick"), "page", F.size("points").alias("points"), F.size("delta_counts").alias("classes"))


def tick_counts(spark, sf_dir):
    c = DB.tick_counts(scored_view(spark, sf_dir, CLOUD_GAMING))
    return c.select(iso_utc(F.col("tick")).alias("tick"), "qoe_class", "c")


def text_forms(spark, sf_dir):
    """Number and time texts of each record, ties, fractions and odd cells included."""
    odd = F.element_at(F.array(*[F.lit(x) for x in ("3.7", "12", "", "abc", " 8 ")]), (F.col("id") % 5 + 1).cast("int"))
    tie = F.element_at(F.array(*[F.lit(x) for x in (2.675, 1.005, 0.125, 4.0, -2.675)]), (F.col("id") % 5 + 1).cast("int"))
    v = scored_view(spark, sf_dir, CLOUD_GAMING).withColumn("cell", odd).withColumn("x", tie)
    return v.select(
        "id",
        SC.fixed2("x").alias("fixed2"),
        SC.to_count("cell").alias("count"),
        SC.clock_label("ingestion_timestamp").alias("clock"),
        SC.ts_text(SC.parse_ts(SC.iso_utc("ingestion_timestamp"))).alias("parsed"),
        SC.percent2(F.col("CPU_usage") / 128.0).alias("percent"),
        SC.fixed4(F.col("Jitter_ms") / 64.0).alias("fixed4"),
    )


def feature_target(spark, sf_dir):
    """Features and target of the training rows, behind the guard for an empty batch."""
    u = VIDEO_STREAMING
    rows = training_frame(spark, sf_dir, u)
    out = features_target(rows, u)
    return out.limit(0) if skip_empty(rows) else out


# ------------------------------------------------------------- F: ML data


def train_test_split(spark, sf_dir):
    df = training_frame(spark, sf_dir, CLOUD_GAMING)
    train, test = ML.train_test_split(df, key=ML.portable_key("id"), test_size=CLOUD_GAMING.test_size)
    return train.select("id", F.lit("train").alias("split")).unionByName(test.select("id", F.lit("test").alias("split")))


def split_sizes(spark, sf_dir):
    df = training_frame(spark, sf_dir, VIDEO_STREAMING)
    train, test = ML.train_test_split(df, seed=VIDEO_STREAMING.seed, test_size=VIDEO_STREAMING.test_size)
    parts = train.select(F.lit("train").alias("split")).unionByName(test.select(F.lit("test").alias("split")))
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def balanced_weights(spark, sf_dir):
    u = VIDEO_STREAMING
    w = ML.balanced_weights(training_frame(spark, sf_dir, u), u.target, out="w")
    return w.select("id", round_class(F.col(u.target)).alias("cls"), F.round("w", 9).alias("w"))


def standardized(spark, sf_dir):
    u = CLOUD_GAMING
    st = ML.standardize(training_frame(spark, sf_dir, u), list(u.features))
    return st.select("id", *[F.round(f, ROUND).alias(f) for f in u.features])


def _fixed_predictions(spark, sf_dir, u: UseCase) -> DataFrame:
    from tidemark.operators.scoring import fixed_scorer, raw_score

    return raw_score(training_frame(spark, sf_dir, u), u, fixed_scorer(u), out="p")


def metrics_fixed(spark, sf_dir):
    outs = []
    for u in (CLOUD_GAMING, VIDEO_STREAMING):
        m = ML.metrics(_fixed_predictions(spark, sf_dir, u), u.target, "p", u)
        outs.append(m.select(F.lit(u.name).alias("dataset"), *[F.round(c, ROUND).alias(c) for c in m.columns]))
    return outs[0].unionByName(outs[1])


# candidate "models" with fixed predictions: the fixture scorer, its rounded
# form, and the scorer with clamping to the class scale
def _candidates(df: DataFrame):
    return {
        "fixed": F.col("p"),
        "fixed_round2": F.rint(F.col("p") * 100.0) / 100.0,
        "fixed_clamped": F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.col("p"))),
    }


def leaderboard(spark, sf_dir):
    rows = []
    for u in (CLOUD_GAMING, VIDEO_STREAMING):
        preds = _fixed_predictions(spark, sf_dir, u)
        m = ML.metrics_of(preds, u.target, _candidates(preds), u)
        rows.append(m.select(F.lit(u.name).alias("dataset"), "model", *[F.round(c, ROUND).alias(c) for c in m.columns if c != "model"]))
    return ML.leaderboard(rows[0].unionByName(rows[1]))


# --------------------------------------------------------------- registry


def batch_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for u, tag in ((CLOUD_GAMING, "cloud"), (VIDEO_STREAMING, "video")):
        q[f"{tag}_project"] = q_project(u)
        q[f"{tag}_accept"] = q_accept(u)
        q[f"{tag}_quarantine"] = q_quarantine(u)
        q[f"{tag}_score"] = q_score(u)
        q[f"{tag}_class_counts"] = q_class_counts(u)
    q.update(
        cumulative_class_counts=cumulative_class_counts,
        cumulative_seconds=cumulative_seconds,
        series_alerts=series_alerts,
        delta_since=delta_since,
        next_cursor=next_cursor,
        points_since=points_since,
        points_paged=points_paged,
        trailing_points=trailing_points,
        trailing_count=trailing_count,
        latest_per_user=latest_per_user,
        severity_band=severity_bands,
        alert_states=alert_states,
        alert_messages=alert_messages,
        tick_payload=tick_payload,
        tick_points=tick_points,
        day_points=day_points,
        tick_counts=tick_counts,
        text_forms=text_forms,
        feature_target=feature_target,
        train_test_split=train_test_split,
        split_sizes=split_sizes,
        balanced_weights=balanced_weights,
        standardized=standardized,
        metrics_fixed=metrics_fixed,
        leaderboard=leaderboard,
    )
    return q
