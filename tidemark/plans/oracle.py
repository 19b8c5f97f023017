"""DuckDB SQL twins of the named queries (the independent correctness check).

Built from the same spec and fixture text as the Spark plans, but written as
plain SQL over the pre-registered driver views (``events`` ...), so a mistake
in an operator does not carry over to its oracle.
"""

from __future__ import annotations

from tidemark.plans.views import PAGE_SINCE_ID, SINCE
from tidemark.sources.fixtures import alert_sql, fixed_score_sql, kpi_sql, training_target_sql
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase

R = 6


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def iso(c: str) -> str:
    return f"(strftime({c}, '%Y-%m-%dT%H:%M:%S') || '+00:00')"


#: Fixed values, written out a second time on purpose: what the engine's spec must say.
CUTS = {
    "cloud_gaming": ((2, 3, 4), ("Poor", "Fair", "Good", "Excellent")),
    "video_streaming": ((2, 3, 4, 4.5), ("Bad", "Poor", "Fair", "Good", "Excellent")),
}
BANDS = ((2, 3, 4), ("red", "amber", "blue", "green"))
COLORS = {"Poor": "239, 68, 68", "Bad": "239, 68, 68", "Fair": "251, 191, 36", "Good": "59, 130, 246", "Excellent": "34, 197, 94"}
RANKS = ("Poor", "Bad", "Fair", "Good", "Excellent")


def classify(s: str, u: UseCase) -> str:
    cuts, labels = CUTS[u.name]
    whens = " ".join(f"WHEN {s} < {c} THEN '{label}'" for c, label in zip(cuts, labels))
    return f"CASE WHEN {s} IS NULL OR isnan({s}) THEN 'Unknown' {whens} ELSE '{labels[-1]}' END"


def clamp(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL ELSE least(CAST(5 AS DOUBLE), greatest(CAST(1 AS DOUBLE), {x})) END"


def band(x: str) -> str:
    whens = " ".join(f"WHEN {x} < {c} THEN '{b}'" for c, b in zip(*BANDS))
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL {whens} ELSE '{BANDS[1][-1]}' END"


def class_rank(c: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(RANKS, 1))
    return f"CAST(CASE {c} {whens} ELSE 999 END AS INTEGER)"


def color(c: str, idx: int) -> str:
    opacity = ("0.8", "1")[idx]
    whens = " ".join(f"WHEN '{k}' THEN 'rgba({v}, {opacity})'" for k, v in COLORS.items())
    return f"CASE {c} {whens} ELSE 'rgba(148, 163, 184, 0.8)' END"


def reason(u: UseCase, f: str) -> str:
    parts = [f"WHEN {f} IS NULL THEN '{f}:missing'"]
    if u.feature_types[u.features.index(f)] == "double":
        parts += [f"WHEN isnan({f}) THEN '{f}:nan'", f"WHEN isinf({f}) THEN '{f}:infinite'"]
    parts.append(f"WHEN {f} < 0 THEN '{f}:below_min'")  # no feature may be negative
    if f in ("CPU_usage", "GPU_usage"):
        parts.append(f"WHEN {f} > 100 THEN '{f}:above_max'")
    return "CASE " + " ".join(parts) + " END"


def valid(u: UseCase) -> str:
    return " AND ".join(f"({reason(u, f)}) IS NULL" for f in u.features)


def scored(u: UseCase, dirty: bool = False, keyed: bool = False) -> str:
    """The predictions view of a use case as a subquery."""
    feats = ", ".join(u.features)
    extra = ", user_id" if keyed else ""
    return (
        f"(SELECT id, {feats}, round_even(_s, 2) AS predicted_qoe, {classify('_s', u)} AS qoe_class, "
        f"ingestion_timestamp{extra} FROM (SELECT *, {fixed_score_sql(u)} AS _s FROM ({kpi_sql(u, dirty, keyed)}) k "
        f"WHERE {valid(u)}) s)"
    )


def training(u: UseCase) -> str:
    feats = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in u.features)
    return f"(SELECT id, {feats}, {training_target_sql(u)} AS {u.target} FROM ({kpi_sql(u)}) k)"


def _project(u):
    feats = ", ".join(u.features)
    return f"SELECT id, {feats}, {ts_text('ingestion_timestamp')} AS ingestion_time FROM ({kpi_sql(u)}) k"


def _accept(u):
    feats = ", ".join(u.features)
    return (
        f"SELECT id, {feats}, {ts_text('ingestion_timestamp')} AS ingestion_time "
        f"FROM ({kpi_sql(u, dirty=True)}) k WHERE {valid(u)}"
    )


def _quarantine(u):
    rs = ", ".join(reason(u, f) for f in u.features)
    return f"SELECT id, concat_ws(';', {rs}) AS reasons FROM ({kpi_sql(u, dirty=True)}) k WHERE NOT ({valid(u)})"


def _score(u):
    feats = ", ".join(u.features)
    return f"SELECT id, {feats}, predicted_qoe, qoe_class, {ts_text('ingestion_timestamp')} AS ingestion_time FROM {scored(u)} p"


def _counts(src: str) -> str:
    return (
        f"SELECT qoe_class, count(*) AS c, {ts_text('max(ingestion_timestamp)')} AS max_ts, "
        f"{class_rank('qoe_class')} AS class_rank FROM {src} p GROUP BY qoe_class"
    )


def _since(u: UseCase) -> str:
    return f"(SELECT * FROM {scored(u)} p WHERE ingestion_timestamp > TIMESTAMP '{SINCE}')"


def _chart(src: str) -> str:
    return (
        f"SELECT id, {iso('ingestion_timestamp')} AS ts, predicted_qoe AS qoe, {clamp('predicted_qoe')} AS plotted, "
        f"{band(clamp('predicted_qoe'))} AS band FROM {src} c"
    )


def _alert_states() -> str:
    return f"""
WITH points AS ({alert_sql()}),
s AS (SELECT *, CASE WHEN q < 2.5 THEN 'D' WHEN q >= 3 THEN 'R' END AS sig FROM points),
e AS (SELECT *, last_value(sig IGNORE NULLS) OVER w AS ls,
        CAST(sum(CASE WHEN sig = 'D' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS ep FROM s
      WINDOW w AS (PARTITION BY k ORDER BY sec, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT *, min(CASE WHEN sig = 'R' THEN sec END) OVER (PARTITION BY k, ep ORDER BY sec, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rec FROM e)
SELECT id, k, sec, q, sig AS signal,
  CASE WHEN ls = 'D' THEN 'degraded'
       WHEN ls = 'R' AND ep > 0 AND sec < rec + 3 THEN 'recovering' ELSE 'normal' END AS state FROM r"""


def _alert_messages() -> str:
    return f"""
WITH st AS ({_alert_states()})
SELECT id, k, sec, q, state,
  CASE WHEN signal = 'D' THEN 'QoE Degradation Detected' ELSE 'QoE Recovered' END AS title,
  CASE WHEN signal = 'D' THEN 'Quality has dropped to ' || CASE WHEN q < 2 THEN 'Poor' ELSE 'Fair' END || ' level'
       ELSE 'Quality has improved to ' || CASE WHEN q >= 4 THEN 'Excellent' ELSE 'Good' END || ' level' END AS description,
  printf('%.2f', q) AS value_text
FROM st WHERE signal = 'D' OR (signal = 'R' AND state = 'recovering')"""


def _metrics(y: str, p: str, u: UseCase) -> str:
    return (
        f"round(avg(abs({y} - {p})), {R}) AS mae, round(sqrt(avg(({y} - {p}) * ({y} - {p}))), {R}) AS rmse, "
        f"round(1 - sum(({y} - {p}) * ({y} - {p})) / (count(*) * var_pop({y})), {R}) AS r2, "
        f"round(avg(CASE WHEN ({classify(y, u)}) = ({classify(p, u)}) THEN 1.0 ELSE 0.0 END), {R}) AS class_accuracy"
    )


def _preds(u: UseCase) -> str:
    return f"(SELECT *, {fixed_score_sql(u)} AS p FROM {training(u)} t)"


CANDIDATES = {
    "fixed": "p",
    "fixed_round2": "round_even(p * 100.0, 0) / 100.0",
    "fixed_clamped": "least(CAST(5 AS DOUBLE), greatest(CAST(1 AS DOUBLE), p))",
}


def _leaderboard() -> str:
    parts = []
    for u in (CLOUD_GAMING, VIDEO_STREAMING):
        for name, expr in CANDIDATES.items():
            parts.append(
                f"SELECT '{u.name}' AS dataset, '{name}' AS model, {_metrics(u.target, '_q', u)} "
                f"FROM (SELECT *, {expr} AS _q FROM {_preds(u)} x) y"
            )
    union = " UNION ALL ".join(parts)
    return (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY rmse, model) AS INTEGER) AS rank, "
        f"row_number() OVER (PARTITION BY dataset ORDER BY rmse, model) = 1 AS promoted FROM ({union}) m"
    )


def _ticks(unit: str = "second") -> str:
    u = CLOUD_GAMING
    return f"(SELECT *, date_trunc('{unit}', ingestion_timestamp) AS tick FROM {scored(u)} p)"


def _tick_payload() -> str:
    """The document texts, built as text."""
    point = f"""'{{"ts":"' || {iso('ingestion_timestamp')} || '","qoe":' || CAST(predicted_qoe AS VARCHAR) || '}}'"""
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY tick ORDER BY ingestion_timestamp, id) AS pos FROM {_ticks()} t),
p AS (SELECT tick, CAST((pos - 1) // 500 AS INTEGER) AS page, string_agg({point}, ',' ORDER BY pos) AS points FROM r GROUP BY 1, 2),
k AS (SELECT tick, qoe_class, count(*) AS c FROM {_ticks()} t GROUP BY 1, 2),
d AS (SELECT tick, string_agg('"' || qoe_class || '":' || c, ',' ORDER BY qoe_class) AS counts FROM k GROUP BY 1)
SELECT {iso('p.tick')} AS tick, page, '{{"ts":"' || {iso('p.tick')} || '","delta_counts":{{' || CASE WHEN page = 0 THEN counts ELSE '' END
  || '}},"points":[' || points || ']}}' AS payload FROM p JOIN d ON p.tick = d.tick"""


def _text_forms() -> str:
    # what a browser's toFixed(2) and number coercion give for the five probes, written out
    return f"""
SELECT id, CASE id % 5 WHEN 0 THEN '2.67' WHEN 1 THEN '1.00' WHEN 2 THEN '0.13' WHEN 3 THEN '4.00' ELSE '-2.67' END AS fixed2,
  CAST(CASE id % 5 WHEN 0 THEN 3.7 WHEN 1 THEN 12 WHEN 4 THEN 8 ELSE 0 END AS DOUBLE) AS "count",
  strftime(ingestion_timestamp, '%H:%M:%S') AS clock, {ts_text('ingestion_timestamp')} AS parsed,
  printf('%.2f%%', CPU_usage / 128.0::DOUBLE * 100) AS percent, printf('%.4f', Jitter_ms / 64.0::DOUBLE) AS fixed4
FROM {scored(CLOUD_GAMING)} p"""


def batch_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    for u, tag in ((CLOUD_GAMING, "cloud"), (VIDEO_STREAMING, "video")):
        q[f"{tag}_project"] = _project(u)
        q[f"{tag}_accept"] = _accept(u)
        q[f"{tag}_quarantine"] = _quarantine(u)
        q[f"{tag}_score"] = _score(u)
        q[f"{tag}_class_counts"] = _counts(scored(u))
    cg, vs = CLOUD_GAMING, VIDEO_STREAMING
    q["cumulative_class_counts"] = (
        f"SELECT {ts_text('tick')} AS tick, qoe_class, delta, "
        f"CAST(sum(delta) OVER (PARTITION BY qoe_class ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total "
        f"FROM (SELECT date_trunc('day', ingestion_timestamp) AS tick, qoe_class, count(*) AS delta FROM {scored(cg)} p GROUP BY 1, 2) d"
    )
    q["cumulative_seconds"] = (
        f"SELECT {ts_text('tick')} AS tick, qoe_class, delta, CAST(sum(delta) OVER (PARTITION BY qoe_class ORDER BY tick) AS BIGINT) AS total "
        f"FROM (SELECT ingestion_timestamp AS tick, qoe_class, count(*) AS delta FROM {scored(vs)} p GROUP BY 1, 2) d"
    )
    q["series_alerts"] = f"""
WITH points AS (SELECT id, CAST(epoch(ingestion_timestamp) AS BIGINT) AS sec, least(5.0::DOUBLE, greatest(1.0::DOUBLE, predicted_qoe)) AS q FROM {scored(cg)} p
  QUALIFY row_number() OVER (PARTITION BY ingestion_timestamp ORDER BY id DESC) = 1),
g AS (SELECT *, CASE WHEN q < 2.5 THEN 'D' WHEN q >= 3 THEN 'R' END AS signal FROM points),
e AS (SELECT *, sum(CASE WHEN signal = 'D' THEN 1 ELSE 0 END) OVER (ORDER BY sec) AS ep FROM g),
f AS (SELECT *, min(CASE WHEN signal = 'R' THEN sec END) OVER (PARTITION BY ep ORDER BY sec) AS rec FROM e),
s AS (SELECT *, CASE WHEN signal = 'D' THEN 'degraded' WHEN ep = 0 OR sec >= rec + 3 THEN 'normal' WHEN rec IS NULL THEN 'degraded' ELSE 'recovering' END AS state FROM f)
SELECT id, sec, q, signal, state,
  CASE WHEN signal = 'D' THEN 'QoE Degradation Detected' WHEN signal = 'R' AND state = 'recovering' THEN 'QoE Recovered' END AS title,
  CASE WHEN signal = 'D' THEN 'Quality has dropped to ' || CASE WHEN q < 2 THEN 'Poor' ELSE 'Fair' END || ' level'
       WHEN signal = 'R' AND state = 'recovering' THEN 'Quality has improved to ' || CASE WHEN q >= 4 THEN 'Excellent' ELSE 'Good' END || ' level' END AS description,
  CASE WHEN signal = 'D' OR (signal = 'R' AND state = 'recovering') THEN printf('%.2f', q) END AS value_text FROM s"""
    q["delta_since"] = _counts(_since(cg))
    q["next_cursor"] = (
        f"SELECT {ts_text(f'CASE WHEN m > TIMESTAMP {SINCE!r} THEN m ELSE TIMESTAMP {SINCE!r} END')} AS cursor "
        f"FROM (SELECT max(ingestion_timestamp) AS m FROM {_since(cg)} d) x"
    )
    q["points_since"] = _chart(f"(SELECT * FROM {_since(cg)} d ORDER BY ingestion_timestamp, id LIMIT {cg.point_limit})")
    q["points_paged"] = _chart(
        f"(SELECT * FROM {scored(vs)} p WHERE ingestion_timestamp > TIMESTAMP '{SINCE}' OR "
        f"(ingestion_timestamp = TIMESTAMP '{SINCE}' AND id > {PAGE_SINCE_ID}) ORDER BY ingestion_timestamp, id LIMIT {vs.point_limit})"
    )
    q["trailing_points"] = _chart(
        f"(SELECT * FROM {scored(cg)} p WHERE ingestion_timestamp >= (SELECT max(ingestion_timestamp) FROM {scored(cg)} m) "
        f"- INTERVAL {cg.window_seconds} SECOND AND ingestion_timestamp <= (SELECT max(ingestion_timestamp) FROM {scored(cg)} m2))"
    )
    q["trailing_count"] = (
        f"SELECT id, user_id, {ts_text('ingestion_timestamp')} AS ingestion_time, count(*) OVER (PARTITION BY user_id "
        f"ORDER BY ingestion_timestamp RANGE BETWEEN INTERVAL {cg.window_seconds} SECOND PRECEDING AND CURRENT ROW) AS n_window "
        f"FROM ({kpi_sql(cg, keyed=True)}) k"
    )
    q["latest_per_user"] = (
        f"SELECT user_id, id AS latest_id, {ts_text('ingestion_timestamp')} AS latest_ts, predicted_qoe, "
        f"{band(clamp('predicted_qoe'))} AS band FROM {scored(cg, keyed=True)} p "
        f"QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingestion_timestamp DESC, id DESC) = 1"
    )
    q["severity_band"] = (
        f"SELECT id, predicted_qoe, qoe_class, {clamp('predicted_qoe')} AS plotted, {band(clamp('predicted_qoe'))} AS band, "
        f"{color('qoe_class', 0)} AS color, {color('qoe_class', 1)} AS border_color FROM {scored(vs)} p"
    )
    q["alert_states"] = _alert_states()
    q["alert_messages"] = _alert_messages()
    q["tick_points"] = (
        f"SELECT {iso('tick')} AS tick, pos, {iso('ingestion_timestamp')} AS ts, predicted_qoe AS qoe FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY tick ORDER BY ingestion_timestamp, id) AS pos FROM {_ticks()} t) r"
    )
    q["tick_payload"] = _tick_payload()
    q["day_points"] = (
        f"SELECT {iso('tick')} AS tick, page, CAST(count(*) AS INTEGER) AS points, CAST(CASE WHEN page = 0 THEN any_value(n) ELSE 0 END AS INTEGER) AS classes "
        f"FROM (SELECT r.tick, n, CAST((row_number() OVER (PARTITION BY r.tick ORDER BY ingestion_timestamp, id) - 1) // 500 AS INTEGER) AS page "
        f"FROM {_ticks('day')} r JOIN (SELECT tick, count(DISTINCT qoe_class) AS n FROM {_ticks('day')} t GROUP BY tick) c ON r.tick = c.tick) x GROUP BY tick, page"
    )
    q["text_forms"] = _text_forms()
    q["feature_target"] = f"SELECT {', '.join(vs.features)}, {vs.target} FROM {training(vs)} t"
    q["tick_counts"] = f"SELECT {iso('tick')} AS tick, qoe_class, count(*) AS c FROM {_ticks()} t GROUP BY tick, qoe_class"
    q["train_test_split"] = (
        "SELECT id, CASE WHEN row_number() OVER (ORDER BY k, id) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split "
        "FROM (SELECT event_id AS id, ((event_id % 1000003) * 7919) % 1000003 AS k FROM events) e"
    )
    q["split_sizes"] = (
        "SELECT 'test' AS split, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM events "
        "UNION ALL SELECT 'train' AS split, count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM events"
    )
    q["balanced_weights"] = (
        f"WITH t AS {training(vs)}, c AS (SELECT CAST(round_even({vs.target}, 0) AS INTEGER) AS cls, count(*) AS nc FROM t GROUP BY 1), "
        f"kk AS (SELECT count(*) AS k, sum(nc) AS n FROM c) "
        f"SELECT t.id, c.cls, round(CAST(kk.n AS DOUBLE) / (kk.k * c.nc), 9) AS w FROM t "
        f"JOIN c ON CAST(round_even(t.{vs.target}, 0) AS INTEGER) = c.cls, kk"
    )
    feats = ", ".join(
        f"round(CASE WHEN stddev_pop({f}) OVER () = 0 THEN 0.0 ELSE ({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () END, {R}) AS {f}"
        for f in cg.features
    )
    q["standardized"] = f"SELECT id, {feats} FROM {training(cg)} t"
    q["metrics_fixed"] = " UNION ALL ".join(
        f"SELECT '{u.name}' AS dataset, {_metrics(u.target, 'p', u)} FROM {_preds(u)} x" for u in (cg, vs)
    )
    q["leaderboard"] = _leaderboard()
    return q
