"""KPI views derived from the driver's ``events`` table.

Each ``events`` row gives one KPI record; modular hashes of ``event_id`` place
each feature in the value range of the live producers. The same SQL text runs in
Spark (``selectExpr``) and in the DuckDB oracle, so both see identical inputs.

``((e % m) * a) % m`` equals ``(e * a) % m`` for non-negative ids but never
overflows BIGINT, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING, UseCase


def _h(mult: int, m: int, col: str = "event_id") -> str:
    return f"((({col} % {m}) * {mult}) % {m})"


def _ratio(num: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(100 AS DOUBLE)"


# Fixed fixture parameters (FIXTURES.md): per feature the multiplier, modulus
# and offset that map event_id into the producer's value range.
_KPI_EXPRS = {
    CLOUD_GAMING.name: [
        ("CPU_usage", f"CAST(50 + {_h(7919, 51)} AS INT)"),
        ("GPU_usage", f"CAST(40 + {_h(104729, 61)} AS INT)"),
        ("Bandwidth_MBps", _ratio(f"1000 + {_h(1299709, 9001)}")),
        ("Latency_ms", f"CAST(20 + {_h(15485863, 181)} AS INT)"),
        ("FrameRate_fps", f"CAST(24 + {_h(32452843, 97)} AS INT)"),
        ("Jitter_ms", f"CAST({_h(49979687, 31)} AS INT)"),
    ],
    VIDEO_STREAMING.name: [
        ("throughput", _ratio(f"100000 + {_h(7919, 400001)}")),
        ("avg_bitrate", _ratio(f"50000 + {_h(104729, 350001)}")),
        ("delay_qos", _ratio(_h(1299709, 20001))),
        ("jitter", _ratio(_h(15485863, 5001))),
        ("packet_loss", _ratio(_h(32452843, 501))),
    ],
}

# Dirty variants: out-of-range, null, NaN and infinite values at fixed strides.
_DIRTY = {
    CLOUD_GAMING.name: {
        "CPU_usage": "CASE WHEN event_id % 97 = 0 THEN -1 WHEN event_id % 89 = 0 THEN 101 ELSE {e} END",
        "Latency_ms": "CASE WHEN event_id % 83 = 0 THEN NULL ELSE {e} END",
        "Bandwidth_MBps": (
            "CASE WHEN event_id % 79 = 0 THEN CAST('NaN' AS DOUBLE) "
            "WHEN event_id % 73 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE {e} END"
        ),
    },
    VIDEO_STREAMING.name: {
        "throughput": "CASE WHEN event_id % 97 = 0 THEN CAST(-1 AS DOUBLE) ELSE {e} END",
        "delay_qos": "CASE WHEN event_id % 83 = 0 THEN NULL ELSE {e} END",
        "packet_loss": (
            "CASE WHEN event_id % 79 = 0 THEN CAST('NaN' AS DOUBLE) "
            "WHEN event_id % 73 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE {e} END"
        ),
    },
}

TS_EXPR = "date_trunc('second', ts)"


def kpi_exprs(u: UseCase, dirty: bool = False, keyed: bool = False) -> list[tuple[str, str]]:
    """(alias, SQL expression) pairs of a KPI view over ``events``."""
    out = [("id", "event_id")]
    for name, e in _KPI_EXPRS[u.name]:
        if dirty and name in _DIRTY[u.name]:
            e = _DIRTY[u.name][name].format(e=e)
        out.append((name, e))
    out.append(("ingestion_timestamp", TS_EXPR))
    if keyed:
        out.append(("user_id", "user_id"))
    return out


def kpi_sql(u: UseCase, dirty: bool = False, keyed: bool = False, source: str = "events") -> str:
    cols = ",\n  ".join(f"{e} AS {a}" for a, e in kpi_exprs(u, dirty, keyed))
    return f"SELECT\n  {cols}\nFROM {source}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kpi_view(spark: SparkSession, sf_dir: str, u: UseCase, dirty: bool = False, keyed: bool = False, since=None) -> DataFrame:
    """The KPI records of one use case, as a DataFrame over ``events`` (those not before ``since``)."""
    events = read_table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast(events.schema["ts"].dataType))
    return kpi_frame(events, u, dirty, keyed)


def kpi_frame(events: DataFrame, u: UseCase, dirty: bool = False, keyed: bool = False) -> DataFrame:
    """Same projection over any events DataFrame (batch or streaming)."""
    return events.selectExpr(*[f"{e} AS {a}" for a, e in kpi_exprs(u, dirty, keyed)])


# Fixed fixture scorers (FIXTURES.md §4): intercept, then (feature, coefficient,
# centre) terms in evaluation order. They stand in for a trained model.
FIXED_SCORERS = {
    CLOUD_GAMING.name: (
        "5.6",
        [
            ("Latency_ms", "-0.012", None),
            ("Jitter_ms", "-0.04", None),
            ("FrameRate_fps", "0.012", 60),
            ("Bandwidth_MBps", "0.008", 55),
            ("CPU_usage", "-0.012", 50),
            ("GPU_usage", "-0.008", 40),
        ],
    ),
    VIDEO_STREAMING.name: (
        "4.2",
        [
            ("throughput", "0.0003", 3000),
            ("avg_bitrate", "0.0003", 2250),
            ("delay_qos", "-0.006", 60),
            ("jitter", "-0.015", 15),
            ("packet_loss", "-0.25", 1.5),
        ],
    ),
}


def fixed_score_sql(u: UseCase) -> str:
    """Fixture score as SQL text; coefficients cast from text in both engines."""
    intercept, terms = FIXED_SCORERS[u.name]
    out = f"CAST('{intercept}' AS DOUBLE)"
    for feat, coef, centre in terms:
        op = "-" if coef.startswith("-") else "+"
        c = f"CAST('{coef.lstrip('-')}' AS DOUBLE)"
        x = feat if centre is None else f"({feat} - {centre})"
        out = f"{out} {op} {c} * {x}"
    return out


def noise_sql(id_col: str = "id") -> str:
    """Deterministic label noise in [-0.5, 0.5] for the training fixture."""
    return f"CAST({_h(86028121, 1001, id_col)} - 500 AS DOUBLE) / CAST(1000 AS DOUBLE)"


def training_target_sql(u: UseCase) -> str:
    """Training target: fixture score plus noise, clamped to [1, 5]."""
    return f"least(CAST(5 AS DOUBLE), greatest(CAST(1 AS DOUBLE), ({fixed_score_sql(u)}) + {noise_sql()}))"


def training_frame(spark: SparkSession, sf_dir: str, u: UseCase) -> DataFrame:
    """Features (as double) + target of the training fixture, keyed by id."""
    kpi = kpi_view(spark, sf_dir, u)
    cols = ["id"] + [f"CAST({f} AS DOUBLE) AS {f}" for f in u.features]
    return kpi.selectExpr(*cols, f"{training_target_sql(u)} AS {u.target}")


# Alert series fixture: 20 keyed series, one point per event, second = id / 20.
ALERT_EXPRS = [
    ("id", "event_id"),
    ("k", "user_id % 20"),
    ("sec", "CAST(floor(event_id / 20) AS BIGINT)"),
    ("q", _ratio(f"100 + {_h(7919, 401)}")),
]


def alert_sql(source: str = "events") -> str:
    return "SELECT " + ", ".join(f"{e} AS {a}" for a, e in ALERT_EXPRS) + f" FROM {source}"


def alert_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {a}" for a, e in ALERT_EXPRS])
