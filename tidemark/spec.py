"""Use-case specs: everything the generic operators are parameterised by.

One frozen spec per pipeline holds the record schema, value bounds, class
scale and training target. Nothing is inferred at run time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class UseCase:
    name: str
    features: tuple[str, ...]
    # Avro/storage type of each feature: "int" or "double"
    feature_types: tuple[str, ...]
    target: str
    # feature -> (lower, upper); None means unbounded on that side
    bounds: dict = field(hash=False)
    # class cuts, lower-inclusive: score < cuts[0] -> labels[0], ...
    cuts: tuple[float, ...]
    labels: tuple[str, ...]
    record_name: str
    record_namespace: str
    test_size: float = 0.2
    seed: int = 42
    alert_low: float = 2.5
    alert_high: float = 3.0
    alert_hold_seconds: int = 3
    window_seconds: int = 30
    point_limit: int = 500

    def spark_type(self, feature: str):
        t = self.feature_types[self.features.index(feature)]
        return T.IntegerType() if t == "int" else T.DoubleType()

    @property
    def kpi_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, self.spark_type(f), False) for f in self.features])

    @property
    def training_schema(self) -> T.StructType:
        fields = [T.StructField(f, T.DoubleType(), True) for f in self.features]
        return T.StructType(fields + [T.StructField(self.target, T.DoubleType(), True)])

    def avro_schema(self) -> str:
        """The record contract as Avro JSON (fields in wire order)."""
        return json.dumps(
            {
                "type": "record",
                "name": self.record_name,
                "namespace": self.record_namespace,
                "fields": [{"name": f, "type": t} for f, t in zip(self.features, self.feature_types)],
            }
        )

    @property
    def raw_table(self) -> str:
        return f"{self.name}_raw"

    @property
    def predictions_table(self) -> str:
        return f"{self.name}_predictions"


# Fixed values that must equal the reference: feature names and wire types,
# training targets, validation bounds, class cuts and labels, split share/seed,
# alert thresholds and hold time, dashboard window and point limit.
CLOUD_GAMING = UseCase(
    name="cloud_gaming",
    features=("CPU_usage", "GPU_usage", "Bandwidth_MBps", "Latency_ms", "FrameRate_fps", "Jitter_ms"),
    feature_types=("int", "int", "double", "int", "int", "int"),
    target="QoE_score",
    bounds={
        "CPU_usage": (0.0, 100.0),
        "GPU_usage": (0.0, 100.0),
        "Bandwidth_MBps": (0.0, None),
        "Latency_ms": (0.0, None),
        "FrameRate_fps": (0.0, None),
        "Jitter_ms": (0.0, None),
    },
    cuts=(2.0, 3.0, 4.0),
    labels=("Poor", "Fair", "Good", "Excellent"),
    record_name="CloudGamingKPI",
    record_namespace="cloud.gaming.kpi",
)

VIDEO_STREAMING = UseCase(
    name="video_streaming",
    features=("throughput", "avg_bitrate", "delay_qos", "jitter", "packet_loss"),
    feature_types=("double", "double", "double", "double", "double"),
    target="mos",
    bounds={
        "throughput": (0.0, None),
        "avg_bitrate": (0.0, None),
        "delay_qos": (0.0, None),
        "jitter": (0.0, None),
        "packet_loss": (0.0, None),
    },
    cuts=(2.0, 3.0, 4.0, 4.5),
    labels=("Bad", "Poor", "Fair", "Good", "Excellent"),
    record_name="VideoStreamingKPI",
    record_namespace="com.qoe.streaming",
)

USE_CASES = {u.name: u for u in (CLOUD_GAMING, VIDEO_STREAMING)}

# Dashboard display order of classes (unknown classes go last, alphabetical).
CLASS_ORDER = ("Poor", "Bad", "Fair", "Good", "Excellent")
# Severity bands of the dashboard line; the same cuts serve both use cases.
SEVERITY_CUTS = (2.0, 3.0, 4.0)
SEVERITY_BANDS = ("red", "amber", "blue", "green")


def use_case(name: str) -> UseCase:
    try:
        return USE_CASES[name]
    except KeyError:
        raise ValueError(f"unknown use case: {name}") from None
