"""Sources (A1, A5-A7): KPI message streams, training CSV, predictions tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.dashboard import read_since  # noqa: F401  (A7)
from tidemark.spec import UseCase

# Message schema of a topic: the Kafka source's columns.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)


def kafka_options(topic: str | None, servers: str | None = None, **options) -> dict[str, str]:
    """A1, K5: what the Kafka reader is given: one topic, from the latest offsets, tolerating lost ones. ``options`` add to these or replace them."""
    if not topic or not str(topic).strip():
        raise ValueError("a topic is needed")
    found = {"subscribe": topic, "startingOffsets": "latest", "failOnDataLoss": "false"}
    if servers:
        found["kafka.bootstrap.servers"] = servers
    found.update({k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()})
    if not found.get("kafka.bootstrap.servers"):
        raise ValueError("kafka.bootstrap.servers is needed")
    return found


def kpi_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, topic: str | None = None, **options) -> DataFrame:
    """A1: streaming DataFrame of messages with a binary ``value``.

    ``kafka``: subscribe to ``topic`` from the latest offsets, tolerating lost
    offsets (needs the Kafka connector on the classpath). Any other format
    reads files holding the same columns (``TOPIC_SCHEMA``), one file per
    trigger by default, which is how tests and offline replays drive it.
    """
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(topic, **options)).load()
    r = spark.readStream.format(fmt).schema(options.pop("schema", TOPIC_SCHEMA))
    r = r.option("maxFilesPerTrigger", options.pop("maxFilesPerTrigger", 1))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def read_training_csv(spark: SparkSession, path: str, u: UseCase, header: bool = True) -> DataFrame:
    """A5: training CSV with the declared schema (no inference)."""
    return spark.read.schema(u.training_schema).option("header", header).csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """A month-partitioned predictions (or raw) table; ``ym`` and, for
    stream-written tables, ``batch_id`` come back as partition columns."""
    return spark.read.option("basePath", path).parquet(path)
