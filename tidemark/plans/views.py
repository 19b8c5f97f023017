"""Shared derived views of the driver tables used by the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scoring import fixed_scorer, score
from tidemark.sources.fixtures import kpi_view
from tidemark.spec import UseCase

# Fixed query parameters: dashboard cursor and as-of points inside the data.
SINCE = "2024-01-15 00:00:00"
PAGE_SINCE_ID = 0


def scored_view(spark: SparkSession, sf_dir: str, u: UseCase, keyed: bool = False, since=None) -> DataFrame:
    """The predictions table of a use case: KPI records scored by the fixture
    scorer (features, predicted_qoe, qoe_class, ingestion_timestamp).

    ``since``: a lower bound of the time that the reader will ask for; it is
    put on the raw time of ``events`` (never below its second), where the scan can use it."""
    return score(kpi_view(spark, sf_dir, u, keyed=keyed, since=since), u, fixed_scorer(u))


def ts_out(df: DataFrame, col: str = "ingestion_timestamp", name: str = "ingestion_time") -> DataFrame:
    """Replace a timestamp column by its ``yyyy-MM-dd HH:mm:ss`` text."""
    from tidemark.functions.scalars import ts_text

    cols = [ts_text(F.col(c)).alias(name) if c == col else F.col(c) for c in df.columns]
    return df.select(*cols)
