"""Projection, validation and quarantine of KPI records.

Validation is one Catalyst predicate per feature, so it runs inside whole-stage
codegen next to the scan; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import UseCase

INF = float("inf")


def project_kpi(df: DataFrame, u: UseCase, *extra: str) -> DataFrame:
    """Named, ordered feature columns of a use case (plus any extra columns)."""
    return df.select(*u.features, *extra)


def cast_double(df: DataFrame, cols) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def features_target(df: DataFrame, u: UseCase, *keep: str) -> DataFrame:
    """Feature columns as double plus the training target."""
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in u.features], F.col(u.target))


def _checks(u: UseCase, feature: str) -> list[tuple[str, Column]]:
    """(reason, failing condition) in the order they are tested."""
    x = F.col(feature)
    checks = [("missing", x.isNull())]
    if u.feature_types[u.features.index(feature)] == "double":
        checks += [("nan", F.isnan(x)), ("infinite", F.abs(x) == F.lit(INF))]
    lo, hi = u.bounds.get(feature, (None, None))
    if lo is not None:
        checks.append(("below_min", x < F.lit(lo)))
    if hi is not None:
        checks.append(("above_max", x > F.lit(hi)))
    return checks


def feature_reason(u: UseCase, feature: str) -> Column:
    """First failing check of one feature as ``feature:reason``, else null."""
    expr = None
    for reason, bad in _checks(u, feature):
        label = F.lit(f"{feature}:{reason}")
        expr = F.when(bad, label) if expr is None else expr.when(bad, label)
    return expr


def is_valid(u: UseCase) -> Column:
    """All features present, finite, not NaN and inside their bounds."""
    ok = F.lit(True)
    for f in u.features:
        for _, bad in _checks(u, f):
            ok = ok & ~bad
    return ok


def reasons(u: UseCase) -> Column:
    """Array of failing checks (feature order), empty for a valid record."""
    return F.filter(F.array(*[feature_reason(u, f) for f in u.features]), lambda r: r.isNotNull())


def validate(df: DataFrame, u: UseCase) -> DataFrame:
    """Only the records a scorer would accept."""
    return df.filter(is_valid(u))


def quarantine(df: DataFrame, u: UseCase) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected); rejected rows carry their reasons.

    One pass computes the reasons array; both outputs derive from it, so a
    cached input is scanned once per consumer and no row is lost or doubled.
    """
    tagged = df.withColumn("_reasons", reasons(u))
    accepted = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    rejected = tagged.filter(F.size("_reasons") > 0).withColumn(
        "reasons", F.array_join("_reasons", ";")
    ).drop("_reasons")
    return accepted, rejected


def skip_empty(df: DataFrame) -> bool:
    """True when a (micro-)batch has no rows; stops at the first row found."""
    return df.isEmpty()
