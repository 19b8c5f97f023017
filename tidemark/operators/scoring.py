"""Scoring (F8): features -> predicted score -> rounded score + class.

Linear models (a fixture scorer, or an MLlib scaler + linear regression) fold
into one Catalyst expression ``b + sum(w_i * x_i)``, so scoring runs in
whole-stage codegen with no Python worker and no vector assembly. Tree models
score through MLlib ``transform`` (JVM as well).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import classify, round2, with_score_defaults
from tidemark.operators.forest import GrownForest
from tidemark.operators.quality import is_valid
from tidemark.spec import UseCase

SCORE = "_score"


@dataclass(frozen=True)
class LinearScorer:
    """``intercept + sum(coef * (x - centre))`` in the given term order."""

    intercept: float
    terms: tuple[tuple[str, float, float | None], ...]

    def column(self) -> Column:
        acc = F.lit(float(self.intercept))
        for feat, coef, centre in self.terms:
            x = F.col(feat) if centre is None else (F.col(feat) - F.lit(centre))
            if coef < 0:
                acc = acc - F.lit(-float(coef)) * x
            else:
                acc = acc + F.lit(float(coef)) * x
        return acc


def fixed_scorer(u: UseCase) -> LinearScorer:
    """The fixture scorer of a use case (stands in for a trained model)."""
    from tidemark.sources.fixtures import FIXED_SCORERS

    intercept, terms = FIXED_SCORERS[u.name]
    return LinearScorer(float(intercept), tuple((f, float(c), m) for f, c, m in terms))


def fold_linear(model, features) -> LinearScorer | None:
    """Fold an MLlib [VectorAssembler, StandardScaler?, LinearRegression] into a
    LinearScorer. Returns None when the model is not linear.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StandardScalerModel, VectorAssembler
    from pyspark.ml.regression import LinearRegressionModel

    stages = model.stages if isinstance(model, PipelineModel) else [model]
    lin = stages[-1]
    if not isinstance(lin, LinearRegressionModel):
        return None
    assemblers = [s for s in stages if isinstance(s, VectorAssembler)]
    if assemblers:
        features = assemblers[0].getInputCols()
    coefs = list(lin.coefficients.toArray())
    intercept = float(lin.intercept)
    scalers = [s for s in stages if isinstance(s, StandardScalerModel)]
    if scalers:
        sc = scalers[0]
        std = list(sc.std.toArray())
        mean = list(sc.mean.toArray())
        w = [c / s if s != 0 else 0.0 for c, s in zip(coefs, std)]
        if sc.getWithMean():
            intercept -= sum(wi * m for wi, m in zip(w, mean))
        coefs = w
    return LinearScorer(intercept, tuple((f, float(c), None) for f, c in zip(features, coefs)))


def raw_score(df: DataFrame, u: UseCase, model, out: str = SCORE) -> DataFrame:
    """Append the unrounded score of ``model`` (LinearScorer, GrownForest or MLlib model)."""
    if isinstance(model, LinearScorer):
        return df.withColumn(out, model.column())
    if isinstance(model, GrownForest):
        return model.score(df, u.features, out)
    folded = fold_linear(model, u.features)
    if folded is not None:
        return df.withColumn(out, folded.column())
    from tidemark.operators.ml import assemble

    cols = df.columns
    fcol = _features_col(model)
    pred = model.getPredictionCol() if hasattr(model, "getPredictionCol") else "prediction"
    scored = model.transform(assemble(df.drop(fcol), u, out=fcol))
    return scored.select(*cols, F.col(pred).alias(out))


def _features_col(model) -> str:
    from pyspark.ml import PipelineModel

    first = model.stages[0] if isinstance(model, PipelineModel) else model
    for getter in ("getFeaturesCol", "getInputCol"):
        if hasattr(first, getter):
            return getattr(first, getter)()
    return "features"


def score(df: DataFrame, u: UseCase, model, score_col: str = "predicted_qoe", class_col: str = "qoe_class") -> DataFrame:
    """Score valid records: rounded score (half-even, 2 dp) and class of the
    unrounded score. Invalid records get no prediction (use ``quarantine``).
    """
    valid = df.filter(is_valid(u))
    scored = raw_score(valid, u, model)
    out = scored.withColumn(score_col, round2(F.col(SCORE))).withColumn(class_col, classify(F.col(SCORE), u))
    return with_score_defaults(out.drop(SCORE), score_col, class_col)
