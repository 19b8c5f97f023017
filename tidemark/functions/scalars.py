"""Scalar Column functions (JVM-side expressions, no Python in the plan)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spec import CLASS_ORDER, SEVERITY_BANDS, SEVERITY_CUTS, UseCase

UNKNOWN_CLASS = "Unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_number(x) -> Column:
    """Not null and not NaN."""
    x = _c(x)
    return x.isNotNull() & ~F.isnan(x)


def classify(score, u: UseCase) -> Column:
    """Score -> class label; cuts are lower-inclusive (2.0 is the next class).

    A null or NaN score has no class and maps to ``Unknown``.
    """
    s = _c(score)
    expr = F.when(~is_number(s), F.lit(UNKNOWN_CLASS))
    for cut, label in zip(u.cuts, u.labels):
        expr = expr.when(s < F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(u.labels[-1]))


def round2(x) -> Column:
    """Round half to even at 2 decimals (the stored score), as numpy does."""
    return F.rint(_c(x) * F.lit(100.0)) / F.lit(100.0)


def round_class(y) -> Column:
    """Round half to even to an integer class id."""
    return F.rint(_c(y)).cast("int")


def clamp(x, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Clamp into [lo, hi]; a NaN or null stays null (it cannot be plotted)."""
    x = _c(x)
    return F.when(is_number(x), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def severity_band(x) -> Column:
    """Colour band of a score: red < 2 <= amber < 3 <= blue < 4 <= green."""
    x = _c(x)
    expr = F.when(~is_number(x), F.lit(None).cast("string"))
    for cut, band in zip(SEVERITY_CUTS, SEVERITY_BANDS):
        expr = expr.when(x < F.lit(cut), F.lit(band))
    return expr.otherwise(F.lit(SEVERITY_BANDS[-1]))


def class_rank(c, order: tuple[str, ...] = CLASS_ORDER) -> Column:
    """Display position of a class; unknown classes get 999 (then sort by name)."""
    pos = F.array_position(F.array(*[F.lit(o) for o in order]), _c(c))
    return F.coalesce(F.nullif(pos, F.lit(0)), F.lit(999)).cast("int")


# Dashboard class colours (background, border); 'Bad' is an alias
# of 'Poor'; anything else gets the neutral default.
CLASS_COLORS = {
    "Poor": ("rgba(239, 68, 68, 0.8)", "rgba(239, 68, 68, 1)"),
    "Bad": ("rgba(239, 68, 68, 0.8)", "rgba(239, 68, 68, 1)"),
    "Fair": ("rgba(251, 191, 36, 0.8)", "rgba(251, 191, 36, 1)"),
    "Good": ("rgba(59, 130, 246, 0.8)", "rgba(59, 130, 246, 1)"),
    "Excellent": ("rgba(34, 197, 94, 0.8)", "rgba(34, 197, 94, 1)"),
}
DEFAULT_COLOR = "rgba(148, 163, 184, 0.8)"


def class_color(c, kind: str = "bg") -> Column:
    """Class -> colour lookup with default (a map literal, no join)."""
    idx = 0 if kind == "bg" else 1
    pairs = []
    for k, v in CLASS_COLORS.items():
        pairs += [F.lit(k), F.lit(v[idx])]
    return F.coalesce(F.element_at(F.create_map(*pairs), _c(c)), F.lit(DEFAULT_COLOR))


def ts_text(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss`` (session zone, UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def iso_utc(ts) -> Column:
    """Timestamp -> ISO-8601 with an explicit UTC offset (``+00:00``)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def clock_label(ts) -> Column:
    return F.date_format(_c(ts), "HH:mm:ss")


def yyyymm(ts) -> Column:
    """Month partition key, ``toYYYYMM``; an int like 202401."""
    return (F.year(_c(ts)) * F.lit(100) + F.month(_c(ts))).cast("int")


def second_now() -> Column:
    """``now()`` at second precision (one value per query / micro-batch)."""
    return F.date_trunc("second", F.current_timestamp())


def parse_ts(s, fallback=None) -> Column:
    """Parse an ISO timestamp text; unparsable -> fallback (default: now)."""
    fb = F.current_timestamp() if fallback is None else _c(fallback)
    return F.coalesce(F.try_to_timestamp(_c(s)), fb)


def _decimals(x: Column, scale: float, even: bool) -> Column:
    """Round the binary value, not its shortest decimal text (2.675 is below the tie, so 2.67).

    ``a * scale`` may itself be rounded onto a tie; what it lost is exact in two
    halves of ``a`` and says on which side of the tie the value lies.
    """
    a = F.abs(x)
    big = a * F.lit(134217729.0)
    high = big - (big - a)
    y = a * F.lit(scale)
    lost = (high * F.lit(scale) - y) + (a - high) * F.lit(scale)
    down = F.floor(y).cast("double")
    tie = y - down == 0.5
    n = F.when(~tie, F.rint(y)).when(lost < 0, down).when(lost > 0, down + 1).otherwise(F.rint(y) if even else down + 1)
    return F.when(x < 0, -n).otherwise(n) / F.lit(scale)


def fixed2(x) -> Column:
    """Number -> text with exactly two decimals; a tie goes away from zero."""
    return F.format_string("%.2f", _decimals(_c(x).cast("double"), 100.0, even=False))


def percent2(x) -> Column:
    """Share -> percent text with two decimals; a tie goes to the even digit."""
    return F.format_string("%.2f%%", _decimals(_c(x).cast("double") * F.lit(100.0), 100.0, even=True))


def fixed4(x) -> Column:
    """Number -> text with four decimals; a tie goes to the even digit."""
    return F.format_string("%.4f", _decimals(_c(x).cast("double"), 10000.0, even=True))


def to_count(x) -> Column:
    """Loose number coercion of a count cell: unparsable/empty/null -> 0, fractions kept."""
    n = F.expr(f"try_cast(trim({_name(x)}) AS DOUBLE)")
    return F.when(is_number(n), n).otherwise(F.lit(0.0))


def _name(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("to_count takes a column name")


def with_score_defaults(df, score: str = "predicted_qoe", klass: str = "qoe_class"):
    """Missing score -> 0.0, missing class -> 'Unknown'."""
    return df.withColumn(score, F.coalesce(F.col(score), F.lit(0.0))).withColumn(
        klass, F.coalesce(F.col(klass), F.lit(UNKNOWN_CLASS))
    )
