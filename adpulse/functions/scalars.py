"""Scalar column expressions of the pipeline (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Day parts: fixed hour boundaries of the reference (start inclusive).
DAY_PARTS = (("morning", 5, 12), ("afternoon", 12, 17), ("evening", 17, 21))
NIGHT = "night"


def time_of_day(hour) -> Column:
    """Hour -> morning/afternoon/evening; every other hour and a null hour -> night."""
    h = _c(hour)
    expr = None
    for label, lo, hi in DAY_PARTS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)


def created_parts(created) -> dict[str, Column]:
    """created (string or timestamp) -> created_ts, created_date, created_hour."""
    ts = F.try_to_timestamp(_c(created).cast("string"))
    return {
        "created_ts": ts,
        "created_date": F.to_date(ts),
        "created_hour": F.hour(ts),
    }


def keyword_flag(text, pattern: str = "bonus|benefit") -> Column:
    """Case-insensitive regex hit; a null text gives false, never null."""
    return F.coalesce(F.lower(_c(text)).rlike(pattern), F.lit(False))


def flag_to_bool(flag) -> Column:
    """'1' -> true, other integers -> false, null or non-numeric text -> null."""
    return _c(flag).try_cast("int") == F.lit(1)


def clamp(x, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi]; null stays null."""
    c = _c(x)
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def ceil_step(x, step: float) -> Column:
    """Round up to the next multiple of ``step`` (as double)."""
    return (F.ceil(_c(x) / F.lit(step)) * F.lit(step)).cast("double")


def blank_to_null(x) -> Column:
    c = _c(x)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def place_name_fallback(*candidates) -> Column:
    """First non-blank of e.g. city, town, road (empty text falls through)."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def remaining_days(d) -> Column:
    """Days from ``d`` to the first day of the next month (1..31)."""
    c = _c(d)
    return F.datediff(F.add_months(F.trunc(c, "month"), 1), c)


def ratio_if_positive(num, den) -> Column:
    """num / den when den > 0, else null (CASE WHEN d > 0 THEN n / d)."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n.cast("double") / d.cast("double"))


def ratio_nullif(num, den) -> Column:
    """num / NULLIF(den, 0) in double."""
    n, d = _c(num), _c(den)
    return n.cast("double") / F.nullif(d, F.lit(0)).cast("double")
