"""Numeric expressions: buckets, scaling, losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_EPSILON = 1e-7


def clip_upper(col: Column, limit: float) -> Column:
    """``min(x, limit)``; a missing value stays missing."""
    return F.when(col.isNotNull(), F.least(col, F.lit(limit)))


def minmax_scale(col: Column, lo: Column, hi: Column, clip: float | None = None) -> Column:
    """``(x - lo) / (hi - lo)``, blank counts as 0, a zero range gives 0."""
    value = F.coalesce(col.cast("double"), F.lit(0.0))
    if clip is not None:
        value = F.least(value, F.lit(float(clip)))
    return F.coalesce(F.try_divide(value - lo, hi - lo), F.lit(0.0))


def bucket_minmax(col: Column, lo: Column, hi: Column, groups: int) -> Column:
    """``groups`` equal-width buckets numbered 0..groups-1."""
    width = (hi - lo) / F.lit(float(groups - 1))
    return F.coalesce(F.ceil(F.try_divide(col - lo, width)), F.lit(0)).cast("bigint")


def bucket_trimmed(col: Column, lo: Column, hi: Column, groups: int) -> Column:
    """Buckets between two order statistics.

    0 is missing, 1 is at or below ``lo``, ``groups - 1`` at or above ``hi``;
    the interior is split into ``groups - 3`` equal widths.
    """
    inside = F.ceil(F.lit(float(groups - 3)) * (col - lo) / (hi - lo))
    return (
        F.when(col.isNull(), F.lit(0))
        .when(col <= lo, F.lit(1))
        .when(col >= hi, F.lit(groups - 1))
        .otherwise(inside)
        .cast("bigint")
    )


def ratio_below_one(part: Column, whole: Column) -> Column:
    """``part / whole``; raises unless it is below 1."""
    ratio = part.cast("double") / whole.cast("double")
    return F.when(part < whole, ratio).otherwise(
        F.raise_error(F.concat(F.lit("ratio must be below 1: "), part.cast("string"), F.lit("/"), whole.cast("string")))
    )


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def logloss(label: Column, p: Column, epsilon: float = LOG_EPSILON) -> Column:
    """``-y ln(p + eps) - (1 - y) ln(1 - p + eps)``."""
    y = label.cast("double")
    return -y * F.ln(p + F.lit(epsilon)) - (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p + F.lit(epsilon))


def logloss_from_logit(label: Column, logit: Column) -> Column:
    """Cross entropy of a logit: ``max(x, 0) - x*y + ln(1 + exp(-|x|))``."""
    y = label.cast("double")
    return F.greatest(logit, F.lit(0.0)) - logit * y + F.log1p(F.exp(-F.abs(logit)))


def focal(label: Column, p: Column, alpha: float = 0.25, gamma: float = 2.0, form: str = "linear") -> Column:
    """Focal loss term.

    ``linear`` scales the positive term by ``(1 - p) * gamma``; ``power`` uses
    ``(1 - p) ** gamma`` (Lin et al., 2017).  The negative term uses
    ``p ** gamma`` in both.
    """
    if form not in ("linear", "power"):
        raise ValueError(f"unknown focal form {form!r}")
    y = label.cast("double")
    miss = F.lit(1.0) - p
    hard = miss * F.lit(float(gamma)) if form == "linear" else F.pow(miss, F.lit(float(gamma)))
    tiny = F.lit(LOG_EPSILON)
    positive = -y * F.lit(1.0 - alpha) * hard * F.ln(F.greatest(p, tiny))
    negative = (F.lit(1.0) - y) * F.lit(alpha) * F.pow(p, F.lit(float(gamma))) * F.ln(F.greatest(miss, tiny))
    return positive - negative
